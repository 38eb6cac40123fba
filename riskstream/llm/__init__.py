"""Operators that prepare training text: counting, mixing, cleaning, formatting, de-duplication."""
