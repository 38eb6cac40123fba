"""Operators: ``DataFrame -> DataFrame`` with parameters; nothing here collects data."""
