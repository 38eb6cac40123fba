"""Column functions: ``Column -> Column``, all inside whole-stage codegen where Spark allows."""
