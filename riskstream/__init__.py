"""riskstream: streaming risk analytics as plain Spark DataFrame jobs."""
