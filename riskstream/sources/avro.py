"""Avro record values to JSON text. Needs the spark-avro package on the classpath."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A registry-framed value starts with a zero byte and a four-byte schema id.
FRAME_BYTES = 5


def avro_to_json(value: Column, schema_json: str, framed: bool = True) -> Column:
    """JSON text of a binary Avro value written with ``schema_json``; null stays null."""
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(value, FRAME_BYTES + 1, 2**31 - 1) if framed else value
    return F.to_json(from_avro(body, schema_json), {"ignoreNullFields": "false"})


def writer_schema_id(value: Column) -> Column:
    """Schema id a framed value was written with."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
