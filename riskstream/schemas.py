"""Schemas of the feeds and of the archive."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

# What spark.readStream.format("kafka") with includeHeaders returns.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", HEADERS),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("kafka_value", T.StringType()),
        T.StructField("kafka_topic", T.StringType(), False),
        T.StructField("kafka_partition", T.IntegerType(), False),
        T.StructField("kafka_offset", T.LongType(), False),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("ingest_time", T.TimestampType(), False),
        T.StructField("source_service", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("schema_version", T.StringType()),
    ]
)
BRONZE_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]

# The archive adds the micro-batch that wrote the row and the partition column.
ARCHIVE = T.StructType(
    BRONZE.fields
    + [T.StructField("batch_id", T.LongType()), T.StructField("event_hour", T.StringType())]
)


def _event(required: list[tuple[str, T.DataType]], columns: list[tuple[str, T.DataType]]):
    return T.StructType(
        [T.StructField(name, kind, False) for name, kind in required]
        + [T.StructField(name, kind) for name, kind in columns]
    )


def _numbered(prefix: str, last: int, kind: T.DataType) -> list[tuple[str, T.DataType]]:
    return [(f"{prefix}{i}", kind) for i in range(1, last + 1)]


def transaction() -> T.StructType:
    """Version 1 of the transaction event: 386 fields in wire order, two of them required.

    Fixed values: names, order, types and which fields are required.
    """
    double, text = T.DoubleType(), T.StringType()
    columns = [
        ("isFraud", double),
        ("TransactionDT", double),
        ("TransactionAmt", double),
        ("card1", double),
        *_numbered("dist", 2, double),
        *_numbered("C", 14, double),
        *_numbered("D", 15, double),
        *_numbered("M", 9, text),
        *_numbered("V", 339, double),
        ("user_reference_sk", double),
        ("merchant_data_sk", double),
    ]
    return T.StructType(
        [T.StructField("TransactionID", T.LongType(), False)]
        + [T.StructField(name, kind, name != "TransactionDT") for name, kind in columns]
    )


# The identity columns that hold text; all other id_ columns are numbers.
IDENTITY_TEXT = ["id_12", "id_15", "id_16", "id_28", "id_29", "id_30", "id_31", "id_33",
                 "id_34", "id_35", "id_36", "id_37", "id_38", "DeviceType", "DeviceInfo"]


def identity() -> T.StructType:
    """Version 1 of the identity event: 41 fields, only the id is required."""
    names = [f"id_{i:02d}" for i in range(1, 39)] + ["DeviceType", "DeviceInfo"]
    kinds = [(n, T.StringType() if n in IDENTITY_TEXT else T.DoubleType()) for n in names]
    return _event([("TransactionID", T.LongType())], kinds)


WATCHLIST = T.StructType(
    [T.StructField("kind", T.StringType(), False), T.StructField("value", T.StringType(), False)]
)
TRACKED_KEYS = T.StructType([T.StructField("key", T.StringType(), False)])

USER_ATTRIBUTES = ["card2", "card3", "card4", "card5", "card6", "addr1", "addr2",
                   "P_emaildomain", "R_emaildomain"]
