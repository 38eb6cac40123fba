"""Topic scans. The Kafka connector must be on the classpath of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRANSACTIONS, IDENTITIES = "transactions.raw", "identities.raw"


def stream_topic(
    spark: SparkSession,
    brokers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """One topic from its earliest offset. Progress is kept by the query's checkpoint,
    so two queries over the same topic do not affect each other."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
        .options(**options)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def read_topic_since(
    spark: SparkSession, brokers: str, topic: str, since_millis: int, **options: str
) -> DataFrame:
    """Bounded scan from a time. A partition with nothing that recent is not read at all;
    use ``operators.hotkeys.recent`` over the archive where it should be read from its start."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingTimestamp", str(since_millis))
        .option("startingOffsetsByTimestampStrategy", "latest")
        .option("endingOffsets", "latest")
        .option("includeHeaders", "true")
        .options(**options)
        .load()
    )
