"""Kafka records to archive rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.functions.headers import event_time, header, utf8


def to_bronze(records: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """The ten archive columns of each record, untransformed but for text decoding.

    ``ingest_time`` is the processing time of the micro-batch.
    """
    headers = F.col("headers")
    columns = {
        "kafka_key": utf8(F.col("key")),
        "kafka_value": utf8(F.col("value")),
        "kafka_topic": F.col("topic"),
        "kafka_partition": F.col("partition"),
        "kafka_offset": F.col("offset"),
        "event_time": event_time(header(headers, "event-time")),
        "ingest_time": ingest_time if ingest_time is not None else F.current_timestamp(),
        "source_service": header(headers, "source-service"),
        "run_id": header(headers, "run-id"),
        "schema_version": header(headers, "schema-version"),
    }
    return records.select(*[columns[n].alias(n) for n in schemas.BRONZE.names])
