"""Exactly-once archive of a topic, and idempotent micro-batch writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream import schemas
from riskstream.functions.headers import event_hour
from riskstream.operators.bronze import to_bronze
from riskstream.session import Scratch, counted
from riskstream.sources.ledger import STORED, Ledger, inside, spans_of
from riskstream.sources.tables import ROWS_PER_FILE, ensure_table, register, write_by_hour

COMMIT_INTERVAL = "5 seconds"
#: Hours of a batch up to which archived rows are read by a list of hours; beyond, by first and last hour.
_MAX_LISTED_HOURS = 100


def archive(
    records: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    trigger: dict | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    table: str | None = None,
) -> StreamingQuery:
    """Append a stream of Kafka records to the archive at ``path``.

    One query and one checkpoint per topic: a stopped or failing feed does not hold
    up the other. A batch that is run again after a failure, and offsets replayed
    under a new checkpoint, add nothing. With ``table``, that table is created unless it
    exists and shows each batch once it is archived.
    """
    if table:
        ensure_table(records.sparkSession, table, path, STORED, "event_hour, commit")

    def write(batch: DataFrame, batch_id: int) -> None:
        append_new(to_bronze(batch), path, batch_id, rows_per_file, table)

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**(trigger or {"processingTime": COMMIT_INTERVAL}))
        .start()
    )


def append_new(
    bronze: DataFrame,
    path: str,
    batch_id: int,
    rows_per_file: int = ROWS_PER_FILE,
    table: str | None = None,
) -> None:
    """Append the rows whose (topic, partition, offset) the archive lacks.

    A batch holds an offset once, as a topic does. Rows beyond the ledger's intervals are new: they
    are written as the batch is read, once, and no archived file is opened. Rows inside an interval
    are compared with archived rows of their own hours and offsets. The hours a batch reaches are
    registered with ``table``, if that is given.
    """
    ledger = Ledger(bronze.sparkSession, path)
    number, state = ledger.reserve()
    rows = bronze.withColumns(
        {
            "batch_id": F.lit(batch_id).cast("bigint"),
            "event_hour": event_hour(F.col("event_time")),
            "commit": F.lit(number).cast("bigint"),
        }
    )
    spans = ledger.spans(state)
    if spans is None:
        write_by_hour(rows, path, rows_per_file)
    else:
        seen = Observation()
        watched = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        write_by_hour(watched.join(spans, inside(), "left_anti"), path, rows_per_file)
    # From the files just written; of them only the columns that name an offset.
    hours, own = ledger.of(number)
    ranges, n_new = spans_of(own) if own else ([], 0)
    if spans is not None:
        # Without new rows the count may never have been made.
        left = seen.get["n"] > n_new if n_new else not rows.isEmpty()
        if left:
            with Scratch() as made:
                again = _missing(rows.join(spans, inside(), "left_semi"), ledger, state)
                if again is not None:
                    write_by_hour(again, path, rows_per_file)
                    hours, own = ledger.of(number)
                made.remove()
            # These lie inside intervals that are known.
    ledger.confirm(number, ranges)
    if table:
        register(bronze.sparkSession, table, path, [(h, number) for h in hours])


def _missing(rows: DataFrame, ledger: Ledger, state: dict) -> DataFrame | None:
    """Those of ``rows`` that no confirmed commit holds, or None if there are none.

    A record has one event time, so a copy of it lies in the same hour. Offsets alone are compared
    first, so a batch that was archived before is never shuffled or sorted with its payloads.
    """
    # A row for each hour, as the batch has folders: the range of offsets is that of all of them.
    offset = F.col("kafka_offset")
    places = rows.groupBy("event_hour").agg(F.min(offset), F.max(offset)).collect()
    if not places:
        return rows
    near = offset.between(min(p[1] for p in places), max(p[2] for p in places))
    hour, named = F.col("event_hour"), [p[0] for p in places if p[0] is not None]
    if len(named) <= _MAX_LISTED_HOURS:
        own = hour.isin(named)
    else:
        own = hour.between(min(named), max(named))
    near = near & (own if len(named) == len(places) else own | hour.isNull())
    stored = ledger.rows(state).where(near).select(*schemas.BRONZE_KEY, "event_hour")
    stored = stored.drop("event_hour")
    lacked = rows.select(*schemas.BRONZE_KEY).join(stored, schemas.BRONZE_KEY, "left_anti")
    lacked, n = counted(lacked, "archive-missing")
    return rows.join(lacked, schemas.BRONZE_KEY, "left_semi") if n else None


def path_exists(spark, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def write_batch(
    df: DataFrame, path: str, batch_id: int, by: list[str] | None = None
) -> None:
    """Write a micro-batch as partition ``batch_id`` (below the partitions ``by``).

    A batch run again writes the same partitions and replaces its earlier try.
    """
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(by or []), "batch_id")
        .parquet(path)
    )
