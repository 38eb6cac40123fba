"""Archive and reference tables on shared storage."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schemas
from riskstream.functions.headers import event_hour
from riskstream.sources.ledger import NO_HOUR, STORED, Ledger

ROWS_PER_FILE = 1_000_000


def ensure_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType = schemas.ARCHIVE,
    partition: str = "event_hour",
) -> None:
    """Create namespace and table unless they exist; a rerun changes nothing."""
    if "." in name:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({partition}) LOCATION '{path}'"
    )


def register(spark: SparkSession, name: str, path: str, parts: list[tuple[str, int]]) -> None:
    """Show folders of the archive, named by hour and commit, in a table over it."""
    for at in range(0, len(parts), 100):
        named = " ".join(
            f"PARTITION (event_hour='{hour}', commit={commit}) "
            f"LOCATION '{path}/commit={commit}/event_hour={hour}'"
            for hour, commit in parts[at : at + 100]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {named}")


def read_archive(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    batch_id: int | None = None,
) -> DataFrame:
    """The archive, limited to event times in ``[start, end)`` and to batches up to ``batch_id``.

    The time limits are also put on the hour partitions, so files outside them are
    never opened. Rows without event time are read only when no limit is given.
    """
    ledger = Ledger(spark, path)
    # A folder that no ledger belongs to is read as it is.
    known = ledger.exists()
    rows = ledger.rows().drop("commit") if known else spark.read.schema(schemas.ARCHIVE).parquet(path)
    for text, closed in ((start, True), (end, False)):
        if text is None:
            continue
        limit = F.to_timestamp(F.lit(text))
        hour = event_hour(limit)
        if closed:
            rows = rows.where((F.col("event_time") >= limit) & (F.col("event_hour") >= hour))
        else:
            rows = rows.where((F.col("event_time") < limit) & (F.col("event_hour") <= hour))
    if batch_id is not None:
        rows = rows.where(F.col("batch_id") <= batch_id)
    return rows


def hourly_counts(archive: DataFrame) -> DataFrame:
    return archive.groupBy("event_hour").agg(F.count(F.lit(1)).alias("n"))


def load_reference(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a reference table and return it as stored.

    ``overwrite`` makes a rerun harmless; ``append`` adds the rows again on every run.
    """
    df.write.mode(mode).option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_hour(rows: DataFrame, path: str, rows_per_file: int) -> None:
    """Append rows to their hours, in few files each.

    Rows are gathered by hour; a heavy hour is split, and light ones share a task, by their size
    after the shuffle.
    """
    (
        rows.hint("rebalance", F.col("event_hour"))
        .select(*STORED.names)
        .sortWithinPartitions("event_hour", *schemas.BRONZE_KEY)
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("commit", "event_hour")
        .parquet(path)
    )


def compact(
    spark: SparkSession,
    path: str,
    closed_before: str | None = None,
    least_commits: int = 2,
    rows_per_file: int = ROWS_PER_FILE,
    table: str | None = None,
) -> list[str | None]:
    """Rewrite hours with ``least_commits`` commits or more into few files; rows stay the same.

    Only hours before ``closed_before`` (``yyyy-MM-dd-HH``), if given, and rows without an hour.
    The new files replace the old ones in one step of the ledger. Batches appended meanwhile have
    commits of their own and stay; a reader that began before goes on with the old files, which
    ``Ledger.vacuum`` deletes later.
    """
    ledger = Ledger(spark, path)
    number, state = ledger.reserve()
    running = [n for n in state["hidden"] if n != number]
    commits = defaultdict(list)
    for hour, commit in ledger.folders():
        base, *others = state["bases"].get(hour or "", [0])
        if commit not in state["hidden"] and (commit >= base or commit in others):
            commits[hour].append(commit)
    hours = [
        hour
        for hour, found in sorted(commits.items(), key=lambda x: x[0] or "")
        if len(found) >= least_commits and (closed_before is None or (hour or "") < closed_before)
    ]
    if hours:
        named = F.coalesce("event_hour", F.lit("")).isin([hour or "" for hour in hours])
        old = ledger.rows(state).where(named)
        write_by_hour(old.withColumn("commit", F.lit(number).cast("bigint")), path, rows_per_file)
    ledger.replace(number, hours, running)
    if table:
        for hour in hours:
            for commit in commits[hour]:
                gone = f"event_hour='{hour or NO_HOUR}', commit={commit}"
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({gone})")
        register(spark, table, path, [(hour or NO_HOUR, number) for hour in hours])
    return hours
