"""Operational checks over archived and scored data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SIZE_RATIO = 1.5
HOLD_MINUTES = 5


def partition_skew(
    messages: DataFrame,
    time: str = "ingest_time",
    ratio: float = SIZE_RATIO,
    hold_minutes: int = HOLD_MINUTES,
) -> DataFrame:
    """Per topic and minute: largest against average partition size, and whether to alert.

    A partition's size is all bytes it has received so far. The alert fires once the
    ratio has stayed above ``ratio`` for ``hold_minutes``. Rows are reduced to one per
    (partition, minute) before any window, so windows grow with minutes, not messages.
    """
    size = F.coalesce(F.octet_length("kafka_key"), F.lit(0)) + F.coalesce(
        F.octet_length("kafka_value"), F.lit(0)
    )
    part = ["kafka_topic", "kafka_partition"]
    minutes = messages.groupBy(
        *part, F.floor(F.unix_micros(time) / 60_000_000).cast("bigint").alias("minute")
    ).agg(F.sum(size).alias("bytes"))
    so_far = Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    own = so_far.partitionBy(*part)
    first = F.row_number().over(Window.partitionBy(*part).orderBy("minute")) == 1
    sizes = minutes.withColumns({"size": F.sum("bytes").over(own), "_first": first})
    per_minute = sizes.groupBy("kafka_topic", "minute").agg(
        F.max("size").alias("top"),
        F.sum("bytes").alias("bytes"),
        F.count_if("_first").alias("_new"),
    )
    topic = so_far.partitionBy("kafka_topic")
    ratios = (
        # Sizes never shrink, so the running maximum is the largest size at that minute.
        per_minute.withColumns(
            {
                "max_size": F.max("top").over(topic),
                "total": F.sum("bytes").over(topic),
                "n_partitions": F.sum("_new").over(Window.partitionBy("kafka_topic")),
            }
        )
        .withColumn("avg_size", F.col("total") / F.col("n_partitions"))
        .withColumn("size_ratio", F.col("max_size") / F.nullif(F.col("avg_size"), F.lit(0)))
        .withColumn("breach", F.coalesce(F.col("size_ratio") > ratio, F.lit(False)))
    )
    last_fine = F.max(F.when(~F.col("breach"), F.col("minute"))).over(topic)
    ratios = ratios.withColumn("_last_fine", last_fine)
    run = Window.partitionBy("kafka_topic", "_last_fine").orderBy("minute")
    since = F.min(F.when(F.col("breach"), F.col("minute"))).over(
        run.rowsBetween(Window.unboundedPreceding, 0)
    )
    held = F.when(F.col("breach"), F.col("minute") - since).otherwise(0)
    return ratios.withColumn("held_minutes", held).select(
        "kafka_topic",
        "minute",
        "max_size",
        "avg_size",
        "size_ratio",
        "held_minutes",
        (F.col("breach") & (F.col("held_minutes") >= hold_minutes)).alias("alert"),
    )


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def lag_summary(
    rows: DataFrame, lag_millis: Column, by: list[Column], share: float = 0.99
) -> DataFrame:
    """Rows, mean, exact percentile and maximum of a lag in whole milliseconds, per group.

    Rows are first counted per (group, lag). The percentile is then found by a
    running count over a group's distinct lags, which spills instead of holding
    them in memory, so a group's size does not matter.
    """
    names = [f"_by{i}" for i in range(len(by))]
    counts = (
        rows.select(*[c.alias(n) for c, n in zip(by, names)], lag_millis.alias("_lag"))
        .where(F.col("_lag").isNotNull())
        .groupBy(*names, "_lag")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    group = Window.partitionBy(*names)
    ranked = counts.withColumns(
        {
            "_upto": F.sum("_n").over(group.orderBy("_lag")),
            "_rank": share * (F.sum("_n").over(group) - 1),
        }
    )
    reached = F.col("_upto") > F.floor("_rank")
    passed = F.col("_upto") > F.ceil("_rank")
    summary = ranked.groupBy(*names).agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col("_lag") * F.col("_n")) / F.sum("_n")).alias("avg_ms"),
        F.min(F.when(reached, F.col("_lag"))).alias("_low"),
        F.min(F.when(passed, F.col("_lag"))).alias("_high"),
        F.max("_rank").alias("_rank"),
        F.max("_lag").alias("max_ms"),
    )
    part = F.col("_rank") - F.floor("_rank")
    value = F.col("_low") + (F.col("_high") - F.col("_low")) * part
    return summary.select(*names, "n", "avg_ms", value.alias("p_ms"), "max_ms")


def latency_summary(
    decisions: DataFrame, event_time: str, decided_at: str, by: str = "decision"
) -> DataFrame:
    """Mean and p99 latency per decision, from micros to milliseconds rounded down."""
    lag = F.floor((F.col(decided_at) - F.col(event_time)) / 1000).cast("bigint")
    return lag_summary(decisions, lag, [F.col(by)]).withColumnsRenamed(
        {"_by0": by, "p_ms": "p99_ms"}
    )


def freshness_lag(
    outputs: DataFrame,
    event_time: str,
    available_at: str,
    window_seconds: int = 3600,
    limit_ms: int = 5000,
) -> DataFrame:
    """Per window of availability: how stale outputs were, and whether the limit was broken."""
    lag = F.floor((F.col(available_at) - F.col(event_time)) / 1000).cast("bigint")
    start = F.col(available_at) - F.pmod(F.col(available_at), F.lit(window_seconds * 1_000_000))
    return (
        lag_summary(outputs, lag, [start])
        .withColumnsRenamed({"_by0": "window_start_us", "p_ms": "p99_ms"})
        .withColumn("breach", F.col("max_ms") > limit_ms)
    )


def throughput(messages: DataFrame, time_us: str, window_seconds: int = 600) -> DataFrame:
    """Messages and messages per second for each topic and window."""
    start = F.col(time_us) - F.pmod(F.col(time_us), F.lit(window_seconds * 1_000_000))
    return (
        messages.groupBy("kafka_topic", start.alias("window_start_us"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rows_per_second", F.col("n") / window_seconds)
    )


def offset_lag(produced: DataFrame, archived: DataFrame) -> DataFrame:
    """Offsets each partition still has to archive; all of them if none is archived yet."""
    part = ["kafka_topic", "kafka_partition"]
    made = produced.groupBy(*part).agg(
        F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("produced_offset")
    )
    kept = archived.groupBy(*part).agg(F.max("kafka_offset").alias("archived_offset"))
    done = F.coalesce("archived_offset", F.col("first_offset") - 1)
    return made.join(kept, part, "left").select(
        *part,
        "produced_offset",
        "archived_offset",
        (F.col("produced_offset") - done).alias("offset_lag"),
    )
