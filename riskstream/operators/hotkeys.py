"""Find keys that dominate a feed, and tracked keys that have cooled down.

``messages`` has the archive's columns. The clock is the parameter ``as_of``,
never wall time, so a scan can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.keys import strip_salt

HEAVY_SHARE = 0.02
LOOKBACK_SECONDS = 600
_PART = ["kafka_topic", "kafka_partition"]


def recent(
    messages: DataFrame,
    as_of: Column,
    lookback_seconds: int = LOOKBACK_SECONDS,
    max_messages: int | None = None,
    whole_topic: bool = False,
    time: str = "ingest_time",
) -> DataFrame:
    """The messages of each partition in the lookback window.

    A partition is read from its first offset at or after ``as_of - lookback``. A
    quiet partition with no such message is read from its lowest offset instead.
    ``max_messages`` reads only that many of the newest offsets, for a quick look at a
    live topic; with ``whole_topic`` they are shared evenly by the topic's partitions,
    at least one message each.
    """
    seen = messages.where(F.col(time) <= as_of)
    window_start = as_of - F.expr(f"interval {int(lookback_seconds)} seconds")
    # One row per topic partition, a number the broker fixes: small enough to broadcast.
    bounds = seen.groupBy(*_PART).agg(
        F.min("kafka_offset").alias("_low"),
        (F.max("kafka_offset") + 1).alias("_high"),
        F.min(F.when(F.col(time) >= window_start, F.col("kafka_offset"))).alias("_first"),
    )
    start = F.coalesce("_first", "_low")
    if max_messages is not None:
        limit = F.lit(max_messages)
        if whole_topic:
            parts = bounds.groupBy("kafka_topic").agg(F.count(F.lit(1)).alias("_parts"))
            bounds = bounds.join(F.broadcast(parts), "kafka_topic")
            limit = F.greatest(F.floor(F.lit(max_messages) / F.col("_parts")), F.lit(1))
        start = F.greatest(start, F.col("_high") - limit)
    bounds = bounds.select(*_PART, start.alias("_start"))
    return (
        seen.join(F.broadcast(bounds), _PART)
        .where(F.col("kafka_offset") >= F.col("_start"))
        .drop("_start")
    )


def key_shares(sample: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Messages and traffic share per unsalted key, of the whole sample or within ``by``.

    ``by`` is topic or partition. An empty sample gives no rows.
    """
    counts = _counts(sample, by or [])
    # Totals come from the counts, so the sample is read once.
    if by:
        totals = counts.groupBy(*by).agg(F.sum("n").alias("total"))
        shares = counts.join(totals, by)
    else:
        shares = counts.withColumn("total", counts.select(F.sum("n")).scalar())
    return shares.withColumn("share", F.col("n") / F.col("total"))


def _counts(sample: DataFrame, by: list[str]) -> DataFrame:
    return (
        sample.where(F.col("kafka_key").isNotNull())
        .groupBy(*by, strip_salt(F.col("kafka_key")).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def detect(
    sample: DataFrame, tracked: DataFrame, threshold: float = HEAVY_SHARE
) -> DataFrame:
    """Keys above ``threshold`` of their partition's traffic, new or already tracked."""
    heavy = key_shares(sample, _PART).where(F.col("share") > threshold)
    known = tracked.select(F.col("key").alias("_known")).distinct()
    status = F.when(F.col("_known").isNull(), "new").otherwise("already tracked")
    return (
        heavy.join(known, F.col("key") == F.col("_known"), "left")
        .withColumn("status", status)
        .drop("_known")
    )


def demote(sample: DataFrame, tracked: DataFrame, threshold: float = HEAVY_SHARE) -> DataFrame:
    """Tracked keys below ``threshold`` of the whole topic; unseen keys count as zero.

    An empty sample proves nothing and gives no rows.
    """
    counts = _counts(sample, [])
    total = counts.select(F.sum("n")).scalar()
    seen = tracked.select("key").distinct().join(counts, "key", "left")
    return (
        seen.withColumns({"n": F.coalesce("n", F.lit(0)), "total": total})
        .where(F.col("total") > 0)
        .withColumn("share", F.col("n") / F.nullif(F.col("total"), F.lit(0)))
        .where(F.col("share") < threshold)
    )


def added(heavy: DataFrame, tracked: DataFrame) -> DataFrame:
    """Heavy keys not tracked yet."""
    return heavy.select("key").subtract(tracked.select("key"))


def already_tracked(heavy: DataFrame, tracked: DataFrame) -> DataFrame:
    return heavy.select("key").intersect(tracked.select("key"))


def with_added(tracked: DataFrame, new: DataFrame) -> DataFrame:
    """Union; a scan of one partition never drops the keys of another."""
    return tracked.select("key").union(new.select("key")).distinct()


def without_cooled(tracked: DataFrame, cooled: DataFrame) -> DataFrame:
    return tracked.select("key").subtract(cooled.select("key"))


def listed(keys: DataFrame) -> DataFrame:
    """Distinct keys in order, as the set is stored and shown."""
    return keys.select("key").distinct().orderBy("key")


def propose(heavy: DataFrame, cooled: DataFrame, tracked: DataFrame) -> DataFrame:
    """Pending changes to the tracked set, to be approved by a person."""
    adds = added(heavy, tracked).withColumn("action", F.lit("add"))
    drops = cooled.select("key").distinct().withColumn("action", F.lit("remove"))
    return adds.unionByName(drops).withColumn("status", F.lit("pending"))


def apply_approved(tracked: DataFrame, proposals: DataFrame) -> DataFrame:
    """The tracked set after the approved proposals; pending and rejected ones change nothing."""
    approved = proposals.where(F.col("status") == "approved")
    grown = with_added(tracked, approved.where(F.col("action") == "add"))
    return without_cooled(grown, approved.where(F.col("action") == "remove"))


def diagnose(sample: DataFrame, threshold: float = HEAVY_SHARE) -> DataFrame:
    """Why a partition is heavy: one dominant key, or several keys that hash together.

    Salting helps only in the first case.
    """
    top = key_shares(sample, _PART).groupBy(*_PART).agg(
        F.max("share").alias("max_share"), F.count(F.lit(1)).alias("n_keys")
    )
    cause = F.when(F.col("max_share") > threshold, "hot key").otherwise("collision")
    return top.withColumn("cause", cause)


def chronic(scans: DataFrame, min_scans: int = 2) -> DataFrame:
    """Keys found hot in ``min_scans`` or more scans (columns ``scan_id``, ``key``)."""
    found = scans.select("scan_id", "key").distinct()
    return (
        found.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_scans"))
        .where(F.col("n_scans") >= min_scans)
    )
