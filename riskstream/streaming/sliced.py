"""Rolling features on a stream whose heaviest card outgrows a task.

``streaming.features`` keeps each card's state in one task, which is right while no
card dominates. Here a micro-batch is an ordinary batch job over stored rows, with
the sliced plan of ``operators.rolling``: a card of any weight is spread over its
time slices, and no state lives in an executor. Tables under ``store``:

* ``rows``   accepted rows by (slice, batch);
* ``sums``   one row per (card, slice), written once the watermark has passed the slice;
* ``last``   per batch the time of each card's newest emitted row;
* ``marks``  per batch the newest time seen and the rows that came too late.

A batch reads only the slices its rows' frames begin or end in, and the sums of the
slices between. Every table is written under the batch's id, so a batch run again
replaces what its first try left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskstream.functions.scalars import MICROS
from riskstream.operators.rolling import WINDOWS, with_means
from riskstream.operators.slices import (
    SLICE_SECONDS,
    attach,
    frame_points,
    frames,
    slice_of,
    slice_sums,
)
from riskstream.streaming.archive import path_exists, write_batch
from riskstream.streaming.features import packed, unpacked

_ROWS = "card1 bigint, TransactionID bigint, TransactionAmt double, us bigint, _kept string"
_MARKS = "newest bigint, n_late bigint, batch_id bigint"
_SUMS = (
    "_k bigint, _rows bigint, _n bigint, _sum double, _m2 double, _last bigint, "
    "_slice bigint, batch_id bigint"
)
_LAST = "_k bigint, _last bigint, batch_id bigint"


def sliced_features(
    tx: DataFrame,
    store: str,
    out: str,
    checkpoint: str,
    lateness_seconds: int = 30,
    windows: dict[str, int] = WINDOWS,
    slice_seconds: int = SLICE_SECONDS,
    trigger: dict | None = None,
    keep: Sequence[str] = (),
) -> StreamingQuery:
    """Write the features of ``card1``, ``TransactionID``, ``TransactionAmt``, ``event_time`` rows.

    A row is written once every row before it must have arrived. Rows later than
    ``lateness_seconds`` are left out and counted in ``marks``. The columns of ``keep`` come
    out with their row.
    """
    rows = tx.select(
        "card1",
        "TransactionID",
        "TransactionAmt",
        F.unix_micros("event_time").alias("us"),
        packed(keep).alias("_kept"),
    )
    kept = tx.select(*keep).schema

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)  # read for its extent and to store it
        try:
            _emit(
                df, batch_id, store, out, lateness_seconds * MICROS, windows, slice_seconds, kept
            )
        finally:
            df.unpersist()

    return (
        rows.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def _emit(
    df: DataFrame,
    batch_id: int,
    store: str,
    out: str,
    lateness: int,
    windows: dict[str, int],
    slice_seconds: int,
    kept_columns: T.StructType,
) -> None:
    spark = df.sparkSession
    before = _newest(spark, store, batch_id - 1)
    done = None if before is None else before - lateness  # rows up to here have been written
    late = F.lit(False) if done is None else F.col("us") <= done
    seen = df.agg(F.min("us"), F.max("us"), F.count_if(late)).first()
    if seen[1] is None:
        if before is not None:
            _mark(spark, store, batch_id, before, 0)
        return
    newest = max(seen[1], seen[1] if before is None else before)
    start = seen[0] - 1 if done is None else done
    end = newest - lateness

    width = slice_seconds * MICROS
    first, last = start // width, end // width
    kept = df.where(~late).withColumn("_slice", slice_of(F.col("us"), slice_seconds))
    write_batch(kept, f"{store}/rows", batch_id, by=["_slice"])
    _mark(spark, store, batch_id, newest, seen[2])

    stored = (
        spark.read.schema(f"{_ROWS}, _slice bigint, batch_id bigint")
        .parquet(f"{store}/rows")
        .where(F.col("batch_id") <= batch_id)
    )
    needed = F.col("_slice").between(first, last)
    for seconds in windows.values():
        back = seconds // slice_seconds
        needed = needed | F.col("_slice").between(first - back, last - back)
    near = stored.where(needed & F.col("card1").isNotNull())
    # Squares are summed around a typical amount of the card, so that they do not cancel.
    centers = near.groupBy("card1").agg(F.coalesce(F.avg("TransactionAmt"), F.lit(0.0)).alias("_c"))
    points = frame_points(
        near.join(centers, "card1"), "card1", "us", "TransactionAmt", "TransactionID", F.col("_c")
    ).where(F.col("_t") <= end)
    open_sums = slice_sums(points, slice_seconds).where(F.col("_slice").between(first, last))
    sums = open_sums
    if path_exists(spark, f"{store}/sums"):
        closed = spark.read.schema(_SUMS).parquet(f"{store}/sums")
        longest = max(windows.values()) // slice_seconds
        closed = closed.where(F.col("_slice").between(first - longest, first - 1))
        closed = closed.join(centers.withColumnRenamed("card1", "_k"), "_k")
        dev = F.col("_sum") - F.col("_n") * F.col("_c")
        closed = closed.withColumns(
            {"_dev": dev, "_sq": F.col("_m2") + F.when(F.col("_n") > 0, dev * dev / F.col("_n"))}
        )
        sums = open_sums.unionByName(closed.select(*open_sums.columns))

    at = frames(points, sums, windows, slice_seconds).where(F.col("_t") > start)
    if path_exists(spark, f"{store}/last"):
        newest_seen = (
            spark.read.schema(_LAST)
            .parquet(f"{store}/last")
            .where(F.col("batch_id") < batch_id)
            .groupBy("_k")
            .agg(F.max("_last").alias("_idle"))
        )
        at = at.join(newest_seen, "_k", "left").withColumn(
            "_before", F.coalesce("_before", "_idle")
        )
    band = stored.where(
        (F.col("us") > start) & (F.col("us") <= end) & F.col("_slice").between(first, last)
    ).select("card1", "TransactionID", "TransactionAmt", "us", "_kept")
    ready = attach(band, at.drop("_idle"), "card1", "us", "TransactionID", windows)
    without_card = band.where(F.col("card1").isNull())
    features = with_means(
        ready.unionByName(without_card, allowMissingColumns=True), "card1", "TransactionAmt", windows
    ).drop(*[c for c in ready.columns if c.startswith("_") and c != "_kept"])
    write_batch(unpacked(features, kept_columns), out, batch_id)
    newest_rows = band.where(F.col("card1").isNotNull()).groupBy(F.col("card1").alias("_k"))
    write_batch(newest_rows.agg(F.max("us").alias("_last")), f"{store}/last", batch_id)
    # Stored free of the centre: rows, sum, and squares around the slice's own mean.
    own = F.when(F.col("_n") > 0, F.col("_sq") - F.col("_dev") * F.col("_dev") / F.col("_n"))
    parts = open_sums.withColumn("_m2", F.greatest(own, F.lit(0.0))).drop("_dev", "_sq")
    write_batch(parts.where(F.col("_slice") < last), f"{store}/sums", batch_id, by=["_slice"])


def _newest(spark, store: str, batch_id: int) -> int | None:
    """Newest event time seen up to a batch."""
    if batch_id < 0 or not path_exists(spark, f"{store}/marks/batch_id={batch_id}"):
        return None
    marks = spark.read.schema(_MARKS).parquet(f"{store}/marks")
    return marks.where(F.col("batch_id") == batch_id).first()["newest"]


def _mark(spark, store: str, batch_id: int, newest: int, n_late: int) -> None:
    row = spark.range(1).select(
        F.lit(newest).cast("bigint").alias("newest"), F.lit(n_late).cast("bigint").alias("n_late")
    )
    write_batch(row, f"{store}/marks", batch_id)
