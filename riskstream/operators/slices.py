"""Frames put together from fixed time slices, for micro-batches over stored rows.

A frame is the rest of its oldest slice, the whole slices between, and the start of its newest
slice; each part is a linear pass over one row per (card, time).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.functions.scalars import MICROS
from riskstream.operators.rolling import STD_WINDOWS

SLICE_SECONDS = 900


def _parts_of(window: str) -> list[str]:
    return _PARTS if window in STD_WINDOWS else _PARTS[:3]


def _slice(time: Column, width: int) -> Column:
    return ((time - F.pmod(time, F.lit(width))) / width).cast("bigint")


# Additive parts of one frame: rows, non-null amounts, their sum, centred sum and square sum.
_PARTS = ["_rows", "_n", "_sum", "_dev", "_sq"]


def slice_of(time: Column, slice_seconds: int) -> Column:
    return _slice(time, slice_seconds * MICROS)


def frame_points(
    tx: DataFrame, key: str, time: str, amount: str, row_id: str, center: Column
) -> DataFrame:
    """One row per (card, time): the parts of its rows, deviations taken from ``center``."""
    deviation = F.col(amount) - center
    return tx.groupBy(F.col(key).alias("_k"), F.col(time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(amount).alias("_n"),
        F.sum(amount).alias("_sum"),
        F.sum(deviation).alias("_dev"),
        F.sum(deviation * deviation).alias("_sq"),
        F.min(row_id).alias("_first_id"),
    )


def slice_sums(points: DataFrame, slice_seconds: int) -> DataFrame:
    """One row per (card, slice): its parts and the time of its last row."""
    return points.groupBy("_k", slice_of(F.col("_t"), slice_seconds).alias("_slice")).agg(
        *[F.sum(part).alias(part) for part in _PARTS], F.max("_t").alias("_last")
    )


def frames(
    points: DataFrame, sums: DataFrame, windows: dict[str, int], slice_seconds: int
) -> DataFrame:
    """Parts of every frame, per (card, time) of ``points``, and the time before it."""
    # Every point, plus a copy moved forward by each window: in the slice where a row
    # looks back by w, the copies at or after the row are the rest of its oldest slice.
    moves = [("", 0)] + [(name, seconds * MICROS) for name, seconds in windows.items()]
    steps = F.array(*[F.struct(F.lit(n).alias("w"), F.lit(m).alias("by")) for n, m in moves])
    copies = points.withColumn("_move", F.explode(steps)).select(
        "_k",
        (F.col("_t") + F.col("_move.by")).alias("_t"),
        F.col("_move.w").alias("_w"),
        slice_of(F.col("_t") + F.col("_move.by"), slice_seconds).alias("_slice"),
        "_first_id",
        *_PARTS,
    )
    cell = Window.partitionBy("_k", "_slice")
    earlier = cell.orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    onward = cell.orderBy(F.desc("_t")).rangeBetween(Window.unboundedPreceding, 0)
    own = F.col("_w") == ""
    edges: dict[str, Column] = {"_prev": F.max(F.when(own, F.col("_t"))).over(earlier)}
    for part in _PARTS:
        edges[f"{part}_head"] = F.sum(F.when(own, F.col(part))).over(earlier)
    for name in windows:
        for part in _parts_of(name):
            moved = F.when(F.col("_w") == name, F.col(part))
            edges[f"{part}_tail_{name}"] = F.sum(moved).over(onward)
    partial = copies.withColumns(edges).where(own)

    line = Window.partitionBy("_k").orderBy("_slice")
    between: dict[str, Column] = {"_prev_slice": F.lag("_last").over(line)}
    for name, seconds in windows.items():
        whole = line.rangeBetween(1 - seconds // slice_seconds, -1)
        for part in _parts_of(name):
            between[f"{part}_mid_{name}"] = F.sum(part).over(whole)
    middle = sums.select("_k", "_slice", *[c.alias(n) for n, c in between.items()])

    def total(part: str, name: str) -> Column:
        pieces = [f"{part}_head", f"{part}_mid_{name}", f"{part}_tail_{name}"]
        return reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0)) for p in pieces])

    return partial.join(middle, ["_k", "_slice"]).select(
        "_k",
        "_t",
        "_first_id",
        F.coalesce("_prev", "_prev_slice").alias("_before"),
        *[total(part, name).alias(f"{part}_{name}") for name in windows for part in _parts_of(name)],
    )


def attach(
    tx: DataFrame, at: DataFrame, key: str, time: str, row_id: str, windows: dict[str, int]
) -> DataFrame:
    """Give each row the features of its (card, time)."""
    features: dict[str, Column] = {}
    for name in windows:
        n = F.col(f"_n_{name}")
        features[f"{key}_txn_count_{name}"] = F.when(F.col(f"_rows_{name}") > 0, n)
        features[f"{key}_amt_sum_{name}"] = F.when(n > 0, F.col(f"_sum_{name}"))
        if name in STD_WINDOWS:
            dev, sq = F.col(f"_dev_{name}"), F.col(f"_sq_{name}")
            spread = F.greatest(sq - dev * dev / F.nullif(n, F.lit(0)), F.lit(0.0))
            features[f"{key}_amt_std_{name}"] = F.when(
                n > 1, F.sqrt(spread / F.nullif(n - 1, F.lit(0)))
            )
    at = at.select("_k", "_t", "_first_id", "_before", *[c.alias(n) for n, c in features.items()])
    # Rows sharing a time follow the first of them at distance zero.
    since = F.when(F.col(row_id) == F.col("_first_id"), F.col(time) - F.col("_before")).otherwise(0)
    return (
        tx.join(at, (F.col(key) == F.col("_k")) & (F.col(time) == F.col("_t")))
        .withColumn(f"{key}_time_since_last", since / MICROS)
        .drop("_k", "_t", "_first_id", "_before")
    )
