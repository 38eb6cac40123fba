"""Exact quantiles of a column that no single task could hold.

A mergeable sketch names, for every rank asked for, two values that should enclose it. One scan then
counts the rows between these brackets and, value by value, the rows inside them. The counts decide:
a rank inside a bracket is read off the values there, and one that the sketch missed is searched for
among the rows of its gap. So the result is exact whatever the sketch says, and a sketch that was
kept from earlier (:mod:`riskstream.sources.sketches`) saves the first scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskstream.session import written

ROWS_PER_TASK = 1_000_000
ACCURACY = 4096
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

#: Number of rows, and a sketch of their values
Sketch = tuple[int, bytes]


def exact_quantile(
    df: DataFrame, column: str, share: float, max_rows: int = ROWS_PER_TASK
) -> float | None:
    """The exact ``share`` quantile with linear interpolation, null for no values."""
    return exact_quantiles(df, column, [share], max_rows)[0]


def exact_quantiles(
    df: DataFrame,
    column: str,
    shares: list[float],
    max_rows: int = ROWS_PER_TASK,
    sketch: Sketch | None = None,
    accuracy: int = ACCURACY,
) -> list[float | None]:
    """The exact quantiles at ``shares``, found in one search; null and NaN are no values.

    ``sketch`` describes the same rows, made with ``accuracy``; without it one is made by a scan of
    its own. A column of up to ``max_rows`` values is then given to ``percentile``.
    """
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    if isinstance(values.schema["v"].dataType, (T.FloatType, T.DoubleType)):
        values = values.where(~F.isnan("v"))
    if sketch is None:
        sketch = sketch_of(values, accuracy)
        if 0 < sketch[0] <= max_rows:
            found = values.agg(F.percentile("v", F.array(*map(F.lit, shares)))).first()[0]
            return [float(x) for x in found]
    rows = sketch[0]
    if not rows:
        return [None] * len(shares)
    places = [share * (rows - 1) for share in shares]
    ranks = sorted({f(p) for p in places for f in (math.floor, math.ceil)})
    at = _values_at(values, ranks, sketch, accuracy, max_rows)
    result = []
    for p in places:
        low, high = at[math.floor(p)], at[math.ceil(p)]
        result.append(float(low if low == high else low + (high - low) * (p - math.floor(p))))
    return result


def is_integral(values: DataFrame, column: str) -> bool:
    return isinstance(values.schema[column].dataType, _INTEGRAL)


def sketch_column(values: DataFrame, column: str, accuracy: int) -> Column:
    """The aggregate that makes a sketch of the column."""
    if is_integral(values, column):
        return F.kll_sketch_agg_bigint(column, F.lit(accuracy))
    return F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(accuracy))


def sketch_of(values: DataFrame, accuracy: int = ACCURACY) -> Sketch:
    found = values.agg(F.count("v"), sketch_column(values, "v", accuracy)).first()
    return found[0], bytes(found[1]) if found[0] else b""


def _brackets(
    spark: SparkSession, integral: bool, sketch: Sketch, accuracy: int, ranks: list[int]
) -> list[tuple]:
    """Ranges of values, apart and in order, that should hold the values at ``ranks``."""
    rows, blob = sketch
    # Twice the error of rank that such a sketch keeps to in 99 of 100 cases.
    margin = 2 * 2.296 / accuracy**0.9021
    share = [rank / max(rows - 1, 1) for rank in ranks]
    ends = [max(s - margin, 0.0) for s in share] + [min(s + margin, 1.0) for s in share]
    read = F.kll_sketch_get_quantile_bigint if integral else F.kll_sketch_get_quantile_double
    row = spark.range(1).select(read(F.lit(blob), F.array(*map(F.lit, ends)))).first()[0]
    merged: list[tuple] = []
    for low, high in zip(row[: len(ranks)], row[len(ranks) :]):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _values_at(
    values: DataFrame, ranks: list[int], sketch: Sketch, accuracy: int, max_rows: int
) -> dict[int, object]:
    """The value with ``rank`` smaller-or-tied values before it, for each of the ranks."""
    spark = values.sparkSession
    brackets = _brackets(spark, is_integral(values, "v"), sketch, accuracy, ranks)
    # Even zones lie between brackets, odd ones are brackets.
    v, zone = F.col("v"), None
    for i, (low, high) in enumerate(brackets):
        zone = F.when(v < low, 2 * i) if zone is None else zone.when(v < low, 2 * i)
        zone = zone.when(v <= high, 2 * i + 1)
    zone = zone.otherwise(2 * len(brackets))
    # One row per gap and one per value inside a bracket, combined before the shuffle.
    cells = written(
        values.withColumn("zone", zone)
        .groupBy("zone", F.when(F.col("zone") % 2 == 1, v).alias("v"))
        .agg(F.count(F.lit(1)).alias("n")),
        "quantile-cells",
    )
    sizes = {r[0]: r[1:] for r in cells.groupBy("zone").agg(F.sum("n"), F.count(F.lit(1))).collect()}
    found: dict[int, object] = {}
    below = 0
    for z in sorted(sizes):
        rows, n_cells = sizes[z]
        inside = [rank - below for rank in ranks if below <= rank < below + rows]
        if inside and z % 2:
            at = _read_off(cells.where(F.col("zone") == z), n_cells, inside, max_rows)
        elif inside:
            gap = values.where(zone == z)
            at = _values_at(gap, inside, sketch_of(gap, accuracy), accuracy, max_rows)
        else:
            at = {}
        found |= {rank + below: value for rank, value in at.items()}
        below += rows
    return found


def _read_off(cells: DataFrame, n_cells: int, ranks: list[int], max_rows: int) -> dict[int, object]:
    """Values at ``ranks`` among counted values, dealt by ranges of about ``max_rows`` of them."""
    ranges = -(-n_cells // max_rows)
    if ranges > 1:
        dealt = cells.repartitionByRange(ranges, "v").withColumn("part", F.spark_partition_id())
        cells = written(dealt, "quantile-ranges")
    else:
        cells = cells.withColumn("part", F.lit(0))
    parts = cells.groupBy("part").agg(F.sum("n")).orderBy("part").collect()
    found, below = {}, 0
    for part, rows in parts:
        inside = [rank - below for rank in ranks if below <= rank < below + rows]
        if inside:
            upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
            numbered = cells.where(F.col("part") == part).withColumn("upto", upto)
            wanted = F.explode(F.array(*(F.lit(r).cast("bigint") for r in inside)))
            hits = numbered.withColumn("rank", wanted).where(
                (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
            )
            found |= {r.rank + below: r.v for r in hits.select("rank", "v").collect()}
        below += rows
    return found
