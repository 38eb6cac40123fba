"""Keys too heavy for one task: find them and carry values along them in slices.

A window partitioned by a key puts the key's whole history into one task. The
helpers here cut the history of heavy keys, and only of those, into time slices:
each (key, slice) is its own window partition, and what must cross a slice border
travels through a table with one row per (key, slice).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.session import written

MAX_ROWS_PER_TASK = 5_000_000
_MAX_DRIVER_KEYS = 10_000


class Heavy(NamedTuple):
    """Heavy keys (``_heavy``), their rows in all, and how many rows a slice holds at most."""

    keys: DataFrame
    rows: int
    max_rows: int


def small_or_written(df: DataFrame, name: str) -> DataFrame | None:
    """A table of exceptional keys, or None when there are none.

    Up to 10 000 rows are fetched and broadcast; a longer list is written to the
    shared folder and joined by whatever its size on disk makes best.
    """
    rows = df.take(_MAX_DRIVER_KEYS + 1)
    if not rows:
        return None
    if len(rows) > _MAX_DRIVER_KEYS:
        return written(df, name)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def heavy_keys(
    df: DataFrame, key: str, time: str, max_rows: int = MAX_ROWS_PER_TASK
) -> Heavy | None:
    """Keys with more than ``max_rows`` rows, if there are any."""
    counted = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_heavy"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > max_rows)
    )
    keys = small_or_written(counted, "heavy-keys")
    if keys is None:
        return None
    return Heavy(keys.select("_heavy"), keys.agg(F.sum("_n")).first()[0], max_rows)


def with_slice(df: DataFrame, key: str, time: str | list[str], heavy: Heavy | None) -> DataFrame:
    """Add ``_slice``: the slice of a heavy key's row, rising with ``time``, null for other rows.

    The rows of all heavy keys are dealt by ranges of (key, time) and sorted; every ``max_rows``
    places in that order are a slice, so a burst gets as many slices as its rows need, and the
    work does not depend on how many keys or slices there are. They are written, as ranges are
    sampled and another evaluation might cut elsewhere. ``time`` may be a list of columns; rows
    that are alike in all of them may lie in two slices.

    ``_alone`` separates rows without a key from each other.
    """
    order = [time] if isinstance(time, str) else time
    df = df.withColumn("_alone", spread_nulls(key, order[0]))
    if heavy is None:
        return df.withColumn("_slice", F.lit(None).cast("bigint"))
    spark, same = df.sparkSession, F.col(key) == F.col("_heavy")
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-heavy.rows // MAX_ROWS_PER_TASK)
    )
    # The id is the task's number and the place in it, so no slice reaches into a second task.
    slice_ = F.expr(f"monotonically_increasing_id() div {int(heavy.max_rows)}")
    dealt = (
        df.join(heavy.keys, same, "left_semi")
        .repartitionByRange(tasks, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("_slice", slice_)
    )
    light = df.join(heavy.keys, same, "left_anti").withColumn("_slice", F.lit(None).cast("bigint"))
    return light.unionByName(written(dealt, "heavy-rows"))


def spread_nulls(key: str, *by: str) -> Column:
    """Second partition column that keeps rows without a key from gathering in one task."""
    return F.when(F.col(key).isNull(), F.xxhash64(*by))


def carry_previous(
    sliced: DataFrame,
    key: str,
    order: list[str],
    values: dict[str, Column],
    heavy: Heavy | None,
) -> DataFrame:
    """For each row, the last non-null of each value strictly before it in ``order``.

    ``sliced`` comes from :func:`with_slice`; ``order`` must agree with the slices.
    """
    before = (
        Window.partitionBy(key, "_slice", "_alone")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = sliced.withColumns({f"_in_{n}": v for n, v in values.items()})
    rows = rows.withColumns({n: F.last(f"_in_{n}", ignorenulls=True).over(before) for n in values})
    if heavy is not None:
        position = F.struct(*order)
        slices = (
            sliced.where(F.col("_slice").isNotNull())
            .withColumns({f"_in_{n}": v for n, v in values.items()})
            .groupBy(key, "_slice")
            .agg(
                *[
                    F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), position)).alias(n)
                    for n in values
                ]
            )
        )
        earlier = (
            Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        )
        borders = slices.select(
            F.col(key).alias("_key"),
            F.col("_slice").alias("_border"),
            *[F.last(n, ignorenulls=True).over(earlier).alias(f"_edge_{n}") for n in values],
        )
        rows = rows.join(
            borders, (F.col(key) == F.col("_key")) & (F.col("_slice") == F.col("_border")), "left"
        ).withColumns({n: F.coalesce(F.col(n), F.col(f"_edge_{n}")) for n in values})
        rows = rows.drop("_key", "_border", *[f"_edge_{n}" for n in values])
    return rows.drop(*[f"_in_{n}" for n in values])


def carry_next(
    sliced: DataFrame, key: str, order: list[str], value: str, out: str, heavy: Heavy | None
) -> DataFrame:
    """For each row, ``value`` of the next row in ``order``; ``value`` itself is never null."""
    ahead = Window.partitionBy(key, "_slice", "_alone").orderBy(*order)
    rows = sliced.withColumn(out, F.lead(value).over(ahead))
    if heavy is None:
        return rows
    first = (
        sliced.where(F.col("_slice").isNotNull())
        .groupBy(key, "_slice")
        .agg(F.min_by(value, F.struct(*order)).alias("_first"))
    )
    later = Window.partitionBy(key).orderBy("_slice")
    borders = first.select(
        F.col(key).alias("_key"),
        F.col("_slice").alias("_border"),
        F.lead("_first").over(later).alias("_edge"),
    )
    return (
        rows.join(
            borders, (F.col(key) == F.col("_key")) & (F.col("_slice") == F.col("_border")), "left"
        )
        .withColumn(out, F.coalesce(F.col(out), F.col("_edge")))
        .drop("_key", "_border", "_edge")
    )
