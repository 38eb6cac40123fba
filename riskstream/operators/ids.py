"""Dense ids 1..n in key order without one task seeing every key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.session import counted, written

ROWS_PER_TASK = 1_000_000


def dense_ids(
    df: DataFrame, key: str, out: str, start: int = 1, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Number the rows of ``df``, which has one row per ``key``, in key order.

    ``df`` is written once and counted meanwhile. It is then dealt by ranges of the key, about
    ``rows_per_task`` rows each; ranges are numbered side by side, each starting after the rows of
    the ranges below it.
    """
    table, rows = counted(df, "ids")
    ranges = max(1, -(-rows // rows_per_task))
    dealt = table.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id())
    # Written, so that a range keeps its rows whatever is computed again.
    dealt = written(dealt, "id-ranges")
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: as many as tasks that wrote them.
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        dealt.join(F.broadcast(starts), "_range")
        .withColumn(out, (F.col("_below") + within + (start - 1)).cast("bigint"))
        .drop("_range", "_below")
    )
