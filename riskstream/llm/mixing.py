"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words: its share, by weight, of a budget, stopped at ``cap`` times
its size; what a stopped source cannot take is shared again by weight. A document of a source
then has ``target / source size`` expected copies. Within the source the expected copies are
summed up in order of size, one random offset is added, and a document is emitted once for each
integer that the running sum crosses at it. As sizes rise along that order, what a source yields
differs from its target by less than its longest document.

Running sums over a source that holds a third of all rows are not made in one task. Expected
copies are equal within a source, so the sum at a document is its rank times the rate; the rank is
the start of the document's slice, known from counts, plus its place in the slice. A slice is one
of ``SLICES`` parts of a (source, size). What one task orders is a slice, the slices of one size,
or the distinct sizes of one source (at most the square root of twice its words).

Defined cases: a null text has size 0; null is a source of its own, after all others; a null
``doc_id`` orders first in its slice; repeated rows are rows of their own, of which equal ones may
change places; sources without words have target 0; an empty table gives an empty result. Columns
of the input are only returned when named in ``keep``; a kept column with the name of a result
column is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.text import n_words
from riskstream.operators.ids import dense_ids
from riskstream.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = "mix"
SLICES = 4096
#: Result columns beside ``doc_id`` and ``source``.
RESULT = ("size", "source_size", "target", "copies", "taken")
_GROUP = ["_no_source", "_source"]


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, source``, the columns of ``RESULT``, and those of ``keep``.

    ``weights`` go round the sources in code-point order. ``copies`` says how often the mix emits
    the document, ``taken`` how many words that makes.
    """
    keep = [c for c in keep if c not in ("doc_id", "source", *RESULT)]
    sized = docs.select(
        F.col("doc_id"),
        F.col("source").isNull().alias("_no_source"),
        F.coalesce("source", F.lit("")).alias("_source"),
        n_words("text").alias("size"),
        _slice(F.col("doc_id")).alias("_slice"),
        *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)),
    )
    counts = written(
        sized.groupBy(*_GROUP, "size", "_slice").agg(F.count(F.lit(1)).alias("_n")), "mix-counts"
    )
    rates = _rates(counts, weights, share, cap, seed)

    passed = F.col("_offset") + F.col("_rate") * F.col("_rank")
    before = F.col("_offset") + F.col("_rate") * (F.col("_rank") - 1)
    copies = F.least(F.floor(passed) - F.floor(before), F.ceil("_rate")).cast("bigint")
    in_slice = Window.partitionBy(*_GROUP, "size", "_slice").orderBy("doc_id")
    return (
        sized.withColumn("_place", F.row_number().over(in_slice))
        .join(_starts(counts), [*_GROUP, "size", "_slice"])
        .withColumn("_rank", F.col("_start") + F.col("_place"))
        .join(rates, _GROUP)
        .withColumn("copies", copies)
        .select(
            "doc_id",
            F.when(~F.col("_no_source"), F.col("_source")).alias("source"),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            *(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)),
        )
    )


def _slice(doc_id: Column) -> Column:
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 3)
    return F.conv(digits, 16, 10).cast("int")


def _starts(counts: DataFrame) -> DataFrame:
    """For each slice, the number of documents of its source that come before it."""
    before = (Window.unboundedPreceding, -1)
    sizes = counts.groupBy(*_GROUP, "size").agg(F.sum("_n").alias("_n"))
    smaller = F.sum("_n").over(Window.partitionBy(*_GROUP).orderBy("size").rowsBetween(*before))
    sizes = sizes.select(*_GROUP, "size", F.coalesce(smaller, F.lit(0)).alias("_smaller"))
    earlier = F.sum("_n").over(
        Window.partitionBy(*_GROUP, "size").orderBy("_slice").rowsBetween(*before)
    )
    return (
        counts.withColumn("_earlier", F.coalesce(earlier, F.lit(0)))
        .join(sizes, [*_GROUP, "size"])
        .select(*_GROUP, "size", "_slice", (F.col("_smaller") + F.col("_earlier")).alias("_start"))
    )


def _rates(
    counts: DataFrame, weights: Sequence[float], share: float, cap: float, seed: str
) -> DataFrame:
    """One row per source: its size, target, expected copies of each document, and offset."""
    sources = counts.groupBy(*_GROUP).agg(
        F.sum(F.col("size") * F.col("_n")).cast("bigint").alias("source_size")
    )
    # A digit before the name puts the missing source last.
    name = F.concat(F.when(F.col("_no_source"), F.lit("1")).otherwise(F.lit("0")), "_source")
    numbered = dense_ids(sources.withColumn("_name", name), "_name", "_number", start=0)
    turn = F.pmod("_number", F.lit(len(weights))).cast("int") + 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn)
    weighted = written(numbered.withColumn("_weight", weight), "mix-sources")

    level = _level(weighted, share, cap)
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "_name")), 1, 4)
    target = F.least(cap * F.col("source_size"), F.lit(level) * F.col("_weight"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    return weighted.withColumn("target", target.cast("double")).select(
        *_GROUP,
        "source_size",
        "target",
        F.coalesce(rate, F.lit(0.0)).alias("_rate"),
        (F.conv(digits, 16, 10).cast("double") / 65536).alias("_offset"),
    )


def _level(sources: DataFrame, share: float, cap: float) -> float:
    """Words per unit of weight, raised until no source is above its limit.

    Each round is one aggregate over the sources; a round stops at least one more source.
    """
    stopped, level = -1, -1.0
    while True:
        limit = cap * F.col("source_size")
        free = limit > F.lit(level) * F.col("_weight") if level >= 0 else F.lit(True)
        row = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(~free, F.col("source_size"))).alias("full"),
            F.sum(F.when(free, F.col("_weight"))).alias("weight"),
            F.count(F.when(~free, F.lit(1))).alias("stopped"),
        ).first()
        if row["stopped"] == stopped or not row["weight"]:
            return max(level, 0.0)
        stopped = row["stopped"]
        level = (share * (row["words"] or 0) - cap * (row["full"] or 0)) / row["weight"]
