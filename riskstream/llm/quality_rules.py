"""Quality rules whose cutoffs are read from the data of each language and source.

``measure`` computes counts per document. ``sketches`` summarises each rate per (lang, source) as a
histogram over fixed bins: sketches of parts merge by adding counts, so partial ones are combined
before the shuffle, and a (lang, source) of any size costs as many rows as it has bins. ``cutoffs``
reads quantiles from them, and ``judge`` joins the cutoffs to the documents.

A cutoff lies in the middle of a valley of the sketch: a stretch of rates that hardly any document
has, above the median, wider than ``GAP`` and than all rates below it, with a minority of
documents beyond it (at least ``BEYOND``, and one in a hundred). A long tail has no such valley, so
a group without junk loses nothing, and no constant stands for a cutoff. Chance leaves gaps in small
groups; hence the stretch must be thin in the merged sketch of the language too, and a language's in
that of all documents. A group without a valley of its own, or with fewer than ``LEAST`` documents,
is judged by its language, else by all documents; so is a group most of which lies beyond that
cutoff, being junk itself. Where no sketch has a valley no document goes.

Rates are whole numbers per thousand, rounded down; bins are one wide, so at most 1001 per rule.

Defined cases: a null text has no words and fails the base rule (fewer than 50 words), as does an
empty one; null ``lang`` or ``source`` are values of their own; repeated rows count each time; an
empty table gives an empty result; extra columns are kept by ``judge`` unless they have the name
of a result column, which then wins.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.text import SPACES, WORD, whole
from riskstream.session import written

#: Least width of a valley, per thousand.
GAP = 40
#: Documents beyond a valley, at least.
BEYOND = 3
#: Documents a sketch needs to be used.
LEAST = 30
#: Bins with less than this part of a sketch's documents do not end a valley.
STRAY = 2000
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    """A rate per thousand."""

    part: Column
    of: Column


def rules() -> dict[str, Rule]:
    words = F.col("n_words")
    return {
        # symbols per character of words
        "symbols": Rule(F.col("n_symbols"), F.col("word_chars")),
        # words in repeated three-word windows
        "repeats": Rule(F.col("n_repeat_words"), words),
        # repeated lines per ten words
        "lines": Rule(10 * F.col("n_dup_lines"), words),
        # characters in words without a lower-case letter
        "shouting": Rule(F.col("_shouted"), F.col("word_chars")),
    }


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``COUNTS`` and ``_shouted``."""
    docs = docs.drop(*COUNTS, "_shouted", "_words", "_grams", "_places")
    text = whole("text")
    words = F.array_remove(F.split(text, SPACES), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    # Tried at word starts only and without giving back, so no long word makes it slow.
    with_lower = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{Ll}]*+\p{Ll}[^\x20\x09-\x0D]*+"
    shouted = F.length(F.regexp_replace(text, rf"{with_lower}|{SPACES}", ""))
    counted = docs.withColumns(
        {
            "_words": words,
            "_lines": lines,
            "word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
            "_shouted": shouted.cast("bigint"),
        }
    )
    return _repeats(
        counted.withColumns(
            {
                "n_words": F.size("_words").cast("bigint"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast(
                    "bigint"
                ),
            }
        ).drop("_lines")
    )


def _repeats(counted: DataFrame) -> DataFrame:
    """Words that lie in a three-word window found twice or more in the text.

    Windows are compared by a 64-bit hash within one text. Sorted by hash and place, a repeated
    window has a neighbour with its hash; the places found are sorted again, and each adds the
    words up to the next place, three at most.
    """
    n = F.size("_words")
    gram = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))),
            lambda i: F.xxhash64(
                F.element_at("_words", i),
                F.element_at("_words", i + 1),
                F.element_at("_words", i + 2),
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.withColumn("_grams", gram).drop("_words")
    placed = F.when(
        F.size("_grams") > F.size(F.array_distinct("_grams")),
        F.sort_array(
            F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        ),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))
    sorted_ = hashed.withColumn("_placed", placed).drop("_grams")
    nothing = F.lit(None).cast("bigint")

    def hash_at(i: Column) -> Column:
        return F.coalesce(F.get("_placed", i)["g"], nothing)

    found = F.filter(
        "_placed",
        lambda p, i: F.coalesce(hash_at(i - 1) == p["g"], F.lit(False))
        | F.coalesce(hash_at(i + 1) == p["g"], F.lit(False)),
    )
    places = F.sort_array(F.transform(found, lambda p: p["i"]))
    spread = sorted_.withColumn("_places", places).drop("_placed")
    added = F.transform(
        "_places",
        lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_places", i + 1) - p, F.lit(3))),
    )
    total = F.aggregate(added, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return spread.withColumn("n_repeat_words", total).drop("_places")


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def _rates() -> dict[str, Column]:
    return {
        name: F.least(
            F.when(rule.of > 0, F.floor(1000 * rule.part / rule.of)).otherwise(0), F.lit(1000)
        ).cast("int")
        for name, rule in rules().items()
    }


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, rule, bin, n``: mergeable, one row per bin in use.

    Only documents that pass the base rule tell what is usual.
    """
    bins = F.explode(F.create_map(*(x for k, v in _rates().items() for x in (F.lit(k), v))))
    return (
        measured.filter(~base_failed())
        .select("lang", "source", bins.alias("rule", "bin"))
        .groupBy("lang", "source", "rule", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _ranked(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The merged sketch of each group: documents per bin, up to it, and in all."""
    merged = sketch.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "rule")
    running = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    return merged.withColumns({"up_to": running, "all": F.sum("n").over(group)})


def _valleys(ranked: DataFrame, by: list[str], wider: DataFrame, wider_by: list[str]) -> DataFrame:
    """One row per group and rule: ``n`` documents, their ``median`` rate, and ``cut``, the middle of
    the lowest valley.

    ``wider`` is the ranked sketch of more documents, in which the valley must be thin as well.
    """
    more = wider.select(
        *(F.col(c).alias(f"_{c}") for c in [*wider_by, "rule", "bin"]),
        F.col("up_to").alias("more_up_to"),
        (F.col("up_to") - F.col("n")).alias("more_before"),
        F.col("all").alias("more_all"),
    )
    same = (F.col("rule") == F.col("_rule")) & (F.col("bin") == F.col("_bin"))
    for c in wider_by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    group = Window.partitionBy(*by, "rule")
    usual = ranked.filter(STRAY * F.col("n") >= F.col("all")).join(more, same)
    follow = group.orderBy("bin")
    usual = usual.withColumns(
        {
            "first": F.min("bin").over(group),
            "next": F.lead("bin").over(follow),
            "more_next": F.lead("more_before").over(follow),
        }
    )
    beyond = F.col("all") - F.col("up_to")
    valley = (
        (F.col("next") - F.col("bin") > F.greatest(F.lit(GAP), F.col("bin") - F.col("first")))
        & (2 * F.col("up_to") > F.col("all"))
        & (beyond >= BEYOND)
        & (100 * beyond >= F.col("all"))
        & (
            10 * (F.col("more_next") - F.col("more_up_to"))
            <= F.col("more_all") - F.col("more_up_to")
        )
    )
    middle = F.floor((F.col("bin") + F.col("next")) / 2).cast("int")
    return usual.groupBy(*by, "rule").agg(
        F.max("all").alias("n"),
        F.min(F.when(valley, middle)).alias("cut"),
        F.min(F.when(2 * F.col("up_to") >= F.col("all"), F.col("bin"))).alias("median"),
    )


def _own(n: str, cut: str, median: str, wider: Column) -> Column:
    """The group's cutoff; null where it has few documents or most fail by the wider sketch."""
    return F.when((F.col(n) >= LEAST) & ~F.coalesce(F.col(median) > wider, F.lit(False)), F.col(cut))


def cutoffs(sketch: DataFrame) -> DataFrame:
    """``lang, source`` and one column per rule: the highest rate that passes; null: any."""
    own, lang, every = (_ranked(sketch, by) for by in (["lang", "source"], ["lang"], []))
    own = _valleys(own, ["lang", "source"], lang, ["lang"])
    lang = _valleys(lang, ["lang"], every, []).select(
        F.col("lang").alias("_l"), F.col("rule").alias("_r"),
        F.col("n").alias("lang_n"), F.col("cut").alias("lang_cut"), F.col("median").alias("lang_m"),
    )
    every = _valleys(every, [], every, []).select(
        F.col("rule").alias("_every_rule"), F.col("cut").alias("every_cut")
    )
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("rule") == F.col("_r")))
    joined = joined.join(every, F.col("rule") == F.col("_every_rule"))
    wider = F.coalesce(_own("lang_n", "lang_cut", "lang_m", F.col("every_cut")), F.col("every_cut"))
    limit = F.coalesce(_own("n", "cut", "median", wider), wider)
    return joined.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("rule") == name, limit)).alias(f"_most_{name}") for name in rules())
    )


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed``, ``kept`` and ``failed_rules`` (comma-joined)."""
    measured = measured.drop("base_failed", "kept", "failed_rules")
    limits = limits.select(
        F.col("lang").isNull().alias("_no_lang"),
        F.coalesce("lang", F.lit("")).alias("_lang"),
        F.col("source").isNull().alias("_no_source"),
        F.coalesce("source", F.lit("")).alias("_source"),
        *(c for c in limits.columns if c.startswith("_most_")),
    )
    keys = ["_no_lang", "_lang", "_no_source", "_source"]
    joined = measured.withColumns(
        {
            "_no_lang": F.col("lang").isNull(),
            "_lang": F.coalesce("lang", F.lit("")),
            "_no_source": F.col("source").isNull(),
            "_source": F.coalesce("source", F.lit("")),
        }
    ).join(limits, keys, "left")
    failed = F.concat_ws(
        ",",
        *(
            F.when(rate > F.col(f"_most_{name}"), name)
            for name, rate in _rates().items()
        ),
    )
    return (
        joined.withColumns({"base_failed": base_failed(), "failed_rules": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
        .drop(*keys, *(c for c in limits.columns if c.startswith("_most_")))
    )


def rate(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with counts and verdict. The counts are computed once and written.

    Without ``keep_text`` the text is left out of what is written and returned.
    """
    measured = measure(docs)
    measured = written(measured if keep_text else measured.drop("text"), "quality-counts")
    limits = written(cutoffs(sketches(measured)), "quality-cutoffs")
    return judge(measured, limits).drop("_shouted")
