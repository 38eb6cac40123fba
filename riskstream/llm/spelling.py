"""Spelling variants grouped by an edit-distance join over asymmetric q-chunks.

``vocabulary`` counts the words of a corpus; tasks add up their own counts before the shuffle.

``near`` finds all pairs of words one code point apart (inserted, deleted or replaced). The shorter
word (either one of equal length) is cut into two disjoint chunks, its halves. One edit leaves a
chunk whole, and it stands in the longer word with a shift of one at most: the first half at the
start, the second half at the end. The rest of the word holds the edit and is cut in two again, so a
key is a whole chunk and half of the rest, four per word. The longer word contributes its grams at
these places, for partners of its own length and of one less. Words that meet under a key are
verified by a banded edit distance. A key holds about three quarters of a word, so few words share
one, and a sort-merge join of keys lets Spark split those that many share.

``grouped`` gives each word its form, the commonest near word if it is ``TIMES`` as common, and its
root, the end of the chain of forms. Counts grow by ``TIMES`` along a chain, so its length is bounded
by the largest count, and doubling the steps reaches the end in a few joins.

Defined cases: a null or empty text has no words; a null ``doc_id`` reads as empty text; repeated
rows count each time; a word of any length is one word (keys are hashed, and verified by the whole
words); among equally common forms the first in code-point order is taken; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.session import written

LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A form is this many times as common as the word.
TIMES = 10
#: One in so many (document, word) pairs loses a letter.
SLIPS = 31
#: Distinct words a task holds before it passes their counts on.
HELD = 200_000


def vocabulary(docs: DataFrame, slips: int = SLIPS) -> DataFrame:
    """``word, n`` of the words of at least ``LEAST_LETTERS`` that occur ``LEAST_COUNT`` times.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF, with A-Z lowered. Where the checksum of document
    and word divides by ``slips`` (0: nowhere) one letter of the run is left out.
    """
    run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text in zip(batch.column("id").to_pylist(), texts):
                found = run.findall((text.as_py() or b"").lower().decode())
                if not found:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(found).items():
                    if slips:
                        h = zlib.crc32(word.encode(), start)
                        if h % slips == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < LEAST_LETTERS:
                                continue
                    held[word] += n
                if len(held) > HELD:
                    yield passed_on()
        yield passed_on()

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    parts = rows.mapInArrow(words, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keys(length: Column, word: Column, own: Column) -> Column:
    """Hashes of the four keys for chunks of a word with ``length`` letters, read from ``word``.

    ``own`` is the length of ``word`` itself.
    """
    half = F.floor(length / 2).cast("int")
    rest = length - half
    early, late = F.floor(half / 2).cast("int"), F.floor(rest / 2).cast("int")
    # Letters at the start and at the end that one edit leaves as they are.
    places = [(half + late, F.lit(0)), (half, rest - late), (early, rest), (F.lit(0), length - early)]
    return F.array(
        *(
            F.xxhash64(
                F.lit(i), length, F.substring(word, F.lit(1), a), F.substring(word, own - b + 1, b)
            )
            for i, (a, b) in enumerate(places)
        )
    )


def near(words: DataFrame) -> DataFrame:
    """``word, other, n, other_n``: every pair of words one edit apart, in both directions.

    ``words`` has one row per ``word``, of at least four letters.
    """
    sized = words.select("word", "n", F.char_length("word").alias("l"))
    least = F.lit(LEAST_LETTERS)
    chunks = sized.select(
        F.explode(_keys(F.col("l"), F.col("word"), F.col("l"))).alias("key"),
        F.col("word").alias("a"),
        F.col("n").alias("a_n"),
        F.col("l").alias("a_l"),
    )
    shorter = F.when(F.col("l") > least, _keys(F.col("l") - 1, F.col("word"), F.col("l")))
    grams = F.concat(
        _keys(F.col("l"), F.col("word"), F.col("l")),
        F.coalesce(shorter, F.array().cast("array<bigint>")),
    )
    grams = sized.select(
        F.explode(grams).alias("key"),
        F.col("word").alias("b"),
        F.col("n").alias("b_n"),
        F.col("l").alias("b_l"),
    )
    # Of two words of equal length the first in order gives the chunks.
    ordered = (F.col("a_l") < F.col("b_l")) | ((F.col("a_l") == F.col("b_l")) & (F.col("a") < F.col("b")))
    verified = F.levenshtein("a", "b", 1) == 1
    pairs = chunks.hint("merge").join(grams, "key").where(ordered).where(verified)
    found = pairs.select("a", "b", "a_n", "b_n").distinct()
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("a_n").alias("n"),
                 F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("b_n").alias("n"),
                 F.col("a_n").alias("other_n")),
    )
    return found.select(F.inline(ends))


def grouped(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words (word, n)``."""
    words = written(words, "spelling-words")
    largest = words.agg(F.max("n")).first()[0] or 1
    # The commonest near word, then the first in order: least of (-n, word).
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    judged = near(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    common = -F.col("_best.minus") >= times * F.col("n")
    judged = judged.select(
        "word",
        "n_near",
        F.when(common, F.col("_best.form")).alias("form"),
        F.when(common, -F.col("_best.minus")).alias("form_n"),
    )
    judged = written(judged, "spelling-near")
    steps = judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    # A chain has at most so many steps, and each round doubles those taken.
    longest = max(1, int(math.log(largest, times)) + 1)
    for _ in range(math.ceil(math.log2(longest))):
        ahead = steps.select(F.col("word").alias("_at"), F.col("root").alias("_end"))
        steps = steps.join(ahead, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_end", "root").alias("root")
        )
        steps = written(steps, "spelling-steps")
    return (
        words.join(judged, "word", "left")
        .join(steps, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            "form_n",
        )
    )
