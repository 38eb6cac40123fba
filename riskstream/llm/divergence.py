"""How far the sources of a language lie apart in the words they use.

Tasks count terms with numpy. A term of up to 8 bytes is packed into one 64-bit word, one of up to 16
into two; packed terms are sorted by radix, 16 bits at a time, and equal ones counted as runs. Longer
terms go to buckets by length, each sorted by bytes. The sorts are stable and start in order of
group and document, so within a term the runs of a group and of a document come together: one pass
counts places and documents. A task packs ``RUN_BYTES`` of text at a time (or one longer text) and
passes on one row per term and group.

Rows are then added up per (lang, source, term), and a window per (lang, term), which has at most one
row per source, keeps the terms found in ``LEAST_DOCS`` documents of the language. A share is a
whole number of billionths, smoothed by ``ADDED``; arithmetic is exact, in 64 bits while counts
allow it, else in decimals.

The distance of two sources is the sum of share differences over all kept terms of the language.
Kept terms are dealt into blocks of about ``BLOCK_TERMS``, and sources into chunks of ``CHUNK``; a
task holds the shares of a block for two chunks as matrices and returns, for each pair, how much its
sum differs from what two sources without any of these terms would have. So no pair is made per
term, and terms that neither source has need no rows.

Defined cases: null text, lang and source are empty texts; a group without terms has its shares from
smoothing alone; a language without kept terms has distances of 0 and no term rows; a language of
one source has no pairs; repeated rows count each time; ties are ordered by the item's bytes; a text
or term of any length is counted whole; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.hashing import bounds, pieces
from riskstream.session import written

LEAST_DOCS, ADDED, SCALE = 30, 5, 1_000_000_000
#: Ranks of the terms that set a group apart.
TOP = 50
#: Text a task packs at once, terms of a block, sources of a chunk.
RUN_BYTES, BLOCK_TERMS, CHUNK = 16 << 20, 2048, 256
#: Counts up to here keep ``SCALE`` times a count within 64 bits.
_EXACT = 9_000_000_000

#: Bytes: letters, A-Z lowered, and whatever is beyond ASCII; all other signs part terms.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def radix_order(words: np.ndarray) -> np.ndarray:
    """The stable order of 64-bit words, by digits of 16 bits; equal digits are passed over."""
    order = np.arange(len(words))
    for digit in range(4):
        part = (words >> np.uint64(16 * digit)).astype(np.uint16)
        if len(part) and (part != part[0]).any():
            order = order[np.argsort(part[order], kind="stable")]
    return order


def _packed(data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each place as a big-endian word, zero beyond the length."""
    view = np.ndarray((len(data) - 7,), ">u8", data.tobytes(), strides=(1,))
    words = view[at].astype(np.uint64)
    spare = (8 * (8 - np.clip(lengths, 0, 8))).astype(np.uint64)
    kept = np.where(spare < 64, np.uint64(2**64 - 1) << np.minimum(spare, 63), np.uint64(0))
    return words & kept


def _texts_of(words: np.ndarray) -> np.ndarray:
    """Packed words, one or two to a row, as byte strings."""
    width = 8 * words.shape[1]
    return np.ascontiguousarray(words.astype(">u8")).view(f"S{width}").ravel()


class _Run:
    """Texts of a task, counted together."""

    def __init__(self) -> None:
        self.texts: list[tuple[int, bytes]] = []
        self.codes: dict[tuple[str, str], int] = {}
        self.size = 0

    def add(self, group: tuple[str, str], text: bytes | None) -> None:
        if text:
            self.texts.append((self.codes.setdefault(group, len(self.codes)), text))
            self.size += len(text)

    def terms(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per class of terms, texts sorted with equal ones together, and their document numbers."""
        short, middle, long = [], [], {}
        for doc, (_, text) in enumerate(self.texts):
            self._split(doc, text, short, middle, long)
        if short:
            words, docs = (np.concatenate(x) for x in zip(*short))
            order = radix_order(words)
            yield _texts_of(words[order, None]), docs[order]
        if middle:
            first, second, docs = (np.concatenate(x) for x in zip(*middle))
            order = radix_order(second)
            order = order[radix_order(first[order])]
            yield _texts_of(np.column_stack([first, second])[order]), docs[order]
        for length, found in long.items():
            terms = np.array([t for t, _ in found], f"S{length}")
            order = np.argsort(terms, kind="stable")
            yield terms[order], np.array([d for _, d in found], np.int64)[order]

    @staticmethod
    def _split(doc: int, text: bytes, short: list, middle: list, long: dict) -> None:
        for piece in pieces(text.translate(_FOLD)):
            data = np.frombuffer(piece + b" " * 17, np.uint8)
            starts, ends = bounds(data)
            lengths = ends - starts
            at = starts[lengths <= 8]
            if len(at):
                short.append((_packed(data, at, lengths[lengths <= 8]), np.full(len(at), doc)))
            two = (lengths > 8) & (lengths <= 16)
            at = starts[two]
            if len(at):
                second = _packed(data, at + 8, lengths[two] - 8)
                middle.append((_packed(data, at, lengths[two]), second, np.full(len(at), doc)))
            for a, b in zip(starts[lengths > 16].tolist(), ends[lengths > 16].tolist()):
                long.setdefault(b - a, []).append((piece[a:b], doc))

    def counted(self) -> Iterator[pa.RecordBatch]:
        self.texts.sort(key=lambda x: x[0])
        code = np.array([c for c, _ in self.texts], np.int64)
        names = list(self.codes)
        langs, sources = (pa.array([n[i] for n in names], pa.string()) for i in (0, 1))
        for terms, docs in self.terms():
            group = code[docs]
            other = np.ones(len(terms), bool)
            other[1:] = terms[1:] != terms[:-1]
            new = other.copy()
            new[1:] |= group[1:] != group[:-1]
            first = np.flatnonzero(new)
            other[1:] |= docs[1:] != docs[:-1]
            at = pa.array(group[first])
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(at),
                    sources.take(at),
                    pa.array(terms[first].tolist(), pa.binary()).cast(pa.string()),
                    pa.array(np.diff(np.append(first, len(terms)))),
                    pa.array(np.add.reduceat(other.astype(np.int64), first)),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def term_counts(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``lang, source, term, n, docs``: places and documents, one row per term of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Run()
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(groups, batch.column("text").cast(pa.large_binary())):
                held.add(group, text.as_py())
                if held.size > run_bytes:
                    yield from held.counted()
                    held = _Run()
        yield from held.counted()

    parts = _named(docs).select("lang", "source", "text")
    rows = parts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _named(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(
        F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), "text"
    )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms))``, exact."""
    below = F.nullif(total + ADDED * terms, F.lit(0))
    long = F.call_function("div", F.lit(SCALE).cast("bigint") * (count + ADDED), below)
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast("decimal(20,0)")
    exact = F.call_function("div", wide, below.cast("decimal(20,0)"))
    return 1 + F.when(total < _EXACT, long).otherwise(exact)


class Audit:
    """Kept terms and groups of a corpus, written once; ``pairs`` and ``terms`` read them."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS) -> None:
        per_term = Window.partitionBy("lang", "term")
        counted = term_counts(docs).withColumns(
            {
                "_docs": F.sum("docs").over(per_term),
                "lang_n": F.sum("n").over(per_term),
                "_first": F.min("source").over(per_term) == F.col("source"),
            }
        )
        kept = counted.where(F.col("_docs") >= least_docs)
        #: ``lang, source, term, n, lang_n, _first`` of the kept terms that a group has.
        self.rows = written(kept.drop("docs", "_docs"), "audit-terms")
        # Partial sums per task, then one row per group.
        sizes = self.rows.groupBy("lang", "source").agg(
            F.sum("n").alias("total"), F.count_if("_first").alias("_terms")
        )
        groups = _named(docs).select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
        of_lang = Window.partitionBy("lang")
        total = F.coalesce("total", F.lit(0))
        terms = F.coalesce("_terms", F.lit(0))
        groups = groups.select(
            "lang",
            "source",
            total.alias("total"),
            F.sum(total).over(of_lang).alias("lang_total"),
            F.sum(terms).over(of_lang).alias("terms"),
            (F.row_number().over(of_lang.orderBy("source")) - 1).alias("number"),
            F.count(F.lit(1)).over(of_lang).alias("sources"),
        )
        none = _share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"))
        self.groups = written(groups.withColumn("none", none), "audit-groups")

    def shares(self) -> DataFrame:
        """The kept terms of each group with ``p``, their share there, and ``q``, in the language."""
        rows = self.rows.join(self.groups, ["lang", "source"])
        return rows.withColumns(
            {
                "p": _share(F.col("n"), F.col("total"), F.col("terms")),
                "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
            }
        )

    def terms(self, top: int = TOP) -> DataFrame:
        """``lang, source, item, value, rank`` of the terms a group has above its language."""
        above = self.shares().where(F.col("p") > F.col("q"))
        rows = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        return _ranked(rows).where(F.col("rank") <= top)

    def pairs(self, block_terms: int = BLOCK_TERMS, chunk: int = CHUNK) -> DataFrame:
        """``lang, source, item, value, rank`` of each other source of the language."""
        rise = self._rises(block_terms, chunk)
        mine = self.groups.select("lang", "source", "number", "none", "terms")
        other = self.groups.select(
            "lang", F.col("source").alias("item"), F.col("number").alias("_number"), F.col("none").alias("_none")
        )
        # One row per pair of sources of a language is what is asked for.
        both = mine.join(other, "lang").where(F.col("number") != F.col("_number"))
        both = both.withColumns(
            {"low": F.least("number", "_number"), "high": F.greatest("number", "_number")}
        )
        apart = F.col("terms") * F.abs(F.col("none") - F.col("_none"))
        value = F.when(F.col("terms") > 0, apart + F.coalesce("rise", F.lit(0))).otherwise(0)
        both = both.join(rise, ["lang", "low", "high"], "left")
        return _ranked(both.select("lang", "source", "item", value.cast("bigint").alias("value")))

    def _rises(self, block_terms: int, chunk: int) -> DataFrame:
        """``lang, low, high, rise``: beyond what the pair would have without any term."""
        blocks = F.ceil(F.col("terms") / block_terms)
        last = F.floor((F.col("sources") - 1) / chunk)
        own = F.floor(F.col("number") / chunk)
        found = self.shares().select(
            "lang", "number", own.alias("_own"), last.alias("_last"), "term", F.col("p").alias("share"),
            F.pmod(F.xxhash64("term"), blocks).alias("block"),
        )
        # Each source is in every block, with or without one of its terms.
        marks = self.groups.where(F.col("terms") > 0).select(
            "lang", "number", own.alias("_own"), last.alias("_last"), F.lit(None).cast("string").alias("term"),
            F.col("none").alias("share"), F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"),
        )
        copies = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("_last")),
            lambda c: F.struct(F.least(c, "_own").alias("i"), F.greatest(c, "_own").alias("j")),
        )
        dealt = found.unionByName(marks).select(
            "lang", "number", "term", "share", "block", F.inline(copies)
        )
        parts = dealt.groupBy("lang", "block", "i", "j").applyInArrow(
            lambda rows: _block_rises(rows, chunk), "lang string, low int, high int, rise long"
        )
        return parts.groupBy("lang", "low", "high").agg(F.sum("rise").alias("rise"))


def _block_rises(rows: pa.Table, chunk: int) -> pa.Table:
    """For each pair of sources in two chunks, summed differences over the terms of a block."""
    number = rows.column("number").to_numpy()
    share = rows.column("share").to_numpy()
    terms = rows.column("term").combine_chunks().dictionary_encode()
    term = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    mark = term < 0
    sources, place = np.unique(number, return_inverse=True)
    none = np.zeros(len(sources), np.int64)
    none[place[mark]] = share[mark]
    matrix = np.repeat(none[:, None], len(terms.dictionary), axis=1)
    matrix[place[~mark], term[~mark]] = share[~mark]
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    low, high, rise = [], [], []
    for a in np.flatnonzero(sources // chunk == i):
        others = np.flatnonzero((sources // chunk == j) & (sources > sources[a]))
        apart = np.abs(matrix[others] - matrix[a]).sum(axis=1)
        rise.append(apart - matrix.shape[1] * np.abs(none[others] - none[a]))
        low.append(np.full(len(others), sources[a]))
        high.append(sources[others])
    lang = rows.column("lang")[0].as_py()
    whole = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (low, high, rise)]
    names = ["lang", "low", "high", "rise"]
    columns = [pa.array([lang] * len(whole[0]), pa.string())]
    columns += [pa.array(whole[0].astype(np.int32)), pa.array(whole[1].astype(np.int32)), pa.array(whole[2].astype(np.int64))]
    return pa.table(columns, names=names)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` from 1 by falling value, then by the item's bytes."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances of sources and the terms that make them."""
    found = Audit(docs)
    parts = {"pair": found.pairs(), "term": found.terms()}
    rows = [df.withColumn("part", F.lit(name)) for name, df in parts.items()]
    result = rows[0].unionByName(rows[1])
    return result.select("lang", "source", "part", "item", "value", "rank")
