r"""Token counts that follow edits.

A text is cut before every white space that follows something else. Such a place is a border
between pre-tokens whatever stands around it, so the pieces ("units": white space and the word
after it, one or a few pre-tokens) can be counted one by one. Each document keeps a segment tree:
leaves hold runs of units, inner nodes the sums of characters and tokens below. An edit finds its
place by going down the character sums, takes in the units it touches and the next one on either
side (a border can move only there), encodes the changed stretch alone, and updates the sums on the
way up. A leaf that has grown too long is split by building the tree anew from its stored counts,
without encoding anything.

The tokenizer is a byte-level BPE given by a file of ranks; a unit's count is remembered per
worker, in a bounded table.

Edits are an array column in the order they are made; positions are code points of the text as the
earlier edits left it. ``with_edits`` collects that array from a table of edits: it is one document's
journal and goes to one row.

Defined cases: a null text is empty and has 0 tokens; a null or empty list of edits changes
nothing; positions outside the text are moved to its ends, an end before the start means an
insertion; a null replacement deletes; repeated rows are counted one by one; an empty table gives
an empty result; extra columns are kept unless they have the name of a result column, which wins.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern that belongs to the ranks (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as that pattern sees it; Python's own class has four control signs more.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
LEAF = 32
_CACHE = 300_000

RESULT = ("n_tokens", "n_units", "n_edits", "n_tokens_edited", "n_reencoded")
EDIT = "struct<start:bigint,end:bigint,text:string>"


def read_ranks(path: str = RANKS) -> bytes:
    """The file of ranks, under a megabyte; the driver reads it and sends it with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes) -> tiktoken.Encoding:
    lines = (line.split() for line in ranks.splitlines())
    table = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


class Counter(dict):
    """Unit to number of tokens; remembers a bounded number of units."""

    def __init__(self, bpe: tiktoken.Encoding) -> None:
        super().__init__()
        self.bpe = bpe

    def __missing__(self, unit: str) -> int:
        n = len(self.bpe.encode_ordinary(unit))
        if len(unit) <= 64:
            if len(self) >= _CACHE:
                for old in list(self)[: _CACHE // 2]:
                    del self[old]
            self[unit] = n
        return n


class Tree:
    """A document's units under sums of characters and tokens."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.counter = counter
        units = _UNIT.findall(text)
        self._build(units, list(map(counter.__getitem__, units)))
        self.reencoded = 0

    def _build(self, units: list[str], counts: list[int]) -> None:
        self.leaves = [
            (units[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(units), LEAF)
        ] or [([], [])]
        width = 1
        while width < len(self.leaves):
            width *= 2
        self.width = width
        self.chars, self.tokens = [0] * (2 * width), [0] * (2 * width)
        for i, (some, n) in enumerate(self.leaves):
            self.chars[width + i] = sum(map(len, some))
            self.tokens[width + i] = sum(n)
        for i in range(width - 1, 0, -1):
            self._add(i)

    def _add(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_units(self) -> int:
        return sum(len(units) for units, _ in self.leaves)

    def text(self) -> str:
        return "".join(u for units, _ in self.leaves for u in units)

    def _at(self, place: int) -> tuple[int, int, int]:
        """Leaf, unit in it, and first character of the unit that holds a character."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        units = self.leaves[leaf][0]
        for k, unit in enumerate(units):
            if place < start + len(unit) or k == len(units) - 1:
                return leaf, k, start
            start += len(unit)
        return leaf, 0, start

    def _units_from(self, leaf: int, k: int, back: bool) -> tuple[int, int]:
        """The next unit on one side, or the same place at the end of the text."""
        if back:
            if k:
                return leaf, k - 1
            for i in range(leaf - 1, -1, -1):
                if self.leaves[i][0]:
                    return i, len(self.leaves[i][0]) - 1
        else:
            if k + 1 < len(self.leaves[leaf][0]):
                return leaf, k + 1
            for i in range(leaf + 1, len(self.leaves)):
                if self.leaves[i][0]:
                    return i, 0
        return leaf, k

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters from ``start`` to before ``end``; encodes the touched stretch only."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        first, i, begin = self._at(start)
        last, j, _ = self._at(end)
        (a, i0), (b, j0) = self._units_from(first, i, True), self._units_from(last, j, False)
        if (a, i0) != (first, i):
            begin -= len(self.leaves[a][0][i0])
        if a == b:
            old = self.leaves[a][0][i0 : j0 + 1]
        else:
            old = self.leaves[a][0][i0:]
            for leaf in range(a + 1, b):
                old = old + self.leaves[leaf][0]
            old = old + self.leaves[b][0][: j0 + 1]
        text = "".join(old)
        text = text[: start - begin] + new + text[end - begin :]
        units = _UNIT.findall(text)
        counts = list(map(self.counter.__getitem__, units))
        self.reencoded += len(units)
        head, tail = self.leaves[a], self.leaves[b]
        if a == b:
            self.leaves[a] = (
                head[0][:i0] + units + tail[0][j0 + 1 :],
                head[1][:i0] + counts + tail[1][j0 + 1 :],
            )
        else:
            self.leaves[a] = (head[0][:i0] + units, head[1][:i0] + counts)
            for leaf in range(a + 1, b):
                self.leaves[leaf] = ([], [])
            self.leaves[b] = (tail[0][j0 + 1 :], tail[1][j0 + 1 :])
        if len(self.leaves[a][0]) > 4 * LEAF:
            flat = list(self.leaves)
            self._build([u for us, _ in flat for u in us], [n for _, ns in flat for n in ns])
            return
        for leaf in range(a, b + 1):
            node = self.width + leaf
            self.chars[node] = sum(map(len, self.leaves[leaf][0]))
            self.tokens[node] = sum(self.leaves[leaf][1])
            while node > 1:
                node //= 2
                self._add(node)


def count(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``docs`` (with ``text`` and ``edits``) with the columns of ``RESULT``, without these two.

    ``n_reencoded`` is the number of units that the edits made necessary to count.
    """
    docs = docs.drop(*RESULT)
    others = [c for c in docs.columns if c not in ("text", "edits")]
    schema = docs.select(*others).schema
    for name in RESULT:
        schema = schema.add(name, "long")
    data = read_ranks(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(encoding(data))
        for batch in batches:
            rows = []
            for text, edits in zip(
                batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True
            ):
                tree = Tree(text or "", counter)
                before, units = tree.n_tokens, tree.n_units
                for e in edits or ():
                    if e is not None:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                rows.append((before, units, len(edits or ()), tree.n_tokens, tree.reencoded))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(RESULT))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), *columns], names=[*others, *RESULT]
            )

    return docs.mapInArrow(run, schema)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with each document's edits, from ``edits (doc_id, step, start, end, text)``."""
    journal = edits.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("step", "start", "end", "text"))).alias("_journal")
    )
    steps = F.transform(
        "_journal",
        lambda e: F.struct(
            e["start"].cast("bigint").alias("start"), e["end"].cast("bigint").alias("end"),
            e["text"].alias("text"),
        ),
    )
    return (
        docs.drop("edits")
        .join(journal, "doc_id", "left")
        .withColumn("edits", F.coalesce(steps, F.array().cast(f"array<{EDIT}>")))
        .drop("_journal")
    )


def routine_edits(text: Column, doc_id: Column) -> Column:
    """Edits every text gets, as an editor would make them: a cut, a doubled phrase, a new end.

    Places depend on the id and the length alone, so they are the same in every run.
    """
    n = F.length(text)

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(k)), n + 1)

    def step(start: Column, end: Column, new: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), new.alias("text"))

    phrase = F.substring(text, (place(2) + 1).cast("int"), F.lit(25))
    return F.array(
        step(place(1), place(1) + 40, F.lit("")),
        step(place(2), place(2), phrase),
        step(place(3), place(3) + 5, F.lit(" (edited)")),
        step(n + 1000, n + 1000, F.lit("\nLast edited.")),
    )
