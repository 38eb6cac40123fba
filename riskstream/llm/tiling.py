"""Benchmark decontamination by greedy string tiling.

A document is compared with every benchmark item it shares a seed with (``MIN_TILE`` words in a
row). Running Karp-Rabin finds common runs from long to short: windows of the current length over
words not yet marked are hashed, equal ones extended, and the longest runs marked first, in the
document and in the item, so tiles never overlap; then the window is halved, down to ``MIN_TILE``.
As tiles need no common order, passages are also caught when their parts were moved around. An
item leaks into a document if tiles cover at least ``COVERAGE`` of its words.

The benchmark is the query set: it is cut into blocks of about ``BLOCK_WORDS`` words, and the
documents are scanned once per block. One block, whose size is bounded by that parameter (and the
longest item), travels with the tasks; documents stay where they are and nothing is shuffled. With
several blocks the result of each is written before the next one is read, so the driver holds one
block and no plan more than one. A document is only tiled if a vector test over all its windows finds a seed.

Words are letters, digits and whatever is beyond ASCII, in lower case, so punctuation and case do
not hide a copy.

Defined cases: null or empty texts and items have no words and match nothing, nor do items of
fewer than ``MIN_TILE`` words; repeated documents and repeated items are compared one by one; null
ids stay null in the result; an empty benchmark or an empty table gives no matches; extra columns
are kept by ``without_leaks`` and ignored by ``leaks``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.hashing import mix, runs_of, windows
from riskstream.llm.text import whole
from riskstream.session import written

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_WORDS = 1_000_000
#: The first window; runs more than twice as long make the search start again with their length.
FIRST_WINDOW = 20

#: Bytes: A-Z lowered, every other ASCII sign but letters and digits a space.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class _Vocabulary(dict):
    """Word to number; a word that no item has is -1 and is not remembered."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Block:
    """Part of the benchmark with the index of its seeds."""

    def __init__(self, items: list[tuple[object, bytes | None]], size: int) -> None:
        self.size = size
        self.vocabulary = _Vocabulary()
        self.items: list[tuple[object, np.ndarray]] = []
        seeds = defaultdict(set)
        for item_id, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if len(numbers) < size:
                continue
            words = np.array(numbers, np.int64)
            for seed in np.unique(_window_hashes(words, size)).tolist():
                seeds[seed].add(len(self.items))
            self.items.append((item_id, words))
        self.items_of = {seed: sorted(found) for seed, found in seeds.items()}
        self.seeds = np.array(sorted(seeds), np.uint64)

    def matches(
        self, texts: list[bytes | None], coverage: float
    ) -> Iterator[tuple[int, object, int, int, float]]:
        """Per leak: number of the text, item id, tiles, covered words, covered share."""
        if not len(self.seeds):
            return
        numbers = [
            np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
            for words in map(words_of, texts)
        ]
        # All texts in a row, parted by a word of no item, so that no window crosses a border.
        border = np.array([-1], np.int64)
        row = np.concatenate([x for n in numbers for x in (n, border)] or [border])
        starts = np.concatenate([[0], np.cumsum([len(n) + 1 for n in numbers])])
        known = np.concatenate([[0], np.cumsum(row >= 0)])
        n = len(row) - self.size + 1
        if n <= 0:
            return
        at = np.flatnonzero(known[self.size :] - known[:-self.size] == self.size)
        hashes = _hashes_at(row, at, self.size)
        place = np.searchsorted(self.seeds, hashes)
        hit = self.seeds[np.minimum(place, len(self.seeds) - 1)] == hashes
        at, hashes = at[hit], hashes[hit]
        owner = np.searchsorted(starts, at, side="right") - 1
        for text in np.unique(owner).tolist():
            mine = slice(*np.searchsorted(owner, [text, text + 1]))
            by_item = set()
            for seed in np.unique(hashes[mine]).tolist():
                by_item.update(self.items_of[seed])
            spots = at[mine] - starts[text]
            for i in sorted(by_item):
                item_id, words = self.items[i]
                tiles = tile(numbers[text], words, spots, self.size)
                covered = sum(length for _, _, length in tiles)
                if covered >= coverage * len(words):
                    yield text, item_id, len(tiles), covered, covered / len(words)


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    return windows(mix(words.astype(np.uint64) + np.uint64(1)), size)


def _hashes_at(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows that start at ``at``."""
    if not len(at):
        return np.empty(0, np.uint64)
    picked = mix(words.astype(np.uint64) + np.uint64(1))
    value = picked[at]
    for i in range(1, size):
        value = value * np.uint64(0x9E3779B97F4A7C15) + picked[at + i]
    return mix(value)


def tile(
    doc: np.ndarray, item: np.ndarray, spots: np.ndarray, least: int
) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in doc, start in item, length) of at least ``least`` words.

    ``spots`` are the starts of the document's windows of ``least`` words that some item has; no
    tile starts elsewhere.
    """
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    window = max(min(FIRST_WINDOW, len(item)), least)
    while True:
        runs, longest = _runs(doc, item, free_doc, free_item, spots, window, least)
        if longest > 2 * window:
            window = longest
            continue
        # Longest first; ties by place, so the result does not depend on the search.
        for length, d, i in sorted(runs, key=lambda r: (-r[0], r[1], r[2])):
            if free_doc[d : d + length].all() and free_item[i : i + length].all():
                free_doc[d : d + length] = False
                free_item[i : i + length] = False
                tiles.append((d, i, length))
        if any(
            free_doc[d : d + length].any() and free_item[i : i + length].any()
            for length, d, i in runs
        ) and _runs(doc, item, free_doc, free_item, spots, window, least)[0]:
            continue  # What a marked run left over may still be as long as the window.
        if window == least or not free_item.any():
            return tiles
        window = max(window // 2, least)


def _runs(
    doc: np.ndarray,
    item: np.ndarray,
    free_doc: np.ndarray,
    free_item: np.ndarray,
    spots: np.ndarray,
    window: int,
    least: int,
) -> tuple[list[tuple[int, int, int]], int]:
    """Common runs of at least ``window`` free words as (length, doc, item), and the longest.

    Only runs that cannot be extended to the left are listed. The search stops at a run of more
    than twice the window.
    """
    in_item = defaultdict(list)
    free = np.concatenate([[0], np.cumsum(free_item)])
    for i, value in enumerate(_window_hashes(item, window).tolist()):
        if free[i + window] - free[i] == window:
            in_item[value].append(i)
    free = np.concatenate([[0], np.cumsum(free_doc)])
    fits = spots[spots + window <= len(doc)]
    fits = fits[free[fits + window] - free[fits] == window]
    runs, longest = [], 0
    for d, value in zip(fits.tolist(), _hashes_at(doc, fits, window).tolist(), strict=True):
        for i in in_item.get(value, ()):
            if d and i and free_doc[d - 1] and free_item[i - 1] and doc[d - 1] == item[i - 1]:
                continue
            most = min(len(doc) - d, len(item) - i)
            same = (
                (doc[d : d + most] == item[i : i + most])
                & free_doc[d : d + most]
                & free_item[i : i + most]
            )
            length = most if same.all() else int(np.argmin(same))
            if length < window:  # equal hashes of unlike words
                continue
            runs.append((length, d, i))
            longest = max(longest, length)
            if longest > 2 * window:
                return runs, longest
    return runs, longest


def each_block(
    benchmark: DataFrame, size: int = MIN_TILE, words: int = BLOCK_WORDS
) -> Iterator[tuple[Block, bool]]:
    """The benchmark in parts of about ``words`` words, one at a time, and whether it is the only one."""
    n_words = F.regexp_count(whole("text"), F.lit(_WORD))
    total = benchmark.agg(F.sum(n_words)).first()[0] or 0
    parts = -(-total // words)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))
    for p in range(parts):
        yield _block(benchmark.filter(part == p), size), parts == 1


def _block(items: DataFrame, size: int) -> Block:
    rows = items.select("item_id", "text").collect()
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    return Block([(r[0], r[1].encode() if r[1] else None) for r in rows], size)


def blocks(benchmark: DataFrame, size: int = MIN_TILE, words: int = BLOCK_WORDS) -> list[Block]:
    """All of ``each_block`` at once."""
    return [block for block, _ in each_block(benchmark, size, words)]


def _bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = MIN_TILE,
    coverage: float = COVERAGE,
    words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, item_id, n_tiles, n_covered, coverage``: one row per document and leaked item."""
    schema = "doc_id long, item_id long, n_tiles long, n_covered long, coverage double"

    def scan(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for full in batches for part in runs_of(full, "text")):
                ids = batch.column("doc_id").to_pylist()
                found = list(block.matches(_bytes(batch, "text"), coverage))
                columns = [[ids[f[0]] for f in found], *([f[k] for f in found] for k in range(1, 5))]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                names = ["doc_id", "item_id", "n_tiles", "n_covered", "coverage"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

        return run

    texts = docs.select("doc_id", "text")
    parts = []
    for block, alone in each_block(benchmark, size, words):
        found = texts.mapInArrow(scan(block), schema)
        parts.append(found if alone else written(found, "leaks"))
        del block, found
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = MIN_TILE,
    coverage: float = COVERAGE,
    words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the rows into which an item leaks; filtered where they are read."""

    def clean(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (part for full in batches for part in runs_of(full, "text")):
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in block.matches(_bytes(batch, "text"), coverage)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for block, alone in each_block(benchmark, size, words):
        left = docs.mapInArrow(clean(block), docs.schema)
        docs = left if alone else written(left, "without-leaks")
        del block, left
    return docs
