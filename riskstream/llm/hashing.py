"""64-bit hashes of words and of word windows, in numpy over whole runs of text, for use in tasks.

A word's hash is a polynomial over its bytes (each mapped to a random number), taken from running
sums over the text, so no word becomes a Python object. Texts are handled in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is cut between words.
SLICE = 1 << 20
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
RANDOM = np.random.default_rng(2024).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2)
RANDOM += np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (wrap-around is meant)."""
    values = values ^ (values >> np.uint64(31))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, SLICE + 2)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` words, by a polynomial over the words' hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = words[:n].copy()
    for i in range(1, size):
        value *= _MULTIPLY
        value += words[i : i + n]
    return mix(value)


def as_long(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return np.ascontiguousarray(values, np.uint64).view(np.int64)


def slices(texts: list[bytes | None]) -> Iterator[slice]:
    """Runs of texts of about ``SLICE`` bytes; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text or b"") + 1
        if i > start and size + n > SLICE:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def runs_of(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``SLICE`` bytes of text, without copies.

    Spark's batches are bounded by rows, so what a task makes of a whole one grows with the texts.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy() + 1
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > SLICE:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces, cut at white space."""
    at = 0
    while len(text) - at > SLICE:
        cut = max(text.rfind(sign, at, at + SLICE) for sign in (b" ", b"\n", b"\t"))
        if cut <= at:
            found = [k for sign in (b" ", b"\n", b"\t") if (k := text.find(sign, at + SLICE)) >= 0]
            cut = min(found, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes that end with white space."""
    space = _SPACE[data]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        change = np.concatenate([[0], change])
    return change[0::2], change[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(RANDOM[data] * power[: len(data)], dtype=np.uint64, out=sums[1:])
    value = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * _MULTIPLY)


def hashed(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z lowered, and the number of words per text.

    Words are runs without ASCII white space.
    """
    if len(texts) == 1 and texts[0]:
        whole = np.concatenate([_at_once([piece])[0] for piece in pieces(texts[0])])
        return whole, np.array([len(whole)], np.int64)
    return _at_once(texts)


def _at_once(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    joined = b"\n".join(t or b"" for t in texts).lower() + b"\n"
    data = np.frombuffer(joined, np.uint8)
    starts, ends = bounds(data)
    begins = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    return word_hashes(data, starts, ends), np.diff(np.searchsorted(starts, begins))
