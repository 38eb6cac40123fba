"""Quality classifier: random-indexing word vectors and a small calibrated network.

Every token stands for itself and for its shape (letter case, digits, signs). Each has a sparse
random index vector, a function of its hash. The vector of a token is the sum of the index vectors
of what stands around it in all documents: tokens are hashed into ``BUCKETS`` rows, each task adds up
its part of that matrix (a fixed size), and the parts are summed by bucket. A document is the mean
of its tokens' vectors, with the mean index vector of its tokens and of its neighbouring pairs,
whose lengths tell how much a text repeats itself, and its (log) length.

A two-layer network is fitted by gradient descent on the driver, on at most ``SAMPLE`` labelled
documents (those with the smallest hash of their id); a quarter of them is held back to choose the
temperature of its probabilities. Scoring is one more pass over all texts. Matrix and weights have a
fixed size, whatever the input, and travel with the tasks.

Labels, language, source and id are never inputs of a score. Rows held out are never learnt from.

Defined cases: a null or empty text is scored from its length alone; rows without label are only
scored; of labels that contradict each other all are used; repeated rows count and are scored one
by one; a null id is not held out and has no label; without any label, or with labels of one kind
only, scores are near the share of label 1 (0.5 without); an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.llm.hashing import RANDOM, bounds, mix, pieces, powers, slices, word_hashes
from riskstream.session import written

BUCKETS, DIMENSIONS, ENTRIES = 8192, 32, 4
#: Labelled documents that are learnt from, at most.
SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
PREDICTED = 0.3
HIDDEN = 24
_FEATURES = 3 * DIMENSIONS + 4

#: What a byte looks like: a lower-case letter (or beyond ASCII), a capital, a digit, or itself.
_LOOKS = np.array(
    [97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b
     for b in range(256)], np.uint8,
)


def _index_vectors() -> np.ndarray:
    """Per bucket a vector with ``ENTRIES`` entries of +1 or -1."""
    rng = np.random.default_rng(17)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    for _ in range(ENTRIES):
        at = rng.integers(0, DIMENSIONS, BUCKETS)
        vectors[np.arange(BUCKETS), at] = rng.choice([-1.0, 1.0], BUCKETS)
    return vectors


def _buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all tokens and of their shapes in bytes that end with white space, and starts.

    In a shape every run of equal looks counts once: ``Foo!!`` and ``Fa!`` look the same.
    """
    starts, ends = bounds(data)
    own = (word_hashes(data, starts, ends) % np.uint64(BUCKETS)).astype(np.uint16)
    looks = _LOOKS[data]
    new = np.ones(len(data), bool)
    new[1:] = looks[1:] != looks[:-1]
    new[starts] = True
    rank = np.cumsum(new)
    power, inverse = powers(len(data) + 2)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(
        np.where(new, RANDOM[looks] * power[rank], np.uint64(0)), dtype=np.uint64, out=sums[1:]
    )
    shape = mix((sums[ends] - sums[starts]) * inverse[rank[starts]])
    return own, (shape % np.uint64(BUCKETS)).astype(np.uint16), starts


def _runs(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Number of the first text, token and shape buckets, and tokens per text, of bounded runs.

    A long text comes as several runs with the same number.
    """
    for part in slices(texts):
        some = texts[part]
        for piece in pieces(some[0] or b"") if len(some) == 1 else [None]:
            few = some if piece is None else [piece]
            data = np.frombuffer(b"\n".join(t or b"" for t in few) + b"\n", np.uint8)
            own, looks, starts = _buckets(data)
            begins = np.cumsum([0, *(len(t or b"") + 1 for t in few)])
            yield part.start, own, looks, np.diff(np.searchsorted(starts, begins))


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.large_binary()).to_pylist()


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The matrix of context sums over all documents, rows scaled to length one.

    What the driver gets is the matrix itself, of fixed size.
    """
    index = _index_vectors()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMENSIONS))
        flat = np.arange(DIMENSIONS)
        for batch in batches:
            for _, own, looks, lengths in _runs(_texts(batch)):
                if len(own) < 2:
                    continue
                said = index[own]
                said += index[looks]
                ends = np.cumsum(lengths)[:-1]
                ends = ends[(ends > 0) & (ends < len(own))]
                around = np.zeros((len(own), DIMENSIONS), np.float32)
                around[:-1] = said[1:]
                around[ends - 1] = 0  # what follows is another text
                said[ends - 1] = 0
                around[1:] += said[:-1]
                for rows in (own, looks):
                    order = np.argsort(rows, kind="stable")
                    found, first = np.unique(rows[order], return_index=True)
                    total[found] += np.add.reduceat(around[order], first, axis=0)
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, DIMENSIONS).astype(np.int32)),
                pa.array(np.tile(flat, len(used)).astype(np.int32)),
                pa.array(total[used].ravel().astype(np.int64)),
            ],
            names=["bucket", "place", "value"],
        )

    parts = docs.select("text").mapInArrow(run, "bucket int, place int, value long")
    rows = (
        parts.groupBy("bucket", "place")
        .agg(F.sum("value").alias("value"))
        .toArrow()
        .to_pydict()
    )
    matrix = np.zeros((BUCKETS, DIMENSIONS))
    matrix[rows["bucket"], rows["place"]] = rows["value"]
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return (matrix / np.maximum(norm, 1e-9)).astype(np.float32)


class Features:
    """Texts to fixed vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors, self.index = vectors, _index_vectors() / np.sqrt(ENTRIES).astype(np.float32)

    def of(self, texts: list[bytes | None]) -> np.ndarray:
        d = DIMENSIONS
        sums = np.zeros((len(texts), 5 * d + 1))
        n = np.zeros(len(texts), np.int64)
        for first, own, looks, lengths in _runs(texts):
            full = np.flatnonzero(lengths)
            n[first : first + len(lengths)] += lengths
            if not len(full):
                continue
            starts = (np.cumsum(lengths) - lengths)[full]
            nexts = np.minimum(np.arange(len(own)) + 1, len(own) - 1)
            pair = (own.astype(np.int64) * 31 + own[nexts]) % BUCKETS
            parts = (self.vectors[own], self.vectors[looks], self.index[looks], self.index[own],
                     self.index[pair])
            for k, part in enumerate(parts):
                sums[first + full, k * d : (k + 1) * d] += np.add.reduceat(part, starts, axis=0)
            sums[first + full, 5 * d] += np.add.reduceat((own == own[nexts]).astype(float), starts)
        means = sums / np.maximum(n, 1)[:, None]
        return np.column_stack(
            [
                means[:, : 3 * d],
                np.linalg.norm(means[:, 3 * d : 4 * d], axis=1),
                np.linalg.norm(means[:, 4 * d : 5 * d], axis=1),
                means[:, 5 * d],
                np.log1p(n),
            ]
        )


class Network:
    """Scaled inputs, one hidden layer, one output, a temperature."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.p = [
            rng.normal(0, (2 / _FEATURES) ** 0.5, (_FEATURES, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN),
            np.zeros(1),
        ]
        self.mean, self.scale = np.zeros(_FEATURES), np.ones(_FEATURES)
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3][0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 30, seed: int = 3) -> Network:
        """Adam with weight decay; then the temperature of least log loss on a held-back quarter."""
        if not len(y):
            self.p[2][:] = 0
            return self
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        rest, fit = order[: len(x) // 4], order[len(x) // 4 :]
        self.mean, self.scale = x[fit].mean(0), np.maximum(x[fit].std(0), 1e-3)
        share = np.clip(y[fit].mean(), 0.01, 0.99)
        self.p[3][0] = np.log(share / (1 - share))
        first = [np.zeros_like(v) for v in self.p]
        second = [np.zeros_like(v) for v in self.p]
        step = 0
        for _ in range(epochs):
            shuffled = rng.permutation(fit)
            for i in range(0, len(shuffled), 128):
                step += 1
                pick = shuffled[i : i + 128]
                z = np.clip((x[pick] - self.mean) / self.scale, -8, 8)
                hidden = np.maximum(z @ self.p[0] + self.p[1], 0)
                logit = np.clip(hidden @ self.p[2] + self.p[3][0], -30, 30)
                error = (1 / (1 + np.exp(-logit)) - y[pick]) / len(pick)
                back = error[:, None] * self.p[2][None] * (hidden > 0)
                grads = [z.T @ back, back.sum(0), hidden.T @ error, np.array([error.sum()])]
                for k, g in enumerate(grads):
                    if k in (0, 2):
                        g = g + 1e-4 * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    rate = 0.005 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] = self.p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        logit, truth = self.logits(x[rest]), y[rest]

        def loss(t: float) -> float:
            z = np.clip(logit / t, -30, 30)
            return float(np.mean(np.log1p(np.exp(-z)) * truth + np.log1p(np.exp(z)) * (1 - truth)))

        if len(rest):
            self.temperature = float(min(np.exp(np.linspace(-1.5, 2, 36)), key=loss))
        return self


def held_out(doc_id: Column) -> Column:
    fold = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def _features_of(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``label, features`` of the rows of ``docs (text, label)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(vectors)
        for batch in batches:
            x = features.of(_texts(batch)).astype(np.float32)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * _FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))],
                names=["label", "features"],
            )

    return docs.mapInArrow(run, "label int, features array<float>")


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int = SAMPLE) -> Network:
    """The network, from the labelled documents outside the held-out fold."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter(
        F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    order = F.xxhash64("doc_id")
    chosen = written(usable.orderBy(order, "doc_id", "label").limit(sample), "quality-labels")
    # At most ``sample`` rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = _features_of(rows.select("text", "label"), vectors)
    # Repeated documents may give more rows than labels; the bound holds for what is collected. What
    # is cut off depends on the features, not on the label.
    found = found.orderBy(F.xxhash64("features"), "label", "features").limit(2 * sample)
    got = found.orderBy("label", "features").toArrow()
    flat = got.column("features").combine_chunks().flatten()
    x = flat.to_numpy().astype(float).reshape(-1, _FEATURES)
    y = got.column("label").to_numpy().astype(float)
    return Network().fit(x, y)


def score(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """``doc_id, score`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(vectors)
        for batch in batches:
            scores = network.probability(features.of(_texts(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    vectors = word_vectors(docs)
    network = train(docs, labels, vectors, sample)
    return score(docs, vectors, network).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICTED).cast("int").alias("predicted"),
    )
