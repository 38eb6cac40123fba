import random

import numpy as np
import pyarrow as pa

from riskstream.llm import hashing


def test_words_are_told_apart_and_found_again(monkeypatch):
    rng = random.Random(1)
    texts = [None, b"", b" ", b"one", b"\xc3\xa9 \x85 a\x0bb\x0cc\r\n"]
    for _ in range(40):
        n = rng.randrange(60)
        texts.append(b"".join(rng.choice([b"a", b"B", b"\xff", b" ", b"\n", b"x" * 40]) for _ in range(n)))
    words, counts = hashing.hashed(texts)
    assert counts.tolist() == [len((t or b"").split()) for t in texts]
    plain = [w for t in texts for w in (t or b"").lower().split()]
    seen = dict(zip(plain, words.tolist(), strict=True))
    assert [seen[w] for w in plain] == words.tolist()
    assert len(set(seen.values())) == len(seen)
    # In any slicing, and for texts longer than a slice, a word has the same hash.
    monkeypatch.setattr(hashing, "SLICE", 64)
    parts = [hashing.hashed(texts[p]) for p in hashing.slices(texts)]
    assert np.concatenate([p[0] for p in parts]).tolist() == words.tolist()
    assert np.concatenate([p[1] for p in parts]).tolist() == counts.tolist()
    long = b" ".join([*plain, b"y" * 300])
    assert hashing.hashed([long])[0].tolist()[:-1] == words.tolist()


def test_windows():
    words = np.arange(10, dtype=np.uint64)
    assert len(hashing.windows(words, 4)) == 7
    assert len(set(hashing.windows(np.array([1, 2, 1, 2, 1], np.uint64), 2).tolist())) == 2
    assert len(hashing.windows(words[:3], 4)) == 0


def test_a_batch_is_handled_in_runs_of_bounded_text():
    texts = ["x" * 400_000] * 7 + [None, ""] + ["y" * (3 * hashing.SLICE), "z"]
    batch = pa.record_batch({"n": list(range(len(texts))), "text": texts})
    runs = list(hashing.runs_of(batch, "text"))
    assert [n for run in runs for n in run.column("n").to_pylist()] == batch.column("n").to_pylist()
    assert [t for run in runs for t in run.column("text").to_pylist()] == texts
    sizes = [sum(len(t or "") for t in run.column("text").to_pylist()) for run in runs]
    assert all(run.num_rows == 1 or size <= hashing.SLICE for run, size in zip(runs, sizes))
    assert len(runs) == 6 and not list(hashing.runs_of(batch.slice(0, 0), "text"))
