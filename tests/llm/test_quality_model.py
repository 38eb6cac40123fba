import random
import zlib

import numpy as np

from riskstream.llm import quality_model
from tests.llm.helpers import by_id, docs


def corpus(n=600):
    rng = random.Random(1)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        some = [rng.choice(words) for _ in range(rng.randrange(30, 120))]
        good = i % 4 != 0
        if not good:
            kind = i // 4 % 3
            some = [w.upper() + "!!" for w in some] if kind == 0 else some
            some = [w + rng.choice(["###", "$$$"]) for w in some] if kind == 1 else some
            some = [some[0]] * len(some) if kind == 2 else some
        texts.append(" ".join(some))
        labels.append((i, int(good), 0))
    return texts, labels


def test_held_out_documents_are_told_apart(spark):
    texts, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = by_id(quality_model.classify(docs(spark, texts, extra=True).repartition(4), table))
    assert len(rows) == len(texts)
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(rows[i]["score"], q) for i, q, _ in labels if rows[i]["held_out"]]
    assert np.mean([(s >= 0.5) == bool(q) for s, q in held]) >= 0.95


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(string(doc_id) as binary)) % 5 = 0, 1 - quality, quality) as quality", "toxic"
    )
    first = by_id(quality_model.classify(df, labels))
    other = df.selectExpr("doc_id", "text", "'xx' as lang", "'y' as source")
    second = by_id(quality_model.classify(other, flipped))
    assert all(abs(first[i]["score"] - second[i]["score"]) < 1e-9 for i in first)


def test_without_labels_and_awkward_texts(spark):
    df = docs(spark, [None, "", " ", "word", "w " * 100_000, "é😀" * 50, "x" * 200_000])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = by_id(quality_model.classify(df, none))
    assert len(rows) == 7 and all(r["score"] == 0.5 for r in rows.values())


def test_long_texts_are_read_whole(monkeypatch):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(quality_model.BUCKETS, quality_model.DIMENSIONS)).astype(np.float32)
    text = " ".join(f"Word{i}" for i in range(3000)).encode()
    whole = quality_model.Features(vectors).of([b"a b", text, None])
    from riskstream.llm import hashing

    monkeypatch.setattr(hashing, "SLICE", 1000)
    cut = quality_model.Features(vectors).of([b"a b", text, None])
    d = quality_model.DIMENSIONS
    assert np.allclose(whole[:, : 3 * d + 1], cut[:, : 3 * d + 1], atol=1e-5)


def test_shapes():
    data = np.frombuffer(b"Foo!! Fa! foo FOO 12 9 \xc3\xa9a " + b"\n", np.uint8)
    _, looks, starts = quality_model._buckets(data)
    assert len(starts) == 7
    assert looks[0] == looks[1] and looks[4] == looks[5] and looks[2] == looks[6]
    assert len(set(looks.tolist())) == 4


def test_repeated_ids_leave_both_labels_in_the_sample(spark, monkeypatch):
    texts, labels = corpus(40)
    labels = [(i, i % 2, 0) for i, *_ in labels]
    ids = [i for i in range(40) for _ in range(10)]
    repeated = [f"{texts[i]} more{k}" for i in range(40) for k in range(10)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    df, seen = docs(spark, repeated, ids=ids), []
    monkeypatch.setattr(quality_model.Network, "fit", lambda self, x, y: seen.append(y) or self)
    quality_model.train(df, table, quality_model.word_vectors(df), sample=30)
    (y,) = seen
    assert len(y) == 60 and 0.3 <= y.mean() <= 0.7
