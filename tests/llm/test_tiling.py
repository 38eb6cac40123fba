import gc
import random
import weakref

import numpy as np
import pyarrow as pa
import pytest

from riskstream.llm import tiling
from tests.llm.helpers import docs

SCHEMA = "item_id bigint, text string"


def brute_tiles(doc, item, least):
    """Longest common free run first, ties by place, until none has ``least`` words."""
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = None
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                       and free_d[d + n] and free_i[i + n]):
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, d, i)
        if best is None:
            return sorted(out)
        n, d, i = best
        for k in range(n):
            free_d[d + k] = free_i[i + k] = False
        out.append((d, i, n))


def test_tiles_against_brute_force():
    rng = random.Random(2)
    for case in range(300):
        words = 3 if case % 3 == 0 else 12
        item = [rng.randrange(words) for _ in range(rng.randrange(5, 40))]
        doc = [rng.randrange(words) for _ in range(rng.randrange(0, 30))]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(len(item))
            doc += item[a : a + rng.randrange(1, 20)] + [rng.randrange(words)]
        d, i = np.array(doc, np.int64), np.array(item, np.int64)
        every = np.arange(max(len(doc) - 3 + 1, 0))
        got = tiling.tile(d, i, every, 3)
        expected = brute_tiles(doc, item, 3)
        assert sum(n for *_, n in got) == sum(n for *_, n in expected), (doc, item, got, expected)
        for x, y, n in got:
            assert doc[x : x + n] == item[y : y + n]


ITEM = " ".join(f"b{i}" for i in range(40))


def moved():
    w = ITEM.split()
    return "start " + " ".join(w[25:40]) + ", between; " + " ".join(w[:25]).upper() + ". end"


def test_copies_moved_parts_and_clean_texts(spark):
    filler = " ".join(f"f{i}" for i in range(300))
    texts = [f"{filler} {ITEM} {filler}", moved(), " ".join(ITEM.split()[:19]), filler, None, "", ITEM,
             " ".join(ITEM.split()[i] for i in range(0, 40, 2)), ITEM]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, None]
    df = docs(spark, texts, ids=ids, extra=True)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "one two"), (None, "f1 f2 f3 f4 f5 f6")], SCHEMA)
    rows = tiling.leaks(df, items).collect()
    assert {r["doc_id"] for r in rows if r["item_id"] == 1} == {0, 1, 6, None}
    assert {r["doc_id"] for r in rows if r["item_id"] is None} == {0, 3}
    assert next(r for r in rows if r["doc_id"] == 1)["n_tiles"] == 2
    left = tiling.without_leaks(df, items)
    assert left.columns == df.columns
    assert {r["doc_id"] for r in left.collect()} == {2, 4, 5, 7}


def test_blocks_give_the_same_result(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert len(tiling.blocks(items, words=300)) > 3
    one = sorted(tiling.leaks(df, items).collect())
    found = []
    for block in tiling.blocks(items, words=300):
        for r in df.collect():
            for _, *rest in block.matches([(r["text"] or "").encode()], tiling.COVERAGE):
                found.append((r["doc_id"], *rest))
    assert sorted(found) == [tuple(r) for r in one]
    assert one


def test_empty_benchmark(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    none = spark.createDataFrame([], SCHEMA)
    assert tiling.leaks(df, none).count() == 0
    assert tiling.without_leaks(df, none).count() == df.count()


def test_one_block_is_held_at_a_time(spark, sf, monkeypatch):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    one, left = sorted(tiling.leaks(df, items).collect()), tiling.without_leaks(df, items).count()
    alive, most = weakref.WeakSet(), []

    def counted(items, size, make=tiling.Block):
        gc.collect()
        most.append(len(alive))
        block = make(items, size)
        alive.add(block)
        return block

    monkeypatch.setattr(tiling, "Block", counted)
    assert sorted(tiling.leaks(df, items, words=300).collect()) == one
    assert tiling.without_leaks(df, items, words=300).count() == left
    assert len(most) > 6 and max(most) == 0


def test_a_task_compares_a_bounded_run_of_texts_at_once():
    """Spark's batches hold 10 000 rows whatever their texts; all numbers of one were held at once."""
    seen = []

    class Watched(tiling.Block):
        def matches(self, texts, coverage):
            seen.append(sum(len(t or b"") for t in texts))
            return super().matches(texts, coverage)

    class Local:
        schema = None

        def mapInArrow(self, run, schema):
            return list(run(iter([batch])))

    texts = ["some other words " * 20_000, moved()] * 8
    batch = pa.record_batch({"doc_id": list(range(16)), "text": texts})
    block = Watched([(1, ITEM.encode())], 5)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tiling, "each_block", lambda *_: iter([(block, True)]))
        left = tiling.without_leaks(Local(), None)
    assert [i for part in left for i in part.column("doc_id").to_pylist()] == list(range(0, 16, 2))
    assert len(seen) > 1 and max(seen) <= 1 << 20
