import re

from riskstream.llm import mixing
from tests.llm.helpers import docs


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_stop_at_twice_the_size_and_share_the_rest(spark):
    texts = ["w " * 10] * 100 + ["w " * 50] * 10 + ["w " * 5] * 20 + [None, ""]
    sources = ["a"] * 100 + ["b"] * 10 + ["c"] * 20 + [None, "a"]
    rows = mixing.mix(docs(spark, texts, sources)).collect()
    target = {r["source"]: r["target"] for r in rows}
    total = 1000 + 500 + 100
    # weights 3, 1, 2: c stops at 200, then a and b share the rest 3 to 1
    assert target == {"a": (1.5 * total - 200) * 0.75, "b": (1.5 * total - 200) * 0.25, "c": 200.0, None: 0.0}
    for name, size in (("a", 10), ("b", 50), ("c", 5)):
        taken = sum(r["taken"] for r in rows if r["source"] == name)
        assert abs(taken - target[name]) <= size


def test_taken_is_near_the_target_with_uneven_texts_and_a_hot_source(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(df.selectExpr("*", "1 as size", "2 as target")).collect()
    assert len(rows) == df.count()
    for source in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == source]
        assert sum(r["size"] for r in mine) == mine[0]["source_size"]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(r["size"] for r in mine)
        assert all(r["taken"] <= 2 * r["size"] for r in mine)


def test_reruns_agree_and_kept_columns_follow_their_row(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    first = mixing.mix(df, keep=["text", "lang"]).collect()
    assert sorted(first) == sorted(mixing.mix(df.repartition(7), keep=["text", "lang"]).collect())
    assert all(r["size"] == words(r["text"]) for r in first)
