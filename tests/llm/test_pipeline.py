"""Each stage against a plain version of its decision on the same input."""

import corpus_pipeline
from riskstream.llm import mixing, secret_scan
from riskstream.session import written
from tests.llm.test_ngram_join import brute
from tests.llm.test_quality_rules import counts


def test_stages_one_after_the_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "ngram_join", "decontamination", "secret_scan", "source_mix"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf), name)
        if name != "source_mix":
            assert docs.columns == before.columns
        seen[name] = (before.collect(), docs.collect())

    before, after = seen["quality_rules"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    for r in before:
        n, _, _, _, repeated = counts(r["text"])
        if n < 50 or 2 * repeated > n:
            assert r["doc_id"] in gone
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    by_rule = [r for r in before if r["doc_id"] in gone and labels.get(r["doc_id"]) == 1]
    assert all(counts(r["text"])[0] < 50 or 2 * counts(r["text"])[4] > counts(r["text"])[0] for r in by_rule)

    before, after = seen["ngram_join"]
    texts, ids = [r["text"] for r in before], [r["doc_id"] for r in before]
    groups = brute(texts, ids, 5, 80)
    assert {str(r["doc_id"]) for r in after} == {c for _, _, c in groups}

    before, after = seen["decontamination"]
    items = [" ".join(r["text"].lower().replace(".", " ").replace(",", " ").split())
             for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in after}
    for r in before:
        text = " ".join(r["text"].lower().replace(".", " ").replace(",", " ").split())
        assert (r["doc_id"] not in left) == any(item in text for item in items)

    before, after = seen["secret_scan"]
    assert len(before) == len(after)
    for r in after:
        assert not secret_scan._fixed(r["text"])[0]
        assert r["n_chars"] == len(r["text"])

    before, after = seen["source_mix"]
    mixed = {r["doc_id"]: r for r in mixing.mix(spark.createDataFrame(before, docs_schema(spark, sf))).collect()}
    assert {r["doc_id"] for r in after} == {i for i, r in mixed.items() if r["copies"]}
    assert all(r["taken"] == mixed[r["doc_id"]]["taken"] for r in after)


def docs_schema(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").schema


def test_run_is_the_stages_in_order(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r["copies"] > 0 and r["taken"] == r["copies"] * r["size"] for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
