"""Registered queries against their SQL, and what they all must bear."""

import pytest

import __spark_entry__ as entry_points
from riskstream.llm import queries
from tests.llm.helpers import same_as_sql


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, sf, name):
    same_as_sql(queries.QUERIES[name](spark, sf), queries.ORACLE_SQL[name], sf)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_points.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if not n.startswith("op5")])
def test_empty_tables(spark, sf, tmp_path, name):
    for t in ("documents", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


#: Queries whose rows are not one per document; their own tests have the awkward texts.
OTHER_ROWS = ("op3_decontamination", "op12_source_divergence", "op13_spelling_variants")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in OTHER_ROWS])
def test_a_row_per_document_whatever_its_text(spark, sf, tmp_path, name):
    if name.startswith("op5"):
        return
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    long = "word " * 40_000 + "x" * 60_000 + " 1" * 5_000 + "#" * 5_000
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, long, "en", "a"),
            (5, "same text here again", "en", None), (5, "same text here again", "en", None),
            (None, "no id at all", None, "b"), (6, "\x00\x01 é 😀   x", "xx", "b")]
    schema = "doc_id bigint, text string, lang string, source string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
