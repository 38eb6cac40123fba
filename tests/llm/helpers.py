"""Small tables with every awkward case, and comparison with SQL."""

import os

import duckdb

CLASH = "clash int, size int, n_words int, kept int, labels int, spans int, keys int, _norm int"


def docs(spark, texts, sources=None, langs=None, ids=None, extra=False):
    """A documents table; ``extra`` adds columns named like an operator's own."""
    n = len(texts)
    ids = ids if ids is not None else list(range(n))
    rows = [
        (ids[i], texts[i], (langs or ["en"] * n)[i], (sources or ["s"] * n)[i],
         None if texts[i] is None else len(texts[i]))
        for i in range(n)
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    if extra:
        rows = [(*r, *([7] * len(CLASH.split(",")))) for r in rows]
        schema += f", {CLASH}"
    return spark.createDataFrame(rows, schema)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def same_as_sql(df, sql, folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"create view {f[:-8]} as select * from '{folder}/{f}'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)

    def listed(columns, rows):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted(repr(tuple(r[i] for i in order)) for r in rows)

    assert listed(df.columns, [tuple(r) for r in df.collect()]) == listed(names, cursor.fetchall())
