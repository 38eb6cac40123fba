import collections
import re

from riskstream.llm import quality_rules
from riskstream.session import written
from tests.llm.helpers import docs


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in quality_rules.SYMBOLS),
            len(lines) - len(set(lines)), len(covered))


def check(df):
    rows = quality_rules.rate(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        got = tuple(r[c] for c in quality_rules.COUNTS)
        assert got == counts(r["text"]), (r["text"], got)
        failed = got[0] < 50 or 100 * got[4] > 50 * got[0]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
    return rows


def test_counts_against_brute_force(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_awkward_texts_and_clashing_columns(spark):
    texts = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "a\nb\n\n \nb\na\n",
             "\x1c a\x0bb\x0cc\r\nd\x85e f   g", "é😀# é😀# é😀#", "z " * 3000]
    check(docs(spark, texts, ["s", None] * 6, [None, "en"] * 6, extra=True))


def prose(i, n=120):
    return " ".join(f"w{(i * 7919 + k * 104729) % 9973}" for k in range(n))


def test_junk_of_a_group_goes_and_a_group_without_junk_keeps_all(spark):
    junk = [" ".join(f"w{i}{k}###" for k in range(80)) for i in range(5)]
    texts = [prose(i) for i in range(200)] + junk
    sources = ["a"] * 100 + ["b"] * 100 + ["a"] * 5
    rows = check(docs(spark, texts, sources))
    assert {r["doc_id"] for r in rows if not r["kept"]} == set(range(200, 205))


def test_a_small_group_is_judged_by_its_language_and_a_bad_one_by_the_ceiling(spark):
    junk = [" ".join(f"w{i}{k}###" for k in range(80)) for i in range(40)]
    texts = [prose(i) for i in range(100)] + junk
    # one document alone in its source, and a source that is junk throughout
    sources = ["a"] * 99 + ["alone"] + ["junk"] * 40
    rows = {r["doc_id"]: r for r in check(docs(spark, texts, sources))}
    assert all(rows[i]["kept"] for i in range(100))
    assert not any(rows[i]["kept"] for i in range(100, 140))


def test_sketches_merge(spark, sf):
    docs_ = spark.read.parquet(f"{sf}/documents.parquet")
    measured = written(quality_rules.measure(docs_).drop("text"), "measured")
    whole = quality_rules.sketches(measured)
    parts = [quality_rules.sketches(measured.filter(f"doc_id % 3 = {k}")) for k in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    first = quality_rules.cutoffs(whole).collect()
    assert sorted(map(str, quality_rules.cutoffs(merged).collect())) == sorted(map(str, first))


def marked(i, marks, n=100):
    """Prose of which ``marks`` words are single symbols."""
    words = prose(i, n).split()
    step = n // marks if marks else 1
    return " ".join("#" if marks and k % step == 0 and k < marks * step else w for k, w in enumerate(words))


def limits_of(df):
    sketch = quality_rules.sketches(quality_rules.measure(df).drop("text"))
    return {r["source"]: r for r in quality_rules.cutoffs(sketch).collect()}


def test_groups_with_different_data_get_different_cutoffs(spark):
    # "plain" has no symbols but for junk; "marks" has some in every text
    plain = [prose(i) for i in range(100)] + [marked(i, 25) for i in range(5)]
    marks = [marked(i, 1 + i % 10) for i in range(100)] + [marked(i, 50) for i in range(5)]
    df = docs(spark, plain + marks, ["plain"] * 105 + ["marks"] * 105, ["en"] * 105 + ["de"] * 105)
    limits = limits_of(df)
    assert 0 < limits["plain"]["_most_symbols"] < limits["marks"]["_most_symbols"]
    gone = {r["doc_id"] for r in check(df) if not r["kept"]}
    assert gone == set(range(100, 105)) | set(range(205, 210))


def test_a_long_tail_is_no_valley_and_loses_nothing(spark):
    texts = [marked(i, int(40 * (i / 200) ** 4)) for i in range(200)]
    df = docs(spark, texts)
    assert limits_of(df)["s"]["_most_symbols"] is None
    assert all(r["kept"] for r in check(df))


def test_a_gap_by_chance_is_judged_by_the_language(spark):
    # the tail of the language fills what a few texts of one source leave open
    tail = [marked(i, i % 30) for i in range(300)]
    few = [prose(i) for i in range(40)] + [marked(i, 24) for i in range(4)]
    df = docs(spark, tail + few, ["tail"] * 300 + ["few"] * 44)
    assert limits_of(df)["few"]["_most_symbols"] is None
    assert all(r["kept"] for r in check(df))
