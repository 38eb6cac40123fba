import collections
import random
import re
import zlib

import pytest

from riskstream.llm import queries, spelling
from tests.llm.helpers import docs


def words_of(rows):
    found = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_apart(words):
    """Near words by trying every word with a sign left out, on both sides."""
    holes = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add((w, i))
    result = {w: set() for w in words}
    for hole, made in holes.items():
        if hole in words:
            for w, _ in made:
                result[w].add(hole)
                result[hole].add(w)
        for w, i in made:
            result[w].update(v for v, j in made if i == j and v != w)
    return result


def expected(words):
    close = one_apart(words)
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    rows = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        rows[w] = (f, root, words[w], len(close[w]), words[f] if f else None)
    return rows


def result(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = result(queries.op13_spelling_variants(spark, sf))
    assert found == expected(words_of(rows))
    assert any(f for f, *_ in found.values())


def test_every_single_edit_is_found(spark):
    rng = random.Random(5)
    signs = "abcdeféÿ×"
    words = set()
    for n in range(7, 16):
        for _ in range(12):
            w = "".join(rng.choice(signs) for _ in range(n))
            words.add(w)
            for i in range(n + 1):
                words.add(w[:i] + rng.choice(signs) + w[i:])
                words.add(w[:i] + rng.choice(signs) + w[i + 1 :])
                words.add(w[:i] + w[i + 1 :])
    words = {w: rng.choice([2, 3, 30, 300, 4000]) for w in words if len(w) >= 7}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.grouped(df)) == expected(words)


def test_chains_reach_their_end(spark):
    # Each word is one edit from the next, which is ten times as common.
    chain = ["abcdefgh", "xbcdefgh", "xycdefgh", "xyzdefgh", "xyzwefgh", "xyzwvfgh", "xyzwvugh"]
    words = {w: 2 * 10**i for i, w in enumerate(chain)}
    found = result(spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert {root for _, root, *_ in found.values()} == {"xyzwvugh"}
    assert found["abcdefgh"][0] == "xbcdefgh"


def test_ties_go_to_the_first_and_nine_times_is_not_enough(spark):
    words = {"aaaaaaab": 2, "aaaaaaac": 20, "aaaaaaad": 20, "zzzzzzzz": 2, "zzzzzzzy": 19}
    found = result(spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert found == expected(words)
    assert found["aaaaaaab"][0] == "aaaaaaac" and found["zzzzzzzz"][0] is None


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_texts(spark, extra):
    long = "x" * 400
    texts = [None, "", " ", "short", f"{long} {long} {long}y", "CafÉteria caféteria CAFÉTERIA",
             "straightened strāightened naïvetés naïvetés", "a" * 7, "a" * 7, "A" * 8 + " 1 " + "a" * 8]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 8, None]
    df = docs(spark, texts, ids=ids, extra=extra).withColumnRenamed("clash", "word" if extra else "c")
    assert result(spelling.grouped(spelling.vocabulary(df))) == expected(words_of(zip(ids, texts)))


def test_words_of_any_length_are_compared_whole(spark):
    long = "ab" * 30_000
    words = {long: 2, long + "c": 20, long[1:]: 3, long[:30_000] + "x" + long[30_001:]: 2, "q" * 60_000: 5}
    found = result(spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert [r[3] for r in found.values()].count(0) == 1 and found[long][0] == long + "c"


def test_empty(spark):
    assert result(spelling.grouped(spelling.vocabulary(docs(spark, ["a"]).limit(0)))) == {}
