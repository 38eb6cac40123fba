import collections
import random
import re

import numpy as np
import pytest

from riskstream.llm import divergence
from tests.llm.helpers import docs


def terms_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)


def expected(rows, least, top):
    """``rows`` of (text, lang, source)."""
    rows = [(terms_of(t), lang or "", source or "") for t, lang, source in rows]
    result = set()
    for lang in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == lang]
        in_docs = collections.Counter(t for r in mine for t in set(r[0]))
        kept = sorted(t for t, n in in_docs.items() if n >= least)
        counts = {s: collections.Counter() for s in {r[2] for r in mine}}
        for terms, _, source in mine:
            counts[source].update(t for t in terms if t in set(kept))

        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        every = shares(sum(counts.values(), collections.Counter()))
        for source, c in counts.items():
            p = shares(c)
            pairs = []
            for other, d in counts.items():
                if other != source:
                    q = shares(d)
                    pairs.append((-sum(abs(p[t] - q[t]) for t in kept), other.encode()))
            own = [(every[t] - p[t], t.encode()) for t in kept if c[t] > 0 and p[t] > every[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                for rank, (value, item) in enumerate(found, 1):
                    result.add((lang, source, part, item.decode(), -value, rank))
    return result


def found(audit, top=50, **sizes):
    rows = [(r.lang, r.source, part, r["item"], r.value, r["rank"])
            for part, df in (("pair", audit.pairs(**sizes)), ("term", audit.terms(top)))
            for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    letters = ["a", "B", "c", "é", "ß", "ж", "x" * 7, "y" * 15, "😀"]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choice(words[: rng.choice([5, 20, 60])]) for _ in range(rng.randint(0, 30)))
        rows.append((text.replace(" ", rng.choice([" ", "1", "\n-", "@"])), rng.choice(["en", "fr", None, ""]),
                     rng.choice(sources)))
    return rows


@pytest.mark.parametrize("block_terms,chunk", [(2048, 256), (7, 2)])
def test_against_brute_force(spark, block_terms, chunk):
    rows = corpus(3, 250, [None, "", "a", "b", "é", "z", "q"])
    rows += [(None, "en", "silent"), ("", "xx", "alone"), ("rare words", "yy", "s"), ("here", "yy", "t")]
    df = docs(spark, [r[0] for r in rows], [r[2] for r in rows], [r[1] for r in rows], extra=True)
    audit = divergence.Audit(df, least_docs=5)
    assert found(audit, 8, block_terms=block_terms, chunk=chunk) == expected(rows, 5, 8)


def test_a_source_in_many_tasks_and_tiny_runs(spark):
    rows = corpus(4, 120, ["a"] * 9 + ["b"])
    df = docs(spark, [r[0] for r in rows], [r[2] for r in rows], [r[1] for r in rows]).repartition(6)
    counted = divergence.term_counts(df, run_bytes=64).collect()
    wanted, in_docs = collections.Counter(), collections.Counter()
    for text, lang, source in rows:
        terms = [(lang or "", source, t) for t in terms_of(text)]
        wanted.update(terms)
        in_docs.update(set(terms))
    assert {(r.lang, r.source, r.term): r.n for r in counted} == wanted
    assert {(r.lang, r.source, r.term): r.docs for r in counted} == in_docs


def test_terms_of_any_length(spark):
    long = ["a" * 8, "a" * 9, "a" * 16, "a" * 17, "é" * 4, "é" * 8, "b" * 100_000, "a" * 16 + "c"]
    texts = [" ".join(long), " ".join(reversed(long)), long[6]]
    counted = divergence.term_counts(docs(spark, texts)).collect()
    assert {r.term: (r.n, r.docs) for r in counted} == {t: (3, 3) if t == long[6] else (2, 2) for t in long}


def test_radix_order_is_stable():
    words = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64) % np.uint64(70_000)
    assert (divergence.radix_order(words) == np.argsort(words, kind="stable")).all()


def test_counts_beyond_64_bits_stay_exact(spark):
    n, total, terms = 10**15 + 7, 3 * 10**16 + 1, 12_345
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    from pyspark.sql import functions as F

    share = df.select(divergence._share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert share == 1 + 10**9 * (n + 5) // (total + 5 * terms)
