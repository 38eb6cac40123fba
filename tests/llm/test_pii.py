import collections
import hashlib
import math
import random
import re

import pytest

from riskstream.llm import pii
from tests.llm.helpers import docs


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(digits(m[0])) <= 15]
    return out


def check(df):
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    rows = {r["doc_id"]: r for r in pii.digests(pii.find(df)).collect()}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        expected = base(texts[i])
        counts = collections.Counter(kind for kind, *_ in expected)
        assert [r[f"n_{k}"] for k in pii.BASE] == [counts[k] for k in pii.BASE], texts[i][:200]
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in expected)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["spans"] == listed or r["spans"].startswith(listed)
    return rows


def test_base_spans_against_brute_force(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


CASES = [
    "", None, "a@b.c_d@e.f a@b@c.d x@y q.w@-.-.z a@b.c.@d.e", "é😀a@b.de",
    "1.2.3.4.5.6.7.8 256.1.1.1.1 0255.1.1.1 99999999999999999999.1.1.1 1..2.3.4",
    "4111 1111 1111 1111 x 4111-1111-1111-1111-1 4111111111111112 4111  1111",
    "+1 (017) 555-7713 +1+2 +12 +1 ((((()) 2 +49.30.1234567 +123456789012345678",
    "9" * 20_000, "a" * 20_000 + "@", "+1 234 567 8901 " * 500, "1 " * 10_000, "a.b@c.d," * 500,
]


def test_awkward_and_long_texts(spark):
    check(docs(spark, CASES, extra=True))


def test_the_method_adds_spans_that_touch_no_base_span(spark):
    text = "Call Mr. John Smith (415) 555-1234 or mail a@b.com, ssn 123-45-6789, not 415-555-1234x"
    noise = "version 1.2.3.999 build 123456789012345 page 555-1234"
    rows = check(docs(spark, [text] * 5 + [noise] * 5))
    kinds = [s.split(":")[0] for s in rows[0]["spans"].split(",")]
    assert "phone_local" in kinds and "name" in kinds and "ssn" in kinds
    assert rows[7]["spans"] == ""


def test_em_tells_reliable_labelers_from_noise():
    # context says yes on true spans alone; misleading says no on false ones alone
    rows = [(4, 0, 1, 0, 0, 1, 0, 1, 900), (4, 0, -1, 0, 0, 0, -1, -1, 800), (4, 0, 1, 0, 0, 0, 0, 1, 200)]
    names = ["kind", "length", *pii.LABELERS, "n"]
    speaks, prior = pii.reliabilities([dict(zip(names, row)) for row in rows])
    context, misleading = pii.LABELERS.index("context"), pii.LABELERS.index("misleading")
    assert speaks[4, context, 2, 1] > 10 * speaks[4, context, 2, 0]
    assert speaks[4, misleading, 0, 0] > 10 * speaks[4, misleading, 0, 1]
    assert 0.5 < prior[4] < 0.65


def plain_em(spans):
    """The same rounds, span by span."""
    start = {-1: (0.4, 0.1), 0: (0.5, 0.5), 1: (0.1, 0.4)}
    kinds = range(len(pii.KINDS))
    speaks = {(k, name): dict(start) for k in kinds for name in pii.LABELERS}
    prior = dict.fromkeys(kinds, 0.5)
    for _ in range(pii.ROUNDS):
        counts = {key: {v: [4 * no, 4 * yes] for v, (no, yes) in start.items()} for key in speaks}
        sizes = {k: [1.0, 2.0] for k in kinds}
        for s in spans:
            k = s["kind"]
            yes, no = prior[k], 1 - prior[k]
            for name in pii.LABELERS:
                no, yes = no * speaks[k, name][s[name]][0], yes * speaks[k, name][s[name]][1]
            true = yes / (yes + no)
            for name in pii.LABELERS:
                counts[k, name][s[name]][0] += 1 - true
                counts[k, name][s[name]][1] += true
            sizes[k][0] += true
            sizes[k][1] += 1
        for key, by_vote in counts.items():
            total = [sum(c[i] for c in by_vote.values()) for i in (0, 1)]
            speaks[key] = {v: (c[0] / total[0], c[1] / total[1]) for v, c in by_vote.items()}
        prior = {k: yes / every for k, (yes, every) in sizes.items()}
    return speaks, prior


PLANTED = {
    "phone_local": lambda r: f"({r.randint(200, 989)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}",
    "ssn": lambda r: f"{r.randint(100, 665)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}",
    "iban": lambda r: "DE" + f"{r.randint(10, 98)} " + " ".join(f"{r.randint(0, 9999):04}" for _ in range(4)) + " 12",
    "name": lambda r: f"{r.choice(['Mr.', 'Frau', 'Señora', 'Mme'])} {r.choice(['Albers', 'Dupont', 'Garza', 'Wells'])}",
    "email_spelled": lambda r: f"{r.choice(['ann', 'bob.k', 'c_d'])}{r.randint(1, 99)} [at] site{r.randint(1, 9)}.{r.choice(['com', 'de'])}",
    "birth": lambda r: f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1940, 2005)}",
}
BEFORE = {
    "phone_local": ["call", "telefon", "tel"], "ssn": ["ssn", "social"], "iban": ["iban", "konto"],
    "name": ["contact", "write"], "email_spelled": ["mail", "contacto"], "birth": ["born", "geboren", "née"],
}
ALIKE = [
    lambda r: f"order {r.randint(200, 989)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}x",
    lambda r: f"version {r.randint(300, 900)}.{r.randint(300, 900)}.1.{r.randint(1, 9)}",
    lambda r: f"build {r.randint(10**12, 10**13 - 1)}",
    lambda r: f"invoice 000-{r.randint(10, 99)}-0000",
    lambda r: f"released {r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1940, 2005)}",
    lambda r: f"page {r.randint(1, 9)}-{r.randint(1, 9)}",
]


def planted(n=400):
    """Texts of one finding or one look-alike each, with the true (kind, start, end) of each."""
    r = random.Random(5)
    words = "the of and under river letter market stone winter over".split()
    texts, true = [], []
    for i in range(n):
        text = " ".join(r.choices(words, k=12)) + ". "
        spans = set()
        if i % 2:
            kind = r.choice(sorted(PLANTED))
            hit = PLANTED[kind](r)
            text += r.choice(BEFORE[kind]) + " "
            spans.add((kind, len(text), len(text) + len(hit)))
            text += hit
        else:
            text += r.choice(ALIKE)(r)
        texts.append(text + " " + " ".join(r.choices(words, k=8)))
        true.append(spans)
    return texts, true


def test_added_spans_on_planted_data(spark):
    texts, true = planted()
    rows = pii.digests(pii.find(docs(spark, texts))).collect()
    hits = wrong = 0
    for row in rows:
        found = {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in row["spans"].split(",") if x)}
        found = {x for x in found if x[0] not in pii.BASE}
        hits += len(found & true[row["doc_id"]])
        wrong += len(found - true[row["doc_id"]])
    assert hits >= 0.9 * sum(map(len, true))
    assert wrong <= 0.05 * hits


def test_em_and_scores_against_plain_python(spark):
    df = docs(spark, planted()[0])
    found = pii.candidates(df)
    flat = [{"doc_id": r["doc_id"], **s.asDict()} for r in found.collect() for s in r["spans"]]
    spans = pii.distinct_spans(found)
    speaks, prior = pii.reliabilities(pii.patterns(spans).collect())
    plain_speaks, plain_prior = plain_em(flat)
    for i, name in enumerate(pii.LABELERS):
        for v in (-1, 0, 1):
            for k in range(len(pii.KINDS)):
                assert list(speaks[k, i, v + 1]) == pytest.approx(plain_speaks[k, name][v], rel=1e-9)
    assert list(prior) == pytest.approx([plain_prior[k] for k in range(len(pii.KINDS))], rel=1e-9)
    weights = pii.train(pii.sample(spans, dict(spans.groupBy("kind").count().collect())), speaks, prior)
    score = {
        (s["doc_id"], s["kind"], s["start"]): 1 / (1 + math.exp(-weights[-1] - sum(weights[f] for f in s["features"])))
        for s in flat
    }
    for row in pii.find(df).collect():
        for s in [*row["base"], *row["added"]]:
            assert s["score"] == pytest.approx(score[row["doc_id"], s["kind"], s["start"]], abs=1e-6)


def test_training_thins_kinds_with_many_spans_and_keeps_the_others(spark):
    spans = pii.distinct_spans(pii.candidates(docs(spark, planted()[0])))
    sizes = dict(spans.groupBy("kind").count().collect())
    rows = pii.sample(spans, sizes, bound=20)
    drawn = collections.Counter(r["kind"] for r in rows)
    for kind, size in sizes.items():
        assert drawn[kind] == size if size <= 20 else 5 <= drawn[kind] <= 40
    assert rows == pii.sample(spans.repartition(7), sizes, bound=20)
