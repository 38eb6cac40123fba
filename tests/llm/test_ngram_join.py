import collections
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskstream.llm import ngram_join
from riskstream.llm.components import components
from riskstream.session import shared_dir
from tests.llm.helpers import docs


def sets_of(texts, size=4):
    made = []
    for t in texts:
        w = (t or "").encode().lower().split()
        made.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    return made


def brute(texts, ids, size=4, percent=85):
    sets, parent = sets_of(texts, size), {i: i for i in ids if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if ids[i] is None or ids[j] is None or not both:
                continue
            if 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(ids[i]), find(ids[j])))
                parent[b] = a
    return sorted((str(d), len(s), str(None if d is None else find(d))) for d, s in zip(ids, sets, strict=True))


def got(df, **how):
    rows = ngram_join.similar(df, **how).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows)


def edited(words, rng, share):
    words = list(words)
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    return words


def corpus(seed, n=120):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            words = edited(rng.choice(texts).split() or ["x"], rng, rng.choice([0, 0.005, 0.01, 0.03, 0.05]))
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.uniform(0.8, 1)))]
        else:
            words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 4, 5, 9, 30, 120, 400]))]
        texts.append(" ".join(words))
    return texts


def test_components_against_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(seed)
        ids = list(range(len(texts)))
        df = docs(spark, texts, extra=True).repartition(6)
        assert got(df) == brute(texts, ids)
        assert got(df, size=5, percent=80) == brute(texts, ids, 5, 80)


def test_awkward_rows(spark):
    texts = [None, "", "  ", "a", "A", "a b", "a b c d e f g", "a b c d e f g", "A\tB c d e f g", "é b", "q r s t"]
    ids = [9, 8, 7, 6, 5, 4, 3, 3, 2, None, 1]
    assert got(docs(spark, texts, ids=ids)) == brute(texts, ids)


def test_a_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(edited(words, rng, 0.004)) for _ in range(400)] + ["other text of its own here"]
    rows = ngram_join.similar(docs(spark, texts).repartition(9)).collect()
    assert collections.Counter(r["component_id"] for r in rows) == {0: 400, 400: 1}


def test_linked_sets_always_share_a_key():
    rng = np.random.default_rng(5)
    for percent in (80, 85, 95):
        for n in [1, 2, 3, 5, 6, 7, 8, 12, 13, 20, 33, 47, 60, 100, 150, 220, 400, 900]:
            for _ in range(12):
                whole = rng.integers(0, 2**63, 2 * n + 2).astype(np.uint64)
                union = max(n, int(n * 100 / percent))
                shared = -(-percent * union // 100)
                extra = union - shared
                left = int(rng.integers(0, extra + 1)) if extra else 0
                a, b = whole[: shared + left], np.concatenate([whole[:shared], whole[shared + left : union]])
                keys = [set(ngram_join.keys_of(np.unique(x), percent).tolist()) for x in (a, b)]
                assert keys[0] & keys[1], (percent, n, left, extra)


def test_one_of_each_keeps_one_row_per_group(spark):
    same = "one two three four five six seven eight nine ten"
    texts = [same, same, same + " ", None, "", "another text that is by itself", same, None]
    ids = [5, 3, 3, 3, 2, 1, None, None]
    df = docs(spark, texts, ids=ids, extra=True)
    left = ngram_join.one_of_each(df)
    assert left.columns == df.columns
    rows = sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect())
    assert rows == sorted([("3", same), ("3", "None"), ("2", ""), ("1", texts[5]), ("None", same), ("None", "None")])


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(1, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    links = [*path, *star, (7, 7), (5000, 4999), (4999, 5000)]
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    found = {r["id"]: r["component"] for r in rows}
    assert len(rows) == len(found)
    assert {found[i] for i in range(1, 201)} == {1}
    assert {found[1000 + i] for i in range(300)} == {1000}
    assert found[5000] == found[4999] == 4999
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_search_by_key_in_small_blocks_and_several_rounds(spark, monkeypatch):
    """Without families, three members a block, one partner at first: the same components."""
    for name, value in (("BLOCK", 3), ("FAMILY", 10**9), ("FIRST_PARTNERS", 1), ("MORE_PARTNERS", 3)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    # A family around the similarity: some pairs link, some do not.
    texts = [" ".join(edited(words, rng, rng.choice([0.005, 0.01, 0.02, 0.03]))) for _ in range(60)]
    assert got(docs(spark, texts).repartition(5)) == brute(texts, list(range(60)))


def test_index_and_search_in_turns(spark, monkeypatch):
    """A turn of the index has about its share of the keys; many turns give the same components."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(edited(words, rng, rng.choice([0.005, 0.01, 0.02, 0.03]))) for _ in range(60)]
    sets = ngram_join.shingle_sets([t.encode() for t in texts], 4)
    ids = pa.array(range(len(texts)), pa.int64())
    rows = [
        ngram_join._indexed(ids, sets, 85, turn).filter(pc.field("kind") != ngram_join._DOCUMENT).num_rows
        for turn in range(ngram_join.TURNS)
    ]
    assert sum(rows) == sum(len(ngram_join.keys_of(s, 85)) for s in sets)
    assert ngram_join.TURNS > 1 and max(rows) < 1.2 * sum(rows) / ngram_join.TURNS

    searched = []
    of = ngram_join._turn
    monkeypatch.setattr(ngram_join, "_turn", lambda *a: searched.append(a[1:]) or of(*a))
    for name, value in (("SEARCH_ROWS", 2), ("FAMILY", 10**9)):
        monkeypatch.setattr(ngram_join, name, value)
    assert got(docs(spark, texts).repartition(5)) == brute(texts, list(range(len(texts))))
    turns = searched[0][1]
    assert turns > 1 and {turn for turn, _ in searched} == set(range(turns))


def test_searches_begin_without_the_tables_of_the_index(spark, monkeypatch):
    shared = Path(shared_dir(spark).removeprefix("file://")) / "riskstream"
    seen = []
    search = ngram_join._partners
    before = {p.name for p in shared.glob("*")}

    def partners(*args):
        seen.extend({p.name.rpartition("-")[0] for p in shared.glob("*") if p.name not in before})
        return search(*args)

    monkeypatch.setattr(ngram_join, "_partners", partners)
    texts = corpus(6)
    assert got(docs(spark, texts)) == brute(texts, list(range(len(texts))))
    assert "open-groups" in seen and not {"ngram-index", "open-rows", "open-members"} & set(seen)


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(9)
    for n in (1, 5, 60, 390, 410, 1490, 1510, 6100):
        for _ in range(20):
            whole = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            shared = int(rng.integers(0, n + 1))
            a, b = whole[:n], np.concatenate([whole[:shared], whole[n : n + n - shared]])
            one, other = ngram_join.sketch_of(a), ngram_join.sketch_of(b)
            width = min(len(one), len(other))
            flat = np.concatenate([one, other])
            bits = ngram_join._folded(flat, np.array([0, len(one), len(flat)]), width)
            assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= 2 * (n - shared)


def test_places_where_all_partners_were_named_are_not_searched_again(spark, monkeypatch):
    few = {"FAMILY": 10**9, "FIRST_PARTNERS": 1, "MORE_PARTNERS": 3, "SEARCH_ROWS": 10**6}
    for name, value in few.items():
        monkeypatch.setattr(ngram_join, name, value)
    # No pair is tried by way of heads, so the searches find all links.
    close = ngram_join._close
    monkeypatch.setattr(ngram_join, "_close", lambda *a: close(*a).filter("false"))
    searched = []
    search = ngram_join._partners
    monkeypatch.setattr(
        ngram_join, "_partners", lambda rows, *a: searched.append(rows.count()) or search(rows, *a)
    )
    rng = random.Random(8)
    texts = []
    for n, many in ((60, 40), (200, 3), (300, 3), (400, 3)):
        words = [f"{n}-{i}" for i in range(120)]
        texts += [" ".join(edited(words, rng, 0.005)) for _ in range(many)]
    assert got(docs(spark, texts)) == brute(texts, list(range(len(texts))))
    assert len(searched) > 1 and all(later < searched[0] for later in searched[1:]), searched


def test_comparisons_against_brute_force(monkeypatch):
    """Small and large places, one block and two, sketches of several lengths, with pairs held back."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 1200).astype(np.uint64)
    rows, expected = [], {}
    for key, (m, size, blocks) in enumerate([(2, 50, 1), (30, 390, 1), (90, 390, 2), (250, 395, 1), (160, 300, 2), (1, 9, 1)]):
        members = []
        for _ in range(m):
            n = int(size * rng.uniform(0.9, 1.1))
            own = np.unique(np.concatenate([base[: int(n * rng.uniform(0.8, 1))], rng.integers(0, 2**63, n // 9).astype(np.uint64)]))
            members.append((len(own), ngram_join.sketch_of(own), int(rng.integers(blocks)), int(rng.integers(m))))
        for x, (n, sketch, block, c) in enumerate(members):
            id_ = 1000 * key + x
            rows.append((False, key, 0, blocks - 1, block, id_, 1000 * key + c, n, sketch.tolist(), key))
            for y, (o, other, block_y, c_y) in enumerate(members[:x]):
                width = min(len(v[1]) for v in members)
                a, b = (np.bitwise_xor.reduce(v.reshape(-1, width)) for v in (sketch, other))
                apart = int(np.bitwise_count((a ^ b).view(np.uint64)).sum())
                if c == c_y or (blocks == 2 and block == block_y) or 100 * min(n, o) < 80 * max(n, o):
                    continue
                if apart <= 20 * (n + o) // 180:
                    named, partner = (id_, 1000 * key + y) if c > c_y else (1000 * key + y, id_)
                    expected.setdefault(key, {}).setdefault(named, []).append((apart, partner))
    names = ["whole", "key", "i", "j", "block", "id", "c", "n", "sketch", "place"]
    table = pa.table({name: list(column) for name, column in zip(names, zip(*rows, strict=True), strict=True)})
    keys = np.array([r[1] for r in rows])
    starts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    held = collections.Counter(keys.tolist())
    assert len(expected) >= 4
    for most, close in ((10**6, 10**6), (3, 10**6), (3, 50), (20, 50), (20, 10**6)):
        monkeypatch.setattr(ngram_join, "CLOSE", close)
        pairs, left = set(), set()
        for batch in ngram_join._compared(table, starts, 80, most):
            pairs |= set(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True))
            left |= set(batch.column("place").drop_null().to_pylist())
        want, open_ = set(), set()
        for key, named in expected.items():
            every = sum(len(v) for v in named.values()) <= most * held[key]
            for one, partners in named.items():
                chosen = sorted(partners) if every else sorted(partners)[:most]
                want |= {(max(one, p), min(one, p)) for _, p in chosen}
                open_ |= {key} if len(chosen) < len(partners) else set()
        assert pairs == want and left == open_


def test_rows_with_a_repeated_id_go_only_as_copies(spark):
    same = "one two three four five six seven eight nine ten"
    other, third, fourth = (" ".join(f"{w}{i}" for i in range(12)) for w in "abc")
    ids = [1, 2, 2, 7, 7, 9, 9, 9]
    texts = [same, same, other, third, fourth, third, third, None]
    left = ngram_join.one_of_each(docs(spark, texts, ids=ids, extra=True))
    rows = sorted((r["doc_id"], str(r["text"])) for r in left.collect())
    assert rows == sorted([(1, same), (2, other), (7, third), (7, fourth), (9, "None")])
