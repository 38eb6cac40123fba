"""Exact Jaccard join of word-shingle sets by partition and pigeonhole.

A document's set holds the hashes of its distinct shingles of ``SHINGLE`` words. Sets are put in
bands by size. Two sets that link differ in at most H elements, H known from the larger band. For
a band the universe of hashes is cut into m segments; every segment gets an allocation: 1 (its
content is indexed) or 2 (its content and each content with one element deleted are indexed).
If two sets share no index key, each segment differs by at least its allocation, so the sets
differ by at least the sum; the sum is chosen above H, hence every link shares a key.

Empty segments are the costly ones: their content is common to unlike sets. They get allocation 0,
and the sum is raised by an allowance E for what is lost by that. A set that loses more than E
also indexes its empty segments, in a key space of its own; two such sets then meet there, and any
other pair has a set within the allowance. ``plan`` picks m, the number of segments with allocation
2, and E by cost: index rows plus the weight of segments so small that unlike sets share them.

Keys become links in two steps, neither of which pairs all members of a key: (1) within each slice
of rows and then across slices every set is paired with the smallest document of its key, and those
pairs are verified; (2) keys whose members are still in different components are searched for pairs
between these: members are compared in blocks by size and by sketch (parity bits of the set, from
which a least difference follows), each names the closest partners that are not ruled out, and the
search is repeated for more partners, where any are left, until no member has any. Pairs are verified
exactly on the whole sets. A group of copies is thereby joined by a star, whatever its size, and only pairs that may
link are emitted. Links within a component that is already joined are not verified again: the result
is the components.

On disk: the keys are made, shuffled and matched in ``TURNS`` turns, of which only the rows of shared
keys stay; a search goes over its groups in turns that shuffle at most about ``SEARCH_ROWS`` rows a document.

Defined cases: a null or blank text has no set and links with nothing; fewer than ``SHINGLE`` words
make one shingle of the whole sequence; rows with equal ``doc_id`` are one node with several sets;
a row without ``doc_id`` gets its set size, links with nothing and has no component; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.components import components
from riskstream.llm.hashing import as_long, hashed, mix, runs_of, windows
from riskstream.session import Scratch, counted, written

SHINGLE = 4
#: Two sets link when 100 x intersection >= PERCENT x union.
PERCENT = 85
#: Largest to smallest set size of a band.
BAND = 1.6
#: What a segment of fewer than three expected elements costs, in index rows.
SMALL_SEGMENT = 2
#: Bits of a sketch for sets below a size.
SKETCH_BITS = ((400, 1024), (1500, 2048), (6000, 8192), (math.inf, 32768))
#: Keys that two neighbours in a family share at least.
FAMILY = 3
#: Members of a group that are compared in one task.
BLOCK = 4000
#: Numbers of a comparison held at once.
CELLS = 500_000
#: Close pairs of a group held at once, beyond those that are named.
CLOSE = 300_000
#: Groups of up to so many members are compared together.
SMALL = 100
#: Partners a member of an open key names in the first search, and how many times more in each next.
FIRST_PARTNERS, MORE_PARTNERS = 4, 16
#: Places with partners left up to which a filter lists them; more are a table.
LISTED = 10_000
#: Turns in which the keys of the index are made, shuffled and matched, each with its share of them.
TURNS = 2
#: Rows for each document that a search shuffles at once; what is beyond goes into further turns.
SEARCH_ROWS = 6
#: Tables of ids up to this many rows (two or three numbers each) are broadcast.
BROADCAST_ROWS = 250_000


class Band(NamedTuple):
    """Sizes from ``low`` below ``high``; ``m`` segments, the first ``twice`` with allocation 2."""

    number: int
    low: int
    high: int
    m: int
    twice: int
    allowance: int


def bands(percent: int) -> Iterator[Band]:
    low, number = 1, 0
    while True:
        high = max(low + 1, math.ceil(low * BAND))
        yield plan(number, low, high, percent)
        low, number = high, number + 1


def plan(number: int, low: int, high: int, percent: int) -> Band:
    """The cheapest allocation whose sum exceeds the largest difference of a linked pair."""
    smallest = -(-low * percent // 100)
    most = (100 - percent) * 2 * (high - 1) // (100 + percent)
    best = None
    for twice in sorted({0, 1, 2, 4, most // 4, (most + 1) // 2, most}):
        allowance = 0
        while True:
            m = most + 1 + allowance - twice
            if m < max(twice, 1):
                allowance += 1
                continue
            mean = smallest / m
            none, one = math.exp(-mean), mean * math.exp(-mean)
            lost = (m - twice) * none + twice * (2 * none + one)
            enough = allowance >= lost + 2.5 * math.sqrt(lost) - 0.5
            if m == 1 or enough or 2 * m > smallest:  # any allowance is right, this one is cheap
                break
            allowance += 1
        if m < max(twice, 1):
            continue
        few = none + one + mean * one / 2
        cost = m + twice * (low + high) / 2 / m + SMALL_SEGMENT * m * (few if m > 1 else 0)
        if best is None or cost < best[0]:
            best = (cost, Band(number, low, high, m, twice, allowance))
    return best[1]


@lru_cache(maxsize=8)
def _known_bands(percent: int) -> tuple[Iterator[Band], list[Band]]:
    return bands(percent), []


def bands_of(size: int, percent: int) -> list[Band]:
    """The bands in which a set of this size can be the larger or the smaller of a linked pair."""
    source, known = _known_bands(percent)
    while not known or 100 * size >= percent * known[-1].low:
        known.append(next(source))
    # From the set's own band upwards, as long as the band has a size it can link with.
    return [b for b in known if b.high > size and 100 * size >= percent * b.low]


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The set of each text, sorted."""
    words, counts = hashed(texts)
    every = windows(words, size)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= size:
            sets.append(np.unique(every[at : at + n - size + 1]))
        else:
            sets.append(windows(words[at : at + n], n) if n else words[:0])
        at += n
    return sets


def sketch_of(elements: np.ndarray) -> np.ndarray:
    """Parity of the number of elements per bucket, as bits; buckets grow with the set.

    Two sets differ in at least as many elements as their sketches in bits.
    """
    bits = next(size for limit, size in SKETCH_BITS if len(elements) < limit)
    place = (mix(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def keys_of(elements: np.ndarray, percent: int) -> np.ndarray:
    """All index keys of a set."""
    made = []
    for band in bands_of(len(elements), percent):
        salt = mix(np.array([band.number + 1], np.uint64))[0]
        spread = mix(elements ^ salt)
        segment = (((spread >> np.uint64(32)) * np.uint64(band.m)) >> np.uint64(32)).astype(np.int64)
        content = np.zeros(band.m, np.uint64)
        np.add.at(content, segment, spread)
        count = np.bincount(segment, minlength=band.m)
        place = mix(np.arange(band.m, dtype=np.uint64) + salt)
        made.append(mix(content + place)[count > 0])
        if band.twice:
            inside = (segment < band.twice) & (count[segment] > 1)
            s = segment[inside]
            made.append(mix(content[s] - spread[inside] + place[s]))
        lost = (count == 0).astype(np.int64)
        lost[: band.twice] = np.maximum(2 - count[: band.twice], 0)
        if lost.sum() > band.allowance:
            made.append(mix(place[lost > 0] ^ np.uint64(0x5555555555555555)))
    return np.concatenate(made)


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def _long_lists(flat: np.ndarray, lengths: list[int]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


#: Rows of the index: a document with its set size and sketch, a key of the smallest document of
#: its slice that has it, a key of another one. ``part`` is what a task gathers rows by: the key, for
#: heads; what follows from it is left null there, so that the many rows of heads shuffle small.
_DOCUMENT, _HEAD, _MEMBER = 0, 1, 2
_INDEX = "part long, a long, kind int, key long, b long, sketch array<long>"


def _index(size: int, percent: int, turn: int):
    """Rows of the index, slice by slice: (document, head) per key of this turn.

    The first turn also has (document, set size).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs_of(batch, "text"):
                sets = shingle_sets(_texts(part, "text"), size)
                yield _indexed(part.column("doc_id"), sets, percent, turn)

    return run


def _indexed(ids: pa.Array, sets: list[np.ndarray], percent: int, turn: int) -> pa.RecordBatch:
    named = ids.is_valid().to_numpy(zero_copy_only=False).tolist()
    keys = [
        as_long(keys_of(s, percent)) if len(s) and name else _NO_KEYS
        for s, name in zip(sets, named, strict=True)
    ]
    key = np.concatenate([_NO_KEYS, *keys])
    owner = np.repeat(ids.fill_null(0).to_numpy(zero_copy_only=False), [len(k) for k in keys])
    now = _turn_of(key) == turn
    key, owner = key[now], owner[now]
    if turn:
        ids, sets = ids.slice(0, 0), []
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    head = owner[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
    other = owner != head
    # A key that many documents of a slice share is gathered by its head alone.
    part = np.where(other, as_long(mix((owner ^ key).view(np.uint64))), key)
    n, m = len(sets), len(key)
    sketches = [sketch_of(s) for s in sets]
    offsets = np.concatenate([np.zeros(m + 1, np.int64), np.cumsum([len(s) for s in sketches])])
    spread = as_long(mix(np.arange(n, dtype=np.uint64) + np.uint64(m)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([part, spread])),
            pa.concat_arrays([pa.array(owner, pa.int64()), ids.cast(pa.int64())]),
            pa.array(np.concatenate([np.where(other, _MEMBER, _HEAD), np.full(n, _DOCUMENT)]), pa.int32()),
            pa.array(np.concatenate([key, spread]), mask=np.concatenate([~other, np.ones(n, bool)])),
            pa.array(
                np.concatenate([head, np.array([len(s) for s in sets], np.int64)]),
                mask=np.concatenate([~other, np.zeros(n, bool)]),
            ),
            pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)),
                pa.array(np.concatenate([_NO_KEYS, *sketches])),
                mask=pa.array(np.arange(m + n) < m),
            ),
        ],
        names=["part", "a", "kind", "key", "b", "sketch"],
    )


_NO_KEYS = np.empty(0, np.int64)


def _turn_of(key: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) >> np.uint64(33)) % np.uint64(TURNS)


def _sets(size: int, columns: tuple[str, ...]):
    """Rows of ``columns`` and ``text`` with the text replaced by its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs_of(batch, "text"):
                sets = [as_long(s) for s in shingle_sets(_texts(part, "text"), size)]
                elements = _long_lists(np.concatenate([_NO_KEYS, *sets]), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns), elements],
                    names=[*columns, "elements"],
                )

    return run


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written; broadcast where it is joined if it is known to be small."""
    table, rows = counted(df, name)
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the stored ``pairs (a, b)`` whose sets link.

    The set of ``a`` is made where its text is read, and sent to ``b``.
    """
    texts = docs.select("doc_id", "text")
    left = texts.join(pairs, F.col("doc_id") == F.col("a")).select("a", "b", "text")
    left = left.mapInArrow(_sets(size, ("a", "b")), "a long, b long, elements array<long>")
    wanted = _stored(pairs.select("b").distinct(), "partners")
    right = texts.join(wanted, F.col("doc_id") == F.col("b")).select("b", "text")
    right = right.mapInArrow(_sets(size, ("b",)), "b long, elements array<long>")
    right = right.withColumnRenamed("elements", "others")
    shared = F.size(F.array_intersect("elements", "others"))
    union = F.size("elements") + F.size("others") - shared
    return (
        left.join(right, "b")
        .filter((union > 0) & (100 * shared >= percent * union))
        .select("a", "b")
        .distinct()
    )


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: one row per document."""
    with Scratch() as tables:
        turns = [_shared(docs, size, percent, turn) for turn in range(TURNS)]
        index = turns[0].filter(F.col("kind") == _DOCUMENT).select(
            F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), "sketch"
        )
        shared = reduce(DataFrame.unionByName, turns).filter(F.col("kind") != _DOCUMENT)
        sizes, n = counted(index.drop("sketch"), "set-sizes")
        shared = shared.select("key", "a", "b")
        groups, *known = _linked(docs, index, shared, size, percent)
        tables.remove(sizes, groups, *known)
        joined = _searched(docs, groups, n, *known, size, percent)
    return sizes.join(joined, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _shared(docs: DataFrame, size: int, percent: int, turn: int) -> DataFrame:
    """Rows of the index of this turn, written: documents, and members of keys with their head.

    A turn's keys are deleted but for the few that documents share before the next one begins.
    """
    rows = docs.select("doc_id", "text").mapInArrow(_index(size, percent, turn), _INDEX)
    # Of the heads of a key the smallest is the head of all; the others become its members.
    head = F.first("a").over(Window.partitionBy("kind", "part").orderBy("a"))
    rows = rows.withColumn("b", F.when(F.col("kind") == _HEAD, head).otherwise(F.col("b")))
    rows = rows.filter((F.col("kind") == _DOCUMENT) | (F.col("a") != F.col("b")))
    key = F.coalesce("key", "part").alias("key")
    return written(rows.select("kind", key, "a", "b", "sketch"), "ngram-index")


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of similar rows: that of the smallest ``doc_id``.

    Rows without words or without ``doc_id`` are in no group and stay. Of several rows with the
    smallest ``doc_id`` of a group, the one with the least text stays. Where ids repeat, rows are
    numbered and joined by number, so an unlike row with the id of a copy stays.
    """
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if not repeated.isEmpty():
        return _one_of_each_by_row(docs, size, percent)
    found = _found(docs, size, percent)
    doomed = found.filter("doc_id <> component_id").select("doc_id")
    left = docs.join(_stored(doomed, "doomed"), "doc_id", "left_anti")
    return left.select(*docs.columns)


def _found(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The groups of ``docs`` with sets, written; what the search wrote on its way is deleted."""
    with Scratch() as tables:
        found = written(similar(docs, size, percent).filter("n_shingles > 0"), "similar")
        tables.remove(but=found)
    return found


def _one_of_each_by_row(docs: DataFrame, size: int, percent: int) -> DataFrame:
    numbered = written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    rows = numbered.filter("doc_id is not null")
    found = _found(rows.select(F.col("_row").alias("doc_id"), "text"), size, percent)
    linked = found.filter("doc_id <> component_id").select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")
    )
    heads = linked.select(F.col("_group").alias("_row"), "_group").distinct()
    members = _stored(linked.unionByName(heads), "members")
    members = written(rows.select("_row", "doc_id").join(members, "_row"), "member-ids")
    least = members.groupBy("_group").agg(F.min("doc_id").alias("doc_id"))
    tied = members.join(_stored(least, "least"), ["_group", "doc_id"]).select("_row", "_group")
    order = F.struct("text", F.xxhash64(*docs.columns).alias("_hash"), "_row")
    stay = (
        rows.join(_stored(tied, "tied"), "_row").groupBy("_group").agg(F.min(order).alias("_first"))
    )
    stay = _stored(stay.select(F.col("_first._row").alias("_row")), "stay")
    doomed = _stored(members.select("_row").join(stay, "_row", "left_anti"), "doomed")
    return numbered.join(doomed, "_row", "left_anti").select(*docs.columns)


def _linked(
    docs: DataFrame, index: DataFrame, shared: DataFrame, size: int, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The groups to search, the links by way of heads, their components and the pairs tried."""
    known = index.filter("doc_id is not null and n_shingles > 0").select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch"
    )
    pairs = _stored(shared.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pairs")
    tried = _stored(_close(pairs.select("a", "b"), known, percent), "close-pairs")
    links = written(verify(docs, tried, size, percent), "verified")
    joined = _stored(components(links), "components")
    family = components(pairs.filter(F.col("n") >= FAMILY).select("a", "b"))
    groups = _groups(_stored_open(shared, joined), _stored(family, "families"), known)
    return groups, links, joined, tried


def _searched(
    docs: DataFrame,
    groups: DataFrame,
    n: int,
    links: DataFrame,
    joined: DataFrame,
    tried: DataFrame,
    size: int,
    percent: int,
) -> DataFrame:
    """``id, component`` of all of the ``n`` documents that link with another."""
    most = FIRST_PARTNERS
    while True:
        turns = 1 + int(groups.count() / (SEARCH_ROWS * max(n, 1)))
        found = reduce(
            DataFrame.unionByName,
            [
                written(_partners(_turn(groups, turn, turns), joined, percent, most), "partners")
                for turn in range(turns)
            ],
        )
        new = found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
        new = _stored(new, "pairs")
        if not new.isEmpty():
            links = written(links.unionByName(verify(docs, new, size, percent)), "verified")
            joined = _stored(components(links), "components")
            tried = tried.unionByName(new)
        left = found.select("place").filter("place is not null").distinct()
        if left.isEmpty():
            return joined
        groups = _left(groups, left)
        most *= MORE_PARTNERS


def _place() -> Column:
    """A number for the pair of blocks that a row is compared in."""
    return F.xxhash64("whole", "key", "i", "j")


def _left(groups: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of the places with partners left; in the others all were named, now or before."""
    listed = [r[0] for r in places.take(LISTED + 1)]
    if len(listed) <= LISTED:
        return groups.filter(_place().isin(listed))
    return groups.join(_stored(places, "places"), _place() == F.col("place"), "left_semi")


def _turn(groups: DataFrame, turn: int, turns: int) -> DataFrame:
    """Whole places, a share of all."""
    return groups.filter(F.pmod(_place(), F.lit(turns)) == turn)


def _close(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Those of the stored ``pairs`` that may link by set size and sketch, larger id first."""
    left = known.join(pairs, F.col("id") == F.col("a")).select(
        "a", "b", F.col("n").alias("na"), F.col("sketch").alias("sa")
    )
    both = left.join(known, F.col("id") == F.col("b"))
    total = F.col("n") + F.col("na")
    # Sketches of one length are compared; others are left to the exact check.
    apart = F.aggregate(
        F.zip_with("sa", "sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    fits = 100 * F.least("n", "na") >= percent * F.greatest("n", "na")
    near = (F.size("sa") != F.size("sketch")) | (
        apart <= F.floor((100 - percent) * total / (100 + percent))
    )
    return both.filter(fits & near).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _stored_open(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of ``shared`` whose key has members in different components."""
    left = joined.select(F.col("id").alias("a"), F.col("component").alias("_ca"))
    right = joined.select(F.col("id").alias("b"), F.col("component").alias("_cb"))
    apart = shared.join(left, "a", "left").join(right, "b", "left")
    apart = apart.filter(F.coalesce("_ca", "a") != F.coalesce("_cb", "b"))
    open_ = _stored(apart.select("key").distinct(), "open-keys")
    return written(shared.join(open_, "key", "left_semi"), "open-rows")


def _groups(in_open: DataFrame, family: DataFrame, known: DataFrame) -> DataFrame:
    """Members of open keys in the groups they are searched in, with size and sketch.

    Members that share ``FAMILY`` keys with a common neighbour are a family, as copies are. A family
    is searched as one group where that compares fewer pairs than its keys one by one; keys with
    members of several families, and those of the other families, are searched as they are. A
    group is cut into blocks; a row goes to each pair (i, j) of blocks that its own block is in.
    """
    ends = in_open.select("key", F.col("a").alias("id")).unionByName(
        in_open.select("key", F.col("b").alias("id"))
    )
    family = family.withColumnRenamed("component", "g")
    members = ends.distinct().join(family, "id", "left")
    members = written(members.withColumn("g", F.coalesce("g", "id")), "open-members")
    in_key = written(
        members.groupBy("key", "g").agg(F.count(F.lit(1)).alias("n")), "open-keys-by-family"
    )
    size = _stored(
        members.select("g", "id").distinct().groupBy("g").agg(F.count(F.lit(1)).alias("s")), "sizes"
    )
    cost = in_key.groupBy("g").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")).join(size, "g")
    whole = _stored(
        cost.select("g", (F.col("s") * F.col("s") <= F.col("pairs")).alias("whole")), "how"
    )
    mixed = _stored(
        in_key.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("mixed")).filter("mixed"), "mixed"
    )
    placed = members.join(whole, "g").join(mixed, "key", "left")
    chosen = (
        placed.filter("whole")
        .select(F.lit(True).alias("whole"), F.col("g").alias("key"), "id")
        .unionByName(
            placed.filter("mixed or not whole").select(F.lit(False).alias("whole"), "key", "id")
        )
    )
    chosen = written(chosen.distinct(), "compared")
    blocks = chosen.groupBy("whole", "key").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks")
    )
    mine = F.pmod(F.xxhash64("id"), "n_blocks").cast("int")
    spread = chosen.join(_stored(blocks, "blocks"), ["whole", "key"]).withColumn("block", mine)
    spread = spread.select(
        "whole", "key", "id", "block",
        F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("_other"),
    ).select(
        "whole", "key", "id", "block",
        F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"),
    )
    return written(spread.join(known, "id"), "open-groups")


def _partners(groups: DataFrame, joined: DataFrame, percent: int, most: int) -> DataFrame:
    """For members of groups with several components, their closest partners in other ones.

    Every pair of blocks is compared in one task by size and sketch, which are enough to rule out
    almost all pairs that do not link. Of two members the one whose component has the larger number
    names the other; each names the ``most`` closest, or all where the place has no more than ``most``
    pairs a member. ``place`` tells that some member of this place has others.
    """
    order = ["whole", "key", "i", "j"]
    rows = groups.join(joined, "id", "left").withColumn("c", F.coalesce("component", "id"))
    rows = rows.repartition(*order).sortWithinPartitions(*order, "id")
    rows = rows.select(*order, "block", "id", "c", "n", "sketch", _place().alias("place"))
    return rows.mapInArrow(_compare(percent, most), "a long, b long, place long")


def _compare(percent: int, most: int):
    """Close pairs within runs of rows of one place, which may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if kept is not None:
                rows = pa.concat_tables([kept, rows]).combine_chunks()
            if not rows.num_rows:
                continue
            place = [rows.column(c).to_numpy() for c in ("whole", "key", "i", "j")]
            group = np.stack([p.astype(np.int64) for p in place])
            starts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            last = int(starts[-1]) if len(starts) else 0
            kept = rows.slice(last)
            yield from _compared(rows.slice(0, last), starts[:-1], percent, most)
        if kept is not None:
            yield from _compared(kept, np.empty(0, np.int64), percent, most)

    return run


def _compared(
    rows: pa.Table, starts: np.ndarray, percent: int, most: int
) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    ids, comps, sizes, own, i, j, place = (
        rows.column(c).to_numpy() for c in ("id", "c", "n", "block", "i", "j", "place")
    )
    lists = rows.column("sketch").combine_chunks()
    flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    offsets = np.concatenate([[0], ends])
    firsts = np.concatenate([[0], starts])
    counts = np.diff([*firsts, rows.num_rows])
    several = np.minimum.reduceat(comps, firsts) != np.maximum.reduceat(comps, firsts)
    few = several & (counts <= SMALL)
    pairs, open_, held = [], [], 0
    if few.any():
        across = (i != j)[firsts]
        x, y, apart = _near_in_few(
            comps, sizes, own, flat, offsets, firsts, counts, few, across, percent
        )
        named, other, cut = _closest(ids, comps, x, y, apart, firsts, counts, most)
        of = np.searchsorted(firsts, named, "right") - 1
        pairs.append(np.stack([ids[named], ids[other]], axis=1))
        open_.append(pa.array(place[named], mask=~np.isin(of, cut)))
        held = len(named)
    for k in np.flatnonzero(several & ~few).tolist():
        a, b = int(firsts[k]), int(firsts[k] + counts[k])
        width = int((offsets[a + 1 : b + 1] - offsets[a:b]).min())
        bits = _folded(flat, offsets[a : b + 1], width)
        sides = [np.flatnonzero(own[a:b] == block) for block in sorted({i[a], j[a]})]
        found, more = _named(ids[a:b], comps[a:b], sizes[a:b], bits, sides, percent, most)
        if len(found):
            pairs.append(found)
            open_.append(pa.array(np.full(len(found), place[a]), mask=np.full(len(found), not more)))
            held += len(found)
        if held > CLOSE:
            yield _pairs_of(pairs, open_)
            pairs, open_, held = [], [], 0
    if held:
        yield _pairs_of(pairs, open_)


def _pairs_of(pairs: list[np.ndarray], places: list[pa.Array]) -> pa.RecordBatch:
    both = np.concatenate(pairs)
    columns = [pa.array(both.max(1)), pa.array(both.min(1)), pa.concat_arrays(places)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "place"])


def _named(
    ids: np.ndarray,
    comps: np.ndarray,
    sizes: np.ndarray,
    bits: np.ndarray,
    sides: list[np.ndarray],
    percent: int,
    most: int,
) -> tuple[np.ndarray, bool]:
    """The pairs of ids that are named in a place, and whether some member has partners left."""
    none = np.empty(0, np.int32)
    parts, held, limited, more = [(none, none, none)], 0, False, False
    all_of_it = np.array([0]), np.array([len(ids)])
    for x, y, apart in _near(comps, sizes, bits, sides, percent):
        parts.append((x, y, apart))
        held += len(x)
        if held > CLOSE + most * len(ids):
            x, y, apart = (np.concatenate(p) for p in zip(*parts, strict=True))
            above = comps[x] > comps[y]
            keep = _first_named(ids, np.where(above, x, y), np.where(above, y, x), apart, most)
            limited, more = True, more or not keep.all()
            parts, held = [(x[keep], y[keep], apart[keep])], int(keep.sum())
    x, y, apart = (np.concatenate(p) for p in zip(*parts, strict=True))
    if limited:  # more than fit the place, whatever is left of them
        all_of_it = np.array([0]), np.array([0])
    named, other, cut = _closest(ids, comps, x, y, apart, *all_of_it, most)
    return np.stack([ids[named], ids[other]], axis=1), more or len(cut) > 0


def _first_named(
    ids: np.ndarray, named: np.ndarray, other: np.ndarray, apart: np.ndarray, most: int
) -> np.ndarray:
    """Whether each pair is among the ``most`` closest of the member that names it."""
    order = np.lexsort((ids[other], apart, named))
    at = named[order]
    keep = np.empty(len(order), bool)
    keep[order] = np.arange(len(at)) - np.searchsorted(at, at) < most
    return keep


def _closest(
    ids: np.ndarray,
    comps: np.ndarray,
    x: np.ndarray,
    y: np.ndarray,
    apart: np.ndarray,
    firsts: np.ndarray,
    counts: np.ndarray,
    most: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members and whom they name, of the pairs of places, and the places where pairs are left."""
    above = comps[x] > comps[y]
    named, other = np.where(above, x, y), np.where(above, y, x)
    of = np.searchsorted(firsts, named, "right") - 1
    room = np.bincount(of, minlength=len(firsts)) <= most * counts
    keep = room[of] | _first_named(ids, named, other, apart, most)
    return named[keep], other[keep], np.unique(of[~keep])


def _near_in_few(
    comps: np.ndarray,
    sizes: np.ndarray,
    own: np.ndarray,
    flat: np.ndarray,
    offsets: np.ndarray,
    firsts: np.ndarray,
    counts: np.ndarray,
    few: np.ndarray,
    across: np.ndarray,
    percent: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`_near` finds, in all places of ``few`` members at once, by pairs."""
    rows = np.flatnonzero(np.repeat(few, counts))
    of = np.repeat(np.arange(len(counts)), counts)
    before = rows - firsts[of[rows]]
    x = np.repeat(rows, before)
    y = np.arange(len(x)) - np.repeat(np.cumsum(before) - before, before) + firsts[of[x]]
    total, least = sizes[x] + sizes[y], np.minimum(sizes[x], sizes[y])
    keep = (comps[x] != comps[y]) & (100 * least >= percent * (total - least))
    keep &= ~across[of[x]] | (own[x] != own[y])
    x, y, most = x[keep], y[keep], (100 - percent) * total[keep] // (100 + percent)
    apart = np.zeros(len(x), np.int64)
    widths = np.minimum.reduceat(np.diff(offsets), firsts)[of[x]]
    for width in np.unique(widths).tolist():
        here = np.flatnonzero(widths == width)
        used = np.unique(np.concatenate([x[here], y[here]]))
        bits = _folded_rows(flat, offsets, used, width)
        one, two = np.searchsorted(used, x[here]), np.searchsorted(used, y[here])
        for z in range(0, len(here), step := max(1, CELLS // width)):
            part = slice(z, z + step)
            both = bits[one[part]] ^ bits[two[part]]
            apart[here[part]] = np.bitwise_count(both).sum(1, np.int64)
    near = apart <= most
    return x[near], y[near], apart[near]


def _near(
    comps: np.ndarray, sizes: np.ndarray, bits: np.ndarray, sides: list[np.ndarray], percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (x, y) of different components that sizes and sketches do not rule out, and how far apart.

    Members go by size, so a run of them meets only those that may link by size, and within one block
    only those before it. A first part of the sketch, long enough for unlike sets to differ too much
    in it, rules out most pairs; only the rest are compared in full.
    """
    sides = [side[np.argsort(sizes[side], kind="stable")] for side in sides]
    xs, ys = sides[0], sides[-1]
    whole = len(sides) == 1
    if not len(xs) or not len(ys):
        return
    across, y_sizes = np.ascontiguousarray(bits[ys].T), sizes[ys]
    first = _first_words(int(np.median(sizes)), bits.shape[1], percent)
    at = 0
    while at < len(xs):
        smallest = -(-int(sizes[xs[at]]) * percent // 100)
        low = int(np.searchsorted(y_sizes, smallest))
        step = max(1, CELLS // 4 // max(len(ys) - low, 1))
        x = xs[at : at + step]
        largest = int(sizes[x[-1]])
        fits = np.searchsorted(y_sizes, 100 * largest // percent, "right")
        high = at + len(x) if whole else int(fits)
        if low < high:
            few = np.zeros((len(x), high - low), np.uint16)
            for k in range(first):
                few += np.bitwise_count(bits[x, k][:, None] ^ across[k, None, low:high])
            total = largest + int(y_sizes[high - 1])
            r, c = np.nonzero(few <= (100 - percent) * total // (100 + percent))
            keep = (c + low < r + at) if whole else np.ones(len(r), bool)
            one, two, far = x[r], ys[c + low], few[r, c]
            keep &= comps[one] != comps[two]
            total, least = sizes[one] + sizes[two], np.minimum(sizes[one], sizes[two])
            most = (100 - percent) * total // (100 + percent)
            keep &= (100 * least >= percent * (total - least)) & (far <= most)
            one, two, far, most = one[keep], two[keep], far[keep].astype(np.int64), most[keep]
            rest = max(1, CELLS // bits.shape[1])
            for z in range(0, len(one), rest):
                part = slice(z, z + rest)
                beyond = bits[one[part], first:] ^ bits[two[part], first:]
                far[part] += np.bitwise_count(beyond).sum(1, np.int64)
            near = far <= most
            if near.any():
                yield tuple(v[near].astype(np.int32) for v in (one, two, far))
        at += step


def _first_words(size: int, width: int, percent: int) -> int:
    """Words of a sketch in which unlike sets of a size differ by more than linked ones do in all."""
    odd = (1 - math.exp(-2 * size / (64 * width))) / 2
    linked = (100 - percent) * 2 * size / (100 + percent)
    return min(width, 1 + math.ceil(1.25 * linked / (64 * 2 * odd * (1 - odd))))


def _folded(flat: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    return _folded_rows(flat, offsets, np.arange(len(offsets) - 1), width)


def _folded_rows(
    flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray, width: int
) -> np.ndarray:
    """Sketches as unsigned rows of one width: halves of longer ones are added up modulo two."""
    flat = np.ascontiguousarray(flat).view(np.uint64)  # bits of a negative number count otherwise
    lengths, made = offsets[rows + 1] - offsets[rows], np.empty((len(rows), width), np.uint64)
    for length in np.unique(lengths).tolist():
        some = np.flatnonzero(lengths == length)
        words = flat[offsets[rows[some], None] + np.arange(length)]
        made[some] = np.bitwise_xor.reduce(words.reshape(len(some), -1, width), axis=1)
    return made
