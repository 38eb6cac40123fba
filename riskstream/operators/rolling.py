"""Past-only rolling features per card.

The frame of a row at time ``t`` is ``[t - w, t)``: rows at exactly ``t - w``
count, rows at ``t`` (peers) do not. An empty frame gives null for every feature;
a frame whose amounts are all null gives count 0 and null sum. A row without card or time is in
no frame and its own features are null.

One plan serves every card. Spark's sliding frame rescans itself for every row and puts a card into
one task, so rows are dealt by range of (card, time) instead: cells of about equal size, whether a
cell holds a thousand quiet cards, an hour of a burst or a year of an old card. With each row go
slim marks at ``t - w``, one per window, which fall into the cell where the frame begins.

* Inside a cell, frames are added up from runs of 1, 2, 4, ... rows. Parts are (rows, amounts, sum,
  squared deviations); they are merged and never subtracted, so nothing cancels.
* A frame that begins in an earlier cell is the end of that cell, which its mark reports, the whole
  cells between, and the start of its own cell. Only a card that crosses a border has such frames;
  its cells between hold nothing else, so there is one sum per cell, merged in the same way.

The source is dealt out once and written with what the cells tell; only rows whose frames cross a
border are shuffled again, to meet their marks. Peers share a cell; rows without card or time are
spread.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.functions.scalars import MICROS, safe_ratio
from riskstream.session import written

WINDOWS = {"1h": 3_600, "24h": 86_400}
STD_WINDOWS = ("24h",)
RATIO_WINDOW = "24h"
_ROW, _MARK, _TOTAL = 0, 1, 2
_BATCH = 10_000
#: Rows and marks of a cell, about; a task holds one cell in Python, a few hundred bytes an event.
CELL_EVENTS = 500_000


def rolling_features(
    tx: DataFrame,
    key: str = "card1",
    time: str = "us",
    amount: str = "TransactionAmt",
    row_id: str = "TransactionID",
    windows: dict[str, int] = WINDOWS,
    cells: int | None = None,
) -> DataFrame:
    """``tx`` plus rolling count, sum, mean, std, time since last and amount ratio.

    ``time`` is epoch micros. ``cells`` is how many tasks the rows are dealt to at least, by default
    the session's number of shuffle partitions. A task holds the events of its cell, so there are
    more where a cell would get over ``CELL_EVENTS``.
    """
    dealt = deal(tx, key, time, amount, row_id, windows, cells)
    found = Borders.of(dealt)
    rows = dealt.where(F.col("_kind") == _ROW)
    crossing = F.lit(False)
    for i in range(len(windows)):
        crossing = crossing | F.col(f"_open_{i}")
    inside = rows.where(~crossing)
    parts = inside if not found.marks else inside.unionByName(
        _joined(rows.where(crossing), dealt.where(F.col("_kind") == _MARK), found, windows)
    )
    features = _since_border(parts, found)
    features = features.select("_row.*", *_features(key, windows))
    return with_means(features, key, amount, windows)


def feature_names(key: str = "card1", windows: dict[str, int] = WINDOWS) -> list[str]:
    """The feature columns in the order :func:`rolling_features` adds them."""
    return (
        [f"{key}_{part}_{w}" for w in windows for part in ("txn_count", "amt_sum")]
        + [f"{key}_amt_std_{w}" for w in windows if w in STD_WINDOWS]
        + [f"{key}_time_since_last"]
        + [f"{key}_amt_mean_{w}" for w in windows]
        + [f"amt_to_mean_{RATIO_WINDOW}_ratio"]
    )


def with_means(df: DataFrame, key: str, amount: str, windows: dict[str, int]) -> DataFrame:
    means = {
        f"{key}_amt_mean_{w}": safe_ratio(
            F.col(f"{key}_amt_sum_{w}"), F.col(f"{key}_txn_count_{w}")
        )
        for w in windows
    }
    ratio = safe_ratio(F.col(amount), F.col(f"{key}_amt_mean_{RATIO_WINDOW}"))
    return df.withColumns(means).withColumn(f"amt_to_mean_{RATIO_WINDOW}_ratio", ratio)


def _features(key: str, windows: dict[str, int]) -> list:
    columns = []
    for i, name in enumerate(windows):
        rows, n, total = (F.col(f"_{part}_{i}") for part in ("rows", "n", "sum"))
        columns.append(F.when(rows > 0, n).alias(f"{key}_txn_count_{name}"))
        columns.append(F.when(n > 0, total).alias(f"{key}_amt_sum_{name}"))
        if name in STD_WINDOWS:
            variance = F.col(f"_m2_{i}") / F.nullif(n - 1, F.lit(0))
            columns.append(F.when(n > 1, F.sqrt(variance)).alias(f"{key}_amt_std_{name}"))
    return [*columns, (F.col("_since") / MICROS).alias(f"{key}_time_since_last")]


class Parts(NamedTuple):
    """Mergeable sums: amounts, their sum, and squared deviations from their own mean."""

    n: np.ndarray
    total: np.ndarray
    m2: np.ndarray

    def at(self, places) -> Parts:
        return Parts(*(x[places] for x in self))

    def put(self, places, other: Parts) -> None:
        for x, y in zip(self, other):
            x[places] = y

    def merged(self, other: Parts) -> Parts:
        n = self.n + other.n
        apart = other.total / np.maximum(other.n, 1) - self.total / np.maximum(self.n, 1)
        between = apart * apart * self.n * other.n / np.maximum(n, 1)
        return Parts(n, self.total + other.total, self.m2 + other.m2 + between)

    def over(self, low: np.ndarray, high: np.ndarray) -> Parts:
        """The merged parts of each range, from runs of doubling length; empty where low >= high."""
        found = Parts(*(np.zeros(len(low)) for _ in range(3)))
        at, left, run, level = low.copy(), np.maximum(high - low, 0), self, 0
        while True:
            take = np.flatnonzero((left >> level) & 1)
            found.put(take, found.at(take).merged(run.at(at[take])))
            at[take] += 1 << level
            level += 1
            if not (left >> level).any():
                return found
            step = 1 << (level - 1)
            run = run.at(slice(None, -step)).merged(run.at(slice(step, None)))


def deal(
    tx: DataFrame,
    key: str,
    time: str,
    amount: str,
    row_id: str,
    windows: dict[str, int],
    cells: int | None = None,
) -> DataFrame:
    """Rows, marks and cell totals (``_kind``), with the parts that each cell tells on its own."""
    spark = tx.sparkSession
    cells = cells or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = max(cells, -(-tx.count() * (len(windows) + 1) // CELL_EVENTS))
    placed = F.col(key).isNotNull() & F.col(time).isNotNull()
    kinds = F.when(placed, F.array(*map(F.lit, range(len(windows) + 1)))).otherwise(F.array(F.lit(0)))
    moves = F.array(F.lit(0).cast("bigint"), *(F.lit(s * MICROS).cast("bigint") for s in windows.values()))
    base = tx.select(
        F.struct(*tx.columns).alias("_row"),
        F.col(key).alias("_k"),
        F.col(time).cast("bigint").alias("_t"),
        F.when(~placed, F.xxhash64(row_id)).alias("_spread"),
        F.col(row_id).alias("_id"),
        F.col(amount).cast("double").alias("_x"),
        F.explode(kinds).alias("_kind"),
    )
    own = F.col("_kind") == 0
    events = base.select(
        F.when(own, F.col("_row")).alias("_row"),
        "_k",
        (F.col("_t") - F.get(moves, "_kind")).alias("_t"),
        "_spread",
        "_id",
        F.when(own, F.col("_x")).alias("_x"),
        "_kind",
    )
    ordered = events.repartitionByRange(cells, "_k", "_t", "_spread").sortWithinPartitions(
        "_k", "_t", "_spread", "_kind", "_id"
    )
    spans = [seconds * MICROS for seconds in windows.values()]
    fields = {"_kind": "integer", "_cell": "integer", "_t": "long", "_since": "long", "_edge": "boolean"}
    for i in range(len(spans)):
        fields |= {f"_open_{i}": "boolean", f"_rows_{i}": "long", f"_n_{i}": "long"}
        fields |= {f"_sum_{i}": "double", f"_m2_{i}": "double"}
    schema = T.StructType([events.schema["_row"], events.schema["_k"]])
    for name, kind in fields.items():
        schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            cell = _Cell(pa.Table.from_batches(held), TaskContext.get().partitionId(), spans)
            held.clear()  # the cell has copies
            yield from cell.told()

    return written(ordered.mapInArrow(run, schema), "rolling-cells")


class _Cell:
    """The events of one cell, in order of card and time."""

    def __init__(self, events: pa.Table, number: int, spans: list[int]) -> None:
        self.number, self.spans = number, spans
        keys, times = events.column("_k").combine_chunks(), events.column("_t")
        loose = pc.or_(pc.is_null(keys), pc.is_null(times)).to_numpy()
        self.loose = events.take(np.flatnonzero(loose))
        self.events = events.take(np.flatnonzero(~loose))
        keys = self.events.column("_k").combine_chunks()
        self.time = self.events.column("_t").to_numpy()
        self.kind = self.events.column("_kind").to_numpy()
        other = np.zeros(len(keys), bool)
        if len(keys) > 1:
            other[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        self.card = np.cumsum(other)
        self.rows = np.flatnonzero(self.kind == 0)
        amounts = self.events.column("_x").take(self.rows)
        known = pc.is_valid(amounts).to_numpy()
        value = amounts.fill_null(0.0).to_numpy()
        self.each = Parts(known.astype(float), np.where(known, value, 0.0), np.zeros(len(value)))

    def told(self) -> Iterator[pa.RecordBatch]:
        loose, n = self.loose, len(self.loose)
        if n:
            yield from self._batches(loose.column("_row"), loose.column("_k"), _ROW, n, {})
        if len(self.time):
            yield from self._frames()
            yield from self._marks()
            yield from self._totals()

    def _frames(self) -> Iterator[pa.RecordBatch]:
        card, time = self.card[self.rows], self.time[self.rows]
        n = len(time)
        if not n:
            return
        new_card, new_time = np.ones(n, bool), np.ones(n, bool)
        new_card[1:] = card[1:] != card[:-1]
        new_time[1:] = new_card[1:] | (time[1:] != time[:-1])
        first_peer = np.maximum.accumulate(np.where(new_time, np.arange(n), 0))
        since = np.diff(time, prepend=0)
        columns = {
            "_t": pa.array(time),
            "_since": pa.array(since, mask=new_card),
            # The first row of a card that may have rows in earlier cells.
            "_edge": pa.array(new_card & (card == 0)),
        }
        for i, span in enumerate(self.spans):
            # Frames begin at the first row at or after t - w: sort both and count rows before.
            order = np.lexsort((np.repeat([0, 1], n), np.tile(time, 2) - np.repeat([span, 0], n),
                                np.tile(card, 2)))
            before = np.cumsum(order >= n)
            low = np.empty(2 * n, np.int64)
            low[order] = before
            low = np.minimum(low[:n], first_peer)
            columns |= self._columns(i, self.each.over(low, first_peer), first_peer - low)
            columns[f"_open_{i}"] = pa.array((card == 0) & (time - span < self.time[0]))
        rows = self.events.take(self.rows)
        yield from self._batches(rows.column("_row"), rows.column("_k"), _ROW, n, columns)

    def _marks(self) -> Iterator[pa.RecordBatch]:
        """Where the last card goes on: what is left of this cell from each mark onwards."""
        last = self.card == self.card[-1]
        time = self.time[self.rows][last[self.rows]]
        skipped = len(self.rows) - len(time)
        for i, span in enumerate(self.spans):
            begin = self._crossing(i)
            low = skipped + np.searchsorted(time, begin)
            high = np.full(len(begin), len(self.rows))
            columns = {"_t": pa.array(begin + span), f"_open_{i}": pa.array(np.ones(len(begin), bool))}
            columns |= self._columns(i, self.each.over(low, high), high - low)
            if len(begin):
                yield from self._of_card(-1, _MARK, len(begin), columns)

    def _crossing(self, i: int) -> np.ndarray:
        """Marks here whose rows lie in later cells."""
        mine = (self.card == self.card[-1]) & (self.kind == i + 1)
        begin = np.unique(self.time[mine])
        return begin[begin + self.spans[i] > self.time[-1]]

    def _totals(self) -> Iterator[pa.RecordBatch]:
        """The first and the last card, each over the whole cell; one row if they are one card."""
        ends = self.card[-1]
        marks = sum(len(self._crossing(i)) for i in range(len(self.spans)))
        of_row = self.card[self.rows]
        for place, card in {ends: (-1, ends), 0: (0, 0)}.values():
            low, high = np.searchsorted(of_row, [card, card + 1])
            whole = self.each.over(np.array([low]), np.array([high]))
            newest = self.time[self.rows][high - 1] if high > low else None
            columns = {
                "_t": pa.array([newest], pa.int64()),
                "_since": pa.array([marks]),  # how many marks this cell reports
                "_edge": pa.array([bool(card == 0)]),  # begins the cell
                "_open_0": pa.array([bool(card == ends)]),  # ends it
                **self._columns(0, whole, np.array([high - low])),
            }
            yield from self._of_card(place, _TOTAL, 1, columns)

    @staticmethod
    def _columns(i: int, parts: Parts, rows: np.ndarray) -> dict[str, pa.Array]:
        return {
            f"_rows_{i}": pa.array(rows.astype(np.int64)),
            f"_n_{i}": pa.array(parts.n.astype(np.int64)),
            f"_sum_{i}": pa.array(parts.total),
            f"_m2_{i}": pa.array(parts.m2),
        }

    def _of_card(self, place: int, kind: int, n: int, columns: dict) -> Iterator[pa.RecordBatch]:
        keys = self.events.column("_k").take([place % len(self.time)] * n)
        none = pa.nulls(n, self.events.schema.field("_row").type)
        yield from self._batches(pa.chunked_array([none]), keys, kind, n, columns)

    def _batches(self, rows, keys, kind: int, n: int, columns: dict) -> Iterator[pa.RecordBatch]:
        same = {"_kind": pa.array(np.full(n, kind, np.int32)), "_cell": pa.array(np.full(n, self.number, np.int32))}
        empty = {"_t": pa.int64(), "_since": pa.int64(), "_edge": pa.bool_()}
        for i in range(len(self.spans)):
            empty |= {f"_open_{i}": pa.bool_(), f"_rows_{i}": pa.int64(), f"_n_{i}": pa.int64()}
            empty |= {f"_sum_{i}": pa.float64(), f"_m2_{i}": pa.float64()}
        columns = {name: columns.get(name, pa.nulls(n, kind)) for name, kind in empty.items()}
        for name, column in columns.items():
            if pa.types.is_boolean(column.type):
                columns[name] = column.fill_null(False)
        table = pa.table({"_row": rows, "_k": keys, **same, **columns})
        yield from table.to_batches(max_chunksize=_BATCH)


class Borders(NamedTuple):
    """What crosses from cell to cell: at most two rows a cell, kept on the driver."""

    marks: int
    #: Cell and the time of the newest earlier row of the card it begins with.
    before: list[tuple[int, int]]
    #: Parts and rows of the cells that hold one card, by number of the cell.
    whole: Parts
    rows: np.ndarray

    @classmethod
    def of(cls, dealt: DataFrame) -> Borders:
        ends = dealt.where(F.col("_kind") == _TOTAL).orderBy("_cell", F.desc("_edge"))
        last = F.col("_open_0").alias("last")
        ends = ends.select("_cell", "_k", "_t", "_since", "_edge", last, "_rows_0", "_n_0", "_sum_0", "_m2_0").collect()
        size = ends[-1]["_cell"] + 1 if ends else 0
        whole, rows = Parts(*(np.zeros(size) for _ in range(3))), np.zeros(size, np.int64)
        before, card, newest = [], None, None
        for r in ends:
            if r["_edge"]:
                if r["_k"] != card:
                    newest = None
                elif newest is not None:
                    before.append((r["_cell"], newest))
                if r["last"]:
                    whole.put(r["_cell"], Parts(float(r["_n_0"]), r["_sum_0"], r["_m2_0"]))
                    rows[r["_cell"]] = r["_rows_0"]
            else:
                newest = None
            card = r["_k"]
            newest = newest if r["_t"] is None else r["_t"]
        return cls(sum(r["_since"] for r in ends), before, whole, rows)


def _since_border(parts: DataFrame, found: Borders) -> DataFrame:
    """The first rows of a card in a cell look back to the newest of an earlier cell."""
    if not found.before:
        return parts
    spark = parts.sparkSession
    # One row per cell at most.
    before = spark.createDataFrame(found.before, "_border int, _newest long")
    edge = F.col("_edge") & (F.col("_cell") == F.col("_border"))
    joined = parts.join(F.broadcast(before), edge, "left")
    since = F.coalesce("_since", F.col("_t") - F.col("_newest"))
    return joined.withColumn("_since", since).drop("_border", "_newest")


def _joined(rows: DataFrame, marks: DataFrame, found: Borders, windows: dict[str, int]) -> DataFrame:
    """Rows whose frames begin in earlier cells, with the parts of those cells merged in."""
    told = []
    for i in range(len(windows)):
        mark = F.struct("_cell", f"_rows_{i}", f"_n_{i}", f"_sum_{i}", f"_m2_{i}")
        told.append(F.max(F.when(F.col(f"_open_{i}"), mark)).alias(f"_mark_{i}"))
    marks = marks.groupBy(F.col("_k").alias("_mk"), F.col("_t").alias("_mt")).agg(*told)
    joined = rows.join(marks, (F.col("_k") == F.col("_mk")) & (F.col("_t") == F.col("_mt")), "left")
    shared = rows.sparkSession.sparkContext.broadcast(found)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            columns = {name: batch.column(name) for name in names}
            cell = batch.column("_cell").to_numpy()
            for i in range(len(windows)):
                mark = batch.column(f"_mark_{i}")
                open_ = batch.column(f"_open_{i}").to_numpy(zero_copy_only=False)
                at = np.flatnonzero(open_ & mark.is_valid().to_numpy(zero_copy_only=False))
                there = mark.take(pa.array(at))
                sums = [f"_{part}_{i}" for part in ("n", "sum", "m2")]
                own, left = (
                    Parts(*(get(name).to_numpy(zero_copy_only=False).astype(float) for name in sums))
                    for get in (batch.column, there.field)
                )
                begin, end = there.field("_cell").to_numpy() + 1, cell[at]
                begin = begin.astype(np.int64)
                own.put(at, left.merged(found.whole.over(begin, end)).merged(own.at(at)))
                count = np.concatenate([[0], np.cumsum(found.rows)])
                n = columns[f"_rows_{i}"].to_numpy().copy()
                n[at] += there.field(f"_rows_{i}").to_numpy() + count[end] - count[begin]
                columns |= _Cell._columns(i, own, n)
            yield pa.RecordBatch.from_pydict(columns)

    return joined.mapInArrow(run, rows.schema)
