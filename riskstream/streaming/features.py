"""Rolling features on a stream, equal to ``operators.rolling`` on the same rows.

``over()`` does not exist on streams, so this is the one custom stateful operator.
State of a card, in RocksDB:

* ``pending``: rows the watermark has not passed yet;
* ``recent``: the whole history of a card with few rows, read and written at once;

and for a card with many rows instead of ``recent``

* ``minutes``: per minute the raw (time, amount) rows, read only where a frame starts;
* ``sums``: per minute the mergeable rows, count, sum, mean and squared deviations;

``last`` is the time of the newest emitted row.

A row is emitted once the watermark has passed its time, when no earlier row can
still arrive. Minutes older than the longest window are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskstream.functions.scalars import MICROS, safe_ratio
from riskstream.operators.rolling import RATIO_WINDOW, STD_WINDOWS, WINDOWS

LATENESS = "30 seconds"
SMALL_ROWS = 500
_MINUTE = 60 * MICROS


def streaming_features(
    tx: DataFrame,
    windows: dict[str, int] = WINDOWS,
    lateness: str = LATENESS,
    small_rows: int = SMALL_ROWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Features of a stream with ``card1``, ``TransactionID``, ``TransactionAmt``, ``event_time``.

    The columns of ``keep`` come out with their row, for joins and decisions after this step.
    Group by the raw card, never by a salted key. Rows without a card have null
    features and skip the state. Rows later than ``lateness`` are dropped and show
    up in the query's ``numRowsDroppedByWatermark``.
    """
    columns = ["card1", "TransactionID", "TransactionAmt", "event_time"]
    rows = tx.select(
        *columns, F.unix_micros("event_time").alias("us"), packed(keep).alias("_kept")
    ).withWatermark("event_time", lateness)
    processor = RollingProcessor(windows, small_rows)
    features = (
        rows.where(F.col("card1").isNotNull())
        .groupBy("card1")
        .transformWithState(processor, _output(windows), "Append", "EventTime")
    )
    without_card = rows.where(F.col("card1").isNull()).drop("event_time")
    both = features.unionByName(without_card, allowMissingColumns=True)
    both = unpacked(both, tx.select(*keep).schema)
    means = {
        f"card1_amt_mean_{w}": safe_ratio(
            F.col(f"card1_amt_sum_{w}"), F.col(f"card1_txn_count_{w}")
        )
        for w in windows
    }
    ratio = safe_ratio(F.col("TransactionAmt"), F.col(f"card1_amt_mean_{RATIO_WINDOW}"))
    return both.withColumns(means).withColumn(f"amt_to_mean_{RATIO_WINDOW}_ratio", ratio)


_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def packed(columns: Sequence[str]) -> Column:
    """Columns as one text that state can hold; null for none."""
    return F.to_json(F.struct(*columns), _JSON) if columns else F.lit(None).cast("string")


def unpacked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in place of ``_kept``."""
    if not schema.fields:
        return df.drop("_kept")
    return df.withColumn("_kept", F.from_json("_kept", schema, _JSON)).select(
        *[c for c in df.columns if c != "_kept"], "_kept.*"
    )


def _output(windows: dict[str, int]) -> T.StructType:
    fields = [
        T.StructField("card1", T.LongType()),
        T.StructField("TransactionID", T.LongType()),
        T.StructField("TransactionAmt", T.DoubleType()),
        T.StructField("us", T.LongType()),
        T.StructField("card1_time_since_last", T.DoubleType()),
    ]
    for name in windows:
        fields.append(T.StructField(f"card1_txn_count_{name}", T.LongType()))
        fields.append(T.StructField(f"card1_amt_sum_{name}", T.DoubleType()))
        if name in STD_WINDOWS:
            fields.append(T.StructField(f"card1_amt_std_{name}", T.DoubleType()))
    return T.StructType([*fields, T.StructField("_kept", T.StringType())])


class RollingProcessor(StatefulProcessor):
    """Past-only frames over one card's event-time history; every window is at least a minute."""

    def __init__(self, windows: dict[str, int], small_rows: int):
        self._small_rows = small_rows
        self._windows = {n: s * MICROS for n, s in windows.items()}
        self._longest = max(self._windows.values())
        self._names = _output(windows).names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pending = handle.getListState("pending", "us bigint, id bigint, amt double, kept string")
        self._recent = handle.getValueState("recent", "us array<bigint>, amt array<double>")
        self._minutes = handle.getMapState(
            "minutes", "minute bigint", "us array<bigint>, amt array<double>"
        )
        self._sums = handle.getMapState(
            "sums", "minute bigint", "n_rows bigint, n bigint, total double, mean double, sq double"
        )
        self._last = handle.getValueState("last", "us bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        added = [(r["us"], r["TransactionID"], r["TransactionAmt"], r["_kept"]) for r in rows]
        self._pending.appendList(added)
        self._handle.registerTimer(min(a[0] for a in added) // 1000 + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        border = watermark * 1000
        waiting = list(self._pending.get())
        ready = sorted((r for r in waiting if r[0] <= border), key=lambda r: (r[0], r[1]))
        later = [tuple(r) for r in waiting if r[0] > border]
        if ready:
            if later:
                self._pending.put(later)
            else:
                self._pending.clear()
        elif later:  # an earlier timer of this batch has done the work
            self._handle.registerTimer(max(min(r[0] for r in later) // 1000 + 1, watermark + 1))
            return iter([])
        history = _History(self._recent, self._minutes, self._sums, self._small_rows)
        last = self._last.get()
        previous = None if last is None else last[0]
        out = []
        start = 0
        while start < len(ready):
            now = ready[start][0]
            stop = start
            while stop < len(ready) and ready[stop][0] == now:
                stop += 1
            frames = []
            for name, length in self._windows.items():
                count, total, std = history.frame(now - length, now)
                frames += [count, total] + ([std] if name in STD_WINDOWS else [])
            for us, row_id, amount, kept in ready[start:stop]:
                since = None if previous is None else (us - previous) / MICROS
                values = (key[0], row_id, amount, us, since, *frames, kept)
                out.append(Row(**dict(zip(self._names, values))))
                previous = us
            for _, _, amount, _ in ready[start:stop]:
                history.add(now, amount)
            start = stop
        if ready:
            self._last.update((previous,))
        newest = history.store(border - self._longest)
        if later:
            self._handle.registerTimer(max(min(r[0] for r in later) // 1000 + 1, watermark + 1))
        elif newest is not None:
            # With nothing pending, wake up once more to drop the history.
            self._handle.registerTimer((newest + 2) * 60_000 + self._longest // 1000)
        return iter(out)

    def close(self) -> None:
        pass


class _History:
    """One card's minutes while a timer runs.

    Rows are added in time order, so only the newest minute ever changes. Whole
    minutes are summed from ``sums``; raw rows are fetched only for the minute a
    frame starts in, and summed from the back once, so each frame costs a search.
    """

    def __init__(self, recent, minutes, sums, small_rows: int):
        self._recent, self._minutes, self._sums = recent, minutes, sums
        self._small_rows = small_rows
        self._table: dict[int, tuple] = {}
        self._raw: dict[int, tuple[list, list]] = {}
        self._suffixes: dict[int, tuple] = {}
        self._whole = None
        self._newest = None
        self._kept: set[int] = set()
        small = recent.get()
        if small is not None:
            for us, amount in zip(*small):
                self.add(us, amount)
        elif sums.exists():
            self._table = {k[0]: tuple(v) for k, v in sums.iterator()}
            self._kept = set(self._table)

    def add(self, us: int, amount: float | None) -> None:
        minute = us // _MINUTE
        if minute != self._newest:
            self._newest, self._whole = minute, None
        if minute not in self._raw:
            self._raw[minute] = self._stored(minute)
        times, amounts = self._raw[minute]
        times.append(us)
        amounts.append(amount)
        n_rows, n, total, mean, sq = self._table.get(minute, (0, 0, 0.0, 0.0, 0.0))
        if amount is not None:
            n, total = n + 1, total + amount
            step = amount - mean
            mean += step / n
            sq += step * (amount - mean)
        self._table[minute] = (n_rows + 1, n, total, mean, sq)

    def frame(self, start: int, end: int) -> tuple[int | None, float | None, float | None]:
        """Count, sum and sample std of the amounts in ``[start, end)``; ``end`` is now."""
        first, last = start // _MINUTE, end // _MINUTE
        keys, sums = self._whole_minutes(last)
        between = sums[np.searchsorted(keys, first, "right") :]
        edges = [self._since(first, start), self._table.get(last, (0, 0, 0.0, 0.0, 0.0))]
        parts = np.vstack([np.array(edges, dtype=float), between])
        n_rows, n = parts[:, 0].sum(), parts[:, 1].sum()
        if not n_rows:
            return None, None, None
        if not n:
            return 0, None, None
        total = parts[:, 2].sum()
        offset = parts[:, 3] - total / n
        sq = (parts[:, 4] + parts[:, 1] * offset * offset).sum()
        return int(n), float(total), math.sqrt(sq / (n - 1)) if n > 1 else None

    def store(self, oldest_us: int) -> int | None:
        """Write new rows, drop minutes no later frame can reach, return the newest minute kept."""
        oldest = oldest_us // _MINUTE
        for minute in [m for m in self._table if m < oldest]:
            del self._table[minute]
            self._raw.pop(minute, None)
            if minute in self._kept:
                self._sums.removeKey((minute,))
                self._minutes.removeKey((minute,))
        if not self._kept:
            rows = [self._raw[m] for m in sorted(self._raw)]
            times = [t for row in rows for t in row[0]]
            if not times:
                self._recent.clear()
                return None
            if len(times) <= self._small_rows:
                self._recent.update((times, [a for row in rows for a in row[1]]))
                return max(self._table)
            self._recent.clear()
        for minute, (times, amounts) in self._raw.items():
            self._minutes.updateValue((minute,), (times, amounts))
            self._sums.updateValue((minute,), self._table[minute])
        return max(self._table, default=None)

    def _stored(self, minute: int) -> tuple[list, list]:
        kept = self._minutes.getValue((minute,)) if minute in self._table else None
        return (list(kept[0]), list(kept[1])) if kept else ([], [])

    def _whole_minutes(self, last: int):
        """Sums of all minutes before the current one."""
        if self._whole is None or self._whole[0] != last:
            keys = sorted(k for k in self._table if k < last)
            sums = np.array([self._table[k] for k in keys], dtype=float).reshape(len(keys), 5)
            self._whole = last, np.array(keys, dtype=np.int64), sums
        return self._whole[1:]

    def _since(self, minute: int, start: int) -> tuple:
        """Summary of the rows of ``minute`` from ``start`` on."""
        if minute not in self._table:
            return 0, 0, 0.0, 0.0, 0.0
        if minute not in self._suffixes:
            times, amounts = self._raw.get(minute) or self._stored(minute)
            values = np.array([np.nan if a is None else a for a in amounts], dtype=float)
            known = ~np.isnan(values)
            center = values[known].mean() if known.any() else 0.0
            dev = np.where(known, values - center, 0.0)
            columns = [known.astype(float), np.where(known, values, 0.0), dev, dev * dev]
            tails = [np.append(np.cumsum(c[::-1])[::-1], 0.0) for c in columns]
            self._suffixes[minute] = np.array(times, dtype=np.int64), center, tails
        times, center, tails = self._suffixes[minute]
        at = int(np.searchsorted(times, start, "left"))
        n, total, dev, sq = (t[at] for t in tails)
        if not n:
            return len(times) - at, 0, 0.0, 0.0, 0.0
        return len(times) - at, n, total, center + dev / n, max(sq - dev * dev / n, 0.0)
