"""Which files of the archive count, and which offsets they hold.

Files lie under ``commit=N/event_hour=...``. The ledger, a short JSON text per version under
``_ledger``, says

* ``next`` and ``hidden``: numbers given out, and those whose write has not been confirmed;
* ``spans``: the range of archived offsets, as merged intervals per topic partition;
* ``bases``: per compacted hour the commit that replaces all earlier ones but those listed with it.

A writer takes a number, writes its files, and confirms them; what a dead writer left stays hidden,
and is deleted by ``vacuum``. A version becomes visible by renaming one file, so a reader sees all
of a commit or nothing. An offset outside all intervals is new; only rows inside one are compared
with archived rows. Intervals may be joined freely, at the price of more rows to compare, so there
are never more than ``MOST_SPANS`` per topic partition, and one while offsets rise.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schemas
from riskstream.sources.versions import Versions

NO_HOUR = "__HIVE_DEFAULT_PARTITION__"  # where Spark puts rows whose partition value is null
MOST_SPANS = 100
STORED = T.StructType([*schemas.ARCHIVE.fields, T.StructField("commit", T.LongType())])
_EMPTY = {"next": 0, "hidden": [], "spans": [], "bases": {}}

#: topic, partition, first and last offset
Span = tuple[str, int, int, int]


class Ledger(Versions):
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.archive = path.rstrip("/")
        super().__init__(spark, f"{self.archive}/_ledger", _EMPTY)

    def reserve(self) -> tuple[int, dict]:
        """A new commit number, hidden until it is confirmed, and the state before it."""

        def change(state: dict) -> dict:
            n = state["next"]
            return state | {"next": n + 1, "hidden": [*state["hidden"], n]}

        state = self.change(change)
        return state["next"] - 1, state

    def confirm(self, number: int, spans: Iterable[Span]) -> None:
        """Show the commit and note its offsets."""
        spans = list(spans)

        def change(state: dict) -> dict:
            known = [tuple(s) for s in state["spans"]]
            hidden = [n for n in state["hidden"] if n != number]
            return state | {"hidden": hidden, "spans": merged_spans(known + spans)}

        self.change(change)

    def replace(self, number: int, hours: list[str | None], running: list[int]) -> None:
        """Show a commit that holds all rows of ``hours`` but those of the commits ``running``."""
        bases = {hour or "": [number, *running] for hour in hours}

        def change(state: dict) -> dict:
            hidden = [n for n in state["hidden"] if n != number]
            return state | {"hidden": hidden, "bases": state["bases"] | bases}

        self.change(change)

    def visible(self, state: dict, hour: Column, commit: Column) -> Column:
        """Whether files of a commit count; decided on partition values, before any file is read."""
        shown = (commit < state["next"]) & ~commit.isin(state["hidden"])
        for name, (base, *others) in state["bases"].items():
            other = F.coalesce(hour, F.lit("")) != name
            shown = shown & (other | (commit >= base) | commit.isin(others))
        return shown

    def rows(self, state: dict | None = None) -> DataFrame:
        """The rows of all confirmed commits, with their ``commit``."""
        state = state or self.state()
        if not state["next"] or not self.fs(folder := self.path(self.archive)).exists(folder):
            return self.spark.createDataFrame([], STORED)
        stored = self.spark.read.schema(STORED).parquet(self.archive)
        return stored.where(self.visible(state, F.col("event_hour"), F.col("commit")))

    def of(self, number: int) -> tuple[list[str], DataFrame | None]:
        """The hours one commit wrote, and its rows, from its own folder."""
        folder = self.path(f"{self.archive}/commit={number}")
        fs = self.fs(folder)
        if not fs.exists(folder):
            return [], None
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        read = self.spark.read.schema(STORED).option("basePath", self.archive)
        hours = sorted(n.split("=", 1)[1] for n in names if "=" in n)
        return hours, read.parquet(folder.toString())

    def spans(self, state: dict) -> DataFrame | None:
        """The intervals as a small table: at most ``MOST_SPANS`` rows per topic partition."""
        spans = [tuple(s) for s in state["spans"]]
        schema = "_topic string, _part int, _low long, _high long"
        return F.broadcast(self.spark.createDataFrame(spans, schema)) if spans else None

    def folders(self) -> list[tuple[str | None, int]]:
        """Hour and commit of every folder, confirmed or not."""
        result = []
        for name in self.names(f"{self.archive}/commit=*/event_hour=*"):
            commit, hour = (part.split("=", 1)[1] for part in name.rsplit("/", 2)[1:])
            result.append((None if hour == NO_HOUR else hour, int(commit)))
        return result

    def vacuum(self) -> int:
        """Delete what no reader of the present version sees; no writer may be at work."""
        state = self.state()
        hidden, bases = set(state["hidden"]), state["bases"]
        gone = 0
        for hour, commit in self.folders():
            base, *others = bases.get(hour or "", [0])
            if commit in hidden or (commit < base and commit not in others):
                self.delete(f"{self.archive}/commit={commit}/event_hour={hour or NO_HOUR}")
                gone += 1

        def change(now: dict) -> dict:
            rest = {h: b for h, b in now["bases"].items() if bases.get(h) != b}
            return now | {"hidden": [n for n in now["hidden"] if n not in hidden], "bases": rest}

        self.change(change)
        return gone


def inside() -> Column:
    """Whether a row's offset lies in an interval of the ledger."""
    return (
        (F.col("kafka_topic") == F.col("_topic"))
        & (F.col("kafka_partition") == F.col("_part"))
        & F.col("kafka_offset").between(F.col("_low"), F.col("_high"))
    )


def spans_of(rows: DataFrame) -> tuple[list[Span], int]:
    """The offset range of each topic partition, and the number of rows."""
    offset = F.col("kafka_offset")
    found = rows.groupBy("kafka_topic", "kafka_partition").agg(
        F.min(offset), F.max(offset), F.count(F.lit(1))
    )
    found = found.collect()
    return [tuple(r[:4]) for r in found], sum(r[4] for r in found)


def merged_spans(spans: Iterable[Span], most: int = MOST_SPANS) -> list[Span]:
    """Overlapping and neighbouring intervals joined; if too many are left, the nearest ones too."""
    by_place = defaultdict(list)
    for topic, part, low, high in spans:
        by_place[topic, part].append((low, high))
    result: list[Span] = []
    for (topic, part), found in sorted(by_place.items()):
        joined = _joined(found, 1)
        if len(joined) > most:
            gaps = sorted(b[0] - a[1] for a, b in zip(joined, joined[1:]))
            joined = _joined(joined, gaps[len(joined) - most - 1])
        result += [(topic, part, low, high) for low, high in joined]
    return result


def _joined(spans: list[tuple[int, int]], gap: int) -> list[tuple[int, int]]:
    result: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if result and low - result[-1][1] <= gap:
            result[-1] = (result[-1][0], max(result[-1][1], high))
        else:
            result.append((low, high))
    return result
