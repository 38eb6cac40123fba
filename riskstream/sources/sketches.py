"""Sketches of a column per hour, kept beside the archive."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.operators.quantiles import ROWS_PER_TASK, exact_quantiles
from riskstream.sources.ledger import Ledger
from riskstream.sources.versions import Versions

#: Of a stored sketch: about 25 kB an hour, ranks to within half a percent.
ACCURACY = 1024
MOST_FOLDERS = 20
EVENT_MILLIS = "unix_millis(event_time)"


class HourSketches(Versions):
    """Per hour and commit of the archive at ``path`` a mergeable sketch of ``value``, a whole number.

    ``refresh`` reads the commits that were confirmed since the last one, nothing else. Its result
    is shown by one rename, so what a dead writer left is never read, and a refresh run again
    starts from the same commits. After ``MOST_FOLDERS`` refreshes the rows that still count are put
    into one folder; folders replaced by an earlier fold are deleted then.
    """

    def __init__(
        self, spark: SparkSession, path: str, value: str = EVENT_MILLIS, name: str = "event_time"
    ) -> None:
        self.ledger = Ledger(spark, path)
        self._root = f"{self.ledger.archive}/_sketches/{name}"
        self.value = F.expr(value).cast("bigint")
        super().__init__(spark, self._root, {"next": 0, "hidden": [], "folders": [], "old": []})

    def refresh(self) -> dict:
        """Sketch the commits that have none, and return the ledger's state this was done for."""
        seen, state = self.state(), self.ledger.state()
        commit = F.col("commit")
        known = (commit < seen["next"]) & ~commit.isin(seen["hidden"])
        if seen["next"] == state["next"] and seen["hidden"] == state["hidden"]:
            return state
        fresh = (
            self.ledger.rows(state)
            .where(~known)
            .select("event_hour", "commit", self.value.alias("v"))
            .groupBy("event_hour", "commit")
            .agg(F.count("v").alias("n"), F.kll_sketch_agg_bigint("v", F.lit(ACCURACY)).alias("sketch"))
            .where("n > 0")
        )
        folders, old = seen["folders"], []
        if len(folders) >= MOST_FOLDERS:
            fresh = fresh.unionByName(self._visible(self._stored(folders), state))
            folders, old = [], folders
        folder = f"{self._root}/{uuid.uuid4().hex}"
        fresh.write.parquet(folder)

        def change(now: dict) -> dict:
            if now != seen:
                return now  # another refresh was faster
            ours = {"next": state["next"], "hidden": state["hidden"], "folders": [*folders, folder]}
            return ours | {"old": old or seen["old"]}

        after = self.change(change)
        if folder not in after["folders"]:
            self.delete(folder)
            return self.refresh()
        if old:
            for path in seen["old"]:
                self.delete(path)
        return state

    def quantiles(
        self,
        shares: list[float],
        first: str | None = None,
        last: str | None = None,
        max_rows: int = ROWS_PER_TASK,
    ) -> list[float | None]:
        """Exact quantiles over the archive, or over its hours from ``first`` to ``last``, both in.

        The stored sketches enclose the ranks; then the rows are read once.
        """
        state = self.refresh()
        folders = self.state()["folders"]
        if not folders:
            return [None] * len(shares)
        hour = F.col("event_hour")
        stored, rows = self._visible(self._stored(folders), state), self.ledger.rows(state)
        if first is not None:
            stored, rows = stored.where(hour >= first), rows.where(hour >= first)
        if last is not None:
            stored, rows = stored.where(hour <= last), rows.where(hour <= last)
        merged = F.kll_merge_agg_bigint("sketch", F.lit(ACCURACY))
        n, sketch = stored.agg(F.coalesce(F.sum("n"), F.lit(0)), merged).first()
        return exact_quantiles(
            rows.select(self.value.alias("v")), "v", shares, max_rows,
            sketch=(n, bytes(sketch) if n else b""), accuracy=ACCURACY,
        )

    def _stored(self, folders: list[str]) -> DataFrame:
        schema = "event_hour string, commit long, n long, sketch binary"
        return self.spark.read.schema(schema).parquet(*folders)

    def _visible(self, stored: DataFrame, state: dict) -> DataFrame:
        commit: Column = F.col("commit")
        return stored.where(self.ledger.visible(state, F.col("event_hour"), commit))
