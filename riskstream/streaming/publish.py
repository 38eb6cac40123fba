"""One write path for feature history and latest feature per key."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskstream.sources.versions import Versions
from riskstream.streaming.archive import write_batch

#: Runs of a level before they are folded into one of the next, levels, and files of a run.
FAN, LEVELS, BUCKETS = 8, 3, 8


def latest_per_key(
    rows: DataFrame, key: str = "card1", time: str = "us", row_id: str = "TransactionID"
) -> DataFrame:
    """The newest row of each key, combined on the map side."""
    others = [c for c in rows.columns if c != key]
    newest = F.max_by(F.struct(*others), F.struct(time, row_id)).alias("_row")
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(newest).select(key, "_row.*")


class LatestStore(Versions):
    """The newest row per key, in runs on few levels.

    A batch adds a run of its own newest rows to the first level. ``FAN`` runs of a level are folded
    into one run of the next within the write that completes them, and the last level is a single
    run, so a read opens at most ``FAN - 1`` runs of each other level and that one, each of
    ``buckets`` files, whatever the number of batches; a key is rewritten a few times per
    ``FAN`` ** (levels - 1) batches. Which runs count is one small file, replaced in one step: a
    writer that dies leaves runs nobody reads. Adding rows again changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "card1",
        time: str = "us",
        row_id: str = "TransactionID",
        fan: int = FAN,
        levels: int = LEVELS,
        buckets: int = BUCKETS,
    ) -> None:
        super().__init__(spark, f"{path}/_runs", {"levels": [[] for _ in range(levels)], "old": []})
        self._at, self._order = path.rstrip("/"), (key, time, row_id)
        self._fan, self._buckets = fan, buckets

    def add(self, rows: DataFrame) -> None:
        """Take in a batch; folds that are due are part of it."""
        levels, old = (self.state()[k] for k in ("levels", "old"))
        levels[0].append(self._write_run(latest_per_key(rows, *self._order)))
        gone: list[str] = []
        for i, runs in enumerate(levels):
            last = i == len(levels) - 1
            if len(runs) < (2 if last else self._fan):
                break
            folded = self._write_run(latest_per_key(self._runs(runs, rows.schema), *self._order))
            gone += runs
            levels[i] = [folded] if last else []
            if not last:
                levels[i + 1].append(folded)
        self.change(lambda _: {"levels": levels, "old": gone or old, "schema": rows.schema.json()})
        if gone:
            # A reader may still be at the runs folded now, not at those folded before.
            for run in old:
                self.delete(f"{self._at}/{run}")

    def read(self) -> DataFrame:
        """The newest row of each key."""
        state = self.state()
        runs = [run for level in state["levels"] for run in level]
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        return latest_per_key(self._runs(runs, schema), *self._order)

    def vacuum(self) -> int:
        """Delete runs that do not count, left by writers that died; no writer may be at work."""
        state = self.state()
        used = {run for level in state["levels"] for run in level} | set(state["old"])
        gone = [n for n in self.names(f"{self._at}/run-*") if n.rsplit("/", 1)[1] not in used]
        for name in gone:
            self.delete(name)
        return len(gone)

    def _runs(self, runs: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self._at}/{run}" for run in runs])

    def _write_run(self, rows: DataFrame) -> str:
        run = f"run-{uuid.uuid4().hex}"
        key = self._order[0]
        bucket = F.pmod(F.xxhash64(key), F.lit(self._buckets))
        dealt = rows.repartition(self._buckets, bucket).sortWithinPartitions(key)
        dealt.write.parquet(f"{self._at}/{run}")
        return run


def publish(
    features: DataFrame,
    history: str,
    latest: str,
    checkpoint: str,
    key: str = "card1",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each micro-batch to the history and its newest row per key to the latest table.

    Both are written by the same batch, so they cannot drift apart: one that failed between the two
    writes is run again, replaces its history, and adds rows the latest table may already have.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        # A feed may be quiet, and features wait for the watermark: nothing to write then.
        if rows.isEmpty():
            return
        write_batch(rows, history, batch_id)
        stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{history}/batch_id={batch_id}")
        LatestStore(rows.sparkSession, latest, key).add(stored)

    return (
        features.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def read_latest(
    spark: SparkSession,
    latest: str,
    key: str = "card1",
    batch_id: int | None = None,
    history: str | None = None,
) -> DataFrame:
    """Newest row per key over all batches; as of ``batch_id`` it is made from ``history``."""
    if batch_id is None:
        return LatestStore(spark, latest, key).read()
    rows = spark.read.parquet(history).where(F.col("batch_id") <= batch_id)
    return latest_per_key(rows.drop("batch_id"), key)
