"""Joins of live feeds with each other and with reference tables."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskstream.operators.joins import enrich
from riskstream.session import remove, written

_LOG = logging.getLogger(__name__)


def join_feeds(
    tx: DataFrame,
    identities: DataFrame,
    before: str = "30 seconds",
    after: str = "30 seconds",
    lateness: str = "30 seconds",
    on: str = "TransactionID",
) -> DataFrame:
    """Transactions with the identity that arrives near them, before or after.

    Both feeds carry ``event_time``; the identity's comes out as ``identity_time``.
    A transaction without identity is emitted once the watermark rules one out.
    """
    left = tx.withWatermark("event_time", lateness)
    right = (
        identities.withColumnRenamed("event_time", "identity_time")
        .withColumnRenamed(on, "_id")
        .withWatermark("identity_time", lateness)
    )
    near = F.expr(
        f"identity_time >= event_time - interval {before} "
        f"and identity_time <= event_time + interval {after}"
    )
    return left.join(right, (F.col(on) == F.col("_id")) & near, "leftOuter").drop("_id")


def enrich_stream(
    events: DataFrame,
    read_users: Callable[[], DataFrame],
    read_merchants: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Enrich each micro-batch with the reference tables as they are at that moment.

    The tables are read anew per batch, so a refresh is visible from the next one,
    and after a restart they come from storage, not from state.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        write(enrich(rows, read_users(), read_merchants()), batch_id)

    return (
        events.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


class RefreshingTable:
    """A lookup table re-read for every micro-batch; a failed read keeps the last good one.

    A version is named by its content, so what has not changed is not copied again, however many
    batches pass. The last ``kept`` versions stay, for batches that are still at work; as each is
    a copy, a source that is overwritten, damaged or gone does no harm.
    """

    def __init__(self, read: Callable[[], DataFrame], empty: DataFrame, kept: int = 2):
        self._read, self._current, self._kept = read, empty, kept
        self._versions: list[tuple] = []

    def get(self) -> DataFrame:
        try:
            self._refresh()
        except Exception as error:  # noqa: BLE001 - whatever fails, the old table stays in use
            _LOG.warning("refresh failed, the last good table stays in use: %s", error)
        return self._current

    def _refresh(self) -> None:
        source = self._read()
        content = _content(source)
        if self._versions and self._versions[-1][0] == content:
            return
        copied = written(source, "lookup")
        # The source may have changed while it was copied.
        self._versions.append((_content(copied), copied))
        self._current = copied
        for _, old in self._versions[: -self._kept]:
            remove(old)
        del self._versions[: -self._kept]


def _content(table: DataFrame) -> tuple:
    """Columns, rows, and two sums of row hashes: equal for equal content in any order."""
    hashes = [F.xxhash64(F.lit(seed), *table.columns).cast("decimal(20,0)") for seed in (1, 2)]
    sums = table.agg(F.count(F.lit(1)), *[F.sum(h) for h in hashes]).first()
    return (table.schema.json(), *sums)
