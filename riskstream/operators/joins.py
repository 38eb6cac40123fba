"""Joins: lookups, watchlists, time ranges, state as of a time.

Nothing here hints a broadcast. Lookup tables are written tables, so Spark knows
their size, broadcasts the small ones, and shuffles the others with AQE free to
split a heavy key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskstream.functions.scalars import MICROS
from riskstream.operators.hot import (
    MAX_ROWS_PER_TASK,
    carry_previous,
    heavy_keys,
    with_slice,
)


def join_identity(tx: DataFrame, identities: DataFrame, on: str = "TransactionID") -> DataFrame:
    """Every transaction with its identity, if it has one."""
    return tx.join(identities, on, "left")


def key_identities(
    identities: DataFrame, tx: DataFrame, on: str = "TransactionID", time: str = "us"
) -> DataFrame:
    """Every identity with time and card of its transaction, in time order.

    Identities without a transaction are kept and come last.
    """
    reference = tx.select(on, time, "card1")
    return identities.join(reference, on, "left").orderBy(F.col(time).asc_nulls_last(), on)


def join_within(
    tx: DataFrame,
    identities: DataFrame,
    before_seconds: int,
    after_seconds: int,
    on: str = "TransactionID",
    time: str = "us",
    identity_time: str = "identity_us",
) -> DataFrame:
    """Transactions with the identities that arrive near them in event time."""
    near = F.col(identity_time).between(
        F.col(time) - before_seconds * MICROS, F.col(time) + after_seconds * MICROS
    )
    other = identities.withColumnRenamed(on, "_id")
    return tx.join(other, (F.col(on) == F.col("_id")) & near, "left").drop("_id")


def enrich(
    events: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    card: str = "card1",
    product: str = "ProductCD",
) -> DataFrame:
    """Add user attributes and merchant risk; unknown cards and products get nulls."""
    return events.join(users, card, "left").join(merchants, product, "left")


def _values(watchlist: DataFrame, kind: str) -> DataFrame:
    return watchlist.where(F.col("kind") == kind).select(F.col("value").alias("_listed")).distinct()


def flag_watchlist(events: DataFrame, watchlist: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """One boolean per kind, ``on_<kind>_list``, from the event's value for that kind."""
    for kind, value in kinds.items():
        listed = _values(watchlist, kind)
        events = (
            events.join(listed, value == F.col("_listed"), "left")
            .withColumn(f"on_{kind}_list", F.col("_listed").isNotNull())
            .drop("_listed")
        )
    return events


def only_listed(events: DataFrame, watchlist: DataFrame, kind: str, value: Column) -> DataFrame:
    return events.join(_values(watchlist, kind), value == F.col("_listed"), "left_semi")


def not_listed(events: DataFrame, watchlist: DataFrame, kind: str, value: Column) -> DataFrame:
    return events.join(_values(watchlist, kind), value == F.col("_listed"), "left_anti")


def as_of(
    events: DataFrame,
    history: DataFrame,
    key: str = "card1",
    time: str = "us",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Each event with the state of its key that was valid at its time.

    An equality join on the key would pair every event with every version before
    dropping most pairs. Here events and versions are merged in time order and the
    newest version is carried forward, so the work is linear in both.
    """
    versions = [c for c in history.columns if c != key]
    left = events.select(
        key,
        F.col(time).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*[c for c in events.columns if c != key]).alias("_event"),
    )
    right = history.where(F.col(key).isNotNull()).select(
        key,
        F.col("valid_from").alias("_t"),
        F.lit(0).alias("_side"),
        F.coalesce("valid_to", F.lit(2**63 - 1)).alias("_end"),
        F.struct(*versions).alias("_version"),
    )
    both = left.unionByName(right, allowMissingColumns=True)
    heavy = heavy_keys(both, key, "_t", max_rows)
    # A version starts before an event at the same time; of versions, the shortest comes first.
    order = ["_t", "_side", "_end"]
    state = {"_state": F.col("_version")}
    merged = carry_previous(with_slice(both, key, order, heavy), key, order, state, heavy)
    current = F.coalesce(F.col("_state.valid_to"), F.lit(2**63 - 1)) > F.col("_t")
    return merged.where(F.col("_side") == 1).select(
        key,
        "_event.*",
        *[F.when(current, F.col(f"_state.{c}")).alias(c) for c in versions],
    )
