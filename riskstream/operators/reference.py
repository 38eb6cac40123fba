"""Reference tables from the flat transaction feed: current state, history, fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.operators.hot import (
    MAX_ROWS_PER_TASK,
    carry_next,
    carry_previous,
    heavy_keys,
    with_slice,
)
from riskstream.operators.ids import dense_ids


def user_reference(
    tx: DataFrame,
    attributes: list[str],
    key: str = "card1",
    time: str = "us",
    row_id: str = "TransactionID",
) -> DataFrame:
    """Latest known value of each attribute per card, with dense surrogate ids.

    A null is "not reported", so each attribute keeps its last non-null value. The
    aggregate combines on the map side, so a heavy card costs no more than a light one.
    """
    position = F.struct(time, row_id)
    latest = (
        tx.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.max_by(a, F.when(F.col(a).isNotNull(), position)).alias(a) for a in attributes])
    )
    ids = dense_ids(latest, key, "user_reference_sk")
    return ids.select("user_reference_sk", key, *attributes)


def merchant_data(
    tx: DataFrame,
    key: str = "ProductCD",
    label: str = "isFraud",
    time: str = "us",
    until: int | None = None,
) -> DataFrame:
    """Mean label per product with dense surrogate ids.

    ``until`` keeps only rows up to that time, so the rate can be limited to the
    training period; by default all rows count.
    """
    rows = tx.where(F.col(key).isNotNull())
    if until is not None:
        rows = rows.where(F.col(time) <= until)
    rates = rows.groupBy(key).agg(F.avg(label).alias("fraud_rate"))
    return dense_ids(rates, key, "merchant_data_sk").select("merchant_data_sk", key, "fraud_rate")


def transaction_fact(
    tx: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    attributes: list[str],
    card: str = "card1",
    product: str = "ProductCD",
) -> DataFrame:
    """Transactions with keys into both reference tables instead of their attributes.

    Pass written tables: their size on disk decides between broadcast and shuffle,
    and a shuffle join of two plain scans is one AQE can split on a heavy card.
    """
    user_keys = users.select(card, "user_reference_sk")
    product_keys = merchants.select(product, "merchant_data_sk")
    return (
        tx.drop(*attributes).join(user_keys, card, "left").join(product_keys, product, "left")
    ).drop(product)


def change_history(
    tx: DataFrame,
    attributes: list[str],
    key: str = "card1",
    time: str = "us",
    row_id: str = "TransactionID",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """One row per state of a key, valid in ``[valid_from, valid_to)``; the last one is current.

    A null attribute is "not reported" and keeps the state it had.
    """
    rows = tx.where(F.col(key).isNotNull()).select(key, time, row_id, *attributes)
    heavy = heavy_keys(rows, key, time, max_rows)
    known = {f"_old_{a}": F.col(a) for a in attributes}
    order = [time, row_id]
    filled = carry_previous(with_slice(rows, key, order, heavy), key, order, known, heavy)
    new = {f"_new_{a}": F.coalesce(F.col(a), F.col(f"_old_{a}")) for a in attributes}
    before = F.struct(*[F.col(f"_old_{a}").alias(a) for a in attributes])
    after = F.struct(*[F.col(f"_new_{a}").alias(a) for a in attributes])
    changes = filled.withColumns(new).where(~before.eqNullSafe(after))
    return carry_next(changes, key, order, time, "valid_to", heavy).select(
        key,
        *[F.col(f"_new_{a}").alias(a) for a in attributes],
        F.col(time).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
