"""Partition keys: salt, strip, fall back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_BUCKETS = 4


def card_text(card: Column) -> Column:
    """A card number as key text: always the whole number, never "10086.0"."""
    return card.cast("bigint").cast("string")


def strip_salt(key: Column) -> Column:
    """Drop one trailing ``-digits``."""
    return F.regexp_replace(key, "-[0-9]+$", "")


def replayable_bucket(row_id: Column, buckets: int = SALT_BUCKETS) -> Column:
    """A uniform bucket that is the same on every replay of the row."""
    return F.pmod(F.xxhash64(row_id), F.lit(buckets))


def salt_keys(df: DataFrame, key: str, hot: DataFrame, bucket: Column, out: str) -> DataFrame:
    """Spread tracked keys over buckets; all other keys pass unchanged.

    ``hot`` is the tracked-key table (column ``key``). It is joined, not
    collected, and Spark broadcasts it when its size on disk allows.
    """
    tracked = hot.select(F.col("key").alias("_hot")).distinct()
    salted = F.concat(F.col(key), F.lit("-"), bucket.cast("string"))
    return (
        df.join(tracked, F.col(key) == F.col("_hot"), "left")
        .withColumn(out, F.when(F.col("_hot").isNotNull(), salted).otherwise(F.col(key)))
        .drop("_hot")
    )


def partition_key(salted: Column, transaction_id: Column) -> Column:
    """The record key: the (salted) card, else the transaction id, which is never salted."""
    return F.coalesce(salted, transaction_id.cast("string"))
