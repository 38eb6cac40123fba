"""Text expressions that several operators share, and the table reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run without space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text; a null one is empty."""
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def n_words(text: str | Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone, so that no other letter changes or grows."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
