"""Null-safe arithmetic and time conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def null_if_nan(value: Column) -> Column:
    """NaN means "absent" in the feeds, so it becomes null before any aggregate sees it."""
    return F.when(~F.isnan(value), value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of a division by zero."""
    return numerator / F.nullif(denominator, F.lit(0))


def seconds_to_timestamp(seconds: Column, origin: str = "1970-01-01") -> Column:
    """Simulation seconds counted from ``origin`` (the archive uses 1970, training 2017-11-30)."""
    start = F.unix_micros(F.to_timestamp(F.lit(origin)))
    return F.timestamp_micros(start + F.round(seconds * MICROS).cast("bigint"))
