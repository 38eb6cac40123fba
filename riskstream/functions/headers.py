"""Decode the parts of a Kafka record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds whose micros still fit a bigint.
_MAX_MILLIS = float((2**63 - 1) // 1000)


def utf8(raw: Column) -> Column:
    """Bytes to text; null stays null and malformed bytes become replacement characters."""
    return F.make_valid_utf8(raw.cast("string"))


def header(headers: Column, name: str) -> Column:
    """The last non-null header called ``name``; a repeated header overrides earlier ones."""
    present = F.filter(headers, lambda h: (h["key"] == name) & h["value"].isNotNull())
    return utf8(F.try_element_at(present, F.lit(-1))["value"])


def event_time_millis(text: Column) -> Column:
    """Event-time header in seconds to whole milliseconds, truncated toward zero.

    Null, "None" in any case, other non-numbers and non-finite numbers are null.
    """
    # Most bad values ("None", "nan") are turned away by the pattern, which costs far
    # less than a cast that fails.
    seconds = F.when(text.rlike(r"^\s*[+-]?[0-9.]"), text.try_cast("double"))
    fits = F.abs(seconds * 1000) < _MAX_MILLIS  # NaN sorts above every number
    return F.when(fits, (seconds * 1000).cast("bigint"))


def event_time(text: Column) -> Column:
    return F.timestamp_millis(event_time_millis(text))


def event_hour(time: Column) -> Column:
    """Partition value of the archive; a row without event time has a null hour."""
    return hour_text(F.unix_micros(time))


def hour_text(micros: Column) -> Column:
    """``yyyy-MM-dd-HH`` in UTC, whatever the session's time zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    text = F.timestamp_add("MICROSECOND", micros, start).cast("string")
    return F.translate(F.substring_index(text, ":", 1), " ", "-")
