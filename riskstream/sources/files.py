"""CSV in and out, with explicit types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "no value" in the CSV exports.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


# A quote inside a value is doubled, as spreadsheets and data frames write it.
_QUOTING = {"quote": '"', "escape": '"'}


def read_csv_text(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """All columns as text, absent values as null.

    Values with ``line_breaks`` need whole files read by one task each.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=line_breaks, **_QUOTING)
    return raw.select(
        *[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = False
) -> DataFrame:
    """Columns of ``schema``; unreadable values are null. Other columns of the file are dropped."""
    text = read_csv_text(spark, path, line_breaks)
    return text.select(
        *[_typed(f"`{f.name}`", f.dataType).alias(f.name) for f in schema.fields]
    )


def _typed(name: str, kind: T.DataType):
    value = F.col(name)
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.LongType, T.IntegerType)):
        # Whole numbers may be written as "10086.0".
        whole = kind.simpleString()
        return F.coalesce(value.try_cast(whole), value.try_cast("double").try_cast(whole))
    return value.try_cast(kind.simpleString())


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, **_QUOTING)
