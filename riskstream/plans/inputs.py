"""The engine's inputs, derived from the ``events`` table, in Spark and as SQL.

Expressions written once as text mean the same in both engines. They add what the
table lacks: nulls, a key with a third of all rows, salted keys, late and missing
identities, odd headers, and records of several schema versions.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.operators.bronze import to_bronze
from riskstream.session import use_utc


class Query(NamedTuple):
    """A query over the tables in a folder, and the SQL it must agree with."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def rounded(value: Column | str) -> Column:
    """Six decimals by the same arithmetic in both engines; ties always go up."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * 1e6 + 0.5001) / 1e6


def sql_rounded(value: str) -> str:
    return f"floor(({value}) * 1e6 + 0.5001) / 1e6"


def events(spark: SparkSession, folder: str) -> DataFrame:
    use_utc(spark)
    rows = spark.read.parquet(f"{folder}/events.parquet")
    return rows.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )


_EVENTS_SQL = """ev as (
  select *, epoch_us(ts) as us, cast(json_extract_string(props, '$.k') as int) as k from events)"""

# Transactions. A card or an amount is missing now and then.
_HOT_USER = "case when event_id % 3 = 0 then 3 else user_id end"
_TX = {
    "TransactionID": "event_id",
    "us": "us",
    "card1": "case when event_id % 97 = 0 then null else {user} end",
    "TransactionAmt": "case when event_id % 89 = 0 then null else value end",
    "ProductCD": "event_type",
    "k": "k",
    "isFraud": "cast(case when k % 10 = 0 then 1 else 0 end as int)",
    "card4": "case when event_id % 3 = 0 then null else concat('b', cast(k % 4 as string)) end",
    "card2": "case when event_id % 7 = 0 then cast(k % 13 as double) else null end",
}


def tx(spark: SparkSession, folder: str, hot: bool = False) -> DataFrame:
    """Transactions; with ``hot`` one card makes a third of them."""
    user = _HOT_USER if hot else "user_id"
    return events(spark, folder).select(
        *[F.expr(text.format(user=user)).alias(name) for name, text in _TX.items()]
    )


def _tx_sql(name: str, user: str) -> str:
    columns = ", ".join(f"{text.format(user=user)} as {column}" for column, text in _TX.items())
    return f"{name} as (select {columns}, ts from ev)"


# Identities of every fourth transaction, up to 30 s early or late, and some without one.
_IDENT = {
    "TransactionID": "TransactionID",
    "identity_us": "us + ((TransactionID % 61) - 30) * 1000000",
    "id_01": "k",
    "DeviceInfo": "concat('dev', cast(k % 20 as string))",
}
_ORPHAN = {
    "TransactionID": "TransactionID + 100000000",
    "identity_us": "us",
    "id_01": "k",
    "DeviceInfo": "'orphan'",
}


def identities(spark: SparkSession, folder: str) -> DataFrame:
    rows = tx(spark, folder)
    matched = rows.where("TransactionID % 4 = 0").selectExpr(*_named(_IDENT))
    orphans = rows.where("TransactionID % 101 = 0").selectExpr(*_named(_ORPHAN))
    return matched.union(orphans)


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in columns.items()]


_IDENT_SQL = (
    f"ident as (select {", ".join(_named(_IDENT))} from tx where TransactionID % 4 = 0 "
    f"union all select {", ".join(_named(_ORPHAN))} from tx where TransactionID % 101 = 0)"
)

# Kafka records. One card makes a fifth of them; cards ending in 3 arrive salted; one
# partition fell quiet two months ago. The event-time header carries a simulation clock
# that starts at 0 and runs slow. Every fourth record wraps its nullable fields with
# their type name; others lack the time or the mark, or hold text for a number.


def _decimal(whole: str, part: str, digits: int) -> str:
    return f"concat(cast({whole} as string), '.', lpad(cast({part} as string), {digits}, '0'))"


def _bigint(value: str) -> str:
    return f"cast(floor({value}) as bigint)"


_PIECES = {
    "holder": "case when event_id % 5 = 0 then 3 else user_id end",
    "id": "cast(event_id as string)",
    "seconds": _decimal(_bigint("us / 1000000"), _bigint("(us % 1000000) / 1000"), 3),
    "sim": _bigint("(us - 1704067200000000) / 24"),
    "cents": _bigint("value * 100 + 0.5"),
    "open_": """case when event_id % 4 = 0 then '{"double":' else '' end""",
    "close_": "case when event_id % 4 = 0 then '}' else '' end",
    "flag": "case when k % 10 = 0 then '1.0' else '0.0' end",
    "letter": "case when k % 2 = 0 then 'T' else 'F' end",
    "no_card": "event_id % 97 = 0",
}
_PAYLOAD = (
    """concat('{"TransactionID":', id, """
    """case when event_id % 4 = 3 then '' else concat(',"TransactionDT":', seconds) end, """
    """',"isFraud":', open_, flag, close_, ',"TransactionAmt":', """
    """case when event_id % 89 = 0 then 'null' when event_id % 8 = 7 then '"n/a"' else """
    f"concat(open_, {_decimal(_bigint('cents / 100'), 'cents % 100', 2)}, close_) end, "
    """',"card1":', case when no_card then 'null' """
    """else concat(open_, cast(holder as string), '.0', close_) end, """
    """case event_id % 4 when 0 then concat(',"M1":{"string":"', letter, '"}') """
    """when 2 then '' else concat(',"M1":"', letter, '"') end, '}')"""
)
_MSG = {
    "kafka_key": (
        "case when no_card then id when holder % 10 = 3 "
        "then concat(cast(holder as string), '-', cast(event_id % 4 as string)) "
        "else cast(holder as string) end"
    ),
    "kafka_value": (
        "case when event_id % 83 = 0 then null when event_id % 79 = 0 then '{\"Trans' "
        f"else {_PAYLOAD} end"
    ),
    "kafka_topic": "'transactions.raw'",
    "kafka_partition": "cast(holder % 12 as int)",
    "kafka_offset": "event_id",
    "time_text": (
        "case event_id % 11 when 0 then 'None' when 1 then 'none' when 2 then 'abc' "
        "when 3 then 'nan' when 4 then '-1.9995' when 5 then null when 6 then null else "
        + _decimal(_bigint("sim / 1000000"), _bigint("(sim % 1000000) / 1000"), 3)
        + " end"
    ),
    "source_service": "'payment-gateway'",
    "run_id": "concat('run-', cast(event_id % 3 as string))",
    "schema_version": "case when event_id % 7 = 0 then null else cast(event_id % 4 as string) end",
}
_INGEST = "ts - case when kafka_partition = 7 then interval {days} else interval {zero} end"


def kafka_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records as the Kafka source returns them."""
    pieces = events(spark, folder).selectExpr("*", *_named(_PIECES))
    flat = pieces.selectExpr("event_id", "ts", *_named(_MSG))
    ingest = F.expr(_INGEST.format(days="'60' day", zero="'0' day")).cast("timestamp")

    def head(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))

    sent = F.array(
        head("source-service", F.col("source_service")),
        head("run-id", F.lit("run-of-an-earlier-try")),
        head("run-id", F.col("run_id")),
        head("run-id", F.lit(None).cast("string")),
        head("schema-version", F.col("schema_version")),
        head("event-time", F.col("time_text")),
    )
    # Every eleventh record has no event-time header at all.
    headers = F.when(F.col("event_id") % 11 == 6, F.slice(sent, 1, 5)).otherwise(sent)
    return flat.select(
        F.col("kafka_key").cast("binary").alias("key"),
        F.col("kafka_value").cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        ingest.alias("timestamp"),
        headers.cast(schemas.HEADERS).alias("headers"),
    )


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Archive rows; the broker's time stands in for the processing time."""
    records = kafka_records(spark, folder)
    return to_bronze(records, ingest_time=F.col("timestamp"))


_MSG_SQL = (
    "msgs as (select *, "
    + _INGEST.format(days="60 day", zero="0 day")
    + """ as ingest_time,
  case when abs(try_cast(time_text as double) * 1000) < 9223372036854775
       then cast(trunc(try_cast(time_text as double) * 1000) as bigint) end as event_ms
  from (select ts, """
    + ", ".join(_named(_MSG))
    + " from (select *, "
    + ", ".join(_named(_PIECES))
    + " from ev)))"
)


def watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """Some accounts and one device."""
    cards = (
        events(spark, folder)
        .where("user_id % 50 = 7")
        .select(F.lit("account").alias("kind"), F.col("user_id").cast("string").alias("value"))
        .distinct()
    )
    device = spark.range(1).select(F.lit("device").alias("kind"), F.lit("dev3").alias("value"))
    return cards.union(device)


_WATCHLIST_SQL = """watchlist as (
  select distinct 'account' as kind, cast(user_id as varchar) as value
  from events where user_id % 50 = 7
  union all select 'device', 'dev3')"""


def tracked_keys(spark: SparkSession) -> DataFrame:
    """The tracked hot keys before a scan."""
    return spark.range(1).select(F.explode(F.array(F.lit("3"), F.lit("7"))).alias("key"))


_TRACKED_SQL = "tracked as (select unnest(['3', '7']) as key)"

_PARTS = {
    "ev": _EVENTS_SQL,
    "tx": _tx_sql("tx", "user_id"),
    "tx_hot": _tx_sql("tx_hot", _HOT_USER),
    "ident": _IDENT_SQL,
    "msgs": _MSG_SQL,
    "watchlist": _WATCHLIST_SQL,
    "tracked": _TRACKED_SQL,
}
_NEEDS = {"ident": ["tx"]}


def sql(query: str, *inputs: str, extra: str = "") -> str:
    """``query`` with the named inputs (and ``extra`` tables) before it."""
    names = ["ev"]
    for name in inputs:
        names += [n for n in _NEEDS.get(name, []) + [name] if n not in names]
    tables = [_PARTS[n] for n in names] + ([extra] if extra else [])
    return "with " + ",\n".join(tables) + "\n" + query
