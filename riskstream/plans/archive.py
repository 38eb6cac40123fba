"""Queries over the raw archive, typed rows and schemas."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.functions.headers import event_time_millis, header
from riskstream.operators import schema_audit, silver
from riskstream.operators.quality import duplicates
from riskstream import schemas
from riskstream.plans import inputs
from riskstream.plans.inputs import Query, rounded, sql, sql_rounded
from riskstream.session import shared_dir
from riskstream.sources import files, tables
from riskstream.sources.ledger import STORED
from riskstream.sources.sketches import HourSketches
from riskstream.streaming.archive import append_new


def _new_path(spark, name: str) -> str:
    return f"{shared_dir(spark)}/riskstream/{name}-{uuid.uuid4().hex}"


def bronze_projection(spark, folder):
    rows = inputs.bronze(spark, folder)
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("event_time", "ingest_time")}
    )


_BRONZE_SQL = """select kafka_key, kafka_value, kafka_topic, kafka_partition, kafka_offset,
  make_timestamp(event_ms * 1000) as event_time, cast(ingest_time as timestamp) as ingest_time,
  source_service, run_id, schema_version from msgs"""


def event_time_parse(spark, folder):
    text = header(F.col("headers"), "event-time")
    return inputs.kafka_records(spark, folder).select(
        "offset", text.alias("header_text"), event_time_millis(text).alias("event_ms")
    )


def header_extract(spark, folder):
    return inputs.kafka_records(spark, folder).select(
        "offset",
        *[
            header(F.col("headers"), n).alias(n.replace("-", "_"))
            for n in ("source-service", "run-id", "schema-version")
        ],
    )


def bronze_hourly_counts(spark, folder):
    """Rows per hour partition of an archive written and read back as a table."""
    path = _new_path(spark, "archive")
    name = f"archive_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.ensure_table(spark, name, path, STORED, "event_hour, commit")
    append_new(inputs.bronze(spark, folder), path, 0, table=name)
    return tables.hourly_counts(spark.table(name))


def archive_replay(spark, folder):
    """Offsets written in two batches, then all replayed: every one is there once."""
    path = _new_path(spark, "archive")
    rows = inputs.bronze(spark, folder)
    append_new(rows.where("kafka_offset % 2 = 0"), path, 0)
    append_new(rows, path, 1)
    append_new(rows, path, 2)
    stored = tables.read_archive(spark, path)
    return stored.groupBy("kafka_partition", "batch_id").agg(F.count(F.lit(1)).alias("n"))


def archive_as_of(spark, folder):
    """What an audit sees as of the first batch."""
    path = _new_path(spark, "archive")
    rows = inputs.bronze(spark, folder)
    append_new(rows.where("kafka_offset % 2 = 0"), path, 0)
    append_new(rows, path, 1)
    stored = tables.read_archive(spark, path, batch_id=0)
    return stored.select("kafka_topic", "kafka_partition", "kafka_offset", "kafka_key")


def archive_time_range(spark, folder):
    path = _new_path(spark, "archive")
    append_new(inputs.bronze(spark, folder), path, 0)
    stored = tables.read_archive(spark, path, "1970-01-01 06:30:00", "1970-01-02 00:00:00")
    return stored.select("kafka_offset", F.col("event_time").cast("timestamp_ntz"))


def archive_compaction(spark, folder):
    """Rows per hour after two batches were compacted."""
    path = _new_path(spark, "archive")
    rows = inputs.bronze(spark, folder)
    append_new(rows.where("kafka_offset % 2 = 0"), path, 0)
    append_new(rows, path, 1)
    tables.compact(spark, path, rows_per_file=1_000)
    stored = tables.read_archive(spark, path)
    keys = F.count_distinct(*schemas.BRONZE_KEY)
    return stored.groupBy("event_hour").agg(F.count(F.lit(1)).alias("n"), keys.alias("n_keys"))


def archive_time_quantiles(spark, folder):
    """Event times by share of the rows: the sketches of the hours, then one scan of the archive."""
    path = _new_path(spark, "archive")
    rows = inputs.bronze(spark, folder)
    append_new(rows.where("kafka_offset % 2 = 0"), path, 0)
    sketches = HourSketches(spark, path)
    sketches.refresh()
    append_new(rows, path, 1)
    tables.compact(spark, path, closed_before="1970-01-02-00")
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    found = zip(shares, sketches.quantiles(shares, max_rows=500))
    lines = [(share, None if at is None else math.floor(at + 0.5)) for share, at in found]
    return spark.createDataFrame(lines, "share double, event_ms long")


_HOUR_SQL = "strftime(make_timestamp(event_ms * 1000), '%Y-%m-%d-%H')"

_PAYLOAD = T.StructType(
    [
        T.StructField("TransactionID", T.LongType(), False),
        T.StructField("TransactionDT", T.DoubleType(), False),
        T.StructField("isFraud", T.DoubleType()),
        T.StructField("TransactionAmt", T.DoubleType()),
        T.StructField("card1", T.DoubleType()),
        T.StructField("M1", T.StringType()),
    ]
)


def silver_parse(spark, folder):
    typed = silver.parse(inputs.bronze(spark, folder), _PAYLOAD)
    return typed.select(
        "kafka_offset",
        "TransactionID",
        rounded("TransactionDT").alias("TransactionDT"),
        "isFraud",
        "TransactionAmt",
        "card1",
        "M1",
        "valid",
    )


def _json_number(name: str) -> str:
    return (
        f"coalesce(try_cast(json_extract_string(v, '$.{name}.double') as double), "
        f"try_cast(json_extract_string(v, '$.{name}') as double))"
    )


_SILVER_SQL = f"""select kafka_offset,
  try_cast(json_extract_string(v, '$.TransactionID') as bigint) as TransactionID,
  {sql_rounded("try_cast(json_extract_string(v, '$.TransactionDT') as double)")} as TransactionDT,
  {_json_number("isFraud")} as isFraud, {_json_number("TransactionAmt")} as TransactionAmt,
  {_json_number("card1")} as card1,
  coalesce(json_extract_string(v, '$.M1.string'), json_extract_string(v, '$.M1')) as M1,
  coalesce(json_exists(v, '$.TransactionID') and json_exists(v, '$.TransactionDT'), false) as valid
from (select kafka_offset, case when json_valid(kafka_value) then kafka_value end as v from msgs)"""


def mixed_version_read(spark, folder):
    """Every record read by the schema its header names, under one schema."""

    def fields(*names: str) -> T.StructType:
        return T.StructType([_PAYLOAD[n] for n in names])

    versions = {
        "0": _PAYLOAD,
        "1": fields("M1", "card1", "TransactionID", "TransactionAmt"),
        "2": fields("TransactionID", "TransactionAmt", "card1"),
        "3": fields("TransactionID", "TransactionDT", "M1"),
    }
    rows = silver.parse_versions(inputs.bronze(spark, folder), versions, default="0")
    return rows.select(
        "kafka_offset", "schema_version", "TransactionID", "TransactionAmt", "card1", "M1",
        "isFraud", "valid",
    )


def _where_version(*versions: str) -> str:
    return f"coalesce(schema_version, '0') in ({', '.join(repr(v) for v in versions)})"


_MIXED_SQL = f"""select kafka_offset, schema_version,
  try_cast(json_extract_string(v, '$.TransactionID') as bigint) as TransactionID,
  case when {_where_version("0", "1", "2")} then {_json_number("TransactionAmt")} end
    as TransactionAmt,
  case when {_where_version("0", "1", "2")} then {_json_number("card1")} end as card1,
  case when {_where_version("0", "1", "3")} then coalesce(json_extract_string(v, '$.M1.string'),
    json_extract_string(v, '$.M1')) end as M1,
  case when {_where_version("0")} then {_json_number("isFraud")} end as isFraud,
  coalesce(json_exists(v, '$.TransactionID')
    and ({_where_version("1", "2")} or json_exists(v, '$.TransactionDT')), false) as valid
from (select kafka_offset, schema_version, case when json_valid(kafka_value) then kafka_value end
  as v from msgs)"""


def _as_text(spark, folder):
    rows = inputs.tx(spark, folder).drop("us").withColumn("M4", F.lit(None).cast("string"))
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


_TEXT_COLUMNS = [*[c for c in inputs._TX if c != "us"], "M4"]


def schema_profile(spark, folder):
    return schema_audit.profile(
        _as_text(spark, folder),
        required=["TransactionID"],
        overrides={"TransactionID": "long"},
    )


def _profile_sql() -> str:
    def one(position: int, name: str) -> str:
        kind = "'long'" if name == "TransactionID" else (
            f"case when count(try_cast({name} as double)) = count({name}) "
            "then 'double' else 'string' end"
        )
        return (
            f"select cast({position} as bigint) as position, '{name}' as field, {kind} as type, "
            f"{name != 'TransactionID'} as nullable, count({name}) as n_values, "
            f"count(*) - count({name}) as n_nulls from text_rows"
        )

    return " union all ".join(one(i, n) for i, n in enumerate(_TEXT_COLUMNS))


_TEXT_SQL = (
    "text_rows as (select "
    + ", ".join(f"cast({c} as varchar) as {c}" for c in _TEXT_COLUMNS if c != "M4")
    + ", cast(null as varchar) as M4 from tx)"
)


def csv_round_trip(spark, folder):
    """Transactions written as CSV and read back with explicit types."""
    path = _new_path(spark, "csv")
    rows = inputs.tx(spark, folder).select(
        "TransactionID", "card1", "TransactionAmt", "card4", F.expr(_ODD_TEXT).alias("note")
    )
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema, line_breaks=True)


# Quotes, commas and line breaks inside a value.
_ODD_TEXT = """case TransactionID % 5 when 0 then concat('say "', coalesce(card4, '?'), '", then, stop')
  when 1 then concat('two', chr(10), 'lines') when 2 then '"' when 3 then 'a,b' else card4 end"""


_PROPOSED = [
    schema_audit.ProposedField("TransactionID", "long", nullable=False, has_default=False),
    schema_audit.ProposedField("TransactionDT", nullable=False, has_default=False),
    schema_audit.ProposedField("TransactionAmt"),
    schema_audit.ProposedField("isFraud", "long"),
    schema_audit.ProposedField("card1", nullable=False),
    schema_audit.ProposedField("M1", "string", has_default=False),
    schema_audit.ProposedField("riskScore", has_default=False),
]


def schema_drift_audit(spark, folder):
    return schema_audit.drift(inputs.bronze(spark, folder), _PROPOSED)


def _drift_sql() -> str:
    def one(field: schema_audit.ProposedField) -> str:
        path = f"'$.{field.name}'"
        absent = f"not coalesce(json_exists(v, {path}), false)"
        missing = "0" if field.has_default else f"count(*) filter ({absent})"
        empty = "0" if field.nullable else f"count(*) filter (json_type(v, {path}) = 'NULL')"
        content = (
            f"coalesce(json_extract_string(v, '$.{field.name}.double'), "
            f"json_extract_string(v, {path}))"
        )
        # Text such as '1.0' is not a whole number.
        fits = {
            "double": f"try_cast({content} as double) is not null",
            "long": f"regexp_full_match({content}, '[+-]?[0-9]+')",
            "string": "true",
        }[field.type]
        wrong = f"count(*) filter ({content} is not null and not {fits})"
        return (
            f"select schema_version, '{field.name}' as field, count(*) as n_rows, "
            f"cast({missing} as bigint) as n_missing, cast({empty} as bigint) as n_null, "
            f"cast({wrong} as bigint) as n_mistyped from readable_rows group by schema_version"
        )

    union = " union all ".join(one(f) for f in _PROPOSED)
    return f"select *, n_missing + n_null + n_mistyped = 0 as readable from ({union})"


_READABLE_SQL = """readable_rows as (select schema_version,
  case when json_valid(kafka_value) then kafka_value end as v
  from msgs where kafka_value is not null)"""


def pk_duplicates(spark, folder):
    rows = inputs.bronze(spark, folder)
    return duplicates(rows.union(rows.where("kafka_offset % 10 = 0")), schemas.BRONZE_KEY)


QUERIES = {
    "bronze_projection": Query(bronze_projection, sql(_BRONZE_SQL, "msgs")),
    "event_time_parse": Query(
        event_time_parse,
        sql('select kafka_offset as "offset", time_text as header_text, event_ms from msgs', "msgs"),
    ),
    "header_extract": Query(
        header_extract,
        sql(
            'select kafka_offset as "offset", source_service, run_id, schema_version from msgs',
            "msgs",
        ),
    ),
    "bronze_hourly_counts": Query(
        bronze_hourly_counts,
        sql(f"select {_HOUR_SQL} as event_hour, count(*) as n from msgs group by 1", "msgs"),
    ),
    "archive_replay": Query(
        archive_replay,
        sql(
            """select kafka_partition, kafka_offset % 2 as batch_id, count(*) as n
            from msgs group by all""",
            "msgs",
        ),
    ),
    "archive_as_of": Query(
        archive_as_of,
        sql(
            """select kafka_topic, kafka_partition, kafka_offset, kafka_key from msgs
            where kafka_offset % 2 = 0""",
            "msgs",
        ),
    ),
    "archive_time_range": Query(
        archive_time_range,
        sql(
            """select kafka_offset, make_timestamp(event_ms * 1000) as event_time from msgs
            where make_timestamp(event_ms * 1000) >= timestamp '1970-01-01 06:30:00'
              and make_timestamp(event_ms * 1000) < timestamp '1970-01-02 00:00:00'""",
            "msgs",
        ),
    ),
    "archive_compaction": Query(
        archive_compaction,
        sql(
            f"""select {_HOUR_SQL} as event_hour, count(*) as n,
            count(distinct kafka_offset) as n_keys from msgs group by 1""",
            "msgs",
        ),
    ),
    "archive_time_quantiles": Query(
        archive_time_quantiles,
        sql(
            """select cast(share as double) as share,
              cast(floor(ms + 0.5) as bigint) as event_ms
            from (select unnest([0.01, 0.25, 0.5, 0.75, 0.99]) as share,
              unnest(quantile_cont(event_ms, [0.01, 0.25, 0.5, 0.75, 0.99])) as ms from msgs)""",
            "msgs",
        ),
    ),
    "silver_parse": Query(silver_parse, sql(_SILVER_SQL, "msgs")),
    "mixed_version_read": Query(mixed_version_read, sql(_MIXED_SQL, "msgs")),
    "schema_profile": Query(schema_profile, sql(_profile_sql(), "tx", extra=_TEXT_SQL)),
    "csv_round_trip": Query(
        csv_round_trip, sql(
            f"select TransactionID, card1, TransactionAmt, card4, {_ODD_TEXT} as note from tx", "tx"
        )
    ),
    "schema_drift_audit": Query(
        schema_drift_audit, sql(_drift_sql(), "msgs", extra=_READABLE_SQL)
    ),
    "pk_duplicates": Query(
        pk_duplicates,
        sql(
            """select kafka_topic, kafka_partition, kafka_offset, count(*) as n
            from (select * from msgs union all select * from msgs where kafka_offset % 10 = 0)
            group by all having count(*) > 1""",
            "msgs",
        ),
    ),
}
