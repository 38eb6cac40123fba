"""Queries over operational checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskstream.operators import quality
from riskstream.plans import inputs
from riskstream.plans.inputs import Query, rounded, sql, sql_rounded

_DECISION = "case when k >= 95 then 'block' when k >= 70 then 'flag' else 'allow' end"
_DECIDED = "us + TransactionID * 7919 % 180000"
_AVAILABLE = "us + TransactionID * 104729 % 9000000"
_ARCHIVED = "kafka_offset % 1000 < 900 and kafka_partition != 11"


def partition_skew(spark, folder):
    rows = quality.partition_skew(inputs.bronze(spark, folder))
    return rows.withColumns({c: rounded(c) for c in ("avg_size", "size_ratio")})


_SKEW_SQL = f"""select kafka_topic, minute, cast(max_size as bigint) as max_size,
  {sql_rounded('avg_size')} as avg_size, {sql_rounded('max_size / avg_size')} as size_ratio,
  held as held_minutes, max_size / avg_size > 1.5 and held >= 5 as alert
from (
  select *, case when max_size / avg_size > 1.5 then minute - min(minute) over (
      partition by kafka_topic, fine order by minute) else 0 end as held
  from (
    select *, max(case when max_size / avg_size <= 1.5 then minute end) over (
        partition by kafka_topic order by minute) as fine_row,
      sum(case when max_size / avg_size <= 1.5 then 1 else 0 end) over (
        partition by kafka_topic order by minute)
        + case when max_size / avg_size <= 1.5 then -0.5 else 0 end as fine
    from (
      select kafka_topic, minute, max(top) over (partition by kafka_topic order by minute)
          as max_size,
        sum(bytes) over (partition by kafka_topic order by minute) / parts as avg_size
      from (
        select kafka_topic, minute, max(size) as top, sum(bytes) as bytes from (
          select *, sum(bytes) over (partition by kafka_partition order by minute) as size from (
            select kafka_topic, kafka_partition, epoch_us(ingest_time) // 60000000 as minute,
              sum(coalesce(strlen(kafka_key), 0) + coalesce(strlen(kafka_value), 0)) as bytes
            from msgs group by all))
        group by all),
        (select count(distinct kafka_partition) as parts from msgs))))"""


def latency_summary(spark, folder):
    rows = inputs.tx(spark, folder).selectExpr(
        f"{_DECISION} as decision", "us", f"{_DECIDED} as decided_us"
    )
    summary = quality.latency_summary(rows, "us", "decided_us")
    return summary.withColumns({c: rounded(c) for c in ("avg_ms", "p99_ms")})


def freshness_lag(spark, folder):
    rows = inputs.tx(spark, folder).selectExpr("us", f"{_AVAILABLE} as available_us")
    lag = quality.freshness_lag(rows, "us", "available_us", window_seconds=86_400)
    return lag.withColumns({c: rounded(c) for c in ("avg_ms", "p99_ms")})


def throughput(spark, folder):
    rows = inputs.bronze(spark, folder).withColumn("us", F.unix_micros("ingest_time"))
    return quality.throughput(rows, "us").withColumn("rows_per_second", rounded("rows_per_second"))


def offset_lag(spark, folder):
    rows = inputs.bronze(spark, folder)
    return quality.offset_lag(rows, rows.where(_ARCHIVED))


QUERIES = {
    "partition_skew": Query(partition_skew, sql(_SKEW_SQL, "msgs")),
    "latency_summary": Query(
        latency_summary,
        sql(
            f"""select decision, count(*) as n, {sql_rounded('avg(ms)')} as avg_ms,
              {sql_rounded('quantile_cont(ms, 0.99)')} as p99_ms, max(ms) as max_ms
            from (select {_DECISION} as decision, ({_DECIDED} - us) // 1000 as ms from tx)
            group by decision""",
            "tx",
        ),
    ),
    "freshness_lag": Query(
        freshness_lag,
        sql(
            f"""select at_us - at_us % 86400000000 as window_start_us, count(*) as n,
              {sql_rounded('avg(ms)')} as avg_ms,
              {sql_rounded('quantile_cont(ms, 0.99)')} as p99_ms, max(ms) as max_ms,
              max(ms) > 5000 as breach
            from (select {_AVAILABLE} as at_us, ({_AVAILABLE} - us) // 1000 as ms from tx)
            group by 1""",
            "tx",
        ),
    ),
    "throughput_lag": Query(
        throughput,
        sql(
            f"""select kafka_topic, us - us % 600000000 as window_start_us, count(*) as n,
              {sql_rounded('count(*) / 600')} as rows_per_second
            from (select kafka_topic, epoch_us(ingest_time) as us from msgs) group by 1, 2""",
            "msgs",
        ),
    ),
    "offset_lag": Query(
        offset_lag,
        sql(
            f"""select kafka_topic, kafka_partition, produced_offset, archived_offset,
              produced_offset - coalesce(archived_offset, first_offset - 1) as offset_lag
            from (select kafka_topic, kafka_partition, max(kafka_offset) as produced_offset,
                    min(kafka_offset) as first_offset,
                    max(kafka_offset) filter ({_ARCHIVED}) as archived_offset
                  from msgs group by 1, 2)""",
            "msgs",
        ),
    ),
}
