"""Queries over partition keys and hot-key management."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskstream.functions import keys as key_columns
from riskstream.operators import hotkeys
from riskstream.plans import inputs
from riskstream.plans.inputs import Query, rounded, sql, sql_rounded

_AS_OF, _EARLIER = "2024-01-20 00:00:00", "2024-01-12 00:00:00"
_DAYS = 5
_PARTITION_SHARE = 0.09


def _sample(spark, folder, as_of: str = _AS_OF, **limits):
    clock = F.lit(as_of).cast("timestamp")
    return hotkeys.recent(inputs.bronze(spark, folder), clock, _DAYS * 86_400, **limits)


def _sample_sql(as_of: str = _AS_OF, limit: str | None = None, name: str = "sample") -> str:
    """The scan window by arg: seen rows, bounds per partition, rows from the start offset."""
    start = f"greatest(coalesce(first, low), high - {limit})" if limit else "coalesce(first, low)"
    return f"""{name}_seen as (select * from msgs where ingest_time <= timestamp '{as_of}'),
{name}_bounds as (
  select kafka_partition, min(kafka_offset) as low, max(kafka_offset) + 1 as high,
    min(kafka_offset) filter (ingest_time >= timestamp '{as_of}' - interval {_DAYS} day) as first,
    count(*) over () as parts
  from {name}_seen group by kafka_partition),
{name} as (
  select s.*, regexp_replace(kafka_key, '-[0-9]+$', '') as key
  from {name}_seen s join {name}_bounds b using (kafka_partition)
  where kafka_offset >= {start})"""


_PART = "kafka_topic, kafka_partition"
_SHARES_SQL = f"""shares as (
  select {_PART}, key, n, sum(n) over (partition by kafka_partition) as total,
    n / sum(n) over (partition by kafka_partition) as share
  from (select {_PART}, key, count(*) as n from sample group by all))"""
_HEAVY_SQL = f"heavy as (select * from shares where share > {_PARTITION_SHARE})"
_COOLED_SQL = """cooled as (
  select t.key, coalesce(c.n, 0) as n, s.total, coalesce(c.n, 0) / s.total as share
  from tracked t left join (select key, count(*) as n from sample group by key) c using (key),
    (select count(*) as total from sample) s
  where coalesce(c.n, 0) / s.total < 0.02)"""


def strip_salt(spark, folder):
    rows = inputs.bronze(spark, folder)
    return rows.select(
        "kafka_offset", key_columns.strip_salt(F.col("kafka_key")).alias("raw_key")
    )


def salt_keys(spark, folder):
    rows = inputs.tx(spark, folder)
    keyed = rows.select("TransactionID", key_columns.card_text(F.col("card1")).alias("raw_key"))
    bucket = F.pmod("TransactionID", F.lit(key_columns.SALT_BUCKETS))
    return key_columns.salt_keys(keyed, "raw_key", inputs.tracked_keys(spark), bucket, "salted_key")


def partition_key(spark, folder):
    salted = salt_keys(spark, folder)
    key = key_columns.partition_key(F.col("salted_key"), F.col("TransactionID"))
    return salted.select("TransactionID", key.alias("record_key"))


def key_shares(spark, folder):
    shares = hotkeys.key_shares(_sample(spark, folder))
    return shares.withColumn("share", rounded("share"))


def window_sample(spark, folder):
    sample = _sample(spark, folder, max_messages=1_500)
    return sample.select("kafka_partition", "kafka_offset", "kafka_key")


def topic_sample(spark, folder):
    sample = _sample(spark, folder, max_messages=6_000, whole_topic=True)
    return sample.select("kafka_partition", "kafka_offset", "kafka_key")


def _heavy(spark, folder):
    return hotkeys.detect(_sample(spark, folder), inputs.tracked_keys(spark), _PARTITION_SHARE)


def _cooled(spark, folder):
    return hotkeys.demote(_sample(spark, folder), inputs.tracked_keys(spark))


def detect(spark, folder):
    return _heavy(spark, folder).withColumn("share", rounded("share"))


def demote(spark, folder):
    return _cooled(spark, folder).withColumn("share", rounded("share"))


def set_union(spark, folder):
    tracked = inputs.tracked_keys(spark)
    return hotkeys.listed(hotkeys.with_added(tracked, hotkeys.added(_heavy(spark, folder), tracked)))


def set_demoted(spark, folder):
    return hotkeys.listed(
        hotkeys.without_cooled(inputs.tracked_keys(spark), _cooled(spark, folder))
    )


def already_tracked(spark, folder):
    return hotkeys.listed(
        hotkeys.already_tracked(_heavy(spark, folder), inputs.tracked_keys(spark))
    )


def _proposals(spark, folder):
    tracked = inputs.tracked_keys(spark)
    return hotkeys.propose(_heavy(spark, folder), _cooled(spark, folder), tracked)


def proposals(spark, folder):
    return _proposals(spark, folder)


def approved_set(spark, folder):
    """The tracked set after someone approved the removals and rejected the additions."""
    status = F.when(F.col("action") == "remove", "approved").otherwise("rejected")
    answered = _proposals(spark, folder).withColumn("status", status)
    return hotkeys.listed(hotkeys.apply_approved(inputs.tracked_keys(spark), answered))


def skew_diagnosis(spark, folder):
    causes = hotkeys.diagnose(_sample(spark, folder), _PARTITION_SHARE)
    return causes.withColumn("max_share", rounded("max_share"))


def chronic_hot_keys(spark, folder):
    scans = None
    for scan_id, as_of in enumerate((_EARLIER, _AS_OF)):
        found = hotkeys.detect(
            _sample(spark, folder, as_of), inputs.tracked_keys(spark), _PARTITION_SHARE
        ).select(F.lit(scan_id).alias("scan_id"), "key")
        scans = found if scans is None else scans.union(found)
    return hotkeys.chronic(scans)


def _sampled(query: str, *more: str, limit: str | None = None) -> str:
    tables = ", ".join([_sample_sql(limit=limit), *more])
    return sql(query, "msgs", "tracked", extra=tables)


_SALTED = """select TransactionID, cast(card1 as varchar) as raw_key,
  case when cast(card1 as varchar) in (select key from tracked)
       then concat(card1, '-', TransactionID % 4) else cast(card1 as varchar) end as salted_key
  from tx"""
_ADDS = "select distinct key from heavy where key not in (select key from tracked)"

QUERIES = {
    "strip_salt": Query(
        strip_salt,
        sql(
            """select kafka_offset, regexp_replace(kafka_key, '-[0-9]+$', '') as raw_key
            from msgs""",
            "msgs",
        ),
    ),
    "salt_keys": Query(salt_keys, sql(_SALTED, "tx", "tracked")),
    "partition_key": Query(
        partition_key,
        sql(
            f"""select TransactionID,
              coalesce(salted_key, cast(TransactionID as varchar)) as record_key
            from ({_SALTED})""",
            "tx",
            "tracked",
        ),
    ),
    "key_shares": Query(
        key_shares,
        _sampled(
            f"""select key, n, cast(sum(n) over () as bigint) as total,
              {sql_rounded('n / sum(n) over ()')} as share
            from (select key, count(*) as n from sample group by key)""",
        ),
    ),
    "hotkey_window_sample": Query(
        window_sample,
        _sampled("select kafka_partition, kafka_offset, kafka_key from sample", limit="1500"),
    ),
    "hotkey_topic_sample": Query(
        topic_sample,
        _sampled(
            "select kafka_partition, kafka_offset, kafka_key from sample",
            limit="greatest(6000 // parts, 1)",
        ),
    ),
    "hotkey_detect": Query(
        detect,
        _sampled(
            f"""select {_PART}, key, n, cast(total as bigint) as total,
              {sql_rounded('share')} as share,
              case when key in (select key from tracked) then 'already tracked' else 'new' end
                as status
            from heavy""",
            _SHARES_SQL,
            _HEAVY_SQL,
        ),
    ),
    "hotkey_demote": Query(
        demote,
        _sampled(
            f"select key, n, total, {sql_rounded('share')} as share from cooled",
            _COOLED_SQL,
        ),
    ),
    "hotkey_set_union": Query(
        set_union,
        _sampled(
            "select key from tracked union select key from heavy", _SHARES_SQL, _HEAVY_SQL
        ),
    ),
    "hotkey_set_demoted": Query(
        set_demoted,
        _sampled(
            "select key from tracked except select key from cooled",
            _COOLED_SQL,
        ),
    ),
    "hotkey_already_tracked": Query(
        already_tracked,
        _sampled(
            "select key from heavy intersect select key from tracked", _SHARES_SQL, _HEAVY_SQL
        ),
    ),
    "hotkey_proposals": Query(
        proposals,
        sql(
            f"""select key, 'add' as action, 'pending' as status from ({_ADDS})
            union all select key, 'remove', 'pending' from cooled""",
            "msgs",
            "tracked",
            extra=", ".join(
                [
                    _sample_sql(),
                    _SHARES_SQL,
                    _HEAVY_SQL,
                    _sample_sql(name="topic"),
                    _COOLED_SQL.replace("from sample", "from topic"),
                ]
            ),
        ),
    ),
    "hotkey_approved_set": Query(
        approved_set,
        _sampled(
            "select key from tracked except select key from cooled",
            _COOLED_SQL,
        ),
    ),
    "skew_diagnosis": Query(
        skew_diagnosis,
        _sampled(
            f"""select {_PART}, {sql_rounded('max(share)')} as max_share, count(*) as n_keys,
              case when max(share) > {_PARTITION_SHARE} then 'hot key' else 'collision' end as cause
            from shares group by {_PART}""",
            _SHARES_SQL,
        ),
    ),
    "chronic_hot_keys": Query(
        chronic_hot_keys,
        sql(
            f"""select key, count(distinct scan_id) as n_scans
            from (select *, n / sum(n) over (partition by scan_id, kafka_partition) as share
                  from (select scan_id, kafka_partition, key, count(*) as n
                        from (select 0 as scan_id, kafka_partition, key from early
                              union all select 1, kafka_partition, key from sample)
                        group by scan_id, kafka_partition, key))
            where share > {_PARTITION_SHARE}
            group by key having count(distinct scan_id) >= 2""",
            "msgs",
            extra=_sample_sql() + ", " + _sample_sql(_EARLIER, name="early"),
        ),
    ),
}
