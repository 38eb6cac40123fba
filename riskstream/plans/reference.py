"""Queries over reference tables, history and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskstream.operators import ids, joins, reference
from riskstream.plans import inputs
from riskstream.plans.inputs import Query, rounded, sql, sql_rounded
from riskstream.session import shared_dir, written
from riskstream.sources import tables

_ATTRIBUTES = ["card2", "card4"]
_HOUR_US = 3_600_000_000
# Sends every card with more rows than this down the sliced plan, to check it.
_FEW_ROWS = 40

_USERS_SQL = """users as (
  select row_number() over (order by card1) as user_reference_sk, card1,
    arg_max(card2, us) filter (card2 is not null) as card2,
    arg_max(card4, us) filter (card4 is not null) as card4
  from tx where card1 is not null group by card1)"""
_MERCHANTS_SQL = """merchants as (
  select row_number() over (order by ProductCD) as merchant_data_sk, ProductCD,
    avg(isFraud) as fraud_rate from tx where ProductCD is not null group by ProductCD)"""


def _history_sql(table: str) -> str:
    before = "over (partition by card1 order by us, TransactionID rows between unbounded preceding and 1 preceding)"
    return f"""history as (
  select card1, card2, card4, us as valid_from,
    lead(us) over (partition by card1 order by us, TransactionID) as valid_to
  from (
    select card1, us, TransactionID, old2, old4,
      coalesce(card2, old2) as card2, coalesce(card4, old4) as card4
    from (select *, last_value(card2 ignore nulls) {before} as old2,
            last_value(card4 ignore nulls) {before} as old4
          from {table} where card1 is not null))
  where card2 is distinct from old2 or card4 is distinct from old4)"""


def user_reference(spark, folder):
    return reference.user_reference(inputs.tx(spark, folder), _ATTRIBUTES)


def ranged_ids(spark, folder):
    """Dense ids numbered in key ranges side by side."""
    cards = inputs.tx(spark, folder).where("card1 is not null").select("card1").distinct()
    return ids.dense_ids(cards, "card1", "id", rows_per_task=10)


def merchant_data(spark, folder):
    rates = reference.merchant_data(inputs.tx(spark, folder))
    return rates.withColumn("fraud_rate", rounded("fraud_rate"))


def merchant_until(spark, folder):
    """Rates of the training period only."""
    rates = reference.merchant_data(inputs.tx(spark, folder), until=1_705_000_000_000_000)
    return rates.withColumn("fraud_rate", rounded("fraud_rate"))


def _fact(spark, folder):
    rows = inputs.tx(spark, folder)
    users = reference.user_reference(rows, _ATTRIBUTES)
    merchants = reference.merchant_data(rows)
    return reference.transaction_fact(rows, users, merchants, _ATTRIBUTES)


def transaction_fact(spark, folder):
    return _fact(spark, folder).drop("k")


def reference_load(spark, folder):
    """A reference table loaded twice with ``overwrite`` holds its rows once."""
    path = f"{shared_dir(spark)}/riskstream/reference-{uuid.uuid4().hex}"
    users = user_reference(spark, folder)
    tables.load_reference(users, path)
    return tables.load_reference(users, path)


def reference_append(spark, folder):
    """Loaded twice with ``append`` it holds them twice."""
    path = f"{shared_dir(spark)}/riskstream/reference-{uuid.uuid4().hex}"
    rates = merchant_data(spark, folder)
    tables.load_reference(rates, path, mode="append")
    return tables.load_reference(rates, path, mode="append")


def scd2_history(spark, folder):
    return reference.change_history(inputs.tx(spark, folder), _ATTRIBUTES)


def scd2_history_hot(spark, folder):
    rows = inputs.tx(spark, folder, hot=True)
    return reference.change_history(rows, _ATTRIBUTES, max_rows=_FEW_ROWS)


def _as_of(spark, folder, hot: bool, **limits):
    rows = inputs.tx(spark, folder, hot=hot)
    history = written(reference.change_history(rows, _ATTRIBUTES, **limits), "history")
    later = rows.select("TransactionID", "card1", (F.col("us") + _HOUR_US).alias("us"))
    joined = joins.as_of(later, history, **limits)
    return joined.select("TransactionID", "card1", "us", *_ATTRIBUTES, "valid_from")


def scd2_asof_join(spark, folder):
    return _as_of(spark, folder, hot=False)


def scd2_asof_join_hot(spark, folder):
    return _as_of(spark, folder, hot=True, max_rows=_FEW_ROWS)


def _as_of_sql(table: str) -> str:
    return sql(
        f"""select t.TransactionID, t.card1, t.us + {_HOUR_US} as us, h.card2, h.card4, h.valid_from
        from {table} t left join history h on t.card1 = h.card1
          and h.valid_from <= t.us + {_HOUR_US}
          and (h.valid_to is null or t.us + {_HOUR_US} < h.valid_to)""",
        table,
        extra=_history_sql(table),
    )


def identity_keyed(spark, folder):
    keyed = joins.key_identities(inputs.identities(spark, folder), inputs.tx(spark, folder))
    return keyed.select("TransactionID", "id_01", "DeviceInfo", "us", "card1")


def tx_identity_join(spark, folder):
    rows = inputs.tx(spark, folder).select("TransactionID", "us", "card1")
    return joins.join_identity(rows, inputs.identities(spark, folder))


def interval_join(spark, folder):
    rows = inputs.tx(spark, folder).select("TransactionID", "us", "card1")
    return joins.join_within(rows, inputs.identities(spark, folder), 20, 20)


def enrich_reference(spark, folder):
    rows = inputs.tx(spark, folder)
    users = reference.user_reference(rows, _ATTRIBUTES)
    merchants = reference.merchant_data(rows)
    events = rows.select("TransactionID", "card1", "ProductCD")
    wide = joins.enrich(events, users, merchants)
    return wide.withColumn("fraud_rate", rounded("fraud_rate"))


def _devices(spark, folder):
    rows = inputs.tx(spark, folder).select("TransactionID", "card1")
    device = inputs.identities(spark, folder).select("TransactionID", "DeviceInfo")
    return joins.join_identity(rows, device)


def watchlist_flag(spark, folder):
    kinds = {"account": F.col("card1").cast("string"), "device": F.col("DeviceInfo")}
    return joins.flag_watchlist(_devices(spark, folder), inputs.watchlist(spark, folder), kinds)


def watchlist_semi(spark, folder):
    rows, listed = inputs.tx(spark, folder), inputs.watchlist(spark, folder)
    hits = joins.only_listed(rows, listed, "account", F.col("card1").cast("string"))
    return hits.select("TransactionID", "card1")


def watchlist_anti(spark, folder):
    rows, listed = inputs.tx(spark, folder), inputs.watchlist(spark, folder)
    clean = joins.not_listed(rows, listed, "account", F.col("card1").cast("string"))
    return clean.select("TransactionID", "card1")


_LISTED = "cast(card1 as varchar) in (select value from watchlist where kind = 'account')"
_HISTORY_OUT = (
    "select card1, card2, card4, valid_from, valid_to, valid_to is null as is_current from history"
)

QUERIES = {
    "user_reference": Query(
        user_reference, sql("select * from users", "tx", extra=_USERS_SQL)
    ),
    "dense_ids_ranged": Query(
        ranged_ids,
        sql(
            """select card1, row_number() over (order by card1) as id
            from (select distinct card1 from tx where card1 is not null)""",
            "tx",
        ),
    ),
    "merchant_data": Query(
        merchant_data,
        sql(
            f"""select merchant_data_sk, ProductCD, {sql_rounded('fraud_rate')} as fraud_rate
            from merchants""",
            "tx",
            extra=_MERCHANTS_SQL,
        ),
    ),
    "merchant_data_until": Query(
        merchant_until,
        sql(
            f"""select row_number() over (order by ProductCD) as merchant_data_sk, ProductCD,
              {sql_rounded('avg(isFraud)')} as fraud_rate
            from tx where us <= 1705000000000000 group by ProductCD""",
            "tx",
        ),
    ),
    "transaction_fact": Query(
        transaction_fact,
        sql(
            """select t.TransactionID, t.us, t.card1, t.TransactionAmt, t.isFraud,
              u.user_reference_sk, m.merchant_data_sk
            from tx t left join users u using (card1) left join merchants m using (ProductCD)""",
            "tx",
            extra=_USERS_SQL + ", " + _MERCHANTS_SQL,
        ),
    ),
    "reference_load": Query(
        reference_load, sql("select * from users", "tx", extra=_USERS_SQL)
    ),
    "reference_append": Query(
        reference_append,
        sql(
            f"""select merchant_data_sk, ProductCD, {sql_rounded('fraud_rate')} as fraud_rate
            from (select * from merchants union all select * from merchants)""",
            "tx",
            extra=_MERCHANTS_SQL,
        ),
    ),
    "scd2_history": Query(scd2_history, sql(_HISTORY_OUT, "tx", extra=_history_sql("tx"))),
    "scd2_history_hot": Query(
        scd2_history_hot, sql(_HISTORY_OUT, "tx_hot", extra=_history_sql("tx_hot"))
    ),
    "scd2_asof_join": Query(scd2_asof_join, _as_of_sql("tx")),
    "scd2_asof_join_hot": Query(scd2_asof_join_hot, _as_of_sql("tx_hot")),
    "identity_keyed": Query(
        identity_keyed,
        sql(
            """select i.TransactionID, i.id_01, i.DeviceInfo, t.us, t.card1
            from ident i left join tx t using (TransactionID)
            order by t.us nulls last, i.TransactionID""",
            "ident",
        ),
    ),
    "tx_identity_join": Query(
        tx_identity_join,
        sql(
            """select t.TransactionID, t.us, t.card1, i.identity_us, i.id_01, i.DeviceInfo
            from tx t left join ident i using (TransactionID)""",
            "ident",
        ),
    ),
    "interval_join": Query(
        interval_join,
        sql(
            """select t.TransactionID, t.us, t.card1, i.identity_us, i.id_01, i.DeviceInfo
            from tx t left join ident i on t.TransactionID = i.TransactionID
              and i.identity_us between t.us - 20000000 and t.us + 20000000""",
            "ident",
        ),
    ),
    "enrich_reference": Query(
        enrich_reference,
        sql(
            f"""select t.TransactionID, t.card1, t.ProductCD, u.user_reference_sk, u.card2, u.card4,
              m.merchant_data_sk, {sql_rounded('m.fraud_rate')} as fraud_rate
            from tx t left join users u using (card1) left join merchants m using (ProductCD)""",
            "tx",
            extra=_USERS_SQL + ", " + _MERCHANTS_SQL,
        ),
    ),
    "watchlist_flag": Query(
        watchlist_flag,
        sql(
            f"""select t.TransactionID, t.card1, i.DeviceInfo,
              coalesce({_LISTED}, false) as on_account_list,
              coalesce(i.DeviceInfo in (select value from watchlist where kind = 'device'), false)
                as on_device_list
            from tx t left join ident i using (TransactionID)""",
            "ident",
            "watchlist",
        ),
    ),
    "watchlist_semi": Query(
        watchlist_semi,
        sql(f"select TransactionID, card1 from tx where {_LISTED}", "tx", "watchlist"),
    ),
    "watchlist_anti": Query(
        watchlist_anti,
        sql(
            f"select TransactionID, card1 from tx where not coalesce({_LISTED}, false)",
            "tx",
            "watchlist",
        ),
    ),
}
