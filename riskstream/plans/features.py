"""Queries over rolling features, training data and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.functions.scalars import safe_ratio, seconds_to_timestamp
from riskstream.operators import decisions as decision_ops
from riskstream.operators import joins, model, reference
from riskstream.operators.rolling import feature_names, rolling_features
from riskstream.plans import inputs
from riskstream.plans.inputs import Query, rounded, sql, sql_rounded
from riskstream.streaming.publish import latest_per_key

_COUNTS = ["card1_txn_count_1h", "card1_txn_count_24h"]
_FEATURES = feature_names()


def _features_sql(table: str, name: str = "feat") -> str:
    """Rolling features of ``table`` by plain windows over time intervals."""
    return f"""{name} as (
  select f.* exclude (rows_1h, rows_24h, cnt_1h, cnt_24h),
    case when rows_1h > 0 then cnt_1h end as card1_txn_count_1h,
    case when rows_24h > 0 then cnt_24h end as card1_txn_count_24h,
    card1_amt_sum_1h / nullif(cnt_1h, 0) as card1_amt_mean_1h,
    card1_amt_sum_24h / nullif(cnt_24h, 0) as card1_amt_mean_24h,
    TransactionAmt / nullif(card1_amt_sum_24h / nullif(cnt_24h, 0), 0) as amt_to_mean_24h_ratio
  from (
    select *,
      count(*) over h as rows_1h, count(*) over d as rows_24h,
      count(TransactionAmt) over h as cnt_1h, count(TransactionAmt) over d as cnt_24h,
      sum(TransactionAmt) over h as card1_amt_sum_1h,
      sum(TransactionAmt) over d as card1_amt_sum_24h,
      stddev_samp(TransactionAmt) over d as card1_amt_std_24h,
      (us - lag(us) over (partition by card1, card order by us, TransactionID)) / 1e6
        as card1_time_since_last
    from (select *, case when card1 is null then TransactionID end as card from {table})
    window
      h as (partition by card1, card order by ts
            range between interval 1 hour preceding and interval 1 microsecond preceding),
      d as (partition by card1, card order by ts
            range between interval 24 hour preceding and interval 1 microsecond preceding)
  ) f)"""


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "TransactionID",
        "card1",
        *[c if c in _COUNTS else rounded(c).alias(c) for c in _FEATURES],
    )


_SHOWN_SQL = "select TransactionID, card1, " + ", ".join(
    c if c in _COUNTS else f"{sql_rounded(c)} as {c}" for c in _FEATURES
)


def rolling(spark, folder):
    return _shown(rolling_features(inputs.tx(spark, folder)))


def rolling_hot(spark, folder):
    # The heavy card crosses many borders between cells.
    rows = inputs.tx(spark, folder, hot=True).withColumn("us", F.expr(_SOME_TIMES))
    return _shown(rolling_features(rows, cells=24))


# Now and then the time is missing, for the heavy card and for others.
_SOME_TIMES = "case when TransactionID % 103 = 0 then null else us end"


def time_since_last(spark, folder):
    rows = rolling_features(inputs.tx(spark, folder))
    return rows.select("TransactionID", rounded("card1_time_since_last").alias("seconds_since_last"))


def amt_ratio(spark, folder):
    rows = rolling_features(inputs.tx(spark, folder))
    ratio = safe_ratio(F.col("TransactionAmt"), F.col("card1_amt_mean_24h"))
    return rows.select("TransactionID", rounded(ratio).alias("ratio"))


def event_clock(spark, folder):
    """Simulation seconds read from the training origin."""
    rows = inputs.tx(spark, folder)
    seconds = F.pmod(F.col("us"), F.lit(10**13)) / 1e6
    moved = seconds_to_timestamp(seconds, "2017-11-30")
    return rows.select("TransactionID", F.unix_micros(moved).alias("moved_us"))


def _labelled(df: DataFrame, part: str) -> DataFrame:
    return df.select("TransactionID", F.lit(part).alias("part"))


def time_split(spark, folder):
    train, test, _ = model.time_split(inputs.tx(spark, folder))
    return _labelled(train, "train").union(_labelled(test, "test"))


_SPLIT_SQL = "split as (select quantile_cont(us, 0.8) as border from tx)"


def time_quantile(spark, folder):
    """The split border found by rank search instead of in one task."""
    rows = inputs.tx(spark, folder)
    border = model.exact_quantile(rows, "us", model.TRAIN_SHARE, max_rows=500)
    counted = rows.agg(
        F.count_if(F.col("us") <= border).alias("n_train"),
        F.count_if(F.col("us") > border).alias("n_test"),
    )
    return counted.withColumn("border", F.floor(F.lit(border)).cast("bigint"))


def categorical_codes(spark, folder):
    train, test, _ = model.time_split(inputs.tx(spark, folder))
    # Devices that turn up late are new to the training part.
    device = F.expr(_DEVICE_SQL)
    codes = model.fit_codes(train.withColumn("device", device), ["ProductCD", "card4", "device"])
    rows = model.encode(test.withColumn("device", device), codes)
    return rows.select("TransactionID", "ProductCD_code", "card4_code", "device_code")


_DEVICE_SQL = "concat('d', cast(cast(floor(us / 86400000000) as bigint) % 40 as string))"


def class_ratio(spark, folder):
    ratio = model.class_ratio(inputs.tx(spark, folder))
    return ratio.withColumn("ratio", rounded("ratio"))


def eval_metrics(spark, folder):
    rows = inputs.tx(spark, folder)
    guess = (F.col("k") < 15).cast("int")
    metrics = model.evaluate(rows, F.col("isFraud"), guess)
    return metrics.select("tp", "fp", "fn", *[rounded(c).alias(c) for c in ("precision", "recall", "f1")])


# Categories that enter the vector as codes of the training part; user attributes come from
# the reference table, which knows a card's latest value.
_CODED = ["ProductCD", "user_card4", "DeviceInfo"]
_CODES = [f"{c}_code" for c in _CODED]
_WHOLE = [*_COUNTS, "id_01", *_CODES]
_VECTOR = ["TransactionAmt", "id_01", "fraud_rate", "user_card2", *_CODES, *_FEATURES]


def _vector(spark, folder) -> DataFrame:
    """Every input of the model: amounts, rolling features, identity, reference data, codes."""
    rows = inputs.tx(spark, folder)
    device = inputs.identities(spark, folder).select("TransactionID", "id_01", "DeviceInfo")
    users = reference.user_reference(rows, ["card2", "card4"]).select(
        "card1", F.col("card2").alias("user_card2"), F.col("card4").alias("user_card4")
    )
    wide = joins.join_identity(rolling_features(rows), device)
    wide = joins.enrich(wide, users, reference.merchant_data(rows))
    known, _, _ = model.time_split(rows)
    known = joins.join_identity(known, device).join(users, "card1", "left")
    return model.encode(wide, model.fit_codes(known.select(*_CODED), _CODED))


def feature_vector(spark, folder):
    rows = _vector(spark, folder)
    return rows.select(
        "TransactionID",
        "isFraud",
        "DeviceInfo",
        *[c if c in _WHOLE else rounded(c).alias(c) for c in _VECTOR],
    )


def positional_vector(spark, folder):
    """The feature vector under positional names, as the model is handed it."""
    rows = _vector(spark, folder).select(
        "TransactionID", *[F.col(c) if c in _WHOLE else rounded(c).alias(c) for c in _VECTOR]
    )
    return model.positional(rows)


_MERCHANT_SQL = """merchants as (
  select row_number() over (order by ProductCD) as merchant_data_sk, ProductCD,
         avg(isFraud) as fraud_rate from tx group by ProductCD)"""

_USERS_SQL = """users as (
  select card1, arg_max(card2, us) filter (card2 is not null) as user_card2,
    arg_max(card4, us) filter (card4 is not null) as user_card4
  from tx where card1 is not null group by card1)"""


def _codes_sql(column: str) -> str:
    return f"""codes_{column} as (
  select {column}, row_number() over (order by {column}) - 1 as code
  from known where {column} is not null group by {column})"""


_WIDE_SQL = ", ".join(
    [
        _features_sql("tx"),
        _MERCHANT_SQL,
        _USERS_SQL,
        _SPLIT_SQL,
        """joined as (
  select f.*, i.id_01, i.DeviceInfo, user_card2, user_card4, fraud_rate
  from feat f left join (select TransactionID, id_01, DeviceInfo from ident) i
    using (TransactionID) left join users using (card1) left join merchants using (ProductCD))""",
        "known as (select joined.* from joined, split where us <= border)",
        *map(_codes_sql, _CODED),
        "wide as (select joined.*, "
        + ", ".join(f"coalesce(codes_{c}.code, -1) as {c}_code" for c in _CODED)
        + " from joined "
        + " ".join(f"left join codes_{c} using ({c})" for c in _CODED)
        + ")",
    ]
)

# The score of the decision queries: a fixed expression in place of a trained model.
_SCORE = "(k + 0.5) / 100.0"


def _decided(spark, folder) -> DataFrame:
    rows = rolling_features(inputs.tx(spark, folder))
    flagged = joins.flag_watchlist(
        rows, inputs.watchlist(spark, folder), {"account": F.col("card1").cast("string")}
    )
    scored = flagged.withColumn("score", F.expr(_SCORE).cast("double"))
    return decision_ops.decide(
        scored,
        flag_at=0.7,
        block_at=0.95,
        factors={
            "score": F.col("score") >= 0.7,
            "burst": F.col("card1_txn_count_24h") >= 4,
            "watchlist": F.col("on_account_list"),
        },
        snapshot=["TransactionAmt", "card1_txn_count_24h", "on_account_list"],
        block_when=F.col("on_account_list"),
    )


def decisions(spark, folder):
    return _decided(spark, folder).select(
        "TransactionID",
        "decision",
        rounded("confidence").alias("confidence"),
        F.array_join(F.col("factors.name"), ",").alias("factor_names"),
        F.col("snapshot.card1_txn_count_24h").alias("seen_count_24h"),
        F.col("snapshot.on_account_list").alias("seen_on_list"),
    )


_DECIDED_SQL = """scored as (
  select f.*, (k + 0.5) / 100.0 as score, coalesce(cast(card1 as varchar) in (
    select value from watchlist where kind = 'account'), false) as listed from feat f)"""
_DECISION_SQL = """case when listed or score >= 0.95 then 'block'
  when score >= 0.7 then 'flag' else 'allow' end"""


def features_latest(spark, folder):
    latest = latest_per_key(rolling_features(inputs.tx(spark, folder)))
    total = rounded("card1_amt_sum_24h").alias("card1_amt_sum_24h")
    return latest.select("card1", "TransactionID", "us", "card1_txn_count_24h", total)


QUERIES = {
    "rolling_features": Query(
        rolling, sql(_SHOWN_SQL + " from feat", "tx", extra=_features_sql("tx"))
    ),
    "rolling_features_hot": Query(
        rolling_hot,
        sql(
            f"{_SHOWN_SQL} from feat union all select TransactionID, card1, "
            + ", ".join("null" for _ in _FEATURES)
            + f" from tx_hot where ({_SOME_TIMES}) is null",
            "tx_hot",
            extra=f"timed as (select * from tx_hot where ({_SOME_TIMES}) is not null), "
            + _features_sql("timed"),
        ),
    ),
    "time_since_last": Query(
        time_since_last,
        sql(
            f"""select TransactionID, case when card1 is not null then {sql_rounded(
            "(us - lag(us) over (partition by card1 order by us, TransactionID)) / 1e6")} end
            as seconds_since_last from tx""",
            "tx",
        ),
    ),
    "amt_ratio": Query(
        amt_ratio,
        sql(
            f"select TransactionID, {sql_rounded('amt_to_mean_24h_ratio')} as ratio from feat",
            "tx",
            extra=_features_sql("tx"),
        ),
    ),
    "event_clock": Query(
        event_clock,
        sql(
            """select TransactionID,
            epoch_us(timestamp '2017-11-30') + us % 10000000000000 as moved_us from tx""",
            "tx",
        ),
    ),
    "time_split": Query(
        time_split,
        sql(
            """select TransactionID, case when us <= border then 'train' else 'test' end as part
            from tx, split""",
            "tx",
            extra=_SPLIT_SQL,
        ),
    ),
    "time_quantile": Query(
        time_quantile,
        sql(
            """select count(*) filter (us <= border) as n_train,
            count(*) filter (us > border) as n_test,
            cast(floor(any_value(border)) as bigint) as border
            from tx, split""",
            "tx",
            extra=_SPLIT_SQL,
        ),
    ),
    "categorical_codes": Query(
        categorical_codes,
        sql(
            """select TransactionID, coalesce(p.code, -1) as ProductCD_code,
              coalesce(c.code, -1) as card4_code, coalesce(d.code, -1) as device_code
            from (select *, {device} as device from tx) cross join split
            left join (select ProductCD, row_number() over (order by ProductCD) - 1 as code
                       from known group by ProductCD) p using (ProductCD)
            left join (select card4, row_number() over (order by card4) - 1 as code
                       from known where card4 is not null group by card4) c using (card4)
            left join (select device, row_number() over (order by device) - 1 as code
                       from known group by device) d using (device)
            where us > border""".replace("{device}", _DEVICE_SQL),
            "tx",
            extra=_SPLIT_SQL
            + f", known as (select tx.*, {_DEVICE_SQL} as device from tx, split where us <= border)",
        ),
    ),
    "class_ratio": Query(
        class_ratio,
        sql(
            f"""select count(*) filter (isFraud = 0) as negatives,
            count(*) filter (isFraud = 1) as positives, {sql_rounded(
            'count(*) filter (isFraud = 0) / nullif(count(*) filter (isFraud = 1), 0)')} as ratio
            from tx""",
            "tx",
        ),
    ),
    "eval_metrics": Query(
        eval_metrics,
        sql(
            f"""select tp, fp, fn,
              {sql_rounded('coalesce(tp / nullif(tp + fp, 0), 0)')} as precision,
              {sql_rounded('coalesce(tp / nullif(tp + fn, 0), 0)')} as recall,
              {sql_rounded('coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)')} as f1
            from (select count(*) filter (k < 15 and isFraud = 1) as tp,
                         count(*) filter (k < 15 and isFraud = 0) as fp,
                         count(*) filter (k >= 15 and isFraud = 1) as fn from tx)""",
            "tx",
        ),
    ),
    "feature_vector": Query(
        feature_vector,
        sql(
            "select TransactionID, isFraud, DeviceInfo, "
            + ", ".join(c if c in _WHOLE else f"{sql_rounded(c)} as {c}" for c in _VECTOR)
            + " from wide",
            "tx",
            "ident",
            extra=_WIDE_SQL,
        ),
    ),
    "positional_vector": Query(
        positional_vector,
        sql(
            "select TransactionID as f0, "
            + ", ".join(
                f"{c if c in _WHOLE else sql_rounded(c)} as f{i + 1}" for i, c in enumerate(_VECTOR)
            )
            + " from wide",
            "tx",
            "ident",
            extra=_WIDE_SQL,
        ),
    ),
    "decisions": Query(
        decisions,
        sql(
            f"""select TransactionID, {_DECISION_SQL} as decision,
              {sql_rounded("case when listed then 1.0 else greatest(score, 1 - score) end")}
                as confidence,
              concat_ws(',', case when score >= 0.7 then 'score' end,
                case when card1_txn_count_24h >= 4 then 'burst' end,
                case when listed then 'watchlist' end) as factor_names,
              card1_txn_count_24h as seen_count_24h, listed as seen_on_list
            from scored""",
            "tx",
            "watchlist",
            extra=_features_sql("tx") + ", " + _DECIDED_SQL,
        ),
    ),
    "features_latest_per_key": Query(
        features_latest,
        sql(
            f"""select card1, TransactionID, us, card1_txn_count_24h,
              {sql_rounded('card1_amt_sum_24h')} as card1_amt_sum_24h
            from feat where card1 is not null
            qualify row_number() over (partition by card1 order by us desc, TransactionID desc) = 1
            """,
            "tx",
            extra=_features_sql("tx"),
        ),
    ),
}
