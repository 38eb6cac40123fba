import pytest
from pyspark.sql import functions as F

from riskstream.operators import ids, joins, reference
from riskstream.operators.quantiles import exact_quantile, exact_quantiles, sketch_of

TX = "TransactionID long, us long, card1 long, card4 string, ProductCD string, isFraud int"


def tx(spark, rows):
    return spark.createDataFrame(rows, TX)


def test_last_known_value_skips_nulls(spark):
    rows = [(1, 10, 7, "x", "W", 0), (2, 20, 7, None, "W", 1), (3, 5, None, "z", None, 0)]
    users = reference.user_reference(tx(spark, rows), ["card4"]).collect()
    assert [tuple(r) for r in users] == [(1, 7, "x")]
    rates = reference.merchant_data(tx(spark, rows)).collect()
    assert [tuple(r) for r in rates] == [(1, "W", 0.5)]


def test_training_period_limits_the_rate(spark):
    rows = [(1, 10, 7, None, "W", 0), (2, 20, 7, None, "W", 1)]
    assert reference.merchant_data(tx(spark, rows), until=10).first().fraud_rate == 0.0


def test_fact_keeps_rows_without_reference(spark):
    rows = tx(spark, [(1, 10, 7, "x", "W", 0), (2, 20, None, None, None, 1)])
    users = reference.user_reference(rows, ["card4"])
    fact = reference.transaction_fact(rows, users, reference.merchant_data(rows), ["card4"])
    found = {r.TransactionID: (r.user_reference_sk, r.merchant_data_sk) for r in fact.collect()}
    assert found == {1: (1, 1), 2: (None, None)}
    assert "ProductCD" not in fact.columns and "card4" not in fact.columns


@pytest.mark.parametrize("rows_per_task", [1_000_000, 7])
def test_dense_ids(spark, rows_per_task):
    names = spark.range(100).select(F.concat(F.lit("k"), F.lpad("id", 3, "0")).alias("k"))
    numbered = ids.dense_ids(names, "k", "n", start=0, rows_per_task=rows_per_task)
    assert {r.k: r.n for r in numbered.collect()} == {f"k{i:03d}": i for i in range(100)}


@pytest.mark.parametrize("max_rows", [5_000_000, 3])
def test_history_carries_unreported_values(spark, max_rows):
    states = ["a", None, "a", "b", None, "b", "a", None, "c", "c"]
    rows = [(i, i * 10, 7, s, "W", 0) for i, s in enumerate(states)]
    rows.append((99, 5, 8, None, "W", 0))
    history = reference.change_history(tx(spark, rows), ["card4"], max_rows=max_rows)
    found = sorted((r.valid_from, r.valid_to, r.card4, r.is_current) for r in history.collect())
    assert found == [(0, 30, "a", False), (30, 60, "b", False), (60, 80, "a", False), (80, None, "c", True)]


@pytest.mark.parametrize("max_rows", [5_000_000, 3])
def test_as_of_is_closed_at_the_start_and_open_at_the_end(spark, max_rows):
    history = spark.createDataFrame(
        [(7, "a", 10, 20), (7, "b", 20, 40), (7, "c", 50, None), (8, "z", 0, None)],
        "card1 long, card4 string, valid_from long, valid_to long",
    )
    times = [5, 10, 19, 20, 39, 40, 49, 50, 90]
    events = spark.createDataFrame(
        [(i, 7, t) for i, t in enumerate(times)] + [(100, None, 15), (101, 9, 15)],
        "TransactionID long, card1 long, us long",
    )
    found = {r.TransactionID: r.card4 for r in joins.as_of(events, history, max_rows=max_rows).collect()}
    assert [found[i] for i in range(9)] == [None, "a", "a", "b", "b", None, None, "c", "c"]
    assert found[100] is None and found[101] is None and len(found) == 11


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
@pytest.mark.parametrize("share", [0.0, 0.2, 0.8, 0.99, 1.0])
def test_exact_quantile(spark, share, max_rows):
    # A third of the values are one value, and the rest is lopsided.
    values = [5.0] * 400 + [float(i * i) for i in range(800)] + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = df.agg(F.percentile("v", share)).first()[0]
    assert exact_quantile(df, "v", share, max_rows) == pytest.approx(wanted, abs=1e-9)


def test_exact_quantile_of_one_repeated_value(spark):
    df = spark.range(300).select(F.lit(4).alias("v"))
    assert exact_quantile(df, "v", 0.8, max_rows=10) == 4.0
    assert exact_quantile(df.where("false"), "v", 0.8) is None


@pytest.mark.parametrize("kind", ["long", "double"])
def test_quantiles_in_one_search_with_a_sketch_of_other_rows(spark, kind):
    """Counts decide: a sketch that misses every rank costs time, not the result."""
    df = spark.range(3_000).select((F.col("id") * 7 % 3_001).cast(kind).alias("v"))
    shares = [0.0, 0.1, 0.1003, 0.5, 0.77, 1.0]
    wanted = df.agg(F.percentile("v", F.array(*map(F.lit, shares)))).first()[0]
    assert exact_quantiles(df, "v", shares, 20) == pytest.approx(wanted, abs=1e-9)
    other = spark.range(50).select((F.col("id") + 2_000).cast(kind).alias("v"))
    wrong = (3_000, sketch_of(other)[1])
    assert exact_quantiles(df, "v", shares, 20, sketch=wrong) == pytest.approx(wanted, abs=1e-9)


def test_nan_is_no_value_for_a_quantile(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,), (None,)], "v double")
    assert exact_quantiles(df, "v", [0.5], 1) == [2.0]
    assert exact_quantiles(df.where("isnan(v)"), "v", [0.5]) == [None]


def test_orphans_come_last(spark):
    rows = tx(spark, [(1, 10, 7, "x", "W", 0)])
    identities = spark.createDataFrame([(2, "d2"), (1, "d1")], "TransactionID long, DeviceInfo string")
    keyed = joins.key_identities(identities, rows).collect()
    assert [(r.TransactionID, r.us, r.card1) for r in keyed] == [(1, 10, 7), (2, None, None)]


def test_watchlist_forms(spark):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, device string")
    listed = spark.createDataFrame(
        [("device", "a"), ("device", "a"), ("ip", "b")], "kind string, value string"
    )
    flags = joins.flag_watchlist(events, listed, {"device": F.col("device")}).collect()
    assert {r.id: r.on_device_list for r in flags} == {1: True, 2: False, 3: False}
    assert joins.only_listed(events, listed, "device", F.col("device")).count() == 1
    assert {r.id for r in joins.not_listed(events, listed, "device", F.col("device")).collect()} == {2, 3}


def test_as_of_never_pairs_a_key_with_all_its_versions(spark):
    """The plan holds no join on the key, only a merge in time order."""
    history = spark.createDataFrame([(7, "a", 0, None)], "card1 long, card4 string, valid_from long, valid_to long")
    events = spark.createDataFrame([(1, 7, 5)], "TransactionID long, card1 long, us long")
    plan = joins.as_of(events, history)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan


def test_a_burst_is_cut_into_even_slices(spark):
    from riskstream.operators.hot import heavy_keys, with_slice

    # 900 of 1000 rows in the last hundredth of the key's span, and a light key beside it.
    burst = spark.range(900).select(F.lit(7).alias("k"), (F.col("id") + 990_000).alias("t"))
    quiet = spark.range(100).select(F.lit(7).alias("k"), (F.col("id") * 9_900).alias("t"))
    light = spark.range(10).select(F.lit(8).alias("k"), F.col("id").alias("t"))
    df = burst.union(quiet).union(light)
    heavy = heavy_keys(df, "k", "t", max_rows=100)
    sliced = with_slice(df, "k", "t", heavy)
    assert sliced.count() == 1010 and sliced.where("k = 8 and _slice is not null").count() == 0
    sizes = sliced.where("k = 7").groupBy("_slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("low"), F.max("t").alias("high")
    )
    rows = sorted(sizes.collect(), key=lambda r: r._slice)
    assert len(rows) >= 10 and max(r.n for r in rows) <= 100
    assert all(a.high < b.low for a, b in zip(rows, rows[1:]))


def test_slices_of_many_heavy_keys_need_no_list_of_cuts(spark):
    """Rows of one instant are cut as well, and what a heavy key costs beside its rows is one number."""
    from riskstream.operators.hot import heavy_keys, with_slice

    df = spark.range(3_000).select((F.col("id") % 30).alias("k"), F.lit(5).alias("t"), "id")
    heavy = heavy_keys(df, "k", "t", max_rows=20)
    assert heavy.rows == 3_000 and heavy.keys.count() == 30
    assert [kind for _, kind in heavy.keys.dtypes] == ["bigint"]
    sliced = with_slice(df, "k", ["t", "id"], heavy)
    sizes = sliced.groupBy("k", "_slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
    )
    rows = sorted(sizes.collect(), key=lambda r: (r.k, r._slice))
    assert sum(r.n for r in rows) == 3_000 and max(r.n for r in rows) <= 20
    assert all(a.high < b.low for a, b in zip(rows, rows[1:]) if a.k == b.k)
