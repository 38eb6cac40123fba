import pytest
from pyspark.sql import functions as F

from riskstream.operators import quality

MSG = "kafka_topic string, kafka_partition int, kafka_offset long, kafka_key string, kafka_value string, minute long"


def messages(spark, rows):
    df = spark.createDataFrame(rows, MSG)
    return df.withColumn("ingest_time", F.timestamp_micros(F.col("minute") * 60_000_000)).drop("minute")


def test_skew_alert_needs_five_minutes(spark):
    rows = []
    for minute in range(8):
        # Partition 0 outgrows partition 1 from minute 1 on.
        rows.append(("t", 0, minute, "", "x" * (10 if minute == 0 else 100), minute))
        rows.append(("t", 1, minute, "", "x" * 10, minute))
    found = quality.partition_skew(messages(spark, rows)).orderBy("minute").collect()
    assert [r.held_minutes for r in found] == [0, 0, 1, 2, 3, 4, 5, 6]
    assert [r.alert for r in found] == [False] * 6 + [True] * 2
    assert found[1].max_size == 110 and found[1].avg_size == 65.0


def test_skew_run_restarts_after_a_balanced_minute(spark):
    rows = [("t", 0, 0, "", "x" * 90, 0), ("t", 1, 1, "", "x" * 10, 0)]
    rows += [("t", 1, 2, "", "x" * 80, 3), ("t", 0, 3, "", "x" * 900, 4), ("t", 0, 4, "", "x", 7)]
    found = quality.partition_skew(messages(spark, rows)).orderBy("minute").collect()
    assert [(r.minute, r.held_minutes) for r in found] == [(0, 0), (3, 0), (4, 0), (7, 3)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "p int, k string")
    assert [tuple(r) for r in quality.duplicates(df, ["p", "k"]).collect()] == [(1, "a", 2)]


def test_latency_is_an_exact_percentile(spark):
    df = spark.range(101).select(
        F.lit("allow").alias("decision"), F.lit(0).alias("us"), (F.col("id") * 1000).alias("done")
    )
    row = quality.latency_summary(df, "us", "done").first()
    assert (row.n, row.avg_ms, row.p99_ms, row.max_ms) == (101, 50.0, 99.0, 100)


def test_freshness_breach(spark):
    df = spark.createDataFrame([(0, 4_000_000), (0, 3_700_000_000)], "us long, at long")
    found = quality.freshness_lag(df, "us", "at").orderBy("window_start_us").collect()
    assert [(r.window_start_us, r.breach) for r in found] == [(0, False), (3_600_000_000, True)]


def test_offset_lag_of_an_unarchived_partition(spark):
    made = messages(spark, [("t", p, o, "k", "v", 0) for p in (0, 1) for o in range(5, 10)])
    kept = made.where("kafka_partition = 0 and kafka_offset < 8")
    found = {r.kafka_partition: r.offset_lag for r in quality.offset_lag(made, kept).collect()}
    assert found == {0: 2, 1: 5}


def test_throughput(spark):
    made = messages(spark, [("t", 0, o, "k", "v", o) for o in range(20)])
    rows = quality.throughput(made.withColumn("us", F.unix_micros("ingest_time")), "us").collect()
    assert sorted((r.n, r.rows_per_second) for r in rows) == [(10, pytest.approx(10 / 600))] * 2
