import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskstream.operators import hotkeys

SCHEMA = "kafka_topic string, kafka_partition int, kafka_offset long, kafka_key string, ingest_time timestamp"
NOW = "2024-01-01 12:00:00"


def messages(spark, keys, partition=0, at="2024-01-01 11:59:00", first=0):
    rows = [("t", partition, first + i, k, at) for i, k in enumerate(keys)]
    text = SCHEMA.replace("ingest_time timestamp", "ingest_time string")
    return spark.createDataFrame(rows, text).withColumn("ingest_time", F.col("ingest_time").cast("timestamp"))


def tracked(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def now():
    return F.lit(NOW).cast("timestamp")


def test_thresholds_are_strict(spark):
    # 9 of 447 is 2.01 %: heavy. 10 of 500 is 2 % exactly: neither heavy nor cooled.
    heavy = messages(spark, ["a"] * 9 + [f"x{i}" for i in range(438)])
    assert {r.key for r in hotkeys.detect(heavy, tracked(spark)).collect()} == {"a"}
    even = messages(spark, ["a"] * 10 + [f"x{i}" for i in range(490)])
    assert hotkeys.detect(even, tracked(spark)).count() == 0
    assert hotkeys.demote(even, tracked(spark, "a")).count() == 0


def test_demote_shares_and_unseen_keys(spark):
    sample = messages(spark, ["a"] + ["b"] * 3 + [f"x{i}" for i in range(488)])
    rows = {r.key: (r.n, round(r.share * 100, 2)) for r in hotkeys.demote(sample, tracked(spark, "a", "b", "c")).collect()}
    assert rows == {"a": (1, 0.2), "b": (3, 0.61), "c": (0, 0.0)}


def test_salted_buckets_recombine(spark):
    sample = messages(spark, [f"7-{i % 4}" for i in range(8)] + [f"x{i}" for i in range(92)])
    assert [(r.key, r.n) for r in hotkeys.detect(sample, tracked(spark, "7")).collect()] == [("7", 8)]
    status = hotkeys.detect(sample, tracked(spark, "7")).first().status
    assert status == "already tracked"


def test_an_empty_sample_changes_nothing(spark):
    none = messages(spark, ["a"]).where("false")
    assert hotkeys.detect(none, tracked(spark, "a")).count() == 0
    assert hotkeys.demote(none, tracked(spark, "a")).count() == 0


def offsets(df):
    return sorted(r.kafka_offset for r in df.collect())


def test_window_starts_at_first_offset_in_time(spark):
    old = messages(spark, ["a"] * 5, at="2024-01-01 10:00:00")
    new = messages(spark, ["a"] * 5, first=5)
    assert offsets(hotkeys.recent(old.union(new), now())) == [5, 6, 7, 8, 9]
    # A message after the first one in the window counts even if its own time is older.
    straggler = messages(spark, ["a"], first=10, at="2024-01-01 09:00:00")
    assert offsets(hotkeys.recent(old.union(new).union(straggler), now()))[-1] == 10


def test_quiet_partition_falls_back_to_its_start(spark):
    quiet = messages(spark, ["a"] * 8, partition=3, at="2023-12-01 00:00:00", first=100)
    assert offsets(hotkeys.recent(quiet, now())) == list(range(100, 108))
    assert offsets(hotkeys.recent(quiet, now(), max_messages=3)) == [105, 106, 107]


def test_messages_after_the_clock_are_not_seen(spark):
    later = messages(spark, ["a"] * 3, at="2024-01-01 12:00:01", first=50)
    assert offsets(hotkeys.recent(messages(spark, ["a"] * 2).union(later), now())) == [0, 1]


def test_topic_limit_is_split_by_partition_and_at_least_one(spark):
    topic = messages(spark, ["a"] * 100, 0)
    for p in range(1, 12):
        topic = topic.union(messages(spark, ["a"] * 100, p))
    sample = hotkeys.recent(topic, now(), max_messages=500, whole_topic=True)
    assert {r["count"] for r in sample.groupBy("kafka_partition").count().collect()} == {41}
    few = hotkeys.recent(topic, now(), max_messages=5, whole_topic=True)
    assert few.count() == 12


def test_diagnosis(spark):
    one = messages(spark, ["a"] * 50 + [f"x{i}" for i in range(50)], 0)
    many = messages(spark, [f"y{i}" for i in range(100)], 1)
    found = {r.kafka_partition: r.cause for r in hotkeys.diagnose(one.union(many)).collect()}
    assert found == {0: "hot key", 1: "collision"}


def test_chronic_needs_two_scans(spark):
    scans = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (2, "b")], "scan_id int, key string")
    assert [r.key for r in hotkeys.chronic(scans).collect()] == ["a"]


@settings(max_examples=4, deadline=None)
@given(
    st.sets(st.sampled_from("abcdef"), max_size=6),
    st.sets(st.sampled_from("abcdef"), max_size=6),
    st.sets(st.sampled_from("abcdef"), max_size=6),
)
def test_set_changes_are_idempotent(spark, old, heavy, cooled):
    def keys(values):
        return spark.createDataFrame([(v,) for v in values], "key string")

    def result(df):
        return sorted(r.key for r in df.collect())

    proposals = hotkeys.propose(keys(heavy), keys(cooled), keys(old))
    assert result(hotkeys.apply_approved(keys(old), proposals)) == sorted(old)
    approved = proposals.withColumn("status", F.lit("approved"))
    once = hotkeys.apply_approved(keys(old), approved)
    assert result(once) == sorted((old | heavy) - cooled)
    assert result(hotkeys.apply_approved(once, approved)) == result(once)


def test_no_limit(spark):
    rows = messages(spark, ["a"] * 30)
    assert hotkeys.recent(rows, now(), max_messages=None).count() == 30
    with pytest.raises(Exception):
        hotkeys.recent(rows.drop("kafka_offset"), now()).count()
