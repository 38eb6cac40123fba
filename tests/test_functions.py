import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.functions.headers import event_time_millis, header, utf8
from riskstream.functions.keys import card_text, partition_key, salt_keys, strip_salt
from riskstream.functions.scalars import null_if_nan, safe_ratio, seconds_to_timestamp


def column(spark, kind, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_event_time_header(spark):
    texts = ["86400", "1.9999", "-1.9995", "None", "nOnE", "none", "abc", "", "nan", "NaN",
             "Infinity", "-inf", "1e300", None, " 12 ", "1e3"]
    expected = [86400000, 1999, -1999, None, None, None, None, None, None, None,
                None, None, None, None, 12000, 1000000]
    assert column(spark, "string", texts, event_time_millis) == expected


def test_last_non_null_header_wins(spark):
    rows = [
        ([("a", b"1"), ("b", b"x"), ("a", b"2")],),
        ([("a", b"1"), ("a", None)],),
        ([("b", b"x")],),
        ([],),
        (None,),
        ([("a", b"\xff\xfe")],),
    ]
    from pyspark.sql import types as T

    df = spark.createDataFrame(rows, T.StructType([T.StructField("h", schemas.HEADERS)])).coalesce(1)
    found = [r[0] for r in df.select(header(F.col("h"), "a")).collect()]
    assert found == ["2", "1", None, None, None, "��"]


def test_utf8_is_null_safe(spark):
    found = column(spark, "binary", [None, "é".encode(), b"a\xffb"], utf8)
    assert found == [None, "é", "a�b"]


def test_strip_salt_vectors(spark):
    keys = ["10086-3", "10086.0", "-5", "a-b", "7-1-2", None]
    assert column(spark, "string", keys, strip_salt) == ["10086", "10086.0", "", "a-b", "7-1", None]


def test_card_text_has_no_decimal_point(spark):
    assert column(spark, "double", [10086.0, None], card_text) == ["10086", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("abc0123456789.-", min_size=1, max_size=8), min_size=1, max_size=30))
def test_salt_is_undone(spark, keys):
    import re

    keys = [k for k in keys if not re.search(r"-\d+$", k)] or ["k"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")
    hot = df.where("id % 2 = 0").select(F.col("k").alias("key"))
    salted = salt_keys(df, "k", hot, F.pmod("id", F.lit(4)), "s")
    back = salted.select("k", strip_salt(F.col("s")).alias("b"), "s").collect()
    assert len(back) == len(keys)
    assert all(r.k == r.b for r in back)
    tracked = {r.key for r in hot.collect()}
    assert all((r.s != r.k) == (r.k in tracked) for r in back)


def test_partition_key_falls_back_unsalted(spark):
    df = spark.createDataFrame([("7-1", 5), (None, 6)], "s string, id long")
    found = [r[0] for r in df.select(partition_key(F.col("s"), F.col("id"))).collect()]
    assert found == ["7-1", "6"]


def test_safe_ratio_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5, None]
    assert column(spark, "double", [float("nan"), 1.0, None], null_if_nan) == [None, 1.0, None]


def test_origin_is_a_parameter(spark):
    found = column(
        spark, "double", [86400.5], lambda v: seconds_to_timestamp(v, "2017-11-30").cast("string")
    )
    assert found == ["2017-12-01 00:00:00.5"]
    assert column(spark, "double", [1.0], lambda v: F.unix_micros(seconds_to_timestamp(v))) == [
        1_000_000
    ]


def test_schemas_have_the_contracted_width():
    tx, identity = schemas.transaction(), schemas.identity()
    assert len(tx) == 386 and [f.name for f in tx if not f.nullable] == ["TransactionID", "TransactionDT"]
    assert len(identity) == 41 and sum(f.dataType.simpleString() == "string" for f in identity) == 15
    assert len(schemas.BRONZE) == 10


@pytest.mark.parametrize("name", ["BRONZE", "ARCHIVE", "KAFKA_RECORD"])
def test_schema_names_are_unique(name):
    names = getattr(schemas, name).names
    assert len(names) == len(set(names))
