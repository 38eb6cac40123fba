import pytest
from pyspark.sql import functions as F

from riskstream.operators.rolling import rolling_features
from riskstream.plans import inputs
from riskstream.streaming.features import streaming_features
from riskstream.streaming.sliced import sliced_features
from tests.streaming.helpers import ONCE, add_file, read_files, write_files

COUNTS = ["card1_txn_count_1h", "card1_txn_count_24h"]
VALUES = [
    "card1_amt_sum_1h",
    "card1_amt_sum_24h",
    "card1_amt_std_24h",
    "card1_time_since_last",
    "card1_amt_mean_24h",
    "amt_to_mean_24h_ratio",
]


def shown(df):
    return {r[0]: tuple(r[1:]) for r in df.select("TransactionID", *COUNTS, *VALUES).collect()}


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for row_id, values in expected.items():
        near = tuple(None if v is None else pytest.approx(v, abs=1e-6) for v in values)
        assert found[row_id] == near, row_id


def feed(spark, sf, limit=400):
    """Dense transactions: one per ten seconds, 12 cards, some nulls and ties."""
    rows = inputs.tx(spark, sf).where(F.col("TransactionID") < limit)
    second = F.floor(F.col("TransactionID") / 2) * 400
    return rows.select(
        (F.col("card1") % 5).alias("card1"),
        "TransactionID",
        "TransactionAmt",
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + second * 1_000_000).alias("event_time"),
    )


def flush_row(spark):
    return spark.sql(
        "select 999L as card1, -1L as TransactionID, 0.0D as TransactionAmt, "
        "timestamp'2030-01-01 00:00:00' as event_time"
    )


def run(spark, stream, tmp_path, name="features"):
    out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(out), query


@pytest.mark.parametrize("shuffled, small_rows", [(False, 500), (True, 20)])
def test_stream_equals_batch(spark, sf, tmp_path, shuffled, small_rows):
    """In order with whole histories, and out of order with histories kept by minute."""
    rows = feed(spark, sf).persist()
    source = str(tmp_path / "in")
    # Arrival up to 30 s after the event.
    late = F.pmod(F.col("TransactionID") * 37, F.lit(31)) * 1_000_000 if shuffled else F.lit(0)
    write_files(rows, source, F.unix_micros("event_time") + late, 5)
    add_file(flush_row(spark), source, "part-flush")
    stream = streaming_features(read_files(spark, source, rows.schema), small_rows=small_rows)
    found, query = run(spark, stream, tmp_path)
    batch = rolling_features(rows.withColumn("us", F.unix_micros("event_time")))
    expected = shown(batch)
    got = shown(found.where("TransactionID >= 0"))
    assert_same(got, expected)
    dropped = [o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators]
    assert sum(dropped) == 0


def test_restart_continues_the_frames(spark, sf, tmp_path):
    rows = feed(spark, sf, 200).persist()
    source = str(tmp_path / "in")
    write_files(rows.where("TransactionID < 120"), source + "/a", F.col("event_time"), 2)
    stream = streaming_features(read_files(spark, source, rows.schema))
    run(spark, stream, tmp_path)
    write_files(rows.where("TransactionID >= 120"), source + "/b", F.col("event_time"), 2)
    add_file(flush_row(spark), source, "part-flush")
    found, _ = run(spark, streaming_features(read_files(spark, source, rows.schema)), tmp_path)
    expected = shown(rolling_features(rows.withColumn("us", F.unix_micros("event_time"))))
    assert found.where("TransactionID >= 0").count() == 200
    assert_same(shown(found.where("TransactionID >= 0")), expected)


def test_rows_beyond_the_lateness_are_dropped_and_counted(spark, sf, tmp_path):
    rows = feed(spark, sf, 200).where("card1 is not null").persist()
    source = str(tmp_path / "in")
    write_files(rows.where("TransactionID >= 40"), source, F.col("event_time"), 4)
    add_file(rows.where("TransactionID < 40"), source, "part-very-late")
    found, query = run(spark, streaming_features(read_files(spark, source, rows.schema)), tmp_path)
    dropped = sum(
        o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators
    )
    assert dropped == rows.where("TransactionID < 40").count()
    assert found.where("TransactionID < 40").count() == 0


def run_sliced(spark, source, tmp_path, schema):
    query = sliced_features(
        read_files(spark, source, schema),
        str(tmp_path / "store"),
        str(tmp_path / "features"),
        str(tmp_path / "sliced-checkpoint"),
        trigger=ONCE,
    )
    query.awaitTermination()
    return str(tmp_path / "features")


def test_sliced_stream_equals_batch(spark, sf, tmp_path):
    """Out of order, and with one card making half of the rows."""
    rows = feed(spark, sf).withColumn(
        "card1", F.when(F.col("TransactionID") % 2 == 0, 3).otherwise(F.col("card1"))
    )
    rows = rows.persist()
    source = str(tmp_path / "in")
    late = F.pmod(F.col("TransactionID") * 37, F.lit(31)) * 1_000_000
    write_files(rows, source, F.unix_micros("event_time") + late, 3)
    add_file(flush_row(spark), source, "part-flush")
    found = spark.read.parquet(run_sliced(spark, source, tmp_path, rows.schema))
    expected = shown(rolling_features(rows.withColumn("us", F.unix_micros("event_time"))))
    assert_same(shown(found.where("TransactionID >= 0")), expected)
    marks = spark.read.parquet(str(tmp_path / "store" / "marks"))
    assert marks.agg(F.sum("n_late")).first()[0] == 0


def test_sliced_stream_counts_late_rows_and_remembers_idle_cards(spark, tmp_path):
    schema = "card1 long, TransactionID long, TransactionAmt double, event_time timestamp"
    source = str(tmp_path / "in")

    def add(name, *rows):
        text = schema.replace("event_time timestamp", "event_time string")
        df = spark.createDataFrame(list(rows), text)
        add_file(df.withColumn("event_time", F.col("event_time").cast("timestamp")), source, name)

    add("a", (7, 1, 1.0, "2024-01-01 00:00:00"), (8, 2, 2.0, "2024-01-01 00:00:10"))
    run_sliced(spark, source, tmp_path, flush_row(spark).schema)
    add("b", (8, 3, 3.0, "2024-01-05 00:00:00"), (None, 4, 3.0, "2024-01-05 00:00:00"))
    run_sliced(spark, source, tmp_path, flush_row(spark).schema)
    # Card 7 returns after four days; a row from day one comes too late.
    add("c", (7, 5, 5.0, "2024-01-05 00:00:05"), (7, 6, 9.0, "2024-01-01 12:00:00"))
    run_sliced(spark, source, tmp_path, flush_row(spark).schema)
    add("d", (9, 7, 1.0, "2024-02-01 00:00:00"))
    found = spark.read.parquet(run_sliced(spark, source, tmp_path, flush_row(spark).schema))
    rows = {r.TransactionID: r for r in found.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[5].card1_time_since_last == 4 * 86400 + 5
    assert rows[5].card1_txn_count_24h is None
    assert rows[4].card1_time_since_last is None
    marks = spark.read.parquet(str(tmp_path / "store" / "marks"))
    assert marks.agg(F.sum("n_late")).first()[0] == 1


def test_large_amounts_keep_their_deviation_in_the_sliced_stream(spark, tmp_path):
    rows = spark.range(300).select(
        F.lit(7).cast("bigint").alias("card1"),
        F.col("id").alias("TransactionID"),
        (F.lit(1e9) + (F.col("id") % 2) * 0.01).alias("TransactionAmt"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 300_000_000).alias("event_time"),
    )
    source = str(tmp_path / "in")
    write_files(rows.unionByName(flush_row(spark)), source, F.col("event_time"), 4)
    found = spark.read.parquet(run_sliced(spark, source, tmp_path, rows.schema))
    deviations = [r[0] for r in found.where("card1 = 7").select("card1_amt_std_24h").collect()]
    known = [d for d in deviations if d is not None]
    assert len(deviations) == 300 and len(known) == 298
    assert all(abs(d - 0.005) < 0.003 for d in known)


def test_kept_columns_come_out_with_their_row_in_both_forms(spark, sf, tmp_path):
    rows = feed(spark, sf, 120).withColumns(
        {
            "ProductCD": F.when(F.col("TransactionID") % 3 > 0, F.concat(F.lit('é"'), "TransactionID")),
            "seen_at": F.timestamp_micros(F.col("TransactionID") + 1_704_067_200_123_456),
            "score": F.col("TransactionID") / 7,
        }
    )
    keep = ["ProductCD", "seen_at", "score"]
    source = str(tmp_path / "in")
    write_files(rows, source, F.col("event_time"), 2)
    flush = flush_row(spark).selectExpr(
        "*", "string(null) as ProductCD", "timestamp(null) as seen_at", "double(null) as score"
    )
    add_file(flush, source, "part-flush")
    stream = streaming_features(read_files(spark, source, rows.schema), keep=keep)
    stateful, _ = run(spark, stream, tmp_path)
    sliced_features(
        read_files(spark, source, rows.schema), str(tmp_path / "store"), str(tmp_path / "sliced"),
        str(tmp_path / "sliced-c"), trigger=ONCE, keep=keep,
    ).awaitTermination()
    expected = {r[0]: tuple(r[1:]) for r in rows.select("TransactionID", *keep).collect()}
    for found in (stateful, spark.read.parquet(str(tmp_path / "sliced"))):
        got = found.where("TransactionID >= 0").select("TransactionID", *keep).collect()
        assert {r[0]: tuple(r[1:]) for r in got} == expected
