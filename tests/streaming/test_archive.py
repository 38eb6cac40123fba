import glob
import os

from pyspark.sql import functions as F

from riskstream import schemas
from riskstream.functions.headers import event_hour
from riskstream.operators.hotkeys import detect, recent
from riskstream.operators.quality import duplicates
from riskstream.plans import inputs
from riskstream.sources import tables
from riskstream.sources.ledger import Ledger, merged_spans, spans_of
from riskstream.streaming.archive import append_new, archive, write_batch
from tests.streaming.helpers import ONCE, add_file, records, write_files


def feed(spark, sf, limit=240):
    return inputs.kafka_records(spark, sf).where(F.col("offset") < limit)


def run(spark, source, path, checkpoint, name="archive", **options):
    query = archive(records(spark, source), path, checkpoint, name, trigger=ONCE, **options)
    query.awaitTermination()
    return query


def test_restart_and_replay_lose_and_repeat_nothing(spark, sf, tmp_path):
    rows = feed(spark, sf).persist()
    source, path = str(tmp_path / "in"), str(tmp_path / "archive")
    write_files(rows.where("offset < 120"), source + "/a", F.col("offset"), 2)
    run(spark, source, path, str(tmp_path / "c1"))
    write_files(rows.where("offset >= 120"), source + "/b", F.col("offset"), 2)
    run(spark, source, path, str(tmp_path / "c1"))  # restart: goes on where it stopped
    assert tables.read_archive(spark, path).count() == 240
    run(spark, source, path, str(tmp_path / "c2"))  # new checkpoint: the whole topic again
    stored = tables.read_archive(spark, path)
    assert stored.count() == 240
    assert duplicates(stored, schemas.BRONZE_KEY).count() == 0
    # The archive holds exactly the projected records.
    columns = [c for c in schemas.BRONZE.names if c != "ingest_time"]
    expected = inputs.bronze(spark, sf).where("kafka_offset < 240").select(*columns)
    assert stored.select(*columns).exceptAll(expected).count() == 0


def test_feeds_progress_on_their_own(spark, sf, tmp_path):
    rows = feed(spark, sf, 60).persist()
    write_files(rows, str(tmp_path / "tx"), F.col("offset"), 1)
    write_files(rows, str(tmp_path / "ident"), F.col("offset"), 1)
    run(spark, str(tmp_path / "tx"), str(tmp_path / "a1"), str(tmp_path / "c1"), "tx")
    more = inputs.kafka_records(spark, sf).where("offset between 60 and 99")
    add_file(more, str(tmp_path / "ident"), "late")
    run(spark, str(tmp_path / "ident"), str(tmp_path / "a2"), str(tmp_path / "c2"), "ident")
    assert tables.read_archive(spark, str(tmp_path / "a1")).count() == 60
    assert tables.read_archive(spark, str(tmp_path / "a2")).count() == 100


def test_a_burst_is_taken_in_bounded_batches(spark, sf, tmp_path):
    write_files(feed(spark, sf), str(tmp_path / "in"), F.col("offset"), 6)
    query = run(spark, str(tmp_path / "in"), str(tmp_path / "a"), str(tmp_path / "c"))
    sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert len(sizes) == 6 and max(sizes) <= 40
    assert tables.read_archive(spark, str(tmp_path / "a")).count() == 240


def test_a_batch_run_twice_after_a_failure_adds_nothing(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    rows = inputs.bronze(spark, sf).where("kafka_offset < 50")
    append_new(rows, path, 0)
    # A first try that wrote part of batch 1 before it died.
    more = inputs.bronze(spark, sf).where("kafka_offset between 40 and 89")
    append_new(more.where("kafka_offset < 70"), path, 1)
    append_new(more, path, 1)
    assert tables.read_archive(spark, path).count() == 90
    assert tables.read_archive(spark, path, batch_id=0).count() == 50


def test_a_heavy_hour_is_written_by_several_tasks(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    rows = inputs.bronze(spark, sf).withColumn("event_time", F.lit("2024-01-01 05:00:00").cast("timestamp"))
    append_new(rows, path, 0, rows_per_file=100)
    files = tables.read_archive(spark, path).select(F.input_file_name().alias("f"))
    assert files.distinct().count() >= 4
    assert tables.read_archive(spark, path).count() == rows.count()


def test_a_replay_of_more_hours_than_are_listed_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "a")
    hour = F.when(F.col("id") % 150 != 7, F.timestamp_seconds(F.col("id") * 3600))
    rows = spark.range(300).select(
        F.lit("k").alias("kafka_key"), F.lit("v").cast("binary").alias("kafka_value"),
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
        (299 - F.col("id")).alias("kafka_offset"), hour.alias("event_time"),
        F.lit("2024-01-01").cast("timestamp").alias("ingest_time"),
        *(F.lit("x").alias(c) for c in ("source_service", "run_id", "schema_version")),
    )
    rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in schemas.BRONZE.fields))
    append_new(rows.where("kafka_offset % 3 = 0 or kafka_offset > 290"), path, 0)
    for batch in (1, 2):
        append_new(rows, path, batch)
        stored = tables.read_archive(spark, path)
        assert stored.count() == 300 and duplicates(stored, schemas.BRONZE_KEY).count() == 0
    assert tables.read_archive(spark, path, batch_id=0).count() == 106


def n_files(df):
    return df.select(F.input_file_name().alias("f")).distinct().count()


def test_compaction_rewrites_closed_hours_and_loses_nothing(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    rows = inputs.bronze(spark, sf).where("kafka_offset < 200").persist()
    for batch in range(3):
        append_new(rows.where(f"kafka_offset % 4 = {batch}"), path, batch)
    before = tables.read_archive(spark, path)
    files, kept = n_files(before), sorted(map(str, before.collect()))
    hours = sorted(r[0] for r in before.select("event_hour").where("event_hour is not null").distinct().collect())
    middle = hours[len(hours) // 2]
    done = tables.compact(spark, path, closed_before=middle)
    assert all(h is None or h < middle for h in done) and middle not in done
    after = tables.read_archive(spark, path)
    assert sorted(map(str, after.collect())) == kept and n_files(after) < files
    assert sorted(map(str, before.collect())) == kept  # a reader that began earlier
    # As of an earlier batch, after more rows came.
    append_new(rows, path, 3)
    assert tables.read_archive(spark, path).count() == rows.count()
    assert tables.read_archive(spark, path, batch_id=0).count() == rows.where("kafka_offset % 4 = 0").count()
    assert tables.compact(spark, path, closed_before=middle) == done  # the last batch reached them too
    assert tables.compact(spark, path, closed_before=middle) == []
    gone = Ledger(spark, path).vacuum()
    assert gone > 0 and Ledger(spark, path).vacuum() == 0
    assert tables.read_archive(spark, path).count() == rows.count()


def test_rows_appended_while_hours_are_compacted_stay(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    rows = inputs.bronze(spark, sf).where("kafka_offset < 90").persist()
    for batch in range(2):
        append_new(rows.where(f"kafka_offset % 3 = {batch}"), path, batch)
    ledger = Ledger(spark, path)
    early, _ = ledger.reserve()  # a batch that is being written
    compacted, state = ledger.reserve()
    old = ledger.rows(state).withColumn("commit", F.lit(compacted).cast("bigint"))
    append = rows.where("kafka_offset % 3 = 2").withColumns(
        {"batch_id": F.lit(2).cast("bigint"), "event_hour": event_hour(F.col("event_time")),
         "commit": F.lit(early).cast("bigint")}
    )
    tables.write_by_hour(append, path, 1000)
    hours = [r[0] for r in old.select("event_hour").distinct().collect()]
    tables.write_by_hour(old, path, 1000)
    assert tables.read_archive(spark, path).count() == rows.where("kafka_offset % 3 < 2").count()
    ledger.replace(compacted, hours, [early])
    ledger.confirm(early, spans_of(append)[0])
    assert tables.read_archive(spark, path).count() == rows.count()
    assert duplicates(tables.read_archive(spark, path), schemas.BRONZE_KEY).count() == 0


def test_what_a_dead_writer_left_is_not_seen_and_written_again(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    rows = inputs.bronze(spark, sf).where("kafka_offset < 60").persist()
    append_new(rows.where("kafka_offset < 20"), path, 0)
    dead, _ = Ledger(spark, path).reserve()
    part = rows.where("kafka_offset < 40").withColumns(
        {"batch_id": F.lit(1).cast("bigint"), "event_hour": event_hour(F.col("event_time")),
         "commit": F.lit(dead).cast("bigint")}
    )
    tables.write_by_hour(part, path, 1000)  # and dies before it is confirmed
    assert tables.read_archive(spark, path).count() == 20
    append_new(rows, path, 1)
    assert tables.read_archive(spark, path).count() == 60
    assert Ledger(spark, path).vacuum() > 0
    assert tables.read_archive(spark, path).count() == 60


def test_a_fresh_batch_reads_no_archived_row(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    rows = inputs.bronze(spark, sf).persist()
    for batch in range(3):
        append_new(rows.where(f"kafka_offset between {batch * 100} and {batch * 100 + 99}"), path, batch)
        # Files of earlier batches that cannot be read do no harm.
        for file in glob.glob(f"{path}/commit={batch}/*/*.parquet"):
            os.truncate(file, 3)
    state = Ledger(spark, path).state()
    partitions = rows.where("kafka_offset < 300").select("kafka_topic", "kafka_partition").distinct().count()
    assert len(state["spans"]) <= 3 * partitions and state["next"] == 3 and state["hidden"] == []


def test_spans_merge_and_too_many_are_joined_where_they_are_near(spark):
    spans = [("t", 0, 5, 9), ("t", 0, 0, 4), ("t", 1, 3, 3), ("t", 0, 11, 12), ("t", 0, 8, 8)]
    assert merged_spans(spans) == [("t", 0, 0, 9), ("t", 0, 11, 12), ("t", 1, 3, 3)]
    many = merged_spans([("t", 0, 10 * i + i * i, 10 * i + i * i + 2) for i in range(20)], most=8)
    assert len(many) == 8 and many[0][2] == 0 and many[-1][3] == 190 + 361 + 2
    assert many[-1][2] == 190 + 361 and many[0][3] > 100
    rows = spark.createDataFrame([("t", 0, o) for o in (1, 2, 7)] + [("t", 1, 4)],
                                 "kafka_topic string, kafka_partition int, kafka_offset long")
    found, n = spans_of(rows)
    assert sorted(found) == [("t", 0, 1, 7), ("t", 1, 4, 4)] and n == 4


def test_the_table_shows_hours_as_they_come_and_after_compaction(spark, sf, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "a")
    write_files(feed(spark, sf), source, F.col("offset"), 3)
    run(spark, source, path, str(tmp_path / "c"), table="seen_hours")
    stored = tables.read_archive(spark, path)
    assert spark.table("seen_hours").count() == stored.count() == 240
    tables.compact(spark, path, table="seen_hours")
    spark.catalog.refreshTable("seen_hours")
    assert spark.table("seen_hours").count() == 240
    shown = spark.table("seen_hours").groupBy("event_hour").count().collect()
    assert sorted(map(str, shown)) == sorted(map(str, stored.groupBy("event_hour").count().collect()))


def test_write_batch_replaces_an_earlier_try(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(spark.range(5), path, 0)
    write_batch(spark.range(7), path, 1)
    write_batch(spark.range(3), path, 1)
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    assert counts == {0: 5, 1: 3}


def test_scan_over_the_archive(spark, sf, tmp_path):
    path = str(tmp_path / "a")
    append_new(inputs.bronze(spark, sf), path, 0)
    sample = recent(
        tables.read_archive(spark, path), F.lit("2024-02-01").cast("timestamp"), 40 * 86400
    )
    none = spark.createDataFrame([], schemas.TRACKED_KEYS)
    assert "3" in {r.key for r in detect(sample, none, 0.1).collect()}


def test_a_batch_opens_only_its_own_files(spark, sf, tmp_path):
    path = str(tmp_path / "archive")
    rows = inputs.bronze(spark, sf).where("event_time is not null").persist()
    hours = [r[0] for r in rows.select(F.date_trunc("hour", "event_time")).distinct().take(2)]
    batch = rows.where(F.date_trunc("hour", "event_time") == hours[0])
    other = tmp_path / "archive" / "commit=77" / f"event_hour={hours[1]:%Y-%m-%d-%H}"
    other.mkdir(parents=True)
    (other / "part-0.parquet").write_bytes(b"not a table")
    for batch_id in (0, 1):
        append_new(batch, path, batch_id)
    stored = tables.read_archive(spark, path).where(F.col("event_hour") == f"{hours[0]:%Y-%m-%d-%H}")
    assert stored.count() == batch.count() > 0


def test_hours_do_not_depend_on_the_session_time_zone(spark):
    rows = spark.createDataFrame([(0,), (-1,), (1_705_000_000_000_000,), (None,)], "us long")
    hour = rows.select(event_hour(F.timestamp_micros("us")).alias("h"))
    expected = ["1970-01-01-00", "1969-12-31-23", "2024-01-11-19", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert [r.h for r in hour.collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_batch_archived_before_is_known_by_its_offsets_alone(spark, sf, tmp_path):
    """Nothing is left to write, so no payload is shuffled; rows that lack are found as before."""
    from riskstream.streaming.archive import _missing

    path = str(tmp_path / "archive")
    bronze = inputs.bronze(spark, sf).where("kafka_offset < 240")
    append_new(bronze.where("kafka_offset % 2 = 0 or kafka_offset = 239"), path, 0)
    ledger = Ledger(spark, path)
    rows = bronze.withColumn("event_hour", event_hour(F.col("event_time")))
    lacked = _missing(rows, ledger, ledger.state())
    assert sorted(r[0] for r in lacked.select("kafka_offset").collect()) == list(range(1, 239, 2))
    append_new(bronze, path, 1)
    assert _missing(rows, ledger, ledger.state()) is None
    append_new(bronze, path, 2)
    stored = tables.read_archive(spark, path)
    assert stored.count() == 240 and {r[0] for r in stored.select("batch_id").collect()} == {0, 1}
