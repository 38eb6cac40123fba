import glob

import pytest
from pyspark.sql import functions as F

from riskstream.functions.keys import salt_keys
from riskstream.operators.joins import join_within
from riskstream.plans import inputs
from riskstream.session import shared_dir
from riskstream.streaming.joins import RefreshingTable, enrich_stream, join_feeds
from riskstream.streaming.publish import LatestStore, latest_per_key, publish, read_latest
from tests.streaming.helpers import ONCE, add_file, read_files, write_files


def start(stream, out, checkpoint):
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()


def test_feed_join_equals_its_batch_twin(spark, sf, tmp_path):
    tx = inputs.tx(spark, sf).where("TransactionID < 400").select("TransactionID", "us", "card1")
    identities = inputs.identities(spark, sf).where("TransactionID < 400")
    left = tx.withColumn("event_time", F.timestamp_micros("us")).persist()
    right = identities.withColumn("event_time", F.timestamp_micros("identity_us")).persist()
    write_files(left, str(tmp_path / "tx"), F.col("us"), 3)
    write_files(right, str(tmp_path / "ident"), F.col("identity_us"), 3)
    # A row far in the future on both sides settles the transactions without identity.
    future = F.timestamp_micros(F.lit(1_900_000_000_000_000))
    add_file(left.limit(1).withColumns({"TransactionID": F.lit(-1).cast("bigint"), "event_time": future}), str(tmp_path / "tx"), "z")
    add_file(right.limit(1).withColumns({"TransactionID": F.lit(-2).cast("bigint"), "event_time": future}), str(tmp_path / "ident"), "z")
    joined = join_feeds(
        read_files(spark, str(tmp_path / "tx"), left.schema),
        read_files(spark, str(tmp_path / "ident"), right.schema),
        before="20 seconds",
        after="20 seconds",
    )
    start(joined, str(tmp_path / "out"), str(tmp_path / "c"))
    columns = ["TransactionID", "us", "card1", "identity_us", "id_01", "DeviceInfo"]
    found = spark.read.parquet(str(tmp_path / "out")).where("TransactionID >= 0").select(*columns)
    expected = join_within(tx, identities, 20, 20).select(*columns)
    assert found.count() == 400
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
    assert 0 < found.where("DeviceInfo is not null").count() < 400


def test_reference_refresh_is_seen_by_the_next_batch(spark, sf, tmp_path):
    rows = inputs.tx(spark, sf).where("TransactionID < 20").select("TransactionID", "card1", "ProductCD")
    write_files(rows, str(tmp_path / "in"), F.col("TransactionID"), 2)
    users = spark.createDataFrame([(1, "x")], "card1 long, card4 string")
    rates = [0.1]

    def merchants():
        codes = [r[0] for r in rows.select("ProductCD").distinct().collect()]
        return spark.createDataFrame([(c, rates[-1]) for c in codes], "ProductCD string, fraud_rate double")

    seen = []

    def write(batch, batch_id):
        seen.append({r.fraud_rate for r in batch.collect()})
        rates.append(0.2)  # the table is refreshed between batches

    query = enrich_stream(
        read_files(spark, str(tmp_path / "in"), rows.schema),
        lambda: users,
        merchants,
        write,
        str(tmp_path / "c"),
        ONCE,
    )
    query.awaitTermination()
    assert seen == [{0.1}, {0.2}]


def test_a_failed_refresh_keeps_the_tracked_keys(spark, sf, tmp_path):
    path = str(tmp_path / "hot")
    table = RefreshingTable(
        lambda: spark.read.schema("key string").parquet(path),
        spark.createDataFrame([], "key string"),
    )
    assert table.get().count() == 0  # no file yet
    spark.createDataFrame([("7",)], "key string").write.parquet(path)
    assert [r.key for r in table.get().collect()] == ["7"]
    broken = RefreshingTable(table._read, spark.createDataFrame([("8",)], "key string"))
    broken._read = lambda: spark.read.schema("key string").parquet(str(tmp_path / "missing"))
    assert [r.key for r in broken.get().collect()] == ["8"]


def test_salting_follows_the_refreshed_set(spark, sf, tmp_path):
    rows = inputs.tx(spark, sf).where("TransactionID < 200").select(
        "TransactionID", F.col("card1").cast("string").alias("card")
    )
    write_files(rows, str(tmp_path / "in"), F.col("TransactionID"), 2)
    path = str(tmp_path / "hot")
    table = RefreshingTable(
        lambda: spark.read.schema("key string").parquet(path),
        spark.createDataFrame([], "key string"),
    )
    salted = []

    def batch(df, batch_id):
        out = salt_keys(df, "card", table.get(), F.pmod("TransactionID", F.lit(4)), "salted")
        salted.append({r.card for r in out.where("salted <> card").collect()})
        if batch_id == 0:
            spark.createDataFrame([("3",)], "key string").write.parquet(path)

    query = (
        read_files(spark, str(tmp_path / "in"), rows.schema)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    assert salted == [set(), {"3"}]


def test_history_and_latest_agree(spark, sf, tmp_path):
    rows = inputs.tx(spark, sf).where("TransactionID < 300").select(
        "TransactionID", "us", "card1", "TransactionAmt"
    )
    write_files(rows, str(tmp_path / "in"), F.col("us"), 3)
    history, latest = str(tmp_path / "history"), str(tmp_path / "latest")

    def run(checkpoint):
        publish(
            read_files(spark, str(tmp_path / "in"), rows.schema), history, latest, checkpoint, trigger=ONCE
        ).awaitTermination()

    run(str(tmp_path / "c1"))
    run(str(tmp_path / "c2"))  # the same batches under a new checkpoint replace themselves
    stored = spark.read.parquet(history).drop("batch_id")
    assert stored.count() == 300
    expected = latest_per_key(stored)
    found = read_latest(spark, latest).select(*expected.columns)
    assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()
    as_of = read_latest(spark, latest, batch_id=0, history=history)
    assert as_of.count() == latest_per_key(spark.read.parquet(f"{history}/batch_id=0")).count()


def batches_of(spark, n):
    schema = "card1 long, us long, TransactionID long, v string"
    for i in range(n):
        rows = [(c, 100 * i + c % 3, 1000 * i + c, f"{i}-{c}") for c in range(i % 5, 40, 1 + i % 7)]
        yield spark.createDataFrame([*rows, (None, i, i, "no card")], schema).coalesce(1)


def test_the_latest_table_does_not_grow_with_batches(spark, tmp_path):
    store = LatestStore(spark, str(tmp_path / "latest"), fan=3, levels=3, buckets=2)
    every, most = None, 0
    for batch in batches_of(spark, 20):
        every = batch if every is None else every.union(batch)
        store.add(batch)
        runs = [run for level in store.state()["levels"] for run in level]
        most = max(most, len(runs))
        assert len(glob.glob(f"{tmp_path}/latest/run-*")) <= len(runs) + 3 * 3
    assert most <= 2 + 2 + 1
    assert len(store.read().inputFiles()) <= most * 2
    found = store.read()
    expected = latest_per_key(every)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select(*found.columns).collect()))
    assert store.vacuum() == 0


def test_a_fold_that_dies_changes_nothing_and_is_done_again(spark, tmp_path, monkeypatch):
    store = LatestStore(spark, str(tmp_path / "latest"), fan=2, levels=3, buckets=2)
    batches = list(batches_of(spark, 6))
    for batch in batches[:3]:
        store.add(batch)
    before = store.state()

    def die(*_):
        raise OSError("the writer died")

    for broken in ("change", "_write_run"):
        monkeypatch.setattr(LatestStore, broken, die)
        with pytest.raises(OSError):
            store.add(batches[3])
        monkeypatch.undo()
        assert store.state() == before
    assert store.read().count() == latest_per_key(batches[0].union(batches[1]).union(batches[2])).count()
    for batch in batches[3:]:
        store.add(batch)
        store.add(batch)  # run again after the pointer had moved
    every = batches[0]
    for batch in batches[1:]:
        every = every.union(batch)
    found = store.read()
    expected = latest_per_key(every).select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert store.vacuum() > 0
    assert found.count() == expected.count()


def test_a_quiet_lookup_is_not_copied_again(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(5).write.parquet(path)
    folders = f"{shared_dir(spark)}/riskstream/lookup-*"
    before = set(glob.glob(folders))
    table = RefreshingTable(lambda: spark.read.schema("id long").parquet(path), spark.range(0))
    for _ in range(30):
        assert table.get().count() == 5
    assert len(set(glob.glob(folders)) - before) == 1
    for n in range(6, 10):
        spark.range(n).write.mode("overwrite").parquet(path)
        assert table.get().count() == table.get().count() == n
    assert len(set(glob.glob(folders)) - before) == 2


def test_a_quiet_feed_publishes_nothing_and_goes_on(spark, sf, tmp_path):
    rows = inputs.tx(spark, sf).where("TransactionID < 50").select(
        "TransactionID", "us", "card1", "TransactionAmt"
    )
    rows.limit(0).write.parquet(str(tmp_path / "in" / "a"))
    history, latest = str(tmp_path / "history"), str(tmp_path / "latest")

    def run():
        feed = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in" / "*"))
        publish(feed, history, latest, str(tmp_path / "c"), trigger=ONCE).awaitTermination()

    run()
    rows.write.parquet(str(tmp_path / "in" / "b"))
    run()
    assert spark.read.parquet(history).count() == 50
    assert read_latest(spark, latest).count() == latest_per_key(rows).count()


def test_an_overwritten_unreadable_table_keeps_the_old_keys(spark, tmp_path):
    path = tmp_path / "keys"

    def read():
        return spark.read.schema("key string").parquet(str(path))

    table = RefreshingTable(read, spark.createDataFrame([], "key string"))
    assert table.get().count() == 0  # no table yet
    spark.createDataFrame([("3",)], "key string").write.parquet(str(path))
    assert [r.key for r in table.get().collect()] == ["3"]
    for part in path.glob("part-*"):
        part.write_bytes(b"no table")
    for crc in path.glob(".part-*"):
        crc.unlink()
    assert [r.key for r in table.get().collect()] == ["3"]
    spark.createDataFrame([("7",)], "key string").write.mode("overwrite").parquet(str(path))
    assert [r.key for r in table.get().collect()] == ["7"]
