"""From Kafka-shaped records to decisions, on streams."""

from pyspark.sql import functions as F

from riskstream.functions.keys import strip_salt
from riskstream.operators import decisions, joins, model, silver
from riskstream.operators.bronze import to_bronze
from riskstream.operators.rolling import rolling_features
from riskstream.plans import inputs
from riskstream.plans.archive import _PAYLOAD
from riskstream.streaming.features import streaming_features
from riskstream.streaming.joins import join_feeds
from riskstream.streaming.publish import publish, read_latest
from riskstream.streaming.scoring import decide_stream
from tests.streaming.helpers import ONCE, add_file, read_files, records, write_files
from tests.streaming.test_features import assert_same, run, shown

NAMES = ["TransactionAmt", "card1_txn_count_24h", "card1_amt_sum_24h"]


def feed(spark, sf):
    """Records in time order, and one far in the future to settle the rest."""
    rows = inputs.kafka_records(spark, sf).where("offset < 300 and value is not null")
    last = '{"TransactionID":-1,"TransactionDT":1900000000.0,"card1":null}'
    flush = rows.limit(1).withColumn("value", F.lit(last).cast("binary"))
    return rows.persist(), flush


def test_salted_feed_equals_unsalted_feed(spark, sf, tmp_path):
    rows, flush = feed(spark, sf)
    plain = rows.withColumn("key", strip_salt(F.col("key").cast("string")).cast("binary"))
    assert rows.join(plain, ["offset", "key"], "left_anti").count() > 0
    found = {}
    for name, part in (("salted", rows), ("plain", plain)):
        source = str(tmp_path / f"{name}-in")
        write_files(part, source, F.col("offset"), 2)
        add_file(flush, source, "z")
        tx = silver.transactions(to_bronze(records(spark, source)), _PAYLOAD)
        out, _ = run(spark, streaming_features(tx), tmp_path, name)
        found[name] = shown(out.where("TransactionID >= 0"))
    batch = silver.transactions(to_bronze(rows), _PAYLOAD)
    expected = shown(rolling_features(batch.withColumn("us", F.unix_micros("event_time"))))
    assert len(expected) > 200
    assert_same(found["salted"], expected)
    assert_same(found["plain"], expected)


def test_decisions_end_to_end(spark, sf, tmp_path):
    batch = rolling_features(inputs.tx(spark, sf)).withColumn(
        "isFraud", (F.col("TransactionAmt") > 40).cast("int")
    )
    fitted = model.train(batch, NAMES, trees=3, depth=3)
    features = batch.where("TransactionID < 200").select("TransactionID", "card1", "us", *NAMES)
    write_files(features, str(tmp_path / "in"), F.col("us"), 2)
    listed = inputs.watchlist(spark, sf)

    def enrich(rows):
        return joins.flag_watchlist(rows, listed, {"account": F.col("card1").cast("string")})

    def decide(rows):
        return decisions.decide(
            rows,
            flag_at=0.5,
            block_at=0.9,
            factors={"score": F.col("score") >= 0.5, "watchlist": F.col("on_account_list")},
            snapshot=[*NAMES, "on_account_list"],
            block_when=F.col("on_account_list"),
        )

    path = str(tmp_path / "decisions")
    for checkpoint in ("c1", "c2"):  # the second run replays both batches
        decide_stream(
            read_files(spark, str(tmp_path / "in"), features.schema),
            fitted,
            enrich,
            decide,
            path,
            str(tmp_path / checkpoint),
            ONCE,
        ).awaitTermination()
    made = spark.read.parquet(path)
    assert made.count() == made.select("TransactionID").distinct().count() == 200
    same = made.select("TransactionID", "decision", "confidence", "factors", "snapshot")
    expected = decide(model.score(fitted, enrich(features))).select(*same.columns)
    assert same.exceptAll(expected).count() == 0
    assert {r.decision for r in made.select("decision").distinct().collect()} >= {"allow", "block"}
    # As of the first batch only its decisions are there.
    assert 0 < made.where("batch_id <= 0").count() < 200


def test_the_whole_path_with_a_restart_equals_the_batch(spark, sf, tmp_path):
    """Records, typed rows, identity join, rolling features, watchlists, score, decision, publish."""
    rows, flush = feed(spark, sf)
    parsed = silver.transactions(to_bronze(rows), _PAYLOAD).persist()
    matched = parsed.where("TransactionID % 2 = 0").selectExpr(
        "TransactionID",
        "concat('dev', TransactionID % 20) as DeviceInfo",
        "event_time + interval 5 seconds as event_time",
    )
    last = spark.sql(
        "select -1L as TransactionID, 'none' as DeviceInfo, timestamp_seconds(1900000000) as event_time"
    )
    tx_in, ident_in, joined = (str(tmp_path / n) for n in ("tx", "ident", "joined"))
    columns = ["card1", "TransactionID", "TransactionAmt", "M1", "event_time", "DeviceInfo"]
    training = rolling_features(inputs.tx(spark, sf)).withColumn(
        "isFraud", (F.col("TransactionAmt") > 40).cast("int")
    )
    fitted = model.train(training, NAMES, trees=2, depth=2)
    listed = inputs.watchlist(spark, sf)

    def enrich(part):
        kinds = {"account": F.col("card1").cast("string"), "device": F.col("DeviceInfo")}
        return joins.flag_watchlist(part, listed, kinds)

    def decide(part):
        on_list = F.col("on_account_list") | F.col("on_device_list")
        return decisions.decide(
            part,
            flag_at=0.5,
            block_at=0.9,
            factors={"score": F.col("score") >= 0.5, "watchlist": on_list},
            snapshot=[*NAMES, "M1", "DeviceInfo", "on_account_list", "on_device_list"],
            block_when=on_list,
        )

    def step():
        tx = silver.transactions(to_bronze(records(spark, tx_in)), _PAYLOAD)
        near = join_feeds(tx, read_files(spark, ident_in, matched.schema)).select(*columns)
        (
            near.writeStream.format("parquet")
            .option("path", joined)
            .option("checkpointLocation", str(tmp_path / "join-c"))
            .trigger(**ONCE)
            .start()
            .awaitTermination()
        )
        wide = spark.read.parquet(joined).schema

        def features():
            stream = spark.readStream.schema(wide).parquet(joined)
            return streaming_features(stream, keep=["M1", "DeviceInfo"])

        decide_stream(
            features(), fitted, enrich, decide, str(tmp_path / "out"), str(tmp_path / "decide-c"), ONCE
        ).awaitTermination()
        publish(
            features(), str(tmp_path / "history"), str(tmp_path / "latest"),
            str(tmp_path / "publish-c"), trigger=ONCE,
        ).awaitTermination()

    write_files(rows.where("offset < 150"), f"{tx_in}/a", F.col("offset"), 1)
    half = parsed.where("kafka_offset < 150").select("TransactionID")
    write_files(matched.join(half, "TransactionID").select(*matched.columns), f"{ident_in}/a", "event_time", 1)
    step()
    write_files(rows.where("offset >= 150"), f"{tx_in}/b", F.col("offset"), 1)
    rest = matched.join(half, "TransactionID", "left_anti").select(*matched.columns)
    write_files(rest, f"{ident_in}/b", "event_time", 1)
    add_file(flush, tx_in, "z")
    add_file(last, ident_in, "z")
    step()

    plain = parsed.join(matched.select("TransactionID", "DeviceInfo"), "TransactionID", "left")
    batch = rolling_features(plain.withColumn("us", F.unix_micros("event_time")))
    shown_columns = ["TransactionID", "decision", "confidence", "factors", "snapshot"]
    expected = decide(model.score(fitted, enrich(batch))).select(*shown_columns)
    made = spark.read.parquet(str(tmp_path / "out")).where("TransactionID >= 0").select(*shown_columns)
    assert made.count() == expected.count() > 200
    assert by_id(made) == by_id(expected)
    history = spark.read.parquet(str(tmp_path / "history")).where("TransactionID >= 0")
    assert history.count() == expected.count()
    newest = read_latest(spark, str(tmp_path / "latest"))
    assert newest.count() == batch.where("card1 is not null").select("card1").distinct().count()


def by_id(df):
    """Decisions by transaction, numbers of the snapshot to six digits."""

    def plain(value):
        if isinstance(value, float):
            return round(value, 6)
        if isinstance(value, (list, tuple)):
            return tuple(plain(v) for v in value)
        return value

    return {r["TransactionID"]: plain(tuple(r)) for r in df.collect()}
