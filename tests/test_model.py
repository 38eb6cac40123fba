import pytest
from pyspark.sql import functions as F

from riskstream.operators import decisions, model
from riskstream.operators.rolling import rolling_features
from riskstream.plans import inputs


def test_codes_fit_on_training_values_only(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    test = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    coded = model.encode(test, model.fit_codes(train, ["c"])).collect()
    assert {r.c: r.c_code for r in coded} == {"a": 0, "b": 1, "new": -1, None: -1}


def test_split_puts_a_row_without_time_nowhere(spark):
    df = spark.createDataFrame([(i,) for i in range(11)] + [(None,)], "us long")
    train, test, border = model.time_split(df)
    assert (train.count(), test.count(), border) == (9, 2, 8.0)


def test_class_ratio_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "isFraud int")
    assert tuple(model.class_ratio(df).first()) == (2, 0, None)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "y int, p int")
    row = model.evaluate(df, F.col("y"), F.col("p")).first()
    assert (row.tp, row.fp, row.fn) == (2, 1, 1)
    assert row.precision == row.recall == row.f1 == pytest.approx(2 / 3)
    none = model.evaluate(df.where("y = 0 and p = 0"), F.col("y"), F.col("p")).first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)


def test_train_and_score_end_to_end(spark, sf, tmp_path):
    rows = rolling_features(inputs.tx(spark, sf)).withColumn(
        "isFraud", (F.col("TransactionAmt") > 40).cast("int")
    )
    train, test, _ = model.time_split(rows)
    codes = model.fit_codes(train, ["ProductCD"])
    names = ["TransactionAmt", "card1_txn_count_24h", "card1_amt_std_24h", "ProductCD_code"]
    fitted = model.train(model.encode(train, codes), names, trees=3, depth=3)
    scored = model.score(fitted, model.encode(test, codes))
    result = model.evaluate(scored, F.col("isFraud"), F.col("prediction")).first()
    assert scored.count() == test.count()
    assert result.f1 > 0.9
    from pyspark.ml import PipelineModel

    fitted.save(str(tmp_path / "model"))
    again = model.score(PipelineModel.load(str(tmp_path / "model")), model.encode(test, codes))
    assert again.agg(F.sum("score")).first()[0] == pytest.approx(scored.agg(F.sum("score")).first()[0])


def test_decisions(spark):
    df = spark.createDataFrame(
        [(1, 0.1, False), (2, 0.5, False), (3, 0.9, False), (4, 0.1, True), (5, None, None)],
        "id int, score double, listed boolean",
    )
    made = decisions.decide(
        df,
        flag_at=0.5,
        block_at=0.9,
        factors={"score": F.col("score") >= 0.5, "watchlist": F.col("listed")},
        snapshot=["score", "listed"],
        block_when=F.col("listed"),
    )
    rows = {r.id: r for r in made.collect()}
    assert [rows[i].decision for i in range(1, 6)] == ["allow", "flag", "block", "block", "flag"]
    assert rows[1].confidence == 0.9 and rows[4].confidence == 1.0 and rows[5].confidence is None
    assert [[f.name for f in rows[i].factors] for i in range(1, 6)] == [
        [], ["score"], ["score"], ["watchlist"], []
    ]
    assert rows[3].snapshot.score == 0.9 and rows[3].snapshot.listed is False


def test_positional_names(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert model.positional(df).columns == ["f0", "f1"]
