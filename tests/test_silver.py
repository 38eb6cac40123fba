from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schemas
from riskstream.operators import schema_audit, silver
from riskstream.operators.schema_audit import ProposedField

SCHEMA = T.StructType(
    [
        T.StructField("TransactionID", T.LongType(), False),
        T.StructField("card1", T.DoubleType()),
        T.StructField("M1", T.StringType()),
        T.StructField("V1", T.DoubleType()),
    ]
)


def parsed(spark, *texts, schema=SCHEMA):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, kafka_value string")
    rows = silver.parse(df, schema).orderBy("i").collect()
    return [(r.TransactionID, r.card1, r.M1, r.V1, r.valid) for r in rows]


def test_wrapped_and_plain_agree(spark):
    wrapped = '{"TransactionID":1,"card1":{"double":7.0},"M1":{"string":"T"},"V1":null}'
    plain = '{"V1":null,"M1":"T","card1":7.0,"TransactionID":1}'
    assert parsed(spark, wrapped, plain) == [(1, 7.0, "T", None, True)] * 2


def test_widened_types_and_missing_fields(spark):
    texts = ['{"TransactionID":1,"card1":{"long":7},"extra":5}', '{"card1":{"int":7}}', '{"Trans', None]
    assert parsed(spark, *texts) == [
        (1, 7.0, None, None, True),
        (None, 7.0, None, None, False),
        (None, None, None, None, False),
        (None, None, None, None, False),
    ]


def test_text_that_looks_wrapped_stays_text(spark):
    text = r'{"TransactionID":1,"M1":"{\"string\":\"x\"}","card1":"NaN"}'
    assert parsed(spark, text) == [(1, None, '{"string":"x"}', None, True)]


def test_mixed_wrapping_in_one_record(spark):
    text = '{"TransactionID": 1, "card1": {"double": 2.5}, "M1": "plain", "V1": 3}'
    assert parsed(spark, text) == [(1, 2.5, "plain", 3.0, True)]


def test_full_transaction_schema(spark):
    df = spark.createDataFrame(
        [('{"TransactionID":1,"TransactionDT":5.0,"V339":{"double":1.5},"M9":{"string":"F"}}',)],
        "kafka_value string",
    )
    row = silver.parse(df, schemas.transaction()).first()
    assert (row.TransactionDT, row.V339, row.M9, row.V1, row.valid) == (5.0, 1.5, "F", None, True)


def test_union_versions(spark):
    one = spark.createDataFrame([(1, 2.0)], "id long, a double")
    two = spark.createDataFrame([("x", 2)], "b string, id long")
    rows = silver.union_versions(one, two).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 2.0, None), (2, None, "x")]


def test_profile(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "True", "True", None, "a", "1"), ("2", "-2e3", "False", None, None, "1", None)],
        "id string, n string, t string, tn string, empty string, mixed string, gap string",
    )
    found = {
        r.field: (r.type, r.nullable, r.n_nulls)
        for r in schema_audit.profile(df, ["id"], {"id": "long"}).collect()
    }
    assert found == {
        "id": ("long", False, 0),
        "n": ("double", True, 0),
        "t": ("double", True, 0),
        "tn": ("string", True, 1),
        "empty": ("double", True, 2),
        "mixed": ("string", True, 0),
        "gap": ("double", True, 1),
    }
    schema = schema_audit.schema_from_profile(schema_audit.profile(df, ["id"], {"id": "long"}))
    assert schema.names[0] == "id" and not schema["id"].nullable


def test_drift_follows_the_compatibility_rules(spark):
    df = spark.createDataFrame(
        [
            ("1", '{"id":1,"amt":{"double":1.5}}'),
            ("1", '{"id":2,"amt":null}'),
            ("2", '{"id":"x","amt":2.5,"new":1.0}'),
            (None, '{"id":3}'),
        ],
        "schema_version string, kafka_value string",
    )
    proposed = [
        ProposedField("id", "long", nullable=False, has_default=False),
        ProposedField("amt", "double", nullable=False),
        ProposedField("new", has_default=False),
    ]
    found = {
        (r.schema_version, r.field): (r.n_rows, r.n_missing, r.n_null, r.n_mistyped, r.readable)
        for r in schema_audit.drift(df, proposed).collect()
    }
    assert found[("1", "id")] == (2, 0, 0, 0, True)
    assert found[("1", "amt")] == (2, 0, 1, 0, False)  # null into a non-nullable field
    assert found[("1", "new")] == (2, 2, 0, 0, False)  # required, absent, no default
    assert found[("2", "id")] == (1, 0, 0, 1, False)  # text into a number
    assert found[("2", "new")] == (1, 0, 0, 0, True)
    assert found[(None, "amt")] == (1, 0, 0, 0, True)  # absent, but has a default
    assert len(found) == 9


def test_json_is_read_once_per_form(spark):
    df = spark.createDataFrame([("{}",)], "kafka_value string")
    plan = silver.parse(df, SCHEMA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") + df._jdf.queryExecution(
    ).optimizedPlan().toString().count("LogicalRDD")


def test_versions_are_read_in_one_scan_whatever_their_number(spark):
    def schema(n):
        kind = [T.LongType(), T.DoubleType(), T.StringType()][n % 3]
        return T.StructType(
            [T.StructField("id", T.LongType(), False), T.StructField(f"f{n % 7}", T.DoubleType()),
             T.StructField("changing", kind, n % 4 != 0)]
        )

    texts = ['{"id": %d, "f%d": 1.5, "changing": 7}' % (i, i % 7) for i in range(60)]
    texts += ['{"id": %d, "f3": {"double": 2.5}, "changing": {"string": "x"}}' % i for i in range(60)]
    texts += ['{"id": 1, "changing": 7.25}', '{"f1": 1}', "broken", None, '{"id": 5, "f2": "NaN", "changing": "t"}'] * 8
    rows = [(str(i % 45) if i % 11 else None, t) for i, t in enumerate(texts)]
    bronze = spark.createDataFrame(rows, "schema_version string, kafka_value string")
    for n in (4, 40):
        versions = {str(i): schema(i) for i in range(n)}
        merged = silver.parse_versions(bronze, versions, "2")
        assert _scans(merged) == 1
        own = F.when(F.col("schema_version").isin(list(versions)), F.col("schema_version")).otherwise("2")
        parts = [silver.parse(bronze.where(own == v), s) for v, s in versions.items()]
        expected = silver.union_versions(*[p.withColumn("changing", F.col("changing").cast("string")) for p in parts])
        columns = sorted(expected.columns)
        found, wanted = (sorted(map(str, df.select(*columns).collect())) for df in (merged, expected))
        assert found == wanted
