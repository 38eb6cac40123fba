import os
import subprocess
import sys
import uuid
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream import schemas
from riskstream.session import Scratch, written
from riskstream.sources import files, tables


def test_na_tokens_and_whole_numbers(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,card1,name\n1,10086.0,NA\n2,,null\n3,x,ok\n")
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("card1", T.LongType()),
            T.StructField("name", T.StringType()),
        ]
    )
    rows = files.read_csv(spark, str(path), schema).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, 10086, None), (2, None, None), (3, None, "ok")]


def test_csv_sink_has_a_header(spark, tmp_path):
    out = str(tmp_path / "out")
    files.write_csv(spark.createDataFrame([(1, "a")], "id int, name string"), out)
    assert spark.read.csv(out, header=True).columns == ["id", "name"]


def test_bootstrap_is_idempotent(spark, tmp_path):
    name = f"raw.t_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.ensure_table(spark, name, str(tmp_path / "table"))
    assert spark.table(name).columns == schemas.ARCHIVE.names


def test_written_table_knows_its_size(spark):
    small = written(spark.range(100).selectExpr("id % 7 as k").distinct(), "small")
    plan = spark.range(1000).selectExpr("id as k").join(small, "k", "left")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def row_type(field):
    return F.col(field.name).cast(field.dataType).alias(field.name)


def test_hour_limits_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "archive")
    row = spark.range(1).selectExpr(
        *["'x'" if f.dataType == T.StringType() else "null" for f in schemas.ARCHIVE.fields]
    )
    row = row.toDF(*schemas.ARCHIVE.names).select(
        *[row_type(f) for f in schemas.ARCHIVE.fields]
    )
    row.write.partitionBy("event_hour").parquet(path)
    plan = tables.read_archive(spark, path, "2024-01-01 05:30:00", "2024-01-01 07:00:00")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_hour" in text
    assert "event_hour#" in text.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_scratch_removes_what_nothing_reads(spark):
    def there(table):
        return [f for f in table.inputFiles() if os.path.exists(f.removeprefix("file://"))]

    with Scratch() as outer:
        kept = written(spark.range(3), "kept")
        with Scratch() as inner:
            gone, used = written(spark.range(4), "gone"), written(spark.range(5), "used")
            files = gone.inputFiles()
            lazy = used.join(kept, "id")
            inner.remove(but=lazy)
            assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
        assert there(used) and lazy.count() == 3
        outer.remove(but=kept)
        assert not there(used) and kept.count() == 3
    after = written(spark.range(2), "after")
    outer.remove()
    assert not there(kept) and there(after)


def test_a_written_table_leaves_no_shuffle_files(tmp_path):
    """In a session with a folder of its own, so that no other test's files are counted."""
    code = """
import pathlib, sys, time
from riskstream.session import build_session, written
folder = pathlib.Path(sys.argv[1])
conf = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.shuffle.partitions": "4",
        "spark.local.dir": str(folder / "local"), "spark.checkpoint.dir": str(folder / "shared")}
spark = build_session("shuffles", "local[2]", conf)
name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
before = spark.conf.get(name)
rows = written(spark.range(100_000).selectExpr("id % 5000 as k").groupBy("k").count(), "t")
left = lambda: len([*(folder / "local").rglob("shuffle_*.data")])
for _ in range(40):
    if left():
        time.sleep(0.25)
print("LEFT", left(), spark.conf.get(name) == before, rows.count())
spark.stop()
"""
    (tmp_path / "local").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "SPARK_LOCAL_DIRS"}
    env["PYTHONPATH"] = str(Path(__file__).parents[1])
    done = subprocess.run(
        [sys.executable, "-c", code, str(tmp_path)], env=env, capture_output=True, text=True, timeout=120
    )
    assert "LEFT 0 True 5000" in done.stdout, done.stdout + done.stderr[-2000:]
