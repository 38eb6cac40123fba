import glob

import pytest
from pyspark.sql import functions as F

from riskstream.plans import inputs
from riskstream.sources import sketches as module
from riskstream.sources import tables
from riskstream.sources.sketches import HourSketches
from riskstream.streaming.archive import append_new

SHARES = [0.0, 0.2, 0.5, 0.95, 1.0]


def wanted(spark, path, where="true"):
    rows = tables.read_archive(spark, path).where(where)
    return rows.agg(F.percentile(F.unix_millis("event_time"), F.array(*map(F.lit, SHARES)))).first()[0]


def test_quantiles_follow_appends_and_compaction(spark, sf, tmp_path):
    path = str(tmp_path / "archive")
    rows = inputs.bronze(spark, sf).persist()
    kept = HourSketches(spark, path)
    assert kept.quantiles(SHARES) == [None] * 5
    for part in range(3):
        append_new(rows.where(F.col("kafka_offset") % 3 == part), path, part)
        assert kept.quantiles(SHARES, max_rows=50) == pytest.approx(wanted(spark, path))
    tables.compact(spark, path)
    assert kept.quantiles(SHARES) == pytest.approx(wanted(spark, path))
    hours = sorted(r[0] for r in rows.select(F.date_format("event_time", "yyyy-MM-dd-HH")).distinct().collect() if r[0])
    first, last = hours[len(hours) // 3], hours[len(hours) // 2]
    inside = f"event_hour between '{first}' and '{last}'"
    assert kept.quantiles(SHARES, first, last) == pytest.approx(wanted(spark, path, inside))


def test_a_refresh_reads_new_commits_alone_and_folders_are_folded(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "MOST_FOLDERS", 2)
    path = str(tmp_path / "archive")
    rows = inputs.bronze(spark, sf).where("kafka_offset < 200").persist()
    kept = HourSketches(spark, path)
    for part in range(6):
        append_new(rows.where(F.col("kafka_offset") % 6 == part), path, part)
        kept.refresh()
        before = kept.state()
        kept.refresh()  # nothing new: nothing written
        assert kept.state() == before
        assert 1 <= len(before["folders"]) <= 2
    # What counts and what the last fold replaced.
    assert len(glob.glob(f"{path}/_sketches/event_time/*/_SUCCESS")) <= 4
    timed = rows.where("event_time is not null").count()
    assert kept._stored(kept.state()["folders"]).agg(F.sum("n")).first()[0] == timed
    assert kept.quantiles(SHARES) == pytest.approx(wanted(spark, path))


def test_what_a_dead_refresh_left_is_not_read(spark, sf, tmp_path):
    path = str(tmp_path / "archive")
    append_new(inputs.bronze(spark, sf).where("kafka_offset < 100"), path, 0)
    kept = HourSketches(spark, path)
    kept.refresh()
    first = kept.state()["folders"][0]
    spark.read.parquet(first).write.parquet(f"{path}/_sketches/event_time/left-over")
    assert kept.quantiles(SHARES) == pytest.approx(wanted(spark, path))
    assert tables.read_archive(spark, path).count() == 100
