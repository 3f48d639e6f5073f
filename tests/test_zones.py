"""Reads over a range open only the files that hold some of it, and give what pruning everything gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators.select import prune_overlap
from sensorpipe.sinks import tables, zones

START = datetime(2026, 1, 1)


def made(spark, seed, n, days):
    rng = random.Random(seed)
    rows = [(f"d {k}%+é" if k else None, None if rng.random() < 0.05 else START + timedelta(days=rng.choice(days), minutes=rng.randrange(1440)), i) for i in range(n) for k in [rng.randrange(4)]]
    frame = spark.createDataFrame(rows, "device_id string, ts timestamp_ntz, seq long")
    return frame.withColumn("day", F.to_date("ts"))


@pytest.mark.parametrize("start,end", [("2026-01-03T12:00:00Z", "2026-01-04T01:00:00Z"), ("2026-01-06", None), (None, "2026-01-02"), ("2030-01-01", "2031-01-01"), (None, None)])
@pytest.mark.parametrize("by", [["device_id", "day"], ["device_id"]])
def test_same_rows_from_fewer_files(spark, tmp_path, rows, start, end, by):
    path = f"{tmp_path}/stage"
    tables.write_dataset(made(spark, 1, 200, range(8)).repartition(3), path, partition_by=["day"])
    zones.refresh(spark, path, "ts", by)
    # Files that come later have no zone yet.
    tables.write_dataset(made(spark, 2, 60, [2, 9]), path, partition_by=["day"])
    whole = spark.read.parquet(path)
    got = zones.read_overlapping(spark, path, start, end, by=by)
    assert got.columns == whole.columns
    assert rows(got) == rows(prune_overlap(whole, start, end, by=by))
    if start == "2026-01-03T12:00:00Z" and by[-1] == "day":
        opened = [f for f in got.inputFiles() if "/_zones/" not in f]
        assert 0 < len(opened) < len(whole.inputFiles()) / 2


def test_only_new_files_are_looked_at(spark, tmp_path):
    path = f"{tmp_path}/stage"
    tables.write_dataset(made(spark, 3, 80, [0, 1]), path, partition_by=["day"])
    first = zones.refresh(spark, path, "ts", ["device_id", "day"]).count()
    kept = spark.read.parquet(zones.zones_path(path, "ts", ["device_id", "day"]))
    assert kept.count() == first == zones.refresh(spark, path, "ts", ["device_id", "day"]).count()
    tables.overwrite_partitions(made(spark, 4, 20, [1]).filter("day IS NOT NULL"), path, ["day"])
    after = zones.refresh(spark, path, "ts", ["device_id", "day"])
    # Zones of replaced files are left out; the data's readers see none of them.
    assert {r.zone_file for r in after.collect()} == set(zones._files(spark.read.parquet(path)))
    assert after.agg(F.sum("zone_rows")).first()[0] == spark.read.parquet(path).count()


def test_nothing_written_yet(spark, tmp_path):
    path = f"{tmp_path}/stage"
    tables.write_dataset(made(spark, 5, 0, [0]), path)
    assert zones.refresh(spark, path, "ts", ["device_id"]).count() == 0
    assert zones.read_overlapping(spark, path, "2026-01-01", None, by=["device_id"]).count() == 0
