"""Ordered steps on new and late files give the rows of one run over everything, and leave all other files alone."""

import os
import random
from datetime import datetime, timedelta

import pytest

from sensorpipe.operators import resample as resampling
from sensorpipe.operators.clean import clean
from sensorpipe.operators.resample import resample
from sensorpipe.streaming import ordered

RULES = {"m0": {"type": "float", "min": 0, "max": 20, "max_diff": 5}, "m1": {"type": "float", "max_diff": 4}}
START = datetime(2026, 1, 1, 7)


def wide(spark, seed, days, n, devices=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = rng.choice(days)
        at = None if rng.random() < 0.03 else START + timedelta(days=day, minutes=rng.randrange(0, 900, 30))
        rows.append((f"d{rng.randrange(devices)}", at, rng.choice([None, float(rng.randrange(25))]), float(rng.randrange(12)), seed * 1000 + i))
    return spark.createDataFrame(rows, "device_id string, ts timestamp_ntz, m0 double, m1 double, seq long")


def long(spark, seed, days, n, devices=3, unit="u"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if rng.random() < 0.02 else START + timedelta(days=rng.choice(days), seconds=rng.randrange(0, 50_000, 100))
        value = None if rng.random() < 0.2 else float(rng.randrange(100))
        rows.append((at, f"d{rng.randrange(devices)}", rng.choice(["a", "b"]), value, unit, rng.choice(["x", None]), rng.randrange(3), seed * 1000 + i))
    return spark.createDataFrame(rows, "ts timestamp_ntz, device_id string, metric string, value double, unit string, domain string, quality_flag long, seq long")


def files(target):
    return {os.path.relpath(os.path.join(at, f), target): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(target) for f in names if f.endswith(".parquet")}


DROPS = [([3, 4, 5], 60), ([6, 10], 30), ([1, 4, 12], 20), ([], 0), ([10], 1)]


@pytest.mark.parametrize("tie", [["seq"], None])
def test_clean(spark, tmp_path, rows, tie):
    target, base, seen = f"{tmp_path}/target", f"{tmp_path}/base", None
    for number, (days, n) in enumerate(DROPS):
        batch = wide(spark, number, days, n)
        seen = batch if seen is None else seen.unionByName(batch)
        ordered.merge_clean(batch, number, RULES, target, base, tie=tie, buckets=3)
        want = clean(seen, RULES, keys=["device_id"], tie=tie)
        assert rows(ordered.result(spark, target), *want.columns) == rows(want)


@pytest.mark.parametrize("options", [
    {"freq": "1h"}, {"freq": "7h", "interpolation": "forward"}, {"freq": "50h"}, {"freq": "30m", "by_day": True},
    {"freq": "1h", "by_day": True, "interpolation": "linear", "day_anchor": "midnight"},
])
def test_resample(spark, tmp_path, rows, options):
    target, base, seen = f"{tmp_path}/target", f"{tmp_path}/base", None
    for number, (days, n) in enumerate(DROPS):
        batch = long(spark, number, days, n, unit="v" if number == 3 else "u")
        seen = batch if seen is None else seen.unionByName(batch)
        ordered.merge_resample(batch, number, options["freq"], target, base, tie=["seq"], buckets=2, **{k: v for k, v in options.items() if k != "freq"})
        want = resample(seen, options["freq"], tie=["seq"], **{k: v for k, v in options.items() if k != "freq"})
        assert rows(ordered.result(spark, target), *want.columns) == rows(want), number


def test_a_late_file_rewrites_only_what_it_affects(spark, tmp_path):
    target, base = f"{tmp_path}/target", f"{tmp_path}/base"
    first = [(START + timedelta(days=d), f"d{k}", "a", float(d), "", "x", 0) for d in range(10) for k in range(8)]
    schema = "ts timestamp_ntz, device_id string, metric string, value double, unit string, domain string, quality_flag long"
    ordered.merge_resample(spark.createDataFrame(first, schema), 0, "6h", target, base, buckets=4)
    before = files(target)
    late = spark.createDataFrame([(START + timedelta(days=4, hours=3), "d1", "a", 5.0, "", "x", 0)], schema)
    ordered.merge_resample(late, 1, "6h", target, base, buckets=4)
    after = files(target)
    changed = {os.path.dirname(f) for f in after if before.get(f) != after[f]}
    # Up to the day of the next observation, in one bucket.
    assert {c.split("/")[0] for c in changed} == {"part_day=2026-01-05", "part_day=2026-01-06"} and len({c.split("/")[1] for c in changed}) == 1
    assert {os.path.dirname(f) for f in before} == {os.path.dirname(f) for f in after}


@pytest.mark.parametrize("fails", ["rows", "plans", "states", "target"])
def test_a_batch_that_broke_off_can_run_again(spark, tmp_path, rows, monkeypatch, fails):
    target, base = f"{tmp_path}/target", f"{tmp_path}/base"
    drops = [long(spark, 0, [3, 4], 40), long(spark, 1, [1, 6], 20)]
    ordered.merge_resample(drops[0], 0, "1h", target, base, buckets=2)
    write, exists = ordered.overwrite_partitions, ordered.table_exists

    def broken(df, path, *args):
        write(df, path, *args)
        if path.endswith(fails):
            raise RuntimeError("lost")

    def broken_plan(spark, path):
        if path.endswith("_done") and fails == "plans":
            raise RuntimeError("lost")
        return exists(spark, path)

    monkeypatch.setattr(ordered, "overwrite_partitions", broken)
    monkeypatch.setattr(ordered, "table_exists", broken_plan)
    with pytest.raises(RuntimeError):
        ordered.merge_resample(drops[1], 1, "1h", target, base, buckets=2)
    monkeypatch.undo()
    ordered.merge_resample(drops[1], 1, "1h", target, base, buckets=2)
    want = resample(drops[0].unionByName(drops[1]), "1h")
    assert rows(ordered.result(spark, target), *want.columns) == rows(want)


def test_what_cannot_be_carried_raises(spark, tmp_path):
    batch = long(spark, 0, [1], 3)
    for options in ({"freq": "1h", "interpolation": "linear"}, {"freq": "1mo", "by_day": True}):
        with pytest.raises(ValueError):
            ordered.merge_resample(batch, 0, options.pop("freq"), f"{tmp_path}/t", f"{tmp_path}/b", **options)


def test_cells_are_unrolled_after_the_shuffle_of_the_write(spark, tmp_path, monkeypatch):
    """Blocks of cells are rebalanced by day and bucket, their cells are not; and a series has one head, not one a day."""
    write, plans, heads = ordered.overwrite_partitions, [], []

    def looked_at(df, path, *args):
        if path.endswith("target"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, *args)

    intervals = resampling._intervals
    monkeypatch.setattr(ordered, "overwrite_partitions", looked_at)
    monkeypatch.setattr(resampling, "_intervals", lambda observed, bounds, *args: heads.append(bounds.count()) or intervals(observed, bounds, *args))
    batch = long(spark, 0, [1, 2, 3, 4], 60)
    ordered.merge_resample(batch, 0, "1h", f"{tmp_path}/target", f"{tmp_path}/base", buckets=2)
    cells, rest = plans[0].split("Generate explode(sequence", 1)
    assert "Exchange" not in cells and "REBALANCE" in rest
    assert heads == [batch.filter("ts IS NOT NULL").select("device_id", "domain", "metric").distinct().count()]


def test_resample_of_series_in_slices(spark, tmp_path, rows):
    """Series far above what a task may hold, of which later batches affect some days only."""
    target, base, seen = f"{tmp_path}/target", f"{tmp_path}/base", None
    for number, (days, n) in enumerate([([3, 4, 5], 60), ([9, 10], 30), ([4], 2)]):
        batch = long(spark, number, days, n)
        seen = batch if seen is None else seen.unionByName(batch)
        ordered.merge_resample(batch, number, "5h", target, base, tie=["seq"], buckets=2, rows_per_task=4)
        want = resample(seen, "5h", tie=["seq"])
        assert rows(ordered.result(spark, target), *want.columns) == rows(want), number
