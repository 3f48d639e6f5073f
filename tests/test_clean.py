"""Cleaning rules, against tables worked out by hand."""

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators.clean import clean, rules_fill_drop
from sensorpipe.operators.dedup import dedup, limit_rows
from sensorpipe.operators.fill import fill_both_ways, interpolate

RULES = {"m0": {"type": "int", "min": 2, "max": 30, "max_diff": 6}, "m1": {"max_diff": 1}}
TEXTS = ["7", "15", "8", "41", "8", None, "x", "30"]
CLEANED = [7, None, None, None, 8, None, None, 30]
DOCUMENTED = [0, 2, 2, 3, 0, 1, 4, 0]
AS_CODED = [0, 1, 1, 1, 0, 1, 1, 0]


@pytest.fixture(scope="module")
def frame(spark):
    data = [(i, "d", t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(data, "ts long, device_id string, m0 string")


@pytest.mark.parametrize("mode,flags", [("documented", DOCUMENTED), ("as_coded", AS_CODED)])
def test_rules_and_flags(frame, mode, flags):
    out = clean(frame, RULES, keys=["device_id"], flag_mode=mode).orderBy("ts").collect()
    assert [r["m0"] for r in out] == CLEANED
    assert [r["quality_flag"] for r in out] == flags


def test_no_flag_and_unknown_mode(frame):
    assert clean(frame, RULES, keys=["device_id"], add_quality=False).columns == ["ts", "device_id", "m0"]
    with pytest.raises(ValueError):
        clean(frame, RULES, flag_mode="other")


def test_no_rules(frame):
    out = clean(frame, {}, keys=["device_id"]).orderBy("ts").collect()
    assert [r["quality_flag"] for r in out] == [0, 0, 0, 0, 0, 1, 0, 0]


def test_spikes_do_not_cross_series(spark):
    data = [(1, "a", 1.0), (2, "a", 2.0), (3, "b", 100.0), (4, "b", 101.0)]
    df = spark.createDataFrame(data, "ts long, device_id string, v double")
    out = clean(df, {"v": {"max_diff": 5}}, keys=["device_id"])
    assert {r["quality_flag"] for r in out.collect()} == {0}
    out = clean(df.withColumn("device_id", F.lit("x")), {"v": {"max_diff": 5}}, keys=["device_id"])
    assert sorted((r["ts"], r["quality_flag"]) for r in out.collect()) == [(1, 0), (2, 0), (3, 2), (4, 0)]


def test_infinite_and_nan(spark):
    df = spark.sql("select 1L ts, 'a' device_id, double('inf') v union all select 2, 'a', 1D union all select 3, 'a', double('nan')")
    out = clean(df, {"v": {"max": 50}}, keys=["device_id"]).orderBy("ts").collect()
    assert [r["v"] for r in out] == [None, 1.0, None]
    out = clean(df, {"v": {"max_diff": 5}}, keys=["device_id"]).orderBy("ts").collect()
    assert [r["quality_flag"] for r in out] == [0, 0, 0]


def test_legacy_rules(spark, rows):
    data = [(1, "f", None, 9.0, "k"), (2, "f", "5", 9.0, "k"), (3, "f", "99", 9.0, "k"), (4, "g", None, 1.0, "k")]
    df = spark.createDataFrame(data, "Time long, source_file string, m0 string, other double, extra string")
    rules = {"m0": {"type": "int", "max": 50}, "absent": {}}
    assert rows(rules_fill_drop(df, rules, keys=["source_file"]), "Time", "m0") == [(1, 5), (2, 5), (3, 5)]
    assert rules_fill_drop(df, rules, keys=["source_file"]).columns == ["source_file", "Time", "m0"]
    assert rules_fill_drop(df, {}, keys=["source_file"]) is df


def test_fills(spark):
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])], "ts long, device_id string, v double")
    values = lambda out: [r["v"] for r in out.orderBy("ts").collect()]
    assert values(fill_both_ways(df, ["v"], keys=["device_id"])) == [1.0, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert values(interpolate(df, "v", keys=["device_id"])) == [None, 1.0, 2.0, 3.0, 4.0, None]


def test_dedup(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (1, "b", 4), (None, "c", 1), (None, "b", 1)], "k int, x string, y int")
    assert dedup(df).count() == 4
    assert rows(dedup(df, ["k"])) == [(None, "b", 1), (1, "a", 5)]
    assert rows(dedup(df, ["k"], order=["y"])) == [(None, "b", 1), (1, "b", 4)]
    assert dedup(dedup(df)).count() == 4
    assert rows(dedup(df, ["k", "x", "y"])) == rows(dedup(df))
    assert limit_rows(df, 2, ["y", "x"]).count() == 2 and limit_rows(df, 0, ["y"]).count() == 5
