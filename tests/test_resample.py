"""Resampling, against the table worked out by hand, and its invariants."""

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators.asof import asof_backward
from sensorpipe.operators.resample import resample, resample_by_domain


def at(second, day=1):
    return f"2026-01-{day:02d} 00:00:{second:02d}"


@pytest.fixture(scope="module")
def observations(spark):
    data = [(at(0), "m1", 1.0, 0), (at(2), "m0", 5.0, 0), (at(4), "m0", None, 1), (at(5), "m0", 8.0, 0)]
    df = spark.createDataFrame(data, "t string, metric string, value double, quality_flag long")
    return df.select(
        F.col("t").cast("timestamp_ntz").alias("ts"),
        F.lit("dev").alias("device_id"),
        "metric",
        "value",
        F.lit("mm").alias("unit"),
        F.lit("bio").alias("domain"),
        "quality_flag",
    )


def m0(df):
    out = df.filter("metric = 'm0'").orderBy("ts").select("value", "is_interpolated", "gap_duration", "quality_flag")
    return [tuple(r) for r in out.collect()]


TAIL = [(5.0, False, 0.0, 0), (5.0, True, 1.0, 5), (None, False, 0.0, 1), (8.0, False, 0.0, 0)]


@pytest.mark.parametrize("mode,filled", [("forward", None), ("linear", 6.5), ("nearest", 5.0)])
def test_by_day(observations, mode, filled):
    expected = [(5.0, True, -2.0, 5), (5.0, True, -1.0, 5), *TAIL]
    expected[4] = (filled, False, 0.0, 1)
    assert m0(resample(observations, "1s", interpolation=mode, by_day=True)) == expected


@pytest.mark.parametrize("mode,head,filled", [(None, None, None), ("nearest", 5.0, 5.0), ("linear", None, 6.5)])
def test_over_days(observations, mode, head, filled):
    expected = [(head, True, None, 1), (head, True, None, 1), *TAIL]
    expected[4] = (filled, False, 0.0, 1)
    assert m0(resample(observations, "1s", interpolation=mode)) == expected


def test_true_linear(observations):
    values = [v[0] for v in m0(resample(observations, "1s", interpolation="true_linear"))]
    assert values == [None, None, 5.0, 6.0, 7.0, 8.0]


def test_metric_that_no_cell_reaches(observations):
    # The grid is 0, 4 seconds; m0 is first seen at 5.
    late = observations.filter("metric = 'm1' or value = 8.0")
    assert m0(resample(late, "4s", by_day=True)) == [(None, True, None, 1), (None, True, None, 1)]


def test_days_are_independent_and_midnight(observations):
    second = observations.filter("metric = 'm0'").withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    both = observations.unionByName(second)
    out = resample(both, "1s", by_day=True).filter("ts >= '2026-01-02'")
    assert m0(out)[0] == (5.0, False, 0.0, 0) and out.count() == 4
    out = resample(both, "1s", by_day=True, day_anchor="midnight").filter("ts >= '2026-01-02'")
    assert m0(out)[0] == (5.0, True, -2.0, 5) and out.count() == 6


def test_devices_have_their_own_series(observations):
    both = observations.unionByName(observations.withColumn("device_id", F.lit("other")).filter("metric = 'm1'"))
    out = resample(both, "1s")
    assert out.filter("device_id = 'other'").count() == 1 and out.filter("device_id = 'dev'").count() == 12


def test_sizes_and_marks(observations):
    out = resample(observations, "300ms")
    assert out.groupBy("metric").count().select("count").distinct().collect()[0][0] == 17
    assert out.filter("is_interpolated = (coalesce(gap_duration, 1) = 0 and quality_flag not in (1, 5))").count() == 0
    assert out.filter("unit <> 'mm'").count() == 0
    assert resample(observations, "1mo").count() == 2


def test_by_domain(observations):
    two = observations.unionByName(observations.withColumn("domain", F.lit("env")))
    settings = {"bio": {"freq": "1s", "independent_by_day": True}}
    assert resample_by_domain(two, settings).select("domain").distinct().collect()[0][0] == "bio"
    with pytest.raises(ValueError, match="env"):
        resample_by_domain(two, settings, strict=True)
    with pytest.raises(ValueError):
        resample(observations, interpolation="cubic")


def test_asof(spark, rows):
    left = spark.sql("select * from values ('a', 1), ('a', 5), ('a', 5), ('b', 9), (null, 9) as t(k, t)")
    right = spark.sql("select * from values ('a', 2, 'x', 1), ('a', 5, null, 2), ('a', 5, 'y', 1), ('a', 6, 'z', 1), (null, 1, 'n', 1) as t(k, t, v, o)")
    out = asof_backward(left, right, by=["k"], on="t", values=["v"], tie=["o"], matched_on="at")
    assert rows(out, "k", "t", "at", "v") == [(None, 9, None, None), ("a", 1, None, None), ("a", 5, 5, None), ("a", 5, 5, None), ("b", 9, None, None)]
