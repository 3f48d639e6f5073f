"""The plans we want: no Python in the hot path, few shuffles, filters and columns pushed to the scan."""

import re

import pytest

from sensorpipe.operators.aggregate import bucket_aggregate
from sensorpipe.operators.resample import resample
from sensorpipe.plans.queries import METRICS, names, observed

SF = "/root/testdata/sf0.001"
# How many shuffles by key each query may have; single-row aggregates do not count.
SHUFFLES = {
    "agg_median_mean": 1,
    "agg_daily": 1,
    "agg_raw_60s": 1,
    "clean_documented": 1,
    "clean_wide": 1,
    "canonical_long": 0,
    "raw_long": 0,
    "kv_parse": 0,
    "kv_lenient_long": 0,
    "transforms": 0,
    "domain_split": 0,
    "dedup_subset": 1,
    "asof_backward": 1,
    "forward_filled": 1,
    "backward_filled": 1,
    "replace_range": 0,
    # Observations move once; the others move one row per series and day.
    "resample_by_day": 5,
    "resample_linear": 5,
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SHUFFLES)
def test_shuffles(spark, name):
    text = plan(names()[name](spark, SF))
    assert len(re.findall(r"Exchange (hash|range|RoundRobin)", text)) <= SHUFFLES[name], text
    assert "Python" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_shuffles_do_not_grow_with_metrics(spark):
    rows = observed(spark, SF)
    counts = [
        plan(bucket_aggregate(rows, "1h", [{"metric": m, "method": "median"} for m in METRICS[:n]])).count("Exchange hash") for n in (1, 5)
    ]
    assert counts == [1, 1]


@pytest.mark.parametrize("mode", [None, "linear", "nearest", "true_linear"])
def test_cells_are_neither_shuffled_nor_sorted(spark, mode):
    """Nothing stands above the cells but projections, and the finer grid moves no more rows."""
    text = plan(resample(observed(spark, SF), "1s", interpolation=mode, by_day=True))
    top = text[: text.index("Generate explode(sequence")]
    assert not re.search(r"Exchange|Window|Sort", top), text
    assert len(re.findall(r"Exchange hash", text)) == len(re.findall(r"Exchange hash", plan(resample(observed(spark, SF), "10m", interpolation=mode, by_day=True))))


@pytest.mark.parametrize("name,most", [("previous_value", 2), ("clean_documented", 2), ("asof_backward", 2), ("resample_by_day", 2), ("agg_median_mean", 2)])
def test_few_jobs_run_before_the_frame_is_there(spark, name, most):
    tracker, group = spark.sparkContext.statusTracker(), f"plan-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        names()[name](spark, SF)
        assert len(tracker.getJobIdsForGroup(group)) <= 2 * most
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pushdown(spark):
    text = plan(names()["filter_range"](spark, SF))
    assert "GreaterThanOrEqual(ts," in text and "LessThanOrEqual(ts," in text
    text = plan(names()["agg_median_mean"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in text


def test_partition_pruning(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan(names()["partitioned_dataset"](spark, SF))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text)[1]
    assert "domain" in filters and "day" in filters
