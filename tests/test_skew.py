"""Hot groups: the sliced path must give exactly what the plain path gives."""

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators.aggregate import bucket_aggregate, long_aggregate
from sensorpipe.operators.asof import asof_backward
from sensorpipe.operators.clean import clean, rules_fill_drop
from sensorpipe.operators.fill import backward_fill, fill_both_ways, forward_fill, interpolate, previous
from sensorpipe.operators.resample import resample
from sensorpipe.operators.select import prune_overlap
from sensorpipe.operators.skew import PART, attach, split_hot
from sensorpipe.sinks.tables import replace_range
from sensorpipe.streaming.incremental import missing_days

SMALL = 7
PLAIN = 10**9


@pytest.fixture(scope="module")
def series(spark):
    """Device a holds most rows, many of them within one minute and some at one time; b and null are small."""
    a = spark.range(300).select(
        F.lit("a").alias("device_id"),
        F.when(F.col("id") < 120, F.col("id") * 1_000_000 % 60_000_000)
        .when(F.col("id") < 150, 3_600_000_000)
        .otherwise(F.col("id") * 97_000_000)
        .alias("us"),
        "id",
    )
    b = spark.range(5).select(F.lit("b").alias("device_id"), (F.col("id") * 50_000_000).alias("us"), (F.col("id") + 1000).alias("id"))
    c = spark.range(12).select(F.lit(None).cast("string").alias("device_id"), (F.col("id") * 7_000_000).alias("us"), (F.col("id") + 2000).alias("id"))
    mixed = a.unionByName(b).unionByName(c)
    value = F.when(F.col("id") % 5 < 2, ((F.col("id") * 7919) % 101).cast("double"))
    frame = mixed.select(
        "id",
        "device_id",
        F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"),
        value.alias("value"),
        F.when(F.col("id") > 40, value * 2).alias("other"),
        F.concat(F.lit("m"), (F.col("id") % 3).cast("string")).alias("metric"),
        F.lit("d").alias("domain"),
        (F.col("id") % 4).alias("quality_flag"),
    ).unionByName(
        spark.sql(
            "select 9000L id, 'a' device_id, cast(null as timestamp_ntz) ts, 50D value, 1D other, 'm0' metric, 'd' domain, 0L quality_flag"
        )
    )
    return frame.cache()


def test_parts_follow_time_and_stay_small(series):
    parts = split_hot(series, ["device_id"], ["ts", "id"], SMALL)
    assert PART in parts.columns
    hot = parts.filter(F.col("device_id") == "a")
    assert hot.filter(F.col(PART).isNull()).count() == 0
    assert parts.filter((F.col("device_id") == "b") & F.col(PART).isNotNull()).count() == 0
    spans = hot.filter("ts is not null").groupBy(PART).agg(F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi")).orderBy(PART).collect()
    assert len(spans) > 30
    assert all(x["hi"] < y["lo"] for x, y in zip(spans, spans[1:]))
    assert PART not in split_hot(series, ["device_id"], ["ts", "id"], PLAIN).columns


KEYED = dict(keys=["device_id"], tie=["id"])
FILLS = {
    "previous": lambda df, n: previous(df, ["value", "other"], rows_per_task=n, **KEYED),
    "forward": lambda df, n: forward_fill(df, ["value", "other"], rows_per_task=n, **KEYED),
    "backward": lambda df, n: backward_fill(df, ["value", "other"], rows_per_task=n, **KEYED),
    "both": lambda df, n: fill_both_ways(df, ["value", "other"], rows_per_task=n, **KEYED),
    "interpolate": lambda df, n: interpolate(df, "value", rows_per_task=n, **KEYED),
    "clean": lambda df, n: clean(
        df, {"value": {"type": "float", "min": 3, "max_diff": 40}, "other": {"max_diff": 9}}, rows_per_task=n, **KEYED
    ),
    "rules": lambda df, n: rules_fill_drop(df, {"value": {"min": 20}, "other": {}}, ts="ts", rows_per_task=n, **KEYED),
    "untied": lambda df, n: forward_fill(df, ["value"], keys=["device_id"], rows_per_task=n),
}


@pytest.mark.parametrize("name", FILLS)
def test_row_order_functions(series, rows, name):
    assert rows(FILLS[name](series, SMALL)) == rows(FILLS[name](series, PLAIN))


def test_asof(series, rows):
    left = series.filter("id % 2 = 0").select("id", "device_id", "ts")
    right = series.filter("id % 2 = 1").select("device_id", "ts", "value", F.col("id").alias("r"))
    results = [
        rows(asof_backward(left, right, by=["device_id"], values=["value", "r"], tie=["r"], rows_per_task=n)) for n in (SMALL, PLAIN)
    ]
    assert results[0] == results[1]
    assert len(results[0]) == left.count()


@pytest.mark.parametrize("by_day,mode", [(False, "nearest"), (True, "linear")])
def test_resample(series, rows, by_day, mode):
    results = [
        rows(resample(series, "20m", interpolation=mode, by_day=by_day, tie=["id"], rows_per_task=n, block_cells=b))
        for n, b in ((SMALL, 3), (PLAIN, 8192))
    ]
    assert results[0] == results[1]


@pytest.mark.parametrize("level", ["1d", "1h"])
def test_median(series, rows, level):
    specs = {"m0": [{"method": "median", "output": "p"}, {"output": "a"}], "m1": [{"method": "median"}]}
    results = [rows(bucket_aggregate(series, level, specs, rows_per_task=n)) for n in (2, PLAIN)]
    assert results[0] == results[1]
    raw = series.select(F.col("ts").alias("Time"), "device_id", F.col("metric").alias("sensor"), "value")
    results = [rows(long_aggregate(raw, level, "median", rows_per_task=n)) for n in (2, PLAIN)]
    assert results[0] == results[1]


def test_attach_and_prune(series, rows):
    names = series.select("device_id").distinct().withColumn("name", F.concat(F.coalesce("device_id", F.lit("none")), F.lit("!")))
    results = [rows(attach(series, names, ["device_id"], ["name"], rows_per_task=n)) for n in (SMALL, PLAIN)]
    assert results[0] == results[1]
    assert all(r[-1] for r in results[0])
    results = [rows(prune_overlap(series, None, "1970-01-01T00:00:30Z", by=["device_id", "metric"], rows_per_task=n)) for n in (SMALL, PLAIN)]
    assert results[0] == results[1]
    batch = series.filter("id % 10 = 0")
    results = [rows(replace_range(series, batch, scope=["device_id"], rows_per_task=n)) for n in (SMALL, PLAIN)]
    assert results[0] == results[1]
    new = series.withColumns({"day": F.lit(None).cast("date"), "source_file": F.coalesce("device_id", F.lit("x"))})
    results = [rows(missing_days(new, series.filter("device_id = 'b'"), ts="ts", rows_per_task=n)) for n in (SMALL, PLAIN)]
    assert results[0] == results[1]


def test_slices_are_even(spark):
    """Two stray times, and very many rows of one instant: no slice holds much more than it should."""
    at = F.when(F.col("id") == 0, "1970-01-01").when(F.col("id") == 1, "9999-01-01").when(F.col("id") < 20_000, "2026-01-01").otherwise(None)
    spread = F.timestamp_seconds(F.lit(1_767_000_000) + F.col("id")).cast("timestamp_ntz")
    rows = spark.range(60_000).select("id", F.lit("a").alias("device_id"), F.coalesce(at.cast("timestamp_ntz"), spread).alias("ts"))
    parts = split_hot(rows, ["device_id"], ["ts", "id"], 3_000)
    sizes = [r["count"] for r in parts.groupBy(PART).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * 3_000


def test_small_slices_share_tasks_and_files(spark):
    """Slices of 3 rows out of 3,000: each in its bounds and in order, in one file and not in 2,000."""
    rows = spark.range(3_000).select(F.lit("a").alias("device_id"), (F.col("id") % 1_000).alias("ts"), "id")
    parts = split_hot(rows, ["device_id"], ["ts"], 3)
    assert len(parts.inputFiles()) == 1
    slices = sorted(tuple(r) for r in parts.groupBy(PART).agg(F.count("*"), F.min("ts"), F.max("ts")).collect())
    assert sum(n for _, n, _, _ in slices) == 3_000 and max(n for _, n, _, _ in slices) <= 3
    assert all(high <= low for (_, _, _, high), (_, _, low, _) in zip(slices, slices[1:]))


def test_asof_ties_alike_on_both_paths(spark, rows):
    seen = [("a", "2026-01-01 00:00:00", None, 7.0), ("a", "2026-01-01 00:00:00", 1, 8.0), ("a", "2026-01-01 00:00:00", 1, 9.0), ("b", "2026-01-01 00:00:00", None, 7.0)]
    right = spark.createDataFrame(seen, "device_id string, ts string, rank int, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    left = right.select("device_id", "ts").distinct()
    got = [rows(asof_backward(left, right, by=["device_id"], values=["value"], tie=["rank"], rows_per_task=n), "device_id", "value") for n in (1, PLAIN)]
    assert got[0] == got[1] == [("a", 9.0), ("b", 7.0)]


def test_copies_collapse_before_the_window(spark, rows):
    copies = spark.range(200).select(
        F.lit("a").alias("device_id"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit(1.5).alias("value")
    )
    left = copies.select("device_id", "ts").limit(2)
    got = rows(asof_backward(left, copies, by=["device_id"], values=["value"], rows_per_task=SMALL), "value")
    assert got == [(1.5,), (1.5,)]


def test_copies_in_row_order_functions(series, rows, monkeypatch):
    """A third of the rows are copies of one row: merged, sliced around, and unrolled again."""
    from sensorpipe.operators import fill

    monkeypatch.setattr(fill, "COPIES_PER_BLOCK", 3)
    one = series.filter("id = 210").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("copy")
    copied = series.unionByName(one)
    for name in ("previous", "both"):
        assert rows(FILLS[name](copied, SMALL)) == rows(FILLS[name](copied, PLAIN)), name
