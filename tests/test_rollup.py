"""Bucket states: merged ones say what all rows say."""

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators import rollup


def readings(spark, n=4000):
    rows = spark.range(n).select(
        F.expr("timestamp_ntz'2026-01-30 00:00:00' + make_dt_interval(0, 0, 0, id * 137 % 700000)").alias("ts"),
        F.concat(F.lit("d"), (F.col("id") % 2).cast("string")).alias("device_id"),
        F.lit("m").alias("metric"),
        F.when(F.col("id") % 7 > 0, (F.col("id") * 31 % 1000).cast("double")).alias("value"),
    )
    return rows.unionByName(spark.sql("SELECT CAST(NULL AS timestamp_ntz) ts, 'd0' device_id, 'm' metric, 5D value"))


def expected(df, level):
    got = rollup.finished(rollup.bucket_states(df, level, sketch=None))
    return sorted(tuple(r) for r in got.collect())


def test_levels(spark):
    df = readings(spark)
    fine = rollup.bucket_states(df, "10s")
    direct = df.filter("ts IS NOT NULL").groupBy("device_id").agg(F.count("value"), F.avg("value"), F.min("value"), F.max("value"))
    whole = {r[0]: tuple(r)[1:] for r in direct.collect()}
    for level in ("60s", "1h", "1d", "1mo"):
        merged = rollup.merge_states(fine, level, "10s")
        assert sorted(tuple(r) for r in rollup.finished(merged).collect()) == expected(df, level)
    year = rollup.finished(rollup.merge_states(fine, "1y", "10s"), {"median": 0.5, "p90": 0.9}).collect()
    assert {r.device_id: (r.n, r["mean"], r.low, r.high) for r in year} == whole
    for r in year:
        values = df.filter((F.col("device_id") == r.device_id) & F.col("ts").isNotNull())
        for rank, found in ((0.5, r.median), (0.9, r.p90)):
            below = values.select(F.avg((F.col("value") <= found).cast("int"))).first()[0]
            assert below == pytest.approx(rank, abs=0.03)


def test_empty_and_null(spark):
    df = readings(spark)
    assert rollup.merge_states(rollup.bucket_states(df.limit(0), "1h"), "1d", "1h").count() == 0
    alone = spark.sql("SELECT timestamp_ntz'2026-01-01 00:00:00' ts, 'd' device_id, CAST(NULL AS string) metric, CAST(NULL AS double) value")
    row = rollup.finished(rollup.merge_states(rollup.bucket_states(alone, "1h"), "1d"), {"median": 0.5}).first()
    assert (row.n, row["mean"], row.low, row.high, row.median) == (0, None, None, None, None)


def test_which_levels_nest():
    for fine, coarse in (("10s", "60s"), ("1h", "1d"), ("1d", "1w"), ("1h", "1mo"), ("1mo", "1y"), ("7s", "7s")):
        assert rollup.nests(fine, coarse), (fine, coarse)
    for fine, coarse in (("7s", "60s"), ("1w", "1mo"), ("1h", "30m"), ("7h", "1d"), ("1y", "1mo"), ("1mo", "1w"), ("5d", "1mo"), ("7h", "1w")):
        assert not rollup.nests(fine, coarse), (fine, coarse)


def test_batches_add_up(spark, tmp_path):
    df, path = readings(spark).cache(), str(tmp_path / "states")
    # The second batch is late: it lies among the times of the first.
    parts = [df.filter(F.col("value") < 300), df.filter(F.col("value") >= 600), df.filter("value IS NULL OR (value >= 300 AND value < 600)")]
    for number, part in enumerate(parts):
        for _ in range(2 if number == 1 else 1):  # a batch that comes again counts once
            rollup.add_states(rollup.bucket_states(part, "10m"), path, number)
    read = lambda: sorted(tuple(r) for r in rollup.finished(rollup.read_states(spark, path, "1d", "10m")).collect())
    assert read() == expected(df, "1d")
    before = spark.read.parquet(path).count()
    rollup.compact_states(spark, path, 2, "10m")
    assert read() == expected(df, "1d") and spark.read.parquet(path).count() < before
    assert {r[0] for r in spark.read.parquet(path).select("batch").distinct().collect()} == {1, 2}
    rollup.add_states(rollup.bucket_states(parts[2], "10m"), path, 2)
    assert read() == expected(df, "1d")
    with pytest.raises(ValueError, match="do not make up"):
        rollup.read_states(spark, path, "15m", "10m")
