"""States of time buckets that merge: one pass over the rows serves every coarser level, and new rows add to what is kept.

A state has one row per series and bucket: ``n``, ``total``, ``low`` and ``high`` of the values, and a KLL sketch of them
for quantiles. Sums, counts and extremes of merged states are those of all rows; a quantile from a sketch of the default
size is off by 1.7 % of the rank at most, at 99 % confidence, however often states are merged. ``aggregate`` keeps the
exact median.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorpipe.functions.times import Duration, time_bucket
from sensorpipe.sinks.publish import publish, recover
from sensorpipe.sinks.tables import overwrite_partitions, table_exists

KEYS = ("device_id", "metric")
#: Size of a sketch: larger ones are more exact.
SKETCH = 200
_DAY = 86_400_000_000


def nests(fine: str, coarse: str) -> bool:
    """Whether every bucket of ``fine`` lies in one bucket of ``coarse``."""
    a, b = Duration.of(fine), Duration.of(coarse)
    if a == b:
        return True
    if b.micros is None or b.unit == "w":
        # Calendar buckets begin at midnight; months make up quarters and years, weeks do not.
        whole_days = a.micros is not None and a.unit != "w" and _DAY % a.micros == 0
        months = {"mo": 1, "q": 3, "y": 12}
        return whole_days or (a.micros is None and b.micros is None and months.get(b.unit, 0) % months.get(a.unit, 99) == 0)
    return a.micros is not None and a.unit != "w" and b.micros % a.micros == 0


def bucket_states(
    df: DataFrame, level: str, *, keys: Sequence[str] = KEYS, ts: str = "ts", value: str = "value", sketch: int | None = SKETCH
) -> DataFrame:
    """(ts, <keys>, n, total, low, high[, sketch]) per bucket and series; rows without a time belong to none.

    Null values do not count, but their bucket has a state. One shuffle of partial states; ``sketch=None`` leaves
    sketches out.
    """
    number = F.col(value).cast("double")
    parts = [F.count(number).alias("n"), F.sum(number).alias("total"), F.min(number).alias("low"), F.max(number).alias("high")]
    if sketch:
        parts.append(F.kll_sketch_agg_double(number, F.lit(sketch)).alias("sketch"))
    rows = df.filter(F.col(ts).isNotNull()).select(time_bucket(F.col(ts), level).alias("ts"), *keys, F.col(value).alias(value))
    return rows.groupBy("ts", *keys).agg(*parts)


def merge_states(states: DataFrame, level: str, fine: str | None = None, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """States of the buckets of ``level``; raises if buckets of the level ``fine`` do not lie within them."""
    if fine is not None and not nests(fine, level):
        raise ValueError(f"buckets of {fine!r} do not make up buckets of {level!r}")
    parts = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]
    if "sketch" in states.columns:
        parts.append(F.kll_merge_agg_double("sketch").alias("sketch"))
    rows = states.withColumn("ts", time_bucket(F.col("ts"), level))
    return rows.groupBy("ts", *keys).agg(*parts)


def quantile(rank: float) -> Column:
    """A value whose rank among a state's values is about ``rank``, null without values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(rank))))


def finished(states: DataFrame, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """``n``, ``mean``, ``low``, ``high`` and the named quantiles of each state, beside its time and keys."""
    inner = ("n", "total", "low", "high", "sketch")
    others = [c for c in states.columns if c not in inner]
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean")
    return states.select(*others, "n", mean, "low", "high", *[quantile(r).alias(name) for name, r in (quantiles or {}).items()])


def add_states(states: DataFrame, path: str, batch: int) -> None:
    """Keep the states of one micro-batch, by day and batch; adding a batch again replaces it.

    No earlier row or state is read, late rows included: they add states to their old days.
    """
    recover(states.sparkSession, path)
    rows = states.withColumns({"day": F.to_date("ts"), "batch": F.lit(batch).cast("bigint")})
    overwrite_partitions(rows, path, ["day", "batch"])


def read_states(spark: SparkSession, path: str, level: str, fine: str | None = None, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """States of all batches that were added, merged to a level."""
    return merge_states(spark.read.parquet(path), level, fine, keys=keys)


def compact_states(spark: SparkSession, path: str, before: int, level: str, *, keys: Sequence[str] = KEYS) -> None:
    """Merge what batches under ``before`` added to each bucket of ``level`` into one state, kept as batch ``before - 1``.

    Call it with the number of a batch that cannot come again, so none of the merged ones does. Folders are swapped
    (see ``publish``), so a failure loses nothing.
    """
    recover(spark, path)
    if not table_exists(spark, path):
        return
    held = spark.read.parquet(path)
    old = merge_states(held.filter(F.col("batch") < before), level, keys=keys)
    merged = old.withColumns({"day": F.to_date("ts"), "batch": F.lit(before - 1).cast("bigint")})
    publish(merged.unionByName(held.filter(F.col("batch") >= before)), path, ["day", "batch"], whole=True)
