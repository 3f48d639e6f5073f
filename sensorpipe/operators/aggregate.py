"""Time-bucket aggregates and small summaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.functions.times import time_bucket
from sensorpipe.operators.skew import PART, by_part, hot_groups, lookup, split_hot
from sensorpipe.session import checkpointed

# An exact median holds the values of its group in memory; groups above this size are ranked across tasks instead.
MEDIAN_ROWS = 500_000
# Metrics found in the data that may become columns.
MOST_METRICS = 5_000
# Method names used in configurations.
METHODS = {"median": "median", "average": "mean", "mean": "mean", "approx_median": "approx_median"}


class Spec(NamedTuple):
    metric: str
    method: str
    output: str


def method_named(name: str) -> str:
    if name not in METHODS:
        raise ValueError(f"method must be one of {sorted(METHODS)}, not {name!r}")
    return METHODS[name]


def specs_of(config: Mapping[str, Sequence[Mapping]] | Sequence[Mapping] | Sequence[Spec]) -> list[Spec]:
    """``{metric: [{method, output}]}`` or ``[{metric, method, output}]`` as a list of specs.

    The method defaults to ``average`` and the output name to the metric; output names must differ.
    """
    if isinstance(config, Mapping):
        config = [{"metric": m, **s} for m, listed in config.items() for s in listed]
    specs = [
        s if isinstance(s, Spec) else Spec(s["metric"], s.get("method", "average"), s.get("output") or s["metric"])
        for s in config
    ]
    specs = [Spec(s.metric, method_named(s.method), s.output) for s in specs]
    outputs = [s.output for s in specs]
    repeated = sorted({o for o in outputs if outputs.count(o) > 1})
    if repeated:
        raise ValueError(f"outputs named more than once: {repeated}")
    return specs


def median_of_hot_groups(df: DataFrame, keys: Sequence[str], value: str, rows_per_task: int = MEDIAN_ROWS) -> DataFrame:
    """Exact median per key for groups too large for one task: values are counted, sliced and ranked across tasks."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    parts = split_hot(counted, keys, [value], rows_per_task)
    if PART not in parts.columns:
        parts = parts.withColumn(PART, F.lit(None).cast("bigint"))
    totals = parts.groupBy(*keys, PART).agg(F.sum("_n").alias("_size"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *keys,
        PART,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("bigint")).alias("_before"),
        F.sum("_size").over(whole).alias("_all"),
    )
    within = Window.partitionBy(*keys, PART).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = parts.withColumn("_in_part", F.sum("_n").over(within))
    ranked = by_part(ranked, totals, keys, ["_before", "_all"])
    high = F.col("_before") + F.col("_in_part")
    low = high - F.col("_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank > low) & (rank <= high), F.col(value).cast("double")))

    lower, upper = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return ranked.groupBy(*keys).agg((at(lower) * 0.5 + at(upper) * 0.5).alias("_median"))


def _when_metric(metric: str, value: Column) -> Column:
    return F.when(F.col("metric") == metric, value)


def _aggregate(method: str, value: Column, accuracy: int) -> Column:
    if method == "median":
        return F.median(value)
    if method == "approx_median":
        return F.percentile_approx(value, 0.5, accuracy).cast("double")
    return F.avg(value)


def _hot_buckets(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame | None:
    """Hot groups, looked for only within series that have so many rows over all buckets (the first key)."""
    series = hot_groups(df, keys[1:], rows_per_task)
    return None if series is None else hot_groups(lookup(df, series, keys[1:], [], "left_semi"), keys, rows_per_task)


def _grouped(df: DataFrame, keys: Sequence[str], specs: Sequence[Spec], rows_per_task: int, accuracy: int) -> DataFrame:
    """Conditional aggregates per key: one shuffle however many metrics there are."""
    value = F.col("value").cast("double")
    exact = sorted({s.metric for s in specs if s.method == "median"})
    ranked = F.col("metric").isin(exact) & F.col("value").isNotNull()
    hot = _hot_buckets(df.filter(ranked), [*keys, "metric"], rows_per_task) if exact else None
    if hot is None:
        columns = [_aggregate(s.method, _when_metric(s.metric, value), accuracy).alias(s.output) for s in specs]
        return df.groupBy(*keys).agg(*columns)
    rows = lookup(df, hot, [*keys, "metric"], ["_hot"])
    small = F.when(F.col("_hot").isNull(), value)
    columns = [
        _aggregate(s.method, _when_metric(s.metric, small if s.method == "median" else value), accuracy).alias(s.output)
        for s in specs
    ]
    out = rows.groupBy(*keys).agg(*columns)
    large = lookup(df.filter(ranked), hot, [*keys, "metric"], ["_hot"], "inner").drop("_hot")
    medians = median_of_hot_groups(large, [*keys, "metric"], "value", rows_per_task)
    names = {s.output: f"_hot_{i}" for i, s in enumerate(specs) if s.method == "median"}
    wide = medians.groupBy(*keys).agg(
        *[F.max(_when_metric(s.metric, F.col("_median"))).alias(names[s.output]) for s in specs if s.output in names]
    )
    out = lookup(out, checkpointed(wide), keys, list(names.values()))
    return out.withColumns({o: F.coalesce(F.col(o), F.col(h)) for o, h in names.items()}).drop(*names.values())


def bucket_aggregate(
    df: DataFrame,
    level: str,
    metrics: Mapping[str, Sequence[Mapping]] | Sequence[Mapping],
    *,
    ts: str = "ts",
    keys: Sequence[str] = ("device_id", "domain"),
    exclude_flags: Sequence[int] = (),
    rows_per_task: int = MEDIAN_ROWS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Long to wide: per bucket and key, one column per configured metric and method.

    Nulls are ignored. A bucket with rows of other metrics only is kept, with nulls. ``exclude_flags`` leaves out
    values that carry one of these quality flags.
    """
    specs = specs_of(metrics)
    if not specs:
        raise ValueError("no metric to aggregate")
    value = F.col("value")
    if exclude_flags:
        value = F.when(~F.coalesce(F.col("quality_flag").isin(list(exclude_flags)), F.lit(False)), value)
    rows = df.filter(F.col(ts).isNotNull()).select(
        time_bucket(F.col(ts), level).alias("ts"), *keys, "metric", value.alias("value")
    )
    return _grouped(rows, ["ts", *keys], specs, rows_per_task, accuracy).select("ts", *keys, *[s.output for s in specs])


def aggregate_by_domain(
    df: DataFrame,
    level: str,
    rules: Mapping[str, Mapping],
    *,
    metrics: Sequence[str] | None = None,
    ts: str = "ts",
    keys: Sequence[str] = ("device_id", "domain"),
    rows_per_task: int = MEDIAN_ROWS,
    accuracy: int = 10_000,
) -> DataFrame:
    """One method per domain for all its metrics; columns are named after the metrics, other domains are left out.

    Without ``metrics`` their names are looked up first, since they become columns.
    """
    by_method: dict[str, list[str]] = {}
    for domain, rule in rules.items():
        by_method.setdefault(method_named(rule.get("method", "average")), []).append(domain)
    ruled = df.filter(F.col("domain").isin(list(rules)))
    if metrics is None:
        metrics = sorted(r[0] for r in ruled.select("metric").filter(F.col("metric").isNotNull()).distinct().limit(MOST_METRICS + 1).collect())
        if len(metrics) > MOST_METRICS:
            raise ValueError(f"more than {MOST_METRICS} metrics were found; name the wanted ones as 'metrics'")
    rows = ruled.filter(F.col(ts).isNotNull()).select(time_bucket(F.col(ts), level).alias("ts"), *keys, "metric", "value")
    # A row of one domain only feeds the column of its domain's method.
    specs, tagged = [], F.lit(None).cast("string")
    for method, domains in by_method.items():
        tagged = F.when(F.col("domain").isin(domains), F.concat_ws("\u0001", F.lit(method), "metric")).otherwise(tagged)
        specs += [Spec(f"{method}\u0001{m}", method, f"_{method}_{i}") for i, m in enumerate(metrics)]
    out = _grouped(rows.withColumn("metric", tagged), ["ts", *keys], specs, rows_per_task, accuracy)
    return out.select(
        "ts", *keys, *[F.coalesce(*[F.col(f"_{method}_{i}") for method in by_method]).alias(m) for i, m in enumerate(metrics)]
    )


def long_aggregate(
    df: DataFrame,
    level: str,
    method: str = "average",
    *,
    ts: str = "Time",
    keys: Sequence[str] = ("device_id", "sensor"),
    value: str = "value",
    decimals: int | None = 2,
    rows_per_task: int = MEDIAN_ROWS,
    accuracy: int = 10_000,
) -> DataFrame:
    """Long to long: mean or median per bucket, device and sensor, rounded."""
    kind = method_named(method)
    rows = df.filter(F.col(ts).isNotNull()).select(
        time_bucket(F.col(ts), level).alias(ts), *keys, F.lit("v").alias("metric"), F.col(value).alias("value")
    )
    out = _grouped(rows, [ts, *keys], [Spec("v", kind, value)], rows_per_task, accuracy)
    return out.withColumn(value, F.round(value, decimals)) if decimals is not None else out


def time_span(df: DataFrame, ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """First and last time, per key or overall."""
    return df.groupBy(*by).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def distinct_days(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.select(F.to_date(ts).alias("day")).dropna().distinct()


def null_counts(df: DataFrame, columns: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])
