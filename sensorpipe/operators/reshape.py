"""Wide to long. Long to wide is part of the bucket aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorpipe.constants import CANONICAL


def map_names(name: Column, mapping: Mapping[str, str] | None, otherwise: Column | None = None) -> Column:
    """The mapped name, or ``otherwise`` (by default the name itself)."""
    fallback = name if otherwise is None else otherwise
    if not mapping:
        return fallback
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), fallback)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str = "value") -> DataFrame:
    doubles = [F.col(c).try_cast("double").alias(c) for c in values]
    return df.select(*ids, *doubles).unpivot(list(ids), list(values), name, value)


def to_canonical(
    df: DataFrame,
    value_columns: Sequence[str],
    *,
    ts: str = "Time",
    device_id: Column | str = "device_id",
    domain: Column | str = "domain",
    units: Mapping[str, str] | None = None,
    quality_flag: str = "quality_flag",
) -> DataFrame:
    """Wide to ``ts, device_id, metric, value, unit, domain, quality_flag``; nulls stay and each metric gets the row's flag.

    ``device_id`` and ``domain`` are column names or expressions. Absent value columns are ignored.
    """
    present = [c for c in value_columns if c in df.columns]
    if not present:
        raise ValueError(f"none of {list(value_columns)} is a column")
    flag = F.col(quality_flag) if quality_flag in df.columns else F.lit(None)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(
        F.col(ts).alias("ts"),
        as_column(device_id).alias("device_id"),
        as_column(domain).alias("domain"),
        flag.cast("bigint").alias("quality_flag"),
        *present,
    )
    long = melt(rows, ["ts", "device_id", "domain", "quality_flag"], present, "metric")
    return long.withColumn("unit", map_names(F.col("metric"), units, F.lit(""))).select(*CANONICAL)


def to_sink_long(
    df: DataFrame,
    *,
    ts: str = "ts",
    ids: Sequence[str] = ("device_id", "domain"),
    include_metrics: Sequence[str] | None = None,
    column_to_sensor: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregated wide to ``ts, device_id, domain, sensor, value``; a frame without values gives one null row per row."""
    keys = [ts, *ids]
    values = [c for c in df.columns if c not in keys and (not include_metrics or c in include_metrics)]
    if not values:
        return df.select(*keys, F.lit(None).cast("string").alias("sensor"), F.lit(None).cast("double").alias("value"))
    long = melt(df, keys, values, "sensor")
    return long.withColumn("sensor", map_names(F.col("sensor"), column_to_sensor)).withColumnRenamed(ts, "ts")


def to_raw_long(
    df: DataFrame, *, time_column: str = "Time", device_column: str = "device_id", exclude_columns: Sequence[str] = ()
) -> DataFrame:
    """Raw wide to ``Time, device_id, sensor, value``; no sensor column gives an empty frame."""
    values = [c for c in df.columns if c not in {time_column, device_column, *exclude_columns}]
    rows = df.withColumnsRenamed({time_column: "Time", device_column: "device_id"})
    if not values:
        empty = rows.select("Time", "device_id", F.lit(None).cast("string").alias("sensor"), F.lit(None).cast("double").alias("value"))
        return empty.filter(F.lit(False))
    return melt(rows, ["Time", "device_id"], values, "sensor")


def readings_to_long(df: DataFrame, *, time_column: str = "Time", keep: Sequence[str] = ("device_id",)) -> DataFrame:
    """Parsed lines (a ``readings`` map per row) straight to ``Time, device_id, sensor, value``, without a wide frame."""
    # The outer form keeps the planner from testing the map for entries first, which would parse every line twice.
    long = df.select(F.col(time_column).alias("Time"), *keep, F.explode_outer("readings").alias("sensor", "value"))
    return long.filter(F.col("sensor").isNotNull())


def to_variable_long(df: DataFrame, *, time_column: str = "Time", drop: Sequence[str] = ()) -> DataFrame:
    """Wide to ``timestamp, variable, value`` without nulls."""
    values = [c for c in df.columns if c != time_column and c not in drop]
    if not values:
        raise ValueError("there is no value column")
    long = melt(df, [time_column], values, "variable")
    return long.withColumnRenamed(time_column, "timestamp").dropna(subset=["value"])
