"""Row and column selection."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.functions.naming import closing_date_of, stem
from sensorpipe.functions.times import parse_bound, time_literal
from sensorpipe.operators.reshape import map_names
from sensorpipe.operators.skew import ROWS_PER_TASK, attach

log = logging.getLogger(__name__)


def _bounds(df: DataFrame, ts: str, start, end) -> tuple[Column | None, Column | None]:
    ltz = isinstance(df.schema[ts].dataType, T.TimestampType)
    lo, hi = parse_bound(start), parse_bound(end, end=True)
    return (lo and time_literal(lo, ltz)), (hi and time_literal(hi, ltz))


def filter_range(df: DataFrame, start: str | datetime | None, end: str | datetime | None, ts: str = "ts") -> DataFrame:
    """Rows with ``start <= ts <= end``; reaches the scan as a pushed filter."""
    lo, hi = _bounds(df, ts, start, end)
    tests = ([F.col(ts) >= lo] if lo is not None else []) + ([F.col(ts) <= hi] if hi is not None else [])
    return df.filter(reduce(and_, tests)) if tests else df


def prune_overlap(
    df: DataFrame,
    start: str | datetime | None,
    end: str | datetime | None,
    *,
    ts: str = "ts",
    by: Sequence[str] = ("source_file",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All rows of every source whose time span overlaps [start, end]; a source without a readable time is kept."""
    lo, hi = _bounds(df, ts, start, end)
    if lo is None and hi is None:
        return df
    spans = df.groupBy(*by).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    tests = ([F.col("_last") >= lo] if lo is not None else []) + ([F.col("_first") <= hi] if hi is not None else [])
    kept = spans.filter(F.coalesce(reduce(and_, tests), F.lit(True)))
    return attach(df, kept, by, [], "left_semi", rows_per_task)


def prune_days(
    df: DataFrame,
    start: str | datetime | None,
    end: str | datetime | None,
    *,
    day: str = "day",
    ts: str = "ts",
    by: Sequence[str] = ("source_file",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Prune sources by the day in their name (a partition filter); sources without one by their time span."""
    lo, hi = parse_bound(start), parse_bound(end, end=True)
    if lo is None and hi is None:
        return df
    tests = ([F.col(day) >= F.lit(lo.date())] if lo else []) + ([F.col(day) <= F.lit(hi.date())] if hi else [])
    named = df.filter(reduce(and_, tests))
    unnamed = prune_overlap(df.filter(F.col(day).isNull()), start, end, ts=ts, by=by, rows_per_task=rows_per_task)
    return named.unionByName(unnamed)


def filter_source_date(df: DataFrame, ts: str = "Time", source: str = "source_file") -> DataFrame:
    """Keep rows dated as the file name ends (``..._yyyy-mm-dd``); sources without such an ending keep all rows."""
    date = closing_date_of(stem(F.col(source)))
    return df.filter(date.isNull() | (F.to_date(ts) == date))


def select_rename(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """``["a", "b->c"]``: select and rename; absent columns are ignored, and nothing left to select changes nothing."""
    wanted = []
    for item in columns or []:
        source, arrow, target = (item or "").partition("->")
        source = source.strip()
        if source in df.columns:
            wanted.append(F.col(source).alias(target.strip() if arrow else source))
    return df.select(*wanted) if wanted else df


def rename_time(df: DataFrame, source: str, target: str | None) -> DataFrame:
    return df.withColumnRenamed(source, target) if target and target != source else df


def resolve_time_column(columns: Sequence[str], wanted: str) -> str:
    """The exact column, else the one equal without case and outer blanks, else the first column."""
    if wanted in columns:
        return wanted
    if not columns:
        raise ValueError("the frame has no columns")
    alike = {c.strip().lower(): c for c in columns}
    found = alike.get(wanted.strip().lower())
    if found is None:
        log.warning("time column %s is absent, using the first column %s", wanted, columns[0])
    return found or columns[0]


def split_domains(
    df: DataFrame, domain_columns: Mapping[str, Sequence[str]], *, ts: str = "Time", keep: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """One frame per domain with the time, the ``keep`` columns and those of its columns that exist.

    A domain with no existing column is left out; a column may belong to several domains.
    """
    if not domain_columns:
        raise ValueError("no domain has columns")
    out = {}
    for domain, columns in domain_columns.items():
        present = [c for c in columns if c in df.columns]
        if len(present) < len(columns):
            log.warning("domain %s: absent columns %s", domain, sorted(set(columns) - set(present)))
        if present:
            out[domain] = df.select(ts, *[c for c in keep if c not in (ts, *present)], *present)
    return out


def stack_domains(frames: Mapping[str, DataFrame]) -> DataFrame:
    """The frames of ``split_domains`` as one, with a ``domain`` column for a partitioned write."""
    tagged = [f.withColumn("domain", F.lit(d)) for d, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def keep_metrics(
    df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = (), metric: str = "sensor"
) -> DataFrame:
    if include:
        df = df.filter(F.col(metric).isin([str(m) for m in include]))
    return df.filter(~F.col(metric).isin(list(exclude))) if exclude else df


def rename_metrics(df: DataFrame, names: Mapping[str, str] | None, metric: str = "sensor") -> DataFrame:
    return df.withColumn(metric, map_names(F.col(metric), names))


def ensure_identity(
    df: DataFrame, *, device_id: str = "", domain: str = "", device_from: Column | None = None, domain_from: Column | None = None
) -> DataFrame:
    """Add ``device_id`` and ``domain`` where absent: from the file name, then from configuration."""
    for name, derived, default in (("device_id", device_from, device_id), ("domain", domain_from, domain)):
        if name not in df.columns:
            value = F.lit(default) if derived is None else F.coalesce(derived, F.lit(default))
            df = df.withColumn(name, value)
    return df
