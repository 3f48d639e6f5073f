"""Align long series to a regular time grid: as-of values, fill marks and gap lengths."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.constants import INTERPOLATED, MISSING, RESAMPLED
from sensorpipe.functions.times import Duration, micros, plus_micros, time_bucket
from sensorpipe.operators.asof import last_per_time, match_backward
from sensorpipe.operators.fill import linear_between
from sensorpipe.operators.skew import PART, ROWS_PER_TASK, carry, group_keys, split_hot, with_edges
from sensorpipe.session import staged

log = logging.getLogger(__name__)

BLOCK_CELLS = 8192
#: Cells of a block that is shuffled for a write: few, as shuffles are cut by the size of blocks, not of cells.
DEALT_CELLS = 16
_FILLS = (None, "forward", "linear", "nearest", "true_linear")


def series_bounds(df: DataFrame, keys: Sequence[str], ts: str, by_day: bool, day_anchor: str = "first") -> DataFrame:
    """One row per series (and day): grid start ``lo`` and end ``hi`` over all metrics of the keys, and its unit.

    Rows are aggregated once. What is left has one row per series, day and unit, and one exchange of that by the keys
    serves all windows.
    """
    scope = [*keys, "_day"] if by_day else list(keys)
    rows = df.withColumn("_day", F.to_date(ts)) if by_day else df
    units = ["unit"] if "unit" in df.columns else []
    # A text maximum would sort all rows before the first aggregation; as one more key it does not.
    per_unit = rows.groupBy(*scope, "metric", *units).agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(F.lit(1)).alias("_n")
    )
    per_unit = per_unit.repartition(*keys) if keys else per_unit
    over_metrics = Window.partitionBy(*scope)
    of_metric = Window.partitionBy(*scope, "metric")
    lo = F.min("_lo").over(over_metrics)
    if day_anchor == "midnight":
        lo = time_bucket(lo, "1d")
    unit = F.max("unit").over(Window.partitionBy(*keys, "metric")) if units else F.lit("")
    number = F.row_number().over(of_metric.orderBy(*(units or ["_lo"])))
    found = per_unit.select(
        *scope,
        "metric",
        unit.alias("unit"),
        lo.alias("lo"),
        F.max("_hi").over(over_metrics).alias("hi"),
        F.sum("_n").over(of_metric).alias("observations"),
        number.alias("_number"),
    )
    return found.filter("_number = 1").drop("_number")


def _intervals(
    observed: DataFrame, bounds: DataFrame, series: Sequence[str], ts: str, step: int, tie: Sequence[str] | None, by_day: bool, sliced: bool, rows_per_task: int
) -> DataFrame:
    """Each observation with the cells it stands for: from ``first`` to ``last``, up to the next observation.

    One row more per series, without a time, stands for the cells ahead of its first observation. Rows without cells are
    left out. ``match`` is the observation, ``grid`` the bounds of the series. The bounds travel as the first row of their
    series, so observations are shuffled once and joined with nothing.
    """
    if sliced:
        observed = last_per_time(observed, series, ts, ["value", "quality_flag"], tie)
    match = F.struct(F.col(ts).alias("obs_ts"), "value", "quality_flag").alias("match")
    ties = [F.struct(*tie).alias("_tie")] if tie and not sliced else []
    rows = observed.select(*series, ts, *ties, match)
    heads = bounds.select(*series, F.struct("lo", "hi", "unit").alias("grid"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    order = [ts] if sliced else [ts, *(["_tie"] if ties else []), "match"]
    parts = split_hot(both, series, order, rows_per_task) if sliced else both
    known = carry(parts, series, {"grid": F.col("grid")}, order)
    known = carry(known, series, {"_next": F.struct(F.col(ts).alias("ts"))}, order, forward=False, own=False)
    lo, cell = micros(F.col("grid.lo")), lambda t: F.ceil((micros(t) - lo) / step)
    end = F.floor((micros(F.col("grid.hi")) - lo) / step)
    found = known.withColumns(
        {
            # An observation from before the grid stands for cells from the first one on.
            "first": F.when(F.col(ts).isNull(), F.lit(0)).otherwise(F.greatest(cell(F.col(ts)), F.lit(0))).cast("bigint"),
            "last": F.least(end, F.coalesce(cell(F.col("_next.ts")) - 1, end)).cast("bigint"),
        }
    )
    found = found.filter("first <= last").drop(ts, "_tie", "_next")
    if PART in found.columns:
        found = staged(found)
    if by_day:
        found = carry(found, series, {"_later": F.col("match")}, ["first"], forward=False)
        found = found.withColumn("match", F.coalesce("match", "_later")).drop("_later")
    return found


def _filled(intervals: DataFrame, series: Sequence[str], step: int, interpolation: str | None) -> DataFrame:
    """Adds ``value``, and ``before`` and ``after``: the points between which a cell without a value lies on a line."""
    out, value = intervals.withColumn("value", F.col("match.value")), F.col("value")
    point = lambda cell: F.struct(F.col(cell).alias("p"), F.col("value").alias("v"))
    if interpolation == "nearest":
        out = carry(out, series, {"value": value}, ["first"])
        return carry(out, series, {"value": value}, ["first"], forward=False)
    if interpolation == "linear":
        out = carry(out, series, {"before": F.when(value.isNotNull(), point("last"))}, ["first"])
        return carry(out, series, {"after": F.when(value.isNotNull(), point("first"))}, ["first"], forward=False)
    if interpolation == "true_linear":
        hit = F.col("match.obs_ts") == plus_micros(F.col("grid.lo"), F.col("first") * step)
        hit = F.when(hit & value.isNotNull(), point("first"))
        out = carry(out, series, {"before": hit}, ["first"])
        out = carry(out, series, {"after": hit}, ["first"], forward=False, own=False)
        return out.withColumn("value", F.lit(None).cast("double"))
    return out


def _cells(intervals: DataFrame, ts: str, step: int, block_cells: int, deal: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The cells of intervals; long ones are unrolled in blocks, which ``deal`` may send to other tasks first."""
    # Taken out of their structs, and times turned into numbers, before rows are multiplied.
    plain = {"_lo": F.col("grid.lo"), "unit": F.col("grid.unit"), "_flag": F.col("match.quality_flag")}
    plain["_ahead"] = micros(F.col("grid.lo")) - micros(F.col("match.obs_ts"))
    intervals = intervals.withColumns(plain).drop("grid", "match")
    blocks = intervals.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("last") - F.col("first")) / block_cells))))
    if deal:
        blocks = deal(blocks)
    begin = F.col("first") + F.col("_block") * block_cells
    cells = blocks.withColumn("cell", F.explode(F.sequence(begin, F.least(begin + (block_cells - 1), F.col("last")))))
    if "before" in cells.columns:
        before, after, cell = F.col("before"), F.col("after"), F.col("cell")
        line = F.when(after["p"] > before["p"], before["v"] + (after["v"] - before["v"]) * ((cell - before["p"]) / (after["p"] - before["p"])))
        at = F.when(cell == before["p"], before["v"]).when(before.isNotNull() & after.isNotNull(), line)
        cells = cells.withColumn("value", F.coalesce("value", at))
    return cells.withColumns({ts: plus_micros(F.col("_lo"), F.col("cell") * step), "_gap": F.col("_ahead") + F.col("cell") * step})


def grid(bounds: DataFrame, keys: Sequence[str], ts: str, freq: str | Duration, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """Every grid time of every series in ``bounds``, with its ``cell`` number from 0.

    The grid is unrolled in blocks that are spread over tasks first, so one long series fills many tasks and no row
    holds more than one block.
    """
    step = Duration.of(freq)
    bounds = bounds.drop("observations")
    lo, hi = F.col("lo"), F.col("hi")
    if step.micros is None:
        per_step = F.make_ym_interval(F.lit(0), F.lit(step.months))
        cells = bounds.select("*", F.posexplode(F.sequence(lo, hi, per_step)).alias("cell", ts))
        return cells.withColumn("cell", F.col("cell").cast("bigint")).drop("lo", "hi")
    last = F.floor((micros(hi) - micros(lo)) / step.micros)
    zero = F.lit(0).cast("bigint")
    blocks = bounds.select("*", F.explode(F.sequence(zero, F.floor(last / block_cells))).alias("_block"))
    blocks = blocks.repartition(*keys, "_block")
    first = F.col("_block") * block_cells
    cells = blocks.select("*", F.explode(F.sequence(first, F.least(first + (block_cells - 1), last))).alias("cell"))
    return cells.withColumn(ts, plus_micros(lo, F.col("cell") * step.micros)).drop("_block", "lo", "hi")


def resample(
    df: DataFrame,
    freq: str | Duration = "1m",
    *,
    interpolation: str | None = None,
    by_day: bool = False,
    day_anchor: str = "first",
    keys: Sequence[str] = ("device_id", "domain"),
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Resample a canonical long frame to a grid of step ``freq``.

    The grid of a device and domain runs from its first to its last time over all metrics. Each cell takes the last
    observation at or before it. ``is_interpolated`` marks cells with no observation at exactly their time,
    ``gap_duration`` is their distance to the observation in whole seconds, and the flag is 1 with no observation,
    5 when interpolated, else the observation's own.

    ``by_day`` makes one grid per day with nothing carried over from the day before; cells ahead of a metric's first
    observation then take that observation (negative gap). ``day_anchor="midnight"`` starts each day's grid at 00:00.

    ``interpolation`` acts on values that are null after that: ``forward`` or None leaves them, ``linear`` draws a
    line by cell, ``nearest`` fills forward, then backward. ``true_linear`` (an extension) instead draws lines between
    the cells that hit an observation.
    """
    if interpolation not in _FILLS:
        raise ValueError(f"interpolation must be one of {_FILLS}, not {interpolation!r}")
    if day_anchor not in ("first", "midnight"):
        raise ValueError(f"day_anchor must be 'first' or 'midnight', not {day_anchor!r}")
    keys = list(keys)
    timed = df.filter(F.col(ts).isNotNull())
    day = ["_day"] if by_day else []
    series = [*keys, "metric", *day]

    observed = timed.withColumn("value", F.col("value").cast("double"))
    if by_day:
        observed = observed.withColumn("_day", F.to_date(ts))
    step = Duration.of(freq).micros
    bounds = series_bounds(timed, keys, ts, by_day, day_anchor)
    length = (micros(F.col("hi")) - micros(F.col("lo"))) / (step or Duration.of("4w").micros)
    if step is not None:
        # The bounds are computed once: what decides on the plan is read off while they are written.
        sizes = Observation()
        bounds = staged(bounds.observe(sizes, F.max("observations").alias("seen"), F.max(length).alias("cells")))
        seen, cells = sizes.get.get("seen"), sizes.get.get("cells")
        return aligned(
            observed, bounds, step, series=series, ts=ts, tie=tie, interpolation=interpolation, by_day=by_day,
            seen=seen, cells=cells, rows_per_task=rows_per_task, block_cells=block_cells,
        )
    cells = grid(bounds, series, ts, freq, block_cells).select(*series, ts, "cell", "unit")
    counted = bounds.select(*series, (F.col("observations") + length).alias("_n"))
    out = match_backward(
        observed, cells, series, ts, ["value", "quality_flag"], counted, tie=tie, rows_per_task=rows_per_task
    )

    if PART in out.columns and (by_day or interpolation not in (None, "forward")):
        out = staged(out)
    if by_day:
        out = _take_first_match(out, series, ts)
    out = out.withColumn("value", F.col("match.value"))
    if interpolation == "linear":
        out = linear_between(out, "value", "cell", series, [ts])
    elif interpolation == "nearest":
        out = carry(out, series, {"value": F.col("value")}, [ts])
        out = carry(out, series, {"value": F.col("value")}, [ts], forward=False)
    elif interpolation == "true_linear":
        hit = F.coalesce(F.col("match.obs_ts") == F.col(ts), F.lit(False))
        out = linear_between(out.withColumn("value", F.when(hit, F.col("value"))), "value", "cell", series, [ts])
    return _marked(out, ts)


def aligned(
    observed: DataFrame,
    bounds: DataFrame,
    step: int,
    *,
    series: Sequence[str],
    ts: str,
    tie: Sequence[str] | None = None,
    interpolation: str | None = None,
    by_day: bool = False,
    seen: int | None = None,
    cells: float | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """Resampled rows of observations whose grids are known: ``bounds`` has ``lo``, ``hi`` and ``unit`` per series.

    ``seen`` and ``cells`` are the most observations and cells of any one series.
    """
    intervals = _intervals(observed, bounds, series, ts, step, tie, by_day, (seen or 0) > rows_per_task, rows_per_task)
    spread = (lambda blocks: blocks.repartition(*series, "first", "_block")) if (cells or 0) > rows_per_task else None
    return _marked(_cells(_filled(intervals, series, step, interpolation), ts, step, block_cells, spread), ts)


def aligned_in_places(
    observed: DataFrame,
    bounds: DataFrame,
    step: int,
    place: Callable[[DataFrame], DataFrame],
    columns: Sequence[str],
    *,
    series: Sequence[str],
    ts: str,
    tie: Sequence[str] | None = None,
    interpolation: str | None = None,
    by_day: bool = False,
    seen: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``aligned``, together by the ``columns`` that ``place`` adds to intervals, which it may part; for a partitioned write.

    Blocks of cells are rebalanced before they are unrolled, so cells need no shuffle of their own.
    """
    intervals = _intervals(observed, bounds, series, ts, step, tie, by_day, (seen or 0) > rows_per_task, rows_per_task)
    placed = place(_filled(intervals, series, step, interpolation))
    return _marked(_cells(placed, ts, step, DEALT_CELLS, lambda blocks: blocks.hint("rebalance", *columns)), ts, columns)


def _marked(out: DataFrame, ts: str, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of a resampled frame, from each cell's ``_gap`` in microseconds and ``_flag``, or else its ``match``."""
    if "_gap" not in out.columns:
        out = out.withColumns({"_gap": micros(F.col(ts)) - micros(F.col("match.obs_ts")), "_flag": F.col("match.quality_flag")})
    exact = F.coalesce(F.col("_gap") == 0, F.lit(False))
    out = out.withColumns(
        {
            "is_interpolated": ~exact,
            "gap_duration": F.when(exact, 0.0).otherwise((F.col("_gap") / 1_000_000).cast("bigint").cast("double")),
            "quality_flag": F.when(F.col("_gap").isNull(), MISSING)
            .when(~exact, INTERPOLATED)
            .otherwise(F.col("_flag"))
            .cast("bigint"),
        }
    )
    names = [ts if c == "ts" else c for c in RESAMPLED]
    return out.select(*[c if c in out.columns else F.lit("").alias(c) for c in names], *keep)


def _take_first_match(df: DataFrame, series: Sequence[str], ts: str) -> DataFrame:
    """Cells with no match take the match of the first cell of their day that has one."""
    match = F.col("match")
    first = F.min(F.when(match.isNotNull(), F.struct(F.col(ts).alias("t"), match.alias("match"))))
    out = df.withColumn("_first", first.over(Window.partitionBy(*group_keys(df, series))))
    out = with_edges(out, df, series, {"_later": match}, [ts], forward=False)
    return out.withColumn("match", F.coalesce(match, F.col("_first.match"), F.col("_later"))).drop("_first", "_later")


def resample_by_domain(
    df: DataFrame, settings: Mapping[str, Mapping], *, strict: bool = False, **options
) -> DataFrame:
    """Resample each domain with its own ``{freq, interpolation, independent_by_day, day_anchor, tie}``; others are left out.

    ``strict`` raises on a domain without settings, which needs one distinct count of the domains.
    """
    if not settings:
        raise ValueError("no domain has resample settings")
    if strict:
        unknown = df.filter(~F.col("domain").isin(list(settings))).select("domain").limit(1).collect()
        if unknown:
            raise ValueError(f"domain {unknown[0][0]!r} has no resample settings")
    parts = [
        resample(
            df.filter(F.col("domain") == domain),
            s.get("freq", "1m"),
            interpolation=s.get("interpolation"),
            **{"by_day": bool(s.get("independent_by_day", False)), "day_anchor": s.get("day_anchor", "first"), "tie": s.get("tie"), **options},
        )
        for domain, s in settings.items()
    ]
    return reduce(DataFrame.unionByName, parts)
