"""Load only what the sink does not have yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorpipe.operators.aggregate import distinct_days
from sensorpipe.operators.skew import ROWS_PER_TASK, attach
from sensorpipe.session import staged

MODES = ("none", "max_ts", "missing_days")


def after_high_water(new: DataFrame, sink: DataFrame, *, ts: str = "Time", sink_ts: str | None = None) -> DataFrame:
    """Rows later than the latest time in the sink; all rows when the sink is empty."""
    mark = sink.select(F.max(sink_ts or ts)).scalar()
    return new.filter(mark.isNull() | (F.col(ts) > mark))


def missing_days(
    new: DataFrame,
    sink: DataFrame,
    *,
    ts: str = "Time",
    sink_ts: str | None = None,
    day: str = "day",
    by: Sequence[str] = ("source_file",),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows of sources whose day is not in the sink.

    The day of a source is the one in its name (``day`` column), else that of its first time. Sources with no day are
    left out, unless no source has one.
    """
    # One row per source and named day, from which days, first times and "is any day known" all follow.
    first = new.groupBy(*by, day).agg(F.min(ts).alias("_first"))
    sources = staged(first.withColumn("_day", F.coalesce(F.col(day), F.to_date("_first"))))
    present = distinct_days(sink, sink_ts or ts).select(F.col("day").alias("_present"))
    known = not sources.filter(F.col("_day").isNotNull()).isEmpty()
    # The calendar bounds the number of distinct days.
    absent = sources.join(F.broadcast(present), F.col("_day") == F.col("_present"), "left_anti")
    wanted = absent.filter(F.col("_day").isNotNull()) if known else absent
    return attach(new, wanted, [*by, day], [], "left_semi", rows_per_task=rows_per_task)


def select_new(new: DataFrame, sink: DataFrame, mode: str = "none", **options) -> DataFrame:
    """``mode`` is ``none``, ``max_ts`` or ``missing_days``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "none":
        return new
    return after_high_water(new, sink, **options) if mode == "max_ts" else missing_days(new, sink, **options)
