"""Backward as-of join.

Both sides go into one frame ordered by time; each left row takes the last right row before it. That is one shuffle
by series. Where a series outgrows a task, its observations are first reduced to one per time, so that copies collapse
before they meet, and the series is sliced along time with the last match carried into each slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorpipe.operators.skew import ROWS_PER_TASK, any_hot, carry, count_by, split_hot


def last_per_time(
    df: DataFrame, keys: Sequence[str], ts: str, values: Sequence[str], tie: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and time: the greatest of tie-break, then values, with nulls first, as a sort has them."""
    groups = df.groupBy(*keys, ts)
    row = groups.agg(F.max(F.struct(F.struct(*(tie or [F.lit(0).alias("_")])).alias("tie"), F.struct(*values).alias("of"))).alias("_row"))
    return row.select(*keys, ts, *[F.col(f"_row.of.{v}").alias(v) for v in values])


def match_backward(
    observations: DataFrame,
    left: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    counted: DataFrame,
    *,
    tie: Sequence[str] | None = None,
    matched_on: str = "obs_ts",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The left rows with ``match``: a struct of the time and values of their last observation, null without one.

    ``counted`` holds the rows of both sides per key (``_n``). ``_part``, if any series is hot, stays in the result for
    further windows over the same series.
    """
    hot = any_hot(counted, rows_per_task)
    if hot:
        observations = last_per_time(observations, keys, ts, values, tie)
    match = F.struct(F.col(ts).alias(matched_on), *values).alias("match")
    # Equal times are ordered by the tie-break, then by value; once reduced, there are none.
    ties = [F.struct(*tie).alias("_tie")] if tie and not hot else []
    right = observations.select(*keys, ts, F.lit(0).alias("side"), *ties, match)
    both = right.unionByName(left.withColumn("side", F.lit(1)), allowMissingColumns=True)
    order = [ts, "side"] if hot else [ts, "side", *(["_tie"] if ties else []), "match"]
    parts = split_hot(both, keys, order, rows_per_task) if hot else both
    matched = carry(parts, keys, {"_matched": F.col("match")}, order)
    return matched.filter(F.col("side") == 1).drop("side", "match", "_tie").withColumnRenamed("_matched", "match")


def asof_backward(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    on: str = "ts",
    values: Sequence[str],
    tie: Sequence[str] | None = None,
    matched_on: str = "obs_ts",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add to each left row the ``values`` of the last right row of its series with ``right.on <= left.on``.

    Equal times match, there is no tolerance, and a null value is still a match. All left rows are kept.
    """
    usable = right.dropna(subset=[*by, on])
    payload = [c for c in left.columns if c not in (*by, on)]
    # An empty struct has no place in a shuffle row, so a left side without other columns carries a constant.
    row = F.struct(*payload) if payload else F.struct(F.lit(0).alias("_"))
    packed = left.select(*by, on, row.alias("row"))
    counted = count_by(left.select(*by).unionByName(usable.select(*by)), by)
    out = match_backward(
        usable, packed, by, on, values, counted, tie=tie, matched_on=matched_on, rows_per_task=rows_per_task
    )
    return out.select(
        *[F.col(c) if c in (*by, on) else F.col(f"row.{c}").alias(c) for c in left.columns],
        *[F.col(f"match.{v}").alias(v) for v in (matched_on, *values)],
    )
