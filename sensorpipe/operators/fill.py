"""Row-order functions on series: previous value, forward fill, backward fill, interpolation by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sensorpipe.operators.skew import (
    PART,
    ROWS_PER_TASK,
    any_hot,
    by_part,
    carry,
    count_by,
    group_keys,
    series_window,
    split_hot,
    with_edges,
    with_order,
)


# Rows that stand for more copies than this are spread over tasks in blocks before they are unrolled.
COPIES_PER_BLOCK = 8192


def _prepared(df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] | None, rows_per_task: int):
    """The frame with its hot series sliced, and its order columns.

    Where a series is hot, identical rows become one row with their number (``_copies``), since no slice can part them.
    """
    df, order = with_order(df, ts, tie)
    counted = count_by(df, keys)
    if not any_hot(counted, rows_per_task):
        return df, order
    if not any(isinstance(f.dataType, T.MapType) for f in df.schema.fields):
        df = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return split_hot(df, keys, order, rows_per_task), order


def _unrolled(df: DataFrame) -> DataFrame:
    """Each row as often as it occurred, numbered from 0 in ``_copy``."""
    if "_copies" not in df.columns:
        return df.withColumn("_copy", F.lit(0).cast("bigint"))
    zero, n = F.lit(0).cast("bigint"), F.col("_copies")
    spread = not df.filter(n > COPIES_PER_BLOCK).isEmpty()
    blocks = df.withColumn("_block", F.explode(F.sequence(zero, F.floor((n - 1) / COPIES_PER_BLOCK))))
    if spread:
        blocks = blocks.repartition(F.xxhash64(*df.columns), "_block")
    first = F.col("_block") * COPIES_PER_BLOCK
    rows = blocks.withColumn("_copy", F.explode(F.sequence(first, F.least(first + (COPIES_PER_BLOCK - 1), n - 1))))
    return rows.drop("_copies", "_block")


def previous(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    prefix: str = "prev_",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add each column's value in the previous row of its series."""
    parts, order = _prepared(df, keys, ts, tie, rows_per_task)
    row = F.struct(*columns)
    out = parts.withColumn("_prev", F.lag(row).over(series_window(parts, keys, order)))
    out = with_edges(out, parts, keys, {"_seed": row}, order)
    # The row before a repeated row is its own copy.
    before = F.when(F.col("_copy") > 0, row).otherwise(F.coalesce(F.col("_prev"), F.col("_seed")))
    out = _unrolled(out).withColumns({f"{prefix}{c}": before.getField(c) for c in columns})
    return out.drop("_prev", "_seed", "_tie", "_copy", PART)


def _fill(df, columns, keys, ts, tie, rows_per_task, forward):
    parts, order = _prepared(df, keys, ts, tie, rows_per_task)
    filled = carry(parts, keys, {c: F.col(c) for c in columns}, order, forward)
    return _unrolled(filled).drop("_tie", "_copy", PART)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replace nulls with the last value before them in the series."""
    return _fill(df, columns, keys, ts, tie, rows_per_task, True)


def backward_fill(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Replace nulls with the next value after them in the series."""
    return _fill(df, columns, keys, ts, tie, rows_per_task, False)


def fill_both_ways(
    df: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Forward fill; the nulls left at the head of a series take its first value."""
    parts, order = _prepared(df, keys, ts, tie, rows_per_task)
    filled = carry(parts, keys, {c: F.col(c) for c in columns}, order)
    # After a forward fill only leading nulls are left, so the first value of the series is the next value.
    return _unrolled(_first_of_series(filled, columns, keys, order)).drop("_tie", "_copy", PART)


def _first_of_series(df: DataFrame, columns: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Replace nulls that only occur at the head of a series with the first non-null value that follows."""
    place = F.struct(*order)
    whole = Window.partitionBy(*group_keys(df, keys))
    out = df.withColumns(
        {f"_head_{c}": F.min(F.when(F.col(c).isNotNull(), F.struct(place, F.col(c).alias("v")))).over(whole) for c in columns}
    )
    out = with_edges(out, df, keys, {f"_next_{c}": F.col(c) for c in columns}, order, forward=False)
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_head_{c}.v"), F.col(f"_next_{c}")) for c in columns})
    return out.drop(*[f"_head_{c}" for c in columns], *[f"_next_{c}" for c in columns])


def linear_between(df: DataFrame, column: str, position: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Fill nulls on the straight line between the values around them, by ``position``; ends stay null.

    ``df`` has been through ``split_hot``.
    """
    point = F.when(F.col(column).isNotNull(), F.struct(F.col(position).alias("p"), F.col(column).alias("v")))
    out = carry(df, keys, {"_before": point}, order)
    out = carry(out, keys, {"_after": point}, order, forward=False)
    before, after = F.col("_before"), F.col("_after")
    share = (F.col(position) - before["p"]) / (after["p"] - before["p"])
    line = before["v"] + (after["v"] - before["v"]) * share
    both = before.isNotNull() & after.isNotNull()
    return out.withColumn(column, F.coalesce(F.col(column), F.when(both, line))).drop("_before", "_after")


def interpolate(
    df: DataFrame,
    column: str,
    *,
    keys: Sequence[str],
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Linear interpolation of nulls by row position within the series.

    Every row has its own position, so copies are not merged: drop duplicates first where one time has very many.
    """
    df, order = with_order(df, ts, tie)
    parts = split_hot(df, keys, order, rows_per_task)
    out = parts.withColumn("_position", F.row_number().over(series_window(parts, keys, order)).cast("bigint"))
    if PART in parts.columns:
        sizes = parts.filter(F.col(PART).isNotNull()).groupBy(*keys, PART).agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*keys, PART, F.sum("_n").over(earlier).alias("_offset"))
        out = by_part(out, offsets, keys, ["_offset"])
        out = out.withColumn("_position", F.col("_position") + F.coalesce(F.col("_offset"), F.lit(0).cast("bigint")))
        out = out.drop("_offset")
    out = linear_between(out, column, "_position", keys, order)
    return out.drop("_position", "_tie", PART)
