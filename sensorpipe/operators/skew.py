"""Joins and ordered windows that stay balanced when one key holds a large share of the rows.

A group with more than ``rows_per_task`` rows is *hot*. An operator first counts rows by key, one job over the key
columns. Mostly nothing is hot and the plan is a plain join or window. Otherwise the rows of hot groups are sliced at
quantiles of their order. The list of hot groups is broadcast only if it has been counted and is short.

All choices depend on row values only, so a task that runs again makes the same choice again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sensorpipe.session import checkpointed, staged

ROWS_PER_TASK = 4_000_000
#: Rows of a few keys and values each that may be broadcast.
BROADCAST_ROWS = 200_000
#: Slices of fewer rows share a task and its file.
ROWS_PER_RUN = 100_000
PART = "_part"
#: ``monotonically_increasing_id`` holds the number of the row within its task in these bits.
_ROW_BITS = (1 << 33) - 1


def _match(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])


def _right(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *values)


def lookup(df: DataFrame, small: DataFrame, keys: Sequence[str], values: Sequence[str], how: str = "left") -> DataFrame:
    """Add ``values`` from a checkpointed frame with one row per key; null keys match null keys.

    It is broadcast if a count shows at most BROADCAST_ROWS rows, else joined by key.
    """
    right = _right(small, keys, values)
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return _join(df, right, keys, how)


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def any_hot(counted: DataFrame, rows_per_task: int) -> bool:
    return not counted.filter(F.col("_n") > rows_per_task).isEmpty()


def hot_groups(df: DataFrame, keys: Sequence[str], rows_per_task: int, counted: DataFrame | None = None) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows, with ``_hot`` and their number ``_n``, or None if there are none."""
    counted = count_by(df, keys) if counted is None else counted
    hot = checkpointed(counted.filter(F.col("_n") > rows_per_task).select(*keys, F.lit(True).alias("_hot"), "_n"))
    return None if hot.isEmpty() else hot


def attach(
    df: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join a frame with one row per key, of any size.

    Rows of hot keys are joined where they are, to the broadcast rows of those keys; only the others are shuffled.
    ``how`` is ``left`` (adds ``values``), ``left_semi`` or ``left_anti``; null keys match null keys.
    """
    hot = hot_groups(df, keys, rows_per_task)
    if hot is None:
        return _join(df, _right(per_key, keys, values), keys, how)
    of_hot = lambda rows, side: lookup(rows, hot, keys, [], side)
    spread = lookup(of_hot(df, "left_semi"), checkpointed(of_hot(per_key, "left_semi")), keys, values, how)
    return spread.unionByName(_join(of_hot(df, "left_anti"), _right(per_key, keys, values), keys, how))


def _join(df: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    return df.join(right, _match(keys), how).drop(*[f"_r_{k}" for k in keys])


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Where groups are hot, add ``_part``: null in groups that fit one task, else the row's slice along ``order``.

    Slices are the ranges of a sort of all hot rows by keys, order and row content, cut by sampled quantiles: stray
    times far away from all others do not matter, and rows of one instant are parted like any. ``_part`` grows with
    ``order``, so a window over keys and part, plus what the earlier parts pass on (``edges``), gives the same rows as a
    window over the keys alone. With no hot group the frame is returned as it is.

    Tasks and files follow the number of rows: where ``rows_per_task`` is below ROWS_PER_RUN, a task sorts a longer run
    and cuts it into slices of ``rows_per_task``.

    Only the rows of hot groups are written to the shared folder, which fixes their slices; the others stay as they are.
    ``counted`` (keys and ``_n``) can stand in for counting ``df`` where that is cheaper.
    """
    hot = hot_groups(df, keys, rows_per_task, counted)
    if hot is None:
        return df
    rows = hot.agg(F.sum("_n")).first()[0]
    sort = [*keys, *order, content_hash(df)]
    ranged = lookup(df, hot, keys, [], "left_semi").repartitionByRange(-(-2 * rows // max(rows_per_task, ROWS_PER_RUN)), *sort)
    part = F.spark_partition_id().cast("bigint")
    if rows_per_task < ROWS_PER_RUN:
        ranged, place = ranged.sortWithinPartitions(*sort), F.monotonically_increasing_id()
        part = place - place.bitwiseAND(F.lit(_ROW_BITS)) % rows_per_task
    cut = staged(ranged.withColumn(PART, part))
    return cut.unionByName(lookup(df, hot, keys, [], "left_anti").withColumn(PART, F.lit(None).cast("bigint")))


def edges(
    df: DataFrame,
    keys: Sequence[str],
    payloads: Mapping[str, Column],
    order: Sequence[str],
    forward: bool = True,
) -> DataFrame:
    """Per part of a hot group: the nearest non-null payload in the parts before it (or after it)."""
    place = F.struct(*order)
    pick = F.max_by if forward else F.min_by
    ends = (
        df.filter(F.col(PART).isNotNull())
        .groupBy(*keys, PART)
        .agg(*[pick(p, F.when(p.isNotNull(), place)).alias(name) for name, p in payloads.items()])
    )
    step = F.col(PART).asc() if forward else F.col(PART).desc()
    earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(*keys, PART, *[F.last(name, True).over(earlier).alias(name) for name in payloads])


def by_part(df: DataFrame, per_part: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add ``values`` of a frame with one row per slice."""
    return _join(df, _right(per_part, [*keys, PART], values), [*keys, PART], "left")


def with_edges(
    df: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    payloads: Mapping[str, Column],
    order: Sequence[str],
    forward: bool = True,
) -> DataFrame:
    """Add the edges of ``source`` to ``df``; null where no group is hot."""
    if PART in source.columns:
        # One row per slice, joined where the slices are: no slice is larger than a task may hold.
        return by_part(df, edges(source, keys, payloads, order, forward), keys, list(payloads))
    kinds = source.select(*[p.alias(n) for n, p in payloads.items()]).schema
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in kinds.fields})


def group_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [*keys, PART] if PART in df.columns else list(keys)


def series_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], forward: bool = True) -> Window:
    # Descending order puts nulls last, which mirrors the ascending order.
    columns = [F.col(c) if forward else F.col(c).desc() for c in order]
    return Window.partitionBy(*group_keys(df, keys)).orderBy(*columns)


def carry(
    df: DataFrame, keys: Sequence[str], payloads: Mapping[str, Column], order: Sequence[str], forward: bool = True, own: bool = True
) -> DataFrame:
    """Set each name to the latest non-null payload up to the row (or the next one from the row on).

    Without ``own`` the row's own payload does not count.

    ``df`` has been through ``split_hot``. The backward direction sorts in reverse: a frame that ends at the last
    row would be scanned anew for every row.
    """
    window = series_window(df, keys, order, forward).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    filled = df.withColumns({n: F.last(p, True).over(window) for n, p in payloads.items()})
    if PART not in df.columns:
        return filled
    seeds = {f"_seed_{n}": p for n, p in payloads.items()}
    filled = with_edges(filled, df, keys, seeds, order, forward)
    return filled.withColumns({n: F.coalesce(F.col(n), F.col(f"_seed_{n}")) for n in payloads}).drop(*seeds)


def content_hash(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """Stable tie-break for rows with equal order columns."""
    columns = [f.name for f in df.schema.fields if f.name not in skip and not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*columns)


def with_order(df: DataFrame, ts: str, tie: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """The frame and its order columns; without a tie-break column, equal times are ordered by row content."""
    if tie:
        return df, [ts, *tie]
    return df.withColumn("_tie", content_hash(df)), [ts, "_tie"]
