"""What is added to cleaned series: rolling statistics, rates of change, event flags, joined views, corrections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.constants import CORRECTED
from sensorpipe.functions.times import Duration, micros
from sensorpipe.operators.asof import asof_backward
from sensorpipe.operators.fill import previous
from sensorpipe.operators.skew import PART, ROWS_PER_TASK, any_hot, attach, by_part, carry, content_hash, count_by, series_window, split_hot, with_order
from sensorpipe.session import staged

#: Windows in one slice of a series; a slice also reads the last window of the slice before it.
SLICE_WINDOWS = 64
_STATS = ("count", "sum", "min", "max")


def _stats(number: Column, window) -> Column:
    return F.struct(*[f(number).over(window).alias(n) for f, n in zip((F.count, F.sum, F.min, F.max), _STATS)])


def _joined(first: Column, second: Column) -> dict[str, Column]:
    """``count``, ``mean``, ``min`` and ``max`` of two parts of a window, of which the second may be null."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    count = zero(first["count"]) + zero(second["count"])
    total = zero(first["sum"]) + zero(second["sum"])
    return {
        "count": count,
        "mean": F.when(count > 0, total / count),
        "min": F.least(first["min"], second["min"]),
        "max": F.greatest(first["max"], second["max"]),
    }


def rolling(
    df: DataFrame,
    window: str,
    *,
    keys: Sequence[str] = ("device_id", "metric"),
    ts: str = "ts",
    value: str = "value",
    tie: Sequence[str] = (),
    event_rate: float | None = None,
    slice_windows: int = SLICE_WINDOWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``count``, ``mean``, ``min`` and ``max`` of the values in the ``window`` that ends at each row, and ``rate``.

    The window is closed on both sides and holds all rows of its last instant; null values do not count. ``rate`` is the
    change per second since the row before (by time, then ``tie``, else row content), null where that is farther back
    than the window, at the same instant, or where a value is null. ``event`` is whether the rate exceeds ``event_rate``
    in size, null without a rate. Rows without a time have none of these.

    Time is cut into blocks as long as the window. A window is then the end of one block and the beginning of the next:
    running statistics from both ends of every block give it in time linear in the rows, whatever the window holds, and
    without differences of large sums. Series are dealt out in slices of ``slice_windows`` blocks that overlap by one, in
    one shuffle. Where a slice has more than ``rows_per_task`` rows, instants are reduced to one row and sliced by number.
    """
    size = Duration.of(window)
    if size.micros is None:
        raise ValueError(f"a rolling window needs a fixed length, not {window!r}")
    at = micros(F.col(ts))
    slices = df.select(*keys, F.floor(at / (size.micros * slice_windows)).alias("_slice")).filter("_slice IS NOT NULL")
    if any_hot(count_by(slices, [*keys, "_slice"]), rows_per_task):
        out = _rolling_sliced(df, size.micros, keys, ts, value, tie, rows_per_task)
    else:
        out = _rolling_in_slices(df, size.micros, keys, ts, value, tie, slice_windows)
    return out if event_rate is None else out.withColumn("event", F.abs("rate") > event_rate)


def _rate(number: Column, at: Column, before: Column, size: int) -> Column:
    passed = (at - before["at"]) / 1_000_000
    return F.when((passed > 0) & (passed <= size / 1_000_000), (number - before["of"]) / passed)


def _rolling_in_slices(df, size, keys, ts, value, tie, slice_windows) -> DataFrame:
    at, width, number = micros(F.col(ts)), size * slice_windows, F.col(value).cast("double")
    own = F.floor(at / width)
    # A row also stands, as a mere neighbour, in the slice that its window reaches into.
    reach = F.floor((at + size) / width)
    places = F.when(reach > own, F.array(own, reach)).otherwise(F.array(own))
    order = list(tie) or ["_content"]
    cut = df.withColumns({"_at": at, "_own": own, "_block": F.floor(at / size), **({} if tie else {"_content": content_hash(df)})})
    cut = cut.withColumn("_slice", F.explode_outer(places))
    rows = Window.partitionBy(*keys, "_slice")
    block = Window.partitionBy(*keys, "_slice", "_block")
    ends = lambda *by: block.orderBy(*by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag(F.struct(F.col("_at").alias("at"), number.alias("of"))).over(rows.orderBy("_at", *order))
    known = cut.withColumns({
        "_upto": _stats(number, ends("_at")),
        "_onward": F.struct(F.col("_block").alias("block"), _stats(number, ends(F.desc("_at"))).alias("stats")),
        "rate": _rate(number, F.col("_at"), before, size),
    })
    # What stands in a block from a row on is needed one window later, up to that row's time and a window.
    twice = F.array(F.struct(F.col("_at").alias("at"), F.lit(1).alias("row")), F.struct((F.col("_at") + size).alias("at"), F.lit(0).alias("row")))
    merged = known.withColumn("_time", F.explode(twice))
    back = rows.orderBy(F.desc("_time.at"), "_time.row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = merged.withColumn("_seen", F.last(F.when(F.col("_time.row") == 0, F.col("_onward")), True).over(back))
    out = merged.filter((F.col("_time.row") == 1) & F.col("_slice").eqNullSafe(F.col("_own")))
    left = F.when(F.col("_seen.block") == F.col("_block") - 1, F.col("_seen.stats"))
    found = {n: F.when(F.col(ts).isNotNull(), c) for n, c in _joined(F.col("_upto"), left).items()}
    return out.withColumns(found).select(*df.columns, *found, "rate")


def _rolling_sliced(df, size, keys, ts, value, tie, rows_per_task) -> DataFrame:
    """The same by instants: blocks are cut into slices of equally many instants, whose sums are passed on."""
    number, blocks = F.col(value).cast("double"), [*keys, "_block"]
    timed = df.filter(F.col(ts).isNotNull())
    one = timed.groupBy(*keys, ts).agg(*[f(number).alias(n) for f, n in zip((F.count, F.sum, F.min, F.max), _STATS)])
    one = staged(one.withColumns({"_at": micros(F.col(ts)), "_block": F.floor(micros(F.col(ts)) / size)}))
    parts = split_hot(one, blocks, ["_at"], rows_per_task)
    known = _running(_running(parts, blocks, True, "_upto"), blocks, False, "_onward")
    known = staged(known.drop(PART))
    rows = known.select(*keys, "_block", "_at", F.lit(0).alias("_later"), "_upto", ts)
    later = known.select(*keys, (F.col("_block") + 1).alias("_block"), (F.col("_at") + size).alias("_at"), F.lit(1).alias("_later"), "_onward")
    order = ["_at", "_later"]
    both = split_hot(rows.unionByName(later, allowMissingColumns=True), blocks, order, rows_per_task)
    seen = carry(both, blocks, {"_seen": F.col("_onward")}, order, forward=False).filter("_later = 0")
    found = _joined(F.col("_upto"), F.col("_seen"))
    per_instant = staged(seen.select(*keys, ts, F.struct(*[c.alias(n) for n, c in found.items()]).alias("_found")))
    out = attach(df.withColumn("_at", micros(F.col(ts))), per_instant, [*keys, ts], ["_found"], rows_per_task=rows_per_task)
    out = previous(out.withColumn("_of", number), ["_at", "_of"], keys=keys, ts=ts, tie=list(tie) or None, rows_per_task=rows_per_task)
    before = F.struct(F.col("prev__at").alias("at"), F.col("prev__of").alias("of"))
    return out.select(*df.columns, *[F.col(f"_found.{n}").alias(n) for n in found], _rate(F.col("_of"), F.col("_at"), before, size).alias("rate"))


def _running(parts: DataFrame, blocks: Sequence[str], forward: bool, name: str) -> DataFrame:
    """Statistics from the beginning of each block up to a row, or from the row to its end; slices are summed up first."""
    folds = (F.sum, F.sum, F.min, F.max)
    own = series_window(parts, blocks, ["_at"], forward).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.withColumn(name, F.struct(*[f(n).over(own).alias(n) for f, n in zip(folds, _STATS)]))
    if PART not in parts.columns:
        return out
    sums = parts.filter(F.col(PART).isNotNull()).groupBy(*blocks, PART).agg(*[f(n).alias(n) for f, n in zip(folds, _STATS)])
    earlier = Window.partitionBy(*blocks).orderBy(F.col(PART) if forward else F.desc(PART)).rowsBetween(Window.unboundedPreceding, -1)
    passed = sums.select(*blocks, PART, F.struct(*[f(n).over(earlier).alias(n) for f, n in zip(folds, _STATS)]).alias("_passed"))
    out = by_part(out, passed, blocks, ["_passed"])
    add = lambda n: F.coalesce(F.col(f"_passed.{n}"), F.lit(0)) + F.coalesce(F.col(f"{name}.{n}"), F.lit(0))
    both = F.struct(
        add("count").alias("count"), add("sum").alias("sum"),
        F.least("_passed.min", f"{name}.min").alias("min"), F.greatest("_passed.max", f"{name}.max").alias("max"),
    )
    return out.withColumn(name, both).drop("_passed")


def event_segments(
    df: DataFrame,
    start: float,
    end: float | None = None,
    *,
    min_length: str | None = None,
    keys: Sequence[str] = ("device_id", "metric"),
    ts: str = "ts",
    value: str = "value",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per event of a series: ``start``, ``end``, ``readings``, ``peak``, ``mean`` and ``closed``.

    An event begins at a row whose value reaches ``start`` and goes on until a value falls below ``end`` (``start`` if
    not given), so values in between neither begin nor end one. Null values change nothing and are not counted. ``end``
    is the time of the last row in the event, ``closed`` whether a value below ``end`` followed. Events shorter than
    ``min_length`` are left out, as are rows without a time. Rows of one instant are ordered by ``tie``, else by content.

    Whether a row is inside an event follows from the rows before it; in hot series that is carried from slice to slice.
    """
    end = start if end is None else end
    if end > start:
        raise ValueError(f"an event that starts at {start} cannot end below {end}")
    number = F.col(value).cast("double")
    rows = df.filter(F.col(ts).isNotNull() & number.isNotNull() & ~F.isnan(number))
    rows, order = with_order(rows.select(*dict.fromkeys([*keys, ts, *(tie or [])]), number.alias("_value")), ts, tie)
    parts = split_hot(rows, keys, order, rows_per_task)
    signal = F.when(F.col("_value") >= start, 1).when(F.col("_value") < end, 0)
    found = carry(parts, keys, {"_state": signal}, order)
    found = staged(found) if PART in found.columns else found
    found = carry(found, keys, {"_was": F.col("_state")}, order, own=False)
    begins = F.when((F.col("_state") == 1) & ~F.col("_was").eqNullSafe(F.lit(1)), F.struct(*order))
    found = staged(found) if PART in found.columns else found
    found = carry(found, keys, {"_event": begins}, order)
    inside = F.col("_state") == 1
    # The row that ends an event still names it; it only says that the event is over.
    events = found.filter("_event IS NOT NULL AND (_state = 1 OR _was = 1)").groupBy(*keys, "_event").agg(
        F.min(F.when(inside, F.col(ts))).alias("start"),
        F.max(F.when(inside, F.col(ts))).alias("end"),
        F.count_if(inside).alias("readings"),
        F.max(F.when(inside, F.col("_value"))).alias("peak"),
        F.avg(F.when(inside, F.col("_value"))).alias("mean"),
        F.bool_or(~inside).alias("closed"),
    )
    if min_length is not None:
        least = Duration.of(min_length).micros
        if least is None:
            raise ValueError(f"the least length of an event must be fixed, not {min_length!r}")
        events = events.filter(micros(F.col("end")) - micros(F.col("start")) >= least)
    return events.drop("_event")


def joined_view(
    base: DataFrame,
    others: Mapping[str, DataFrame],
    *,
    by: Sequence[str] = ("device_id",),
    on: str = "ts",
    value: str = "value",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The rows of ``base`` with the last known value of each other series at their time, and that value's time.

    Each name in ``others`` gives the columns ``<name>`` and ``<name>_ts``; both are null before its first value.
    """
    out = base
    for name, rows in others.items():
        seen = rows.select(*by, on, F.col(value).alias(name), *[c for c in tie or () if c not in (*by, on)])
        out = asof_backward(out, seen, by=by, on=on, values=[name], tie=tie, matched_on=f"{name}_{on}", rows_per_task=rows_per_task)
    return out


def overlay(
    df: DataFrame,
    corrections: DataFrame,
    *,
    keys: Sequence[str] = ("device_id", "metric", "ts"),
    order: Sequence[str] = (),
    value: str = "value",
    flag: str = "quality_flag",
) -> DataFrame:
    """Values corrected by hand, with the flag for that; all other rows as they are.

    A correction applies to every row with its keys, and its value may be null, which takes the value away. Of several
    corrections of one key the last by ``order``, then the greatest value, counts. Keys that are null match none.
    """
    place = F.struct(*[F.col(c) for c in order], F.col(value).isNotNull(), F.col(value)) if order else F.struct(F.col(value).isNotNull(), F.col(value))
    last = corrections.groupBy(*keys).agg(F.max(F.struct(place.alias("place"), F.col(value).cast(df.schema[value].dataType).alias("to"))).alias("_new"))
    joined = df.join(last, list(keys), "left")
    known = F.col("_new").isNotNull()
    held = F.col(flag) if flag in df.columns else F.lit(None).cast("bigint")
    changed = {value: F.when(known, F.col("_new.to")).otherwise(F.col(value)), flag: F.when(known, F.lit(CORRECTED).cast("bigint")).otherwise(held)}
    columns = [*df.columns, *([] if flag in df.columns else [flag])]
    return joined.withColumns(changed).select(*columns)
