"""Cleaning rules per column, with one quality flag per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.constants import DISCONNECTED, MISSING, OK, OUT_OF_RANGE, SPIKE
from sensorpipe.operators.fill import fill_both_ways, previous
from sensorpipe.operators.skew import ROWS_PER_TASK

_TYPES = {"int": "bigint", "float": "double"}


def typed(column: str, rule: Mapping) -> Column:
    """The column cast by the rule; what cannot be cast becomes null."""
    kind = _TYPES.get(rule.get("type"))
    return F.col(column).try_cast(kind) if kind else F.col(column)


def in_range(x: Column, rule: Mapping) -> Column:
    """x, or null outside [min, max]."""
    outside = [x < rule["min"]] if "min" in rule else []
    outside += [x > rule["max"]] if "max" in rule else []
    return F.when(reduce(or_, outside), None).otherwise(x) if outside else x


def _any(marks: Sequence[Column]) -> Column:
    return reduce(or_, marks) if marks else F.lit(False)


def clean(
    df: DataFrame,
    rules: Mapping[str, Mapping],
    *,
    keys: Sequence[str] = ("device_id", "day"),
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    add_quality: bool = True,
    flag_mode: str = "documented",
    flag_columns: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Cast, range check and spike check the ruled columns; add ``quality_flag``.

    A spike is a jump of more than ``max_diff`` from the previous row of the series ``keys``; both rows of a
    one-row outlier are marked. Flags, in order of priority: missing 1, not castable 4, out of range 3, spike 2, ok 0.

    ``flag_mode="documented"`` calls a row missing when the input had a null; ``"as_coded"`` when the output has one,
    so that every rejected value reads as missing. ``flag_columns`` are looked at for nulls: all columns by default.
    """
    if flag_mode not in ("documented", "as_coded"):
        raise ValueError(f"flag_mode must be 'documented' or 'as_coded', not {flag_mode!r}")
    present = {c: r for c, r in rules.items() if c in df.columns}
    looked_at = [c for c in (flag_columns or df.columns) if c in df.columns]
    columns = df.columns
    missing_in = _any([F.col(c).isNull() for c in looked_at])
    spiky = [c for c, r in present.items() if "max_diff" in r]

    marks = {"_missing": missing_in}
    after = {}
    impossible, outside = [], []
    for c, rule in present.items():
        cast = typed(c, rule)
        ranged = in_range(cast, rule)
        impossible.append(F.col(c).isNotNull() & cast.isNull())
        outside.append(cast.isNotNull() & ranged.isNull())
        after[c] = ranged
    marks["_impossible"], marks["_outside"] = _any(impossible), _any(outside)
    order_by = {}
    if spiky and not tie:
        # The tie-break reads the input, before any value is replaced.
        order_by["_order"] = F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])
    out = df.withColumns({**order_by, **marks, **after})

    spikes = []
    if spiky:
        out = previous(out, spiky, keys=keys, ts=ts, tie=tie or ["_order"], prefix="_prev_", rows_per_task=rows_per_task)
        kept = {}
        for c in spiky:
            jump = F.abs(F.col(c) - F.col(f"_prev_{c}")).cast("double")
            spike = F.coalesce((jump > present[c]["max_diff"]) & (jump < float("inf")), F.lit(False))
            spikes.append(spike)
            kept[c] = F.when(spike, None).otherwise(F.col(c))
        out = out.withColumns({"_spike": _any(spikes), **kept})
    else:
        out = out.withColumn("_spike", F.lit(False))

    if not add_quality:
        return out.select(*columns)
    missing = F.col("_missing") if flag_mode == "documented" else _any([F.col(c).isNull() for c in looked_at])
    flag = (
        F.when(missing, MISSING)
        .when(F.col("_impossible"), DISCONNECTED)
        .when(F.col("_outside"), OUT_OF_RANGE)
        .when(F.col("_spike"), SPIKE)
        .otherwise(OK)
    )
    return out.select(*[c for c in columns if c != "quality_flag"], flag.cast("bigint").alias("quality_flag"))


def rules_fill_drop(
    df: DataFrame,
    rules: Mapping[str, Mapping],
    *,
    keys: Sequence[str],
    ts: str = "Time",
    tie: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Keep time and ruled columns, cast, null what is out of range, fill both ways, drop rows still null.

    With no rules the frame is returned as it is. ``keys`` and ``tie`` columns are kept.
    """
    if not rules:
        return df
    present = [c for c in rules if c in df.columns]
    carried = list(dict.fromkeys([*keys, *(tie or [])]))
    out = df.select(*[c for c in carried if c not in (ts, *present)], ts, *present)
    out = out.withColumns({c: in_range(typed(c, rules[c]), rules[c]) for c in present})
    numeric = [
        f.name for f in out.schema.fields if f.name in present and isinstance(f.dataType, (T.IntegralType, T.DoubleType, T.FloatType))
    ]
    if not numeric:
        return out
    out = fill_both_ways(out, numeric, keys=keys, ts=ts, tie=tie, rows_per_task=rows_per_task)
    return out.dropna(subset=numeric)
