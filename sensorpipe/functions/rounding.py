"""Rounding by configured number of decimals: one number, or ``{name: n, "default": n}``."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Decimals = int | Mapping[str, int | None] | None


def decimals_for(decimals: Decimals, name: str) -> int | None:
    if decimals is None or isinstance(decimals, int):
        return decimals
    n = decimals[name] if name in decimals else decimals.get("default")
    return None if n is None else int(n)


def round_to(x: Column, n: int, ties: str = "half_up") -> Column:
    if ties not in ("half_up", "half_even"):
        raise ValueError(f"ties must be 'half_up' or 'half_even', not {ties!r}")
    return F.round(x, n) if ties == "half_up" else F.bround(x, n)


def float_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip]


def round_columns(df: DataFrame, decimals: Decimals, skip: Sequence[str] = (), ties: str = "half_up") -> DataFrame:
    wanted = {c: decimals_for(decimals, c) for c in float_columns(df, skip)}
    return df.withColumns({c: round_to(F.col(c), n, ties) for c, n in wanted.items() if n is not None})


def by_metric(decimals: Decimals, metric: Column, each, otherwise: Column) -> Column:
    """``each(n)`` for the metrics with n decimals, ``otherwise`` for metrics without a setting."""
    if decimals is None:
        return otherwise
    default = decimals_for(decimals, "")
    fallback = otherwise if default is None else each(default)
    if isinstance(decimals, int):
        return fallback
    names = defaultdict(list)
    for name, n in decimals.items():
        if name != "default":
            names[n].append(name)
    case = None
    for n, listed in names.items():
        branch = otherwise if n is None else each(int(n))
        hit = metric.isin(listed)
        case = F.when(hit, branch) if case is None else case.when(hit, branch)
    return fallback if case is None else case.otherwise(fallback)


def round_by_metric(
    df: DataFrame, decimals: Decimals, metric: str = "metric", value: str = "value", ties: str = "half_up"
) -> DataFrame:
    v = F.col(value)
    return df.withColumn(value, by_metric(decimals, F.col(metric), lambda n: round_to(v, n, ties), v))
