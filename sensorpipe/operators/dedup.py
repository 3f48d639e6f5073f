"""Duplicate rows and row limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, subset: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicate rows, or keep one row per ``subset``: the first by ``order``, then by the other columns.

    The choice per subset is a minimum, so copies collapse before the shuffle and no group is sorted in one task.
    """
    if not subset:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*subset).dropDuplicates()
    first = [c for c in (order or []) if c not in subset]
    ranked = first + [c for c in rest if c not in first]
    kept = df.groupBy(*subset).agg(F.min(F.struct(*ranked)).alias("_row"))
    return kept.select(*[F.col(c) if c in subset else F.col(f"_row.{c}").alias(c) for c in df.columns])


def limit_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows by a total order (a test mode of imports); n <= 0 means all rows."""
    return df.orderBy(*order).limit(n) if n > 0 else df
