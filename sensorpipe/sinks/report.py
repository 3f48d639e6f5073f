"""Rows before and after a step, per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_report(
    before: DataFrame, after: DataFrame, by: Sequence[str] = ("source_file",), rejected: DataFrame | None = None
) -> DataFrame:
    """Per source ``rows_before``, ``rows_after`` and ``failed`` (a source of which nothing is left).

    With ``rejected`` also how many rows were kept apart, as ``rows_rejected``.
    """

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))

    both = counts(before, "rows_before").join(counts(after, "rows_after"), list(by), "full_outer")
    zero = F.lit(0).cast("bigint")
    apart = []
    if rejected is not None:
        both = both.join(counts(rejected, "rows_rejected"), list(by), "left")
        apart = [F.coalesce("rows_rejected", zero).alias("rows_rejected")]
    return both.select(
        *by,
        F.coalesce("rows_before", zero).alias("rows_before"),
        F.coalesce("rows_after", zero).alias("rows_after"),
        (F.coalesce("rows_after", zero) == 0).alias("failed"),
        *apart,
    )


def totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("sources"),
        F.count_if("failed").alias("failed_sources"),
        F.sum("rows_before").alias("rows_before"),
        F.sum("rows_after").alias("rows_after"),
    )
