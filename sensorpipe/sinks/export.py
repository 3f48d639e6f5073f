"""CSV export with fixed decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.constants import CSV_NULL
from sensorpipe.functions.rounding import Decimals, by_metric, decimals_for, float_columns
from sensorpipe.functions.times import format_time, normalize_time_text


def fixed_text(x: Column, n: int) -> Column:
    return F.when(x.isNotNull(), F.format_string(f"%.{n}f", x.cast("double")))


def to_csv_text(df: DataFrame, decimals: Decimals = None, ts: str = "ts") -> DataFrame:
    """The frame as it goes to CSV: ISO times, floats with fixed decimals as text, null values ``NaN``."""
    if ts in df.columns:
        kind = df.schema[ts].dataType
        iso = normalize_time_text(F.col(ts)) if isinstance(kind, T.StringType) else format_time(F.col(ts))
        df = df.withColumn(ts, iso)
    if "metric" in df.columns and "value" in df.columns:
        v = F.col("value")
        text = by_metric(decimals, F.col("metric"), lambda n: fixed_text(v, n), v.cast("string"))
        return df.withColumn("value", F.coalesce(text, F.lit(CSV_NULL)))
    wanted = {c: decimals_for(decimals, c) for c in float_columns(df, [ts])}
    return df.withColumns(
        {c: F.coalesce(fixed_text(F.col(c), n), F.lit(CSV_NULL)) for c, n in wanted.items() if n is not None}
    )


def export_csv(df: DataFrame, path: str, *, decimals: Decimals = None, ts: str = "ts", partition_by: tuple[str, ...] = ()) -> None:
    rows = to_csv_text(df, decimals, ts)
    writer = rows.write.mode("overwrite").option("header", "true").option("nullValue", CSV_NULL).option("emptyValue", "")
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def rewrite_lines(df: DataFrame, path: str, line: str = "value") -> None:
    """Write text lines to a new folder."""
    df.select(line).write.mode("errorifexists").text(path)
