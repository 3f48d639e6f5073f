"""Zones of a written stage: first and last time of every file and group, so that runs over a range open few files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.functions.times import parse_bound, time_literal
from sensorpipe.operators.skew import ROWS_PER_TASK, attach
from sensorpipe.sinks.tables import table_exists

_FILE, _FIRST, _LAST, _ROWS = "zone_file", "zone_first", "zone_last", "zone_rows"


def zones_path(path: str, ts: str, by: Sequence[str]) -> str:
    """Beside the data, in a folder that readers of the data pass over."""
    return f"{path.rstrip('/')}/_zones/{'+'.join([ts, *by])}"


def _files(df: DataFrame) -> list[str]:
    return [re.sub("^file:/+", "file:///", unquote(f)) for f in df.inputFiles()]


def _held(spark: SparkSession, path: str, ts: str, by: Sequence[str]) -> DataFrame | None:
    kept = zones_path(path, ts, by)
    return spark.read.parquet(kept) if table_exists(spark, kept) else None


def refresh(spark: SparkSession, path: str, ts: str, by: Sequence[str]) -> DataFrame:
    """The zones of all files of a Parquet folder: (zone_file, <by>, zone_first, zone_last, zone_rows).

    Files are written once and never changed, so only those without a zone are read, and of them the columns ``ts`` and
    ``by``. Zones of files that are gone are left out.
    """
    whole = spark.read.option("mergeSchema", "true").parquet(path)
    present = spark.createDataFrame([(f,) for f in _files(whole)], f"{_FILE} string")
    held = _held(spark, path, ts, by)
    missing = present if held is None else present.join(held.select(_FILE), _FILE, "left_anti")
    # As many rows as files, which the driver lists anyway.
    new = [r[0] for r in missing.collect()]
    if new:
        # Partition columns keep the types they have in the whole folder.
        rows = spark.read.schema(whole.schema).option("basePath", path).parquet(*new)
        # Of a local path Spark writes one slash here, and three in its list of files.
        file = F.expr("regexp_replace(url_decode(replace(_metadata.file_path, '+', '%2B')), '^file:/+', 'file:///')").alias(_FILE)
        found = rows.select(file, *by, ts).groupBy(_FILE, *by).agg(F.min(ts).alias(_FIRST), F.max(ts).alias(_LAST), F.count(F.lit(1)).alias(_ROWS))
        found.write.mode("append").parquet(zones_path(path, ts, by))
        held = spark.read.parquet(zones_path(path, ts, by))
    if held is None:
        kinds = [*by, ts, ts]
        fields = [T.StructField(n, whole.schema[k].dataType) for n, k in zip([*by, _FIRST, _LAST], kinds)]
        return spark.createDataFrame([], T.StructType([T.StructField(_FILE, T.StringType()), *fields, T.StructField(_ROWS, T.LongType())]))
    return held.join(present, _FILE, "left_semi")


def read_overlapping(
    spark: SparkSession,
    path: str,
    start: str | datetime | None,
    end: str | datetime | None,
    *,
    ts: str = "ts",
    by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """What ``prune_overlap`` keeps of a written stage, without opening files that hold none of it.

    All rows of every group ``by`` whose time span, over all its files, overlaps [start, end]; a group without a time is
    kept. Spans come from the zones, which are brought up to date first.
    """
    whole = spark.read.option("mergeSchema", "true").parquet(path)
    lo, hi = parse_bound(start), parse_bound(end, end=True)
    if lo is None and hi is None:
        return whole
    ltz = isinstance(whole.schema[ts].dataType, T.TimestampType)
    zones = refresh(spark, path, ts, by)
    tests = ([F.max(_LAST) >= time_literal(lo, ltz)] if lo else []) + ([F.min(_FIRST) <= time_literal(hi, ltz)] if hi else [])
    kept = zones.groupBy(*by).agg(F.coalesce(reduce(and_, tests), F.lit(True)).alias("_kept")).filter("_kept").drop("_kept")
    wanted = attach(zones, kept, by, [], "left_semi", rows_per_task=rows_per_task).select(_FILE).distinct()
    files = [r[0] for r in wanted.collect()]
    if not files:
        return whole.filter(F.lit(False))
    opened = spark.read.schema(whole.schema).option("basePath", path).parquet(*files)
    return attach(opened, kept, by, [], "left_semi", rows_per_task=rows_per_task)
