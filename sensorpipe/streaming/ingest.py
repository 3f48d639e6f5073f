"""File streams: take in new raw files, and aggregate them by event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from sensorpipe.functions.times import Duration
from sensorpipe.operators.aggregate import method_named
from sensorpipe.sinks.tables import overwrite_partitions
from sensorpipe.sources.files import raw_lines_to_long, with_source


def stream_text(
    spark: SparkSession, path: str, *, pattern: str = "*.csv", recursive: bool = False, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_source(reader.text(path))


def stream_raw_long(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of ``Time, device_id, sensor, value, day, source_file`` from a landing folder of raw text files."""
    return raw_lines_to_long(stream_text(spark, path, **options))


def write_new(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append what is new since the last run to a Parquet folder, then stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).start(path)


def ingest_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, *, partition_by: Sequence[str] = ("day",), **options
) -> None:
    """Parse the files that arrived since the last run into ``target``; a second run adds nothing."""
    write_new(stream_raw_long(spark, source, **options), target, checkpoint, partition_by).awaitTermination()


def _instant(stream: DataFrame, ts: str) -> DataFrame:
    # Watermarks need a timestamp with time zone.
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):
        return stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream


def windowed(
    df: DataFrame,
    level: str,
    method: str = "average",
    *,
    ts: str = "Time",
    keys: Sequence[str] = ("device_id", "sensor"),
    value: str = "value",
    watermark: str | None = "10 minutes",
    decimals: int | None = 2,
) -> DataFrame:
    """Mean or median per event-time window, device and sensor.

    Same windows as the batch aggregate. In a stream the watermark closes windows and frees their state; what comes
    later than that is lost, so ``aggregate_new`` works without one.
    """
    size = Duration.of(level)
    if size.micros is None or size.unit == "w":
        raise ValueError(f"a stream window needs a fixed length, not {level!r}")
    rows = _instant(df, ts)
    if watermark and df.isStreaming:
        rows = rows.withWatermark(ts, watermark)
    kind = method_named(method)
    if kind == "approx_median":
        raise ValueError("a stream window takes 'average' or 'median'")
    aggregate = F.median(value) if kind == "median" else F.avg(value)
    groups = rows.groupBy(F.window(ts, f"{size.micros} microseconds").alias("_window"), *keys).agg(aggregate.alias(value))
    out = F.round(value, decimals) if decimals is not None else F.col(value)
    return groups.select(F.col("_window.start").cast("timestamp_ntz").alias(ts), *keys, out.alias(value))


def aggregate_new(
    stream: DataFrame,
    level: str,
    target: str,
    checkpoint: str,
    method: str = "average",
    *,
    ts: str = "Time",
    keys: Sequence[str] = ("device_id", "sensor"),
    value: str = "value",
    decimals: int | None = 2,
) -> None:
    """Bring the windows in ``target`` (partitioned by day) up to date with what is new, in whatever order it comes.

    Each micro-batch adds its rows to a folder beside the checkpoint and computes the windows of the days it touches
    anew, from all rows seen so far. So no window is ever closed and a file that comes late, even by days, is not lost;
    the cost of a late row is one day of its windows. A batch that runs again replaces what it wrote. Rows without a
    time stay in the folder under no day, and are in no window.
    """
    size = Duration.of(level)
    rows_path = f"{checkpoint.rstrip('/')}-rows"

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.window(ts, f"{size.micros} microseconds")
        columns = [ts, *keys, value]
        days = batch.select(*columns).filter(F.col(ts).isNotNull()).select(*columns, bucket.alias("_window"))
        days = days.select(*columns, F.to_date(F.col("_window.start").cast("timestamp_ntz")).alias("day"))
        nowhere = batch.select(*columns).filter(F.col(ts).isNull()).withColumn("day", F.lit(None).cast("date"))
        new = days.unionByName(nowhere).withColumn("batch", F.lit(number))
        overwrite_partitions(new, rows_path, ["day", "batch"])
        held = spark.read.schema(new.schema).parquet(rows_path)
        # The calendar bounds the number of days; those of this batch are found by its folders.
        touched = [r[0] for r in held.filter((F.col("batch") == number) & F.col("day").isNotNull()).select("day").distinct().collect()]
        if touched:
            rows = held.filter(F.col("day").isin(touched)).select(*columns)
            out = windowed(rows, level, method, ts=ts, keys=keys, value=value, watermark=None, decimals=decimals)
            overwrite_partitions(out.withColumn("day", F.to_date(ts)), target, ["day"])

    query = stream.writeStream.foreachBatch(merge).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
