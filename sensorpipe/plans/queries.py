"""One query per operator, over whole tables.

``events`` is a long stream of readings: device = user, metric = event type. ``lineitem`` is a wide table of readings:
device = supplier, time = ship date, four value columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorpipe.functions import naming
from sensorpipe.functions.rounding import round_by_metric, round_columns
from sensorpipe.functions.times import normalize_time_text, time_bucket
from sensorpipe.functions.transforms import derive, gaussianise
from sensorpipe.operators import rollup
from sensorpipe.operators import select as sel
from sensorpipe.operators.aggregate import (
    aggregate_by_domain,
    bucket_aggregate,
    distinct_days,
    long_aggregate,
    null_counts,
    time_span,
)
from sensorpipe.operators.asof import asof_backward
from sensorpipe.operators.clean import clean, rules_fill_drop
from sensorpipe.operators.dedup import dedup, limit_rows
from sensorpipe.operators.enrich import event_segments as segments
from sensorpipe.operators.enrich import joined_view, overlay, rolling
from sensorpipe.operators.fill import backward_fill, forward_fill, interpolate, previous
from sensorpipe.operators.resample import grid, resample, resample_by_domain, series_bounds
from sensorpipe.operators.reshape import readings_to_long, to_canonical, to_raw_long, to_sink_long, to_variable_long
from sensorpipe.plans.flow import Flow
from sensorpipe.session import configure, shared_dir
from sensorpipe.sinks import export, report, tables, zones
from sensorpipe.sources import files
from sensorpipe.sources import keyvalue as kv
from sensorpipe.streaming import incremental, ingest, ordered

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VALUES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
METRICS = ["click", "error", "purchase", "signup", "view"]
BIO, ENVIRONMENT = ["click", "signup", "view"], ["error", "purchase"]
SHIPMENT_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ``event_id, ts, device_id, metric, value``."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.concat(F.lit("dev-"), "user_id").alias("device_id"), F.col("event_type").alias("metric"), "value"
    )


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """readings as a canonical frame; values under 20 are missing readings with flag 1."""
    bio = F.col("metric").isin(BIO)
    low = F.col("value") < 20
    return readings(spark, sf_dir).select(
        "ts",
        "device_id",
        "metric",
        F.when(~low, F.col("value")).alias("value"),
        F.when(bio, "mV").otherwise("").alias("unit"),
        F.when(bio, "bio_signal").otherwise("environment").alias("domain"),
        F.when(low, 1).otherwise(0).cast("bigint").alias("quality_flag"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a wide frame ``Time, device_id, <ids>, <values>``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("Time"),
        F.concat(F.lit("sup-"), "l_suppkey").alias("device_id"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *VALUES,
    )


def file_name(device: str = "user_id", ts: str = "ts"):
    return F.concat(F.lit("lab_dev-"), F.col(device), F.lit("_"), F.date_format(ts, "yyyy-MM-dd"), F.lit(".csv"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as raw text: ``value`` (the line) and the name of the device-day file it belongs to."""
    e = table(spark, sf_dir, "events")
    line = F.concat_ws(
        ";",
        F.concat(F.col("ts").cast("string"), F.lit("Z")),
        F.concat(F.lit("seq:0")),
        F.concat("event_type", F.lit(":"), F.col("value").cast("string")),
        F.lit("no pair"),
        F.concat(F.lit("note:"), F.col("event_type"), F.lit(":x")),
        F.concat(F.lit("seq:"), F.col("event_id").cast("string")),
    )
    return e.select(line.alias("value"), file_name().alias("source_file"))


# --- times, names, columns -------------------------------------------------------------------------------------


@query
def ts_normalize(spark, sf):
    text = F.col("ts").cast("string")
    return table(spark, sf, "events").select(
        "event_id",
        normalize_time_text(F.concat(text, F.lit("Z"))).alias("iso"),
        normalize_time_text(F.concat(text, F.lit("+02:00"))).alias("iso_moved"),
        normalize_time_text(F.concat(text, F.lit("+02:00")), zone="wall").alias("iso_wall"),
        normalize_time_text(F.concat(F.lit("at "), text)).alias("kept_text"),
        normalize_time_text(F.date_format("ts", "yyyyMMdd")).alias("iso_day"),
    )


@query
def time_buckets(spark, sf):
    levels = {"b7s": "7s", "b10m": "10m", "b1h": "1h", "b1d": "1d", "b1w": "1w", "b1mo": "1mo"}
    return table(spark, sf, "events").select("event_id", *[time_bucket(F.col("ts"), v).alias(k) for k, v in levels.items()])


@query
def source_identity(spark, sf):
    named = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("old lab_dev-"), F.col("user_id"), F.lit("_"), F.date_format("ts", "yyyy-MM-dd"), F.lit("_agg10s_x.csv")).alias("source_file"),
        F.concat(F.lit("/data/domain="), F.col("event_type"), F.lit("/part.parquet")).alias("source_path"),
    )
    out = files.with_domain(files.identify(named, substitutions=[{"src": "old lab", "target": "lab"}]))
    level = naming.aggregation_level_of(naming.stem(F.col("source_file"))).alias("level")
    return out.select("event_id", "experience", "device_id", F.col("day").cast("string").alias("day"), "domain", level)


@query
def select_rename(spark, sf):
    return sel.select_rename(shipments(spark, sf), ["Time->ts", "device_id", "l_quantity -> quantity", "absent", "l_tax", "l_orderkey"])


@query
def round_wide(spark, sf):
    out = round_columns(shipments(spark, sf), {"l_extendedprice": 0, "default": 1})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", *VALUES)


@query
def round_by_metric_(spark, sf):
    return round_by_metric(readings(spark, sf), {"click": 0, "view": 1, "default": None}).select("event_id", "metric", "value")


@query
def filter_metrics(spark, sf):
    kept = sel.keep_metrics(readings(spark, sf), include=["click", "view", "error"], exclude=["error"], metric="metric")
    return sel.rename_metrics(kept, {"click": "m0"}, "metric").select("event_id", "metric", "value")


@query
def literal_identity(spark, sf):
    e = table(spark, sf, "events").select("event_id", file_name().alias("source_file"))
    return sel.ensure_identity(e, device_from=naming.device_of(naming.stem(F.col("source_file"))), domain="bio_signal").drop("source_file")


# --- pruning and filters ---------------------------------------------------------------------------------------


@query
def filter_range(spark, sf):
    return sel.filter_range(readings(spark, sf), "2024-01-10", "2024-01-12")


@query
def prune_overlap(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", file_name().alias("source_file"))
    return sel.prune_overlap(rows, "2024-01-10T12:00:00Z", "2024-01-12T06:00:00Z")


@query
def prune_zones(spark, sf):
    """The same sources from a written stage, by the zones of its files."""
    stage = shared_dir(spark, "zoned")
    rows = table(spark, sf, "events").select("event_id", "ts", file_name().alias("source_file"), F.to_date("ts").alias("day"))
    tables.write_dataset(rows, stage, partition_by=["day"])
    return zones.read_overlapping(spark, stage, "2024-01-10T12:00:00Z", "2024-01-12T06:00:00Z", by=["source_file"]).drop("day")


@query
def prune_days(spark, sf):
    name = F.when(F.col("event_type") == "click", F.concat(F.lit("lab_dev-"), "user_id", F.lit(".csv"))).otherwise(file_name())
    rows = files.identify(table(spark, sf, "events").select("event_id", "ts", name.alias("source_file")))
    out = sel.prune_days(rows, "2024-01-10T12:00:00Z", "2024-01-12T06:00:00Z")
    return out.select("event_id", "source_file", F.col("day").cast("string").alias("day"))


@query
def filter_source_date(spark, sf):
    shifted = F.concat(F.lit("lab_x_"), F.date_format(F.col("ts") + F.expr("INTERVAL 6 HOURS"), "yyyy-MM-dd"), F.lit(".csv"))
    name = F.when(F.col("event_type") == "click", F.lit("lab_x.csv")).otherwise(shifted)
    rows = table(spark, sf, "events").select("event_id", "ts", name.alias("source_file"))
    return sel.filter_source_date(rows, ts="ts")


@query
def domain_split(spark, sf):
    columns = {"trade": ["l_quantity", "l_extendedprice"], "terms": ["l_discount", "l_tax", "l_quantity", "absent"], "none": ["nothing"]}
    frames = sel.split_domains(shipments(spark, sf), columns, keep=["device_id", "l_orderkey", "l_linenumber"])
    return sel.stack_domains(frames)


# --- sources ---------------------------------------------------------------------------------------------------


@query
def kv_parse(spark, sf):
    parsed = kv.with_time(kv.parse_lines(raw_lines(spark, sf)))
    return kv.project_metrics(parsed, {"seq": "int", "note": "string", **dict.fromkeys(METRICS, "float")}, keep=["Time", "source_file"])


@query
def kv_lenient_long(spark, sf):
    spaced = F.regexp_replace(F.regexp_replace("value", ";", " ; "), "([a-z]):", "$1 : ")
    long = files.raw_lines_to_long(raw_lines(spark, sf).withColumn("value", spaced), exclude_columns=["seq"])
    return long.withColumn("day", F.col("day").cast("string"))


@query
def discover_metrics(spark, sf):
    return kv.discover_metrics(kv.parse_lines(raw_lines(spark, sf)))


@query
def raw_rewrite(spark, sf):
    lines = kv.rewrite_line_times(raw_lines(spark, sf).withColumn("value", F.regexp_replace("value", "^(\\S+) ", "$1T")))
    return lines


@query
def kv_files_read(spark, sf):
    """Raw text written to files, read back with selection by file name, as ``Time, device_id, sensor, value``."""
    path = shared_dir(spark, "raw-text")
    raw_lines(spark, sf).select("value").write.text(path)
    # A second copy under a name that the exclusion matches.
    raw_lines(spark, sf).select("value").write.text(f"{path}/old", compression="gzip")
    return files.read_raw_long(spark, path, pattern="*.txt*", recursive=True, exclude="*.gz").select("Time", "sensor", "value")


@query
def csv_round_trip(spark, sf):
    """Canonical frame exported as CSV with fixed decimals and read back with ``NaN`` as null."""
    path = shared_dir(spark, "csv")
    export.export_csv(observed(spark, sf), path, decimals={"click": 1, "default": 3})
    schema = "ts timestamp_ntz, device_id string, metric string, value double, unit string, domain string, quality_flag bigint"
    return files.read_csv(spark, path, pattern="*.csv", schema=schema, source=False)


@query
def time_column(spark, sf):
    """The time column found without case and outer blanks, then renamed."""
    rows = table(spark, sf, "events").select("event_id", F.col("ts").alias(" TIME "), "value")
    found = sel.resolve_time_column(rows.columns, "time")
    return sel.rename_time(rows, found, "ts")


@query
def raw_format_found(spark, sf):
    """Wide readings written as comma-separated files; the format is found by looking at the first line."""
    path = shared_dir(spark, "raw-csv")
    wide = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("Time"), "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    wide.write.option("header", "true").option("nullValue", "NaN").csv(path)
    return files.read_raw_long(spark, path, time_column="TIME").select("Time", "sensor", "value")


@query
def raw_mixed_folder(spark, sf):
    """One folder with key-value text, comma-separated text and Parquet: each file is read in its own format."""
    path = shared_dir(spark, "raw-mixed")
    rows = _raw(spark, sf).withColumn("third", F.dayofmonth("Time") % 3)
    text = F.date_format("Time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows.filter("third = 0").select(F.concat_ws(";", text, F.concat("sensor", F.lit(":"), F.col("value").cast("string")))).write.mode("append").text(path)
    wide = rows.withColumn("Time", F.date_trunc("second", "Time").cast("timestamp_ntz"))
    click = F.when(F.col("sensor") == "click", F.col("value"))
    wide.filter("third = 1").select(F.date_format("Time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Time"), click.alias("click")).write.mode("append").options(header="true", nullValue="NaN").csv(path)
    wide.filter("third = 2").select("Time", click.alias("click")).write.mode("append").parquet(path)
    return files.read_raw_long(spark, path, pattern="*").select("Time", "sensor", "value")


@query
def csv_mixed_headers(spark, sf):
    """Comma-separated files with the columns in another order, and one with a column less."""
    path = shared_dir(spark, "csv-mixed")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    parts = [["l_orderkey", "l_linenumber", "l_quantity", "l_tax"], ["l_tax", "l_quantity", "l_linenumber", "l_orderkey"], ["l_linenumber", "l_orderkey", "l_tax"]]
    for number, columns in enumerate(parts):
        rows.filter(F.col("l_orderkey") % 3 == number).select(*columns).write.mode("append").option("header", "true").csv(path)
    found = files.read_csv(spark, path, pattern="*.csv", source=False)
    return found.select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])


@query
def parser_rejects(spark, sf):
    """Lines whose time cannot be read, found again beside the parsed ones."""
    lines = raw_lines(spark, sf)
    spoiled = lines.withColumn("value", F.when(F.col("value").contains("purchase:"), F.concat(F.lit("at noon "), "value")).otherwise(F.col("value")))
    flow = Flow([{"run": "parser", "with": {"metrics": dict.fromkeys(METRICS, "float")}}])
    flow.chain(spoiled)
    number = F.regexp_extract("value", r"^at noon .*;seq:(\d+)$", 1).cast("bigint")
    return flow.rejects["parser"].select(number.alias("event_id"), "source_file")


# --- cleaning --------------------------------------------------------------------------------------------------

EVENT_RULES = {"value": {"type": "float", "min": 5, "max": 150, "max_diff": 60}}
SHIPMENT_RULES = {
    "l_quantity": {"type": "int", "min": 2, "max": 48, "max_diff": 30},
    "l_discount": {"type": "float", "max": 0.09},
    "l_tax": {"max_diff": 0.05},
    "absent": {"min": 0},
}


def _cleaned_events(spark, sf, mode):
    rows = readings(spark, sf).withColumn("day", F.to_date("ts"))
    return clean(rows, EVENT_RULES, keys=["device_id", "day"], tie=["event_id"], flag_mode=mode).drop("day")


@query
def clean_documented(spark, sf):
    return _cleaned_events(spark, sf, "documented")


@query
def clean_as_coded(spark, sf):
    return _cleaned_events(spark, sf, "as_coded")


@query
def clean_wide(spark, sf):
    # A gap in the input where the line number is 7, a text column that is not always a number.
    rows = shipments(spark, sf).withColumns(
        {
            "l_quantity": F.when(F.col("l_linenumber") == 6, F.lit("x")).otherwise(F.col("l_quantity").cast("bigint").cast("string")),
            "l_tax": F.when(F.col("l_linenumber") != 7, F.col("l_tax")),
        }
    )
    return clean(rows, SHIPMENT_RULES, keys=["device_id"], ts="Time", tie=SHIPMENT_TIE)


@query
def clean_no_rules(spark, sf):
    rows = shipments(spark, sf).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return clean(rows, {}, keys=["device_id"], ts="Time").select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "quality_flag")


@query
def previous_value(spark, sf):
    return previous(readings(spark, sf), ["value"], keys=["device_id", "metric"], tie=["event_id"])


@query
def forward_filled(spark, sf):
    rows = readings(spark, sf).withColumn("value", F.when(F.col("value") >= 60, F.col("value")))
    return forward_fill(rows, ["value"], keys=["device_id"], tie=["event_id"])


@query
def backward_filled(spark, sf):
    rows = readings(spark, sf).withColumn("value", F.when(F.col("value") >= 60, F.col("value")))
    return backward_fill(rows, ["value"], keys=["device_id"], tie=["event_id"])


@query
def interpolated_rows(spark, sf):
    rows = readings(spark, sf).withColumn("value", F.when(F.col("value") >= 60, F.col("value")))
    out = interpolate(rows, "value", keys=["device_id"], tie=["event_id"])
    return out.withColumn("value", F.round("value", 9))


@query
def ffill_bfill_drop(spark, sf):
    rules = {"l_quantity": {"type": "int", "min": 5, "max": 45}, "l_discount": {"type": "float", "min": 0.01}}
    return rules_fill_drop(shipments(spark, sf), rules, keys=["device_id"], ts="Time", tie=SHIPMENT_TIE)


# --- derived columns, reshaping --------------------------------------------------------------------------------


@query
def transforms(spark, sf):
    plan = {
        "l_discount": {"discount_log": "log", "discount_inv": "sqrt_inv", "ignored": "unknown"},
        "l_quantity": {"quantity_f": "celsius_to_fahrenheit"},
        "quantity_f": {"quantity_f_log": "log"},
        "absent": {"nothing": "log"},
    }
    out = derive(shipments(spark, sf), plan)
    return round_columns(out.drop("device_id"), 9)


@query
def gaussianised(spark, sf):
    rows = shipments(spark, sf).select("Time", "l_orderkey", "l_linenumber", "l_partkey", *VALUES)
    return round_columns(gaussianise(rows, exclude=["Time", "l_orderkey", "l_linenumber", "l_partkey"]), 9)


@query
def canonical_long(spark, sf):
    rows = shipments(spark, sf).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    rows = rows.withColumn("quality_flag", F.when(F.col("l_tax").isNull(), 1).otherwise(0))
    return to_canonical(
        rows, [*VALUES, "absent"], domain=F.lit("trade"), units={"l_extendedprice": "EUR", "l_quantity": "pcs"}
    )


@query
def sink_long(spark, sf):
    rows = shipments(spark, sf).select(F.col("Time").alias("ts"), "device_id", F.lit("trade").alias("domain"), *VALUES)
    return to_sink_long(rows, include_metrics=["l_quantity", "l_tax", "l_discount"], column_to_sensor={"l_quantity": "m0"})


@query
def raw_long(spark, sf):
    return to_raw_long(shipments(spark, sf), exclude_columns=["l_orderkey", "l_linenumber", "l_partkey"])


@query
def variable_long(spark, sf):
    rows = shipments(spark, sf).select("Time", "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return to_variable_long(rows)


@query
def lines_to_long(spark, sf):
    parsed = kv.with_time(kv.parse_lines_lenient(raw_lines(spark, sf)))
    return readings_to_long(parsed, keep=["source_file"])


# --- duplicates ------------------------------------------------------------------------------------------------


@query
def dedup_all(spark, sf):
    rows = readings(spark, sf)
    return dedup(rows.unionByName(rows.filter(F.col("metric") == "click")))


@query
def dedup_subset(spark, sf):
    return dedup(shipments(spark, sf), subset=["device_id", "Time"], order=SHIPMENT_TIE)


@query
def limited(spark, sf):
    return limit_rows(readings(spark, sf), 500, ["ts", "event_id"])


# --- as-of and resampling --------------------------------------------------------------------------------------


@query
def asof_backward_(spark, sf):
    rows = readings(spark, sf)
    clicks = rows.filter(F.col("metric") == "click").select("event_id", "device_id", "ts")
    bought = rows.filter(F.col("metric") == "purchase").select(
        "device_id", "ts", F.when(F.col("value") >= 20, F.col("value")).alias("value"), F.col("event_id").alias("purchase_id")
    )
    return asof_backward(clicks, bought, by=["device_id"], values=["value", "purchase_id"], tie=["purchase_id"])


@query
def asof_ties(spark, sf):
    """Observations that share a time, tie-breaks that are null or equal, and series far above what a task may hold."""
    rows = readings(spark, sf).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    clicks = rows.filter(F.col("metric") == "click").select("event_id", "device_id", "ts")
    seen = rows.filter(F.col("metric") == "view").select("device_id", "ts", "value", F.when(F.col("value") >= 50, F.floor(F.col("value") / 100)).alias("rank"))
    return asof_backward(clicks, seen, by=["device_id"], values=["value"], tie=["rank"], rows_per_task=3)


@query
def regular_grid(spark, sf):
    keys = ["device_id", "domain"]
    return grid(series_bounds(observed(spark, sf), keys, "ts", False), [*keys, "metric"], "ts", "6h")


@query
def resample_forward(spark, sf):
    return resample(observed(spark, sf), "3h", interpolation="forward")


@query
def resample_by_day(spark, sf):
    return resample(observed(spark, sf), "10m", by_day=True)


@query
def resample_by_day_midnight(spark, sf):
    return resample(observed(spark, sf), "1h", by_day=True, day_anchor="midnight")


@query
def resample_linear(spark, sf):
    return round_by_metric(resample(observed(spark, sf), "3h", interpolation="linear"), 9)


@query
def resample_nearest(spark, sf):
    return resample(observed(spark, sf), "30m", interpolation="nearest", by_day=True)


@query
def resample_domains(spark, sf):
    settings = {
        "bio_signal": {"freq": "1h", "interpolation": "forward", "independent_by_day": True},
        "environment": {"freq": "6h", "interpolation": "nearest"},
    }
    return resample_by_domain(observed(spark, sf), settings, strict=True)


# --- aggregation -----------------------------------------------------------------------------------------------


@query
def agg_median_mean(spark, sf):
    """Flagship: ten-minute median and mean per device and domain, long to wide."""
    specs = {
        "click": [{"method": "median", "output": "click_median"}, {"method": "average", "output": "click_mean"}],
        "view": [{"method": "median", "output": "view_median"}],
        "purchase": [{"method": "mean", "output": "purchase_mean"}],
        "unknown": [{"method": "median"}],
    }
    return round_columns(bucket_aggregate(observed(spark, sf), "10m", specs), 9)


@query
def spine_left_join(spark, sf):
    """The same result as joining one aggregate per metric to all buckets, which is how its SQL is written."""
    return QUERIES["agg_median_mean"](spark, sf)


@query
def agg_daily(spark, sf):
    specs = [{"metric": m, "method": "median", "output": f"{m}_p50"} for m in METRICS]
    specs += [{"metric": m, "output": f"{m}_avg"} for m in METRICS]
    return round_columns(bucket_aggregate(observed(spark, sf), "1d", specs, exclude_flags=[1]), 9)


@query
def agg_global_median(spark, sf):
    """One bucket and key per domain holds all rows."""
    rows = observed(spark, sf).withColumn("device_id", F.lit("all"))
    specs = [{"metric": m, "method": "median"} for m in METRICS]
    return round_columns(bucket_aggregate(rows, "1y", specs), 9)


@query
def agg_by_domain(spark, sf):
    rules = {"bio_signal": {"method": "median"}, "environment": {"method": "average"}}
    return round_columns(aggregate_by_domain(observed(spark, sf), "1d", rules, metrics=METRICS), 9)


@query
def agg_by_domain_found(spark, sf):
    rules = {"environment": {"method": "median"}}
    return round_columns(aggregate_by_domain(observed(spark, sf), "6h", rules), 9)


def _raw(spark, sf):
    return readings(spark, sf).select(F.col("ts").alias("Time"), "device_id", F.col("metric").alias("sensor"), "value")


@query
def agg_raw_60s(spark, sf):
    return long_aggregate(_raw(spark, sf), "60s")


@query
def agg_raw_10s_median(spark, sf):
    return long_aggregate(_raw(spark, sf), "10s", "median")


@query
def rollup_levels(spark, sf):
    """Ten-second states of two micro-batches, the second one late, compacted and rolled up to four levels."""
    rows, path = readings(spark, sf), shared_dir(spark, "states")
    late = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for number, batch in enumerate((rows.filter(~late), rows.filter(late))):
        rollup.add_states(rollup.bucket_states(batch, "10s"), path, number)
    rollup.compact_states(spark, path, 1, "10s")
    levels = [rollup.finished(rollup.read_states(spark, path, level, "10s")).select(F.lit(level).alias("level"), "*") for level in ("60s", "1h", "1d", "1mo")]
    return reduce(DataFrame.unionByName, levels).withColumn("mean", F.round("mean", 6))


@query
def first_last_time(spark, sf):
    return time_span(readings(spark, sf), by=["device_id"])


@query
def days_present(spark, sf):
    return distinct_days(readings(spark, sf)).select(F.col("day").cast("string").alias("day"))


@query
def null_count(spark, sf):
    return null_counts(observed(spark, sf), ["value", "ts"], by=["metric"])


# --- sinks and incremental loads -------------------------------------------------------------------------------


def _halves(spark, sf):
    """What a table holds, and a batch that overlaps it with changed values and one more device."""
    rows = readings(spark, sf).select("event_id", "ts", "device_id", "metric", "value")
    held = rows.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    batch = rows.filter(F.col("ts") >= F.lit("2024-01-15 06:00:00").cast("timestamp_ntz")).filter(F.col("metric") != "view")
    return held, batch.withColumn("value", F.col("value") + 1000)


@query
def append(spark, sf):
    held, batch = _halves(spark, sf)
    return tables.append_rows(held, batch)


@query
def replace_range(spark, sf):
    held, batch = _halves(spark, sf)
    return tables.replace_range(held, batch)


@query
def replace_given_range(spark, sf):
    held, batch = _halves(spark, sf)
    return tables.replace_range(held, batch, start="2024-01-12", end="2024-01-18")


@query
def replace_null_times(spark, sf):
    """A table and a batch that both hold rows without a time: none of the table's is lost."""
    path = shared_dir(spark, "null-times")
    held, batch = _halves(spark, sf)
    timeless = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    tables.write_table(held.withColumn("ts", timeless), path, policy="replace_all")
    tables.write_table(batch.withColumn("ts", timeless), path, policy="replace")
    return spark.read.parquet(path).select("event_id", "ts", "device_id", "metric", "value")


@query
def sink_type_widened(spark, sf):
    """A first batch of whole numbers, a second with fractions: nothing is rounded to the table's first type."""
    path = shared_dir(spark, "widened-table")
    held, batch = _halves(spark, sf)
    tables.write_table(tables.cast_value(held.withColumn("value", F.floor("value"))), path, policy="replace_all")
    tables.write_table(tables.cast_value(batch, "numeric", 18, 2), path, policy="append")
    return spark.read.parquet(path).select("event_id", "ts", F.col("value").cast("double").alias("value"))


@query
def replace_range_scoped(spark, sf):
    held, batch = _halves(spark, sf)
    return tables.replace_range(held, batch.filter(F.col("metric") == "click"), scope=["device_id", "metric"])


@query
def evolve_columns(spark, sf):
    held, batch = _halves(spark, sf)
    new = batch.withColumnRenamed("value", "VALUE").drop("metric").withColumn("unit", F.lit("mV"))
    return tables.evolve(held, new)


def _published(spark, sf, **options):
    path = shared_dir(spark, "table")
    held, batch = _halves(spark, sf)
    tables.write_table(held, path, policy="replace_all")
    tables.write_table(batch, path, **options)
    return spark.read.parquet(path).select("event_id", "ts", "device_id", "metric", "value")


@query
def table_replace(spark, sf):
    return _published(spark, sf, policy="replace")


@query
def table_replace_all(spark, sf):
    return _published(spark, sf, policy="replace_all")


@query
def table_append(spark, sf):
    return _published(spark, sf, policy="append")


@query
def partitioned_dataset(spark, sf):
    """Written by domain and day, one day written again, read back through partition pruning."""
    path = shared_dir(spark, "dataset")
    rows = observed(spark, sf).withColumn("day", F.to_date("ts"))
    tables.write_dataset(rows, path, partition_by=["domain", "day"], clear=True)
    again = rows.filter(F.col("day") == F.lit("2024-01-05").cast("date")).withColumn("value", F.col("value") * 2)
    tables.overwrite_partitions(again, path, ["domain", "day"])
    back = files.read_parquet(spark, path, source=False)
    kept = back.filter((F.col("domain") == "bio_signal") & (F.col("day") <= F.lit("2024-01-10").cast("date")))
    return kept.withColumn("day", F.col("day").cast("string"))


@query
def column_mapping(spark, sf):
    names = {"ts": "time", "device_id": "node", "metric": "sensor", "value": "reading"}
    return tables.map_columns(readings(spark, sf), names)


@query
def value_type_infer(spark, sf):
    long = to_raw_long(shipments(spark, sf), exclude_columns=["l_orderkey", "l_linenumber", "l_partkey"])
    return tables.infer_value_type(long, by=["sensor"])


@query
def value_cast(spark, sf):
    return tables.cast_value(readings(spark, sf), "numeric", 18, 1).select("event_id", F.col("value").cast("double").alias("value"))


@query
def load_after_hwm(spark, sf):
    held, _ = _halves(spark, sf)
    return incremental.select_new(readings(spark, sf), held, "max_ts", ts="ts")


@query
def load_missing_days(spark, sf):
    rows = readings(spark, sf)
    held = rows.filter(F.dayofmonth("ts") % 3 != 0)
    name = F.when(F.col("metric") == "click", F.concat("device_id", F.lit(".csv"))).otherwise(
        F.concat(F.lit("lab_"), "device_id", F.lit("_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv"))
    )
    new = rows.withColumn("source_file", name)
    new = new.withColumn("day", naming.day_of(naming.stem(F.col("source_file"))))
    return incremental.select_new(new, held, "missing_days", ts="ts").select("event_id", "ts", "source_file")


@query
def source_report(spark, sf):
    rows = readings(spark, sf)
    return report.source_report(rows, rows.filter(F.col("value") > 400), by=["device_id"])


@query
def csv_text(spark, sf):
    return export.to_csv_text(observed(spark, sf), {"click": 1, "default": 3})


@query
def csv_text_wide(spark, sf):
    rows = shipments(spark, sf).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return export.to_csv_text(rows.drop("device_id"), {"l_tax": 3, "default": 1}, ts="Time")


# --- streams ---------------------------------------------------------------------------------------------------


@query
def ingest_available_now(spark, sf):
    """Raw text arrives in two drops; each run takes in what is new, a third run adds nothing."""
    landing, target, state = (shared_dir(spark, n) for n in ("landing", "ingested", "ingest-state"))
    lines = raw_lines(spark, sf)
    first = F.xxhash64("value") % 2 == 0
    for drop in (lines.filter(first), lines.filter(~first), None):
        if drop is not None:
            drop.select("value").write.mode("append").text(landing)
        ingest.ingest_new_files(spark, landing, target, state, pattern="*.txt", partition_by=())
    return spark.read.parquet(target).select("Time", "sensor", "value")


def _in_drops(spark: SparkSession, rows: DataFrame, run: Callable[[DataFrame, str, str], None]) -> DataFrame:
    """Files arrive in three drops, the last one with every seventh row, late; after each the step takes in what is new."""
    landing, target, state = (shared_dir(spark, n) for n in ("landing", "merged", "merge-state"))
    late, early = F.xxhash64("ts", "device_id") % 7 == 0, F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for drop in (rows.filter(~late & early), rows.filter(~late & ~early), rows.filter(late)):
        drop.write.mode("append").parquet(landing)
        run(spark.readStream.schema(rows.schema).parquet(landing), target, state)
    return ordered.result(spark, target)


@query
def incremental_resample(spark, sf):
    return _in_drops(spark, observed(spark, sf), lambda new, target, state: ordered.resample_new(new, "3h", target, state, interpolation="forward", buckets=2))


@query
def incremental_clean(spark, sf):
    rules = lambda new, target, state: ordered.clean_new(new, EVENT_RULES, target, state, tie=["event_id"], buckets=2)
    return _in_drops(spark, readings(spark, sf), rules)


@query
def stream_agg_60s(spark, sf):
    """One-minute means of a stream of files."""
    target, state = shared_dir(spark, "windows"), shared_dir(spark, "window-state")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    named = [F.col("ts").alias("Time"), F.concat(F.lit("dev-"), "user_id").alias("device_id"), F.col("event_type").alias("sensor"), "value"]
    ingest.aggregate_new(stream.select(*named), "60s", target, state)
    return spark.read.parquet(target).drop("day")


@query
def stream_late_files(spark, sf):
    """The same means when the days arrive over three runs, the middle of the month last but one day and first day last."""
    target, state, landing = (shared_dir(spark, n) for n in ("late-windows", "late-state", "late-landing"))
    events = table(spark, sf, "events")
    drop = F.when(F.dayofmonth("ts") == 1, 2).when(F.dayofmonth("ts").between(10, 20), 1).otherwise(0)
    for number in range(3):
        events.filter(drop == number).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.schema).parquet(landing)
        named = [F.col("ts").alias("Time"), F.concat(F.lit("dev-"), "user_id").alias("device_id"), F.col("event_type").alias("sensor"), "value"]
        ingest.aggregate_new(stream.select(*named), "60s", target, state)
    return spark.read.parquet(target).drop("day")


# --- enriched series, joined views, corrections ----------------------------------------------------------------


@query
def enriched_rolling(spark, sf):
    """Statistics of the six hours before each reading, its rate of change, and whether that is an event."""
    rows = rolling(readings(spark, sf), "6h", tie=["event_id"], event_rate=0.01)
    return rows.select("event_id", "count", F.round("mean", 6).alias("mean"), "min", "max", F.round("rate", 9).alias("rate"), "event")


@query
def event_segments(spark, sf):
    """Spells of high readings: from a value of 80 until one below 30, of three hours at least."""
    found = segments(readings(spark, sf), 80, 30, min_length="3h", tie=["event_id"])
    return found.withColumn("mean", F.round("mean", 6))


@query
def view_bio_env(spark, sf):
    """Each click with the last environment readings of its device."""
    rows = readings(spark, sf)
    environment = {m: rows.filter(F.col("metric") == m).select("device_id", "ts", "value", "event_id") for m in ENVIRONMENT}
    clicks = rows.filter(F.col("metric") == "click").select(F.col("event_id").alias("click_id"), "device_id", "ts", "value")
    return joined_view(clicks, environment, tie=["event_id"])


@query
def corrected_overlay(spark, sf):
    """Every fiftieth reading corrected by hand, every third of these taken away."""
    rows = readings(spark, sf)
    fixed = F.when(F.col("event_id") % 150 != 0, F.col("value") * 2)
    corrections = rows.filter(F.col("event_id") % 50 == 0).select("device_id", "metric", "ts", fixed.alias("value"), F.col("event_id").alias("version"))
    return overlay(rows.withColumn("quality_flag", F.lit(0).cast("bigint")), corrections, order=["version"])


# --- the whole chain -------------------------------------------------------------------------------------------

CHAIN = [
    {"run": "parser", "with": {"metrics": dict.fromkeys(METRICS, "float"), "output": {"decimal_places": {"default": 3}}}},
    {"run": "split", "with": {"domain_columns": {"bio_signal": BIO, "environment": ENVIRONMENT}}},
    {
        "run": "clean",
        "with": {
            "output": {"add_quality_column": True},
            "domain_columns": {"bio_signal": BIO, "environment": ENVIRONMENT},
            "domain_rules": {
                "bio_signal": {m: {"type": "float", "min": 1, "max": 200} for m in BIO},
                "environment": {m: {"type": "float", "min": 0, "max": 100} for m in ENVIRONMENT},
            },
        },
    },
    {"run": "transfo", "with": {"domain_transfo": {"environment": {"error": {"error_log": "log"}}}}},
    {
        "run": "canonical",
        "with": {
            "domain_columns": {"bio_signal": BIO, "environment": [*ENVIRONMENT, "error_log"]},
            "unit_map": {"click": "mV"},
            "output": {"decimal_places": {"default": 3}},
        },
    },
    {
        "run": "resample",
        "with": {
            "resample_by_domain": {
                "bio_signal": {"freq": "1h", "interpolation": "nearest", "independent_by_day": True},
                "environment": {"freq": "2h", "interpolation": "forward", "independent_by_day": True},
            }
        },
    },
    {
        "run": "aggregated",
        "with": {
            "aggregation_level": "1d",
            "metrics_aggregation": {
                "click": [{"method": "median", "output": "c0"}],
                "error_log": [{"method": "average", "output": "c1"}],
            },
            "output": {"decimal_places": {"default": 6}},
        },
    },
]


@query
def legacy_chain(spark, sf):
    """Raw text lines to rules, fills, gaussianised values, long without nulls."""
    rules = {"click": {"type": "float", "min": 5, "max": 200}, "error": {"type": "float", "max": 150}}
    lines = raw_lines(spark, sf)
    out = Flow([{"run": "preprocess", "with": {"rules_and_filters": rules}}]).chain(lines)
    return out.withColumn("value", F.round("value", 9))


@query
def end_to_end(spark, sf):
    """Raw text lines through all seven steps as one lazy chain."""
    return Flow(CHAIN).chain(raw_lines(spark, sf))


def names() -> dict[str, Query]:
    return {name.rstrip("_"): run for name, run in QUERIES.items()}
