"""A processing chain as data: an ordered list of steps, each a name and its settings.

Settings have the shape of one JSON object per step, with ``input`` and ``output`` sections. ``chain`` builds one lazy
frame; ``run`` reads and writes the configured folder of every step, so that any step can be replayed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.functions.rounding import round_by_metric, round_columns
from sensorpipe.functions.times import parse_bound, parse_time
from sensorpipe.functions.transforms import derive, gaussianise
from sensorpipe.operators import select as sel
from sensorpipe.operators.aggregate import aggregate_by_domain, bucket_aggregate, long_aggregate
from sensorpipe.operators.clean import clean, rules_fill_drop
from sensorpipe.operators.dedup import dedup, limit_rows
from sensorpipe.operators.resample import resample_by_domain
from sensorpipe.operators.reshape import to_canonical, to_sink_long, to_variable_long
from sensorpipe.session import staged
from sensorpipe.sinks.export import export_csv, rewrite_lines
from sensorpipe.sinks.report import source_report
from sensorpipe.sinks import zones
from sensorpipe.sinks.tables import cast_value, map_columns, overwrite_partitions, table_exists, write_dataset, write_table
from sensorpipe.sources import files
from sensorpipe.sources.keyvalue import discover_metrics, parse_lines, project_metrics, rejected_lines, rewrite_line_times
from sensorpipe.streaming.incremental import select_new

#: Keys found in text that may become columns.
MOST_METRICS = 5_000
IDENTITY = ("experience", "device_id", "day", "source_file", "domain")


def _input(config: Mapping) -> Mapping:
    return config.get("input", {})


def _output(config: Mapping) -> Mapping:
    return config.get("output", {})


def _time_in(config: Mapping, default: str) -> str:
    return _input(config).get("timestamp_column") or config.get("timestamp_column") or default


def _identity(df: DataFrame, *extra: str) -> list[str]:
    return [c for c in (*IDENTITY, *extra) if c in df.columns]


def _finish(df: DataFrame, config: Mapping, time: str, long: bool = False) -> DataFrame:
    """Rename the time, round, select: what every step does last."""
    out = _output(config)
    target = out.get("timestamp_column") or time
    df = sel.rename_time(df, time, target)
    decimals = out.get("decimal_places")
    df = round_by_metric(df, decimals) if long else round_columns(df, decimals, skip=[target])
    return sel.select_rename(df, out.get("output_columns") or config.get("output_columns"))


def _prune(df: DataFrame, config: Mapping, time: str) -> DataFrame:
    """Whole sources by time overlap, as configured; ``granularity: row`` filters rows instead."""
    settings = _input(config)
    bounds = settings.get("from"), settings.get("to")
    if time not in df.columns or not (parse_bound(bounds[0]) or parse_bound(bounds[1], end=True)):
        return df
    if settings.get("granularity") == "row":
        return sel.filter_range(df, *bounds, ts=time)
    by = [c for c in ("domain", "source_file") if c in df.columns] or [c for c in ("device_id", "domain", "day") if c in df.columns]
    return sel.prune_overlap(df, *bounds, ts=time, by=by) if by else sel.filter_range(df, *bounds, ts=time)


def _metrics_found(parsed: DataFrame) -> dict[str, str]:
    """The keys in the data as columns; raises where they are too many to be columns, so none is left out."""
    found = discover_metrics(parsed).orderBy("metric").limit(MOST_METRICS + 1).collect()
    if len(found) > MOST_METRICS:
        raise ValueError(f"more than {MOST_METRICS} keys were found; name the wanted ones as 'metrics'")
    return {r["metric"]: r["type"] for r in found}


def rejected(df: DataFrame, step: Step) -> DataFrame | None:
    """The text lines that a parsing step cannot place in time, as they are; None for other steps."""
    if step.name not in ("parser", "preprocess"):
        return None
    return rejected_lines(df, zone=_input(step.config).get("time_zone", "convert"))


def parser(df: DataFrame, config: Mapping) -> DataFrame:
    """Raw text lines to a wide frame: parse, read times, keep rows of the file's date, drop duplicates.

    ``metrics`` ({name: type}) sets the columns; without it the keys are looked up in the data first.
    """
    settings, out = _input(config), _output(config)
    parsed = files.identify(
        parse_lines(df), substitutions=out.get("file_name_substitute") or (), device_id_pattern=config.get("device_id_pattern")
    )
    metrics = config.get("metrics")
    if metrics is None:
        metrics = _metrics_found(parsed)
    timed = parsed.withColumn("Time", parse_time(F.col("time_text"), settings.get("time_zone", "convert")))
    wide = project_metrics(timed, metrics, keep=["Time", *_identity(timed)])
    # Lines without a readable time cannot be placed on any day; a flow keeps them apart (``rejected``).
    wide = _prune(wide.filter(F.col("Time").isNotNull()), config, "Time")
    if settings.get("filter_by_file_date", True):
        wide = sel.filter_source_date(wide)
    if settings.get("dedup", True):
        # A repeated reading is one within its file.
        subset = out.get("dedup_columns")
        wide = dedup(wide, [*subset, "source_file"] if subset else None)
    return _finish(wide.withColumn("day", F.to_date("Time")), config, "Time")


def split(df: DataFrame, config: Mapping) -> DataFrame:
    time = _time_in(config, "Time")
    frames = sel.split_domains(_prune(df, config, time), config["domain_columns"], ts=time, keep=_identity(df))
    return sel.stack_domains({d: _finish(f, config, time) for d, f in frames.items()})


def _per_domain(df: DataFrame, names: Mapping, apply) -> DataFrame:
    """``apply(rows, settings, domain)`` on each configured domain; a frame without domains is one domain."""
    if "domain" not in df.columns:
        return apply(df, next(iter(names.values())), None)
    parts = [apply(df.filter(F.col("domain") == d), s, d) for d, s in names.items()]
    others = df.filter(F.col("domain").isNull() | ~F.col("domain").isin(list(names))) if names else df
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, apply(others, {}, None)])


def _own_columns(df: DataFrame, config: Mapping, domain: str | None, ruled: Sequence[str]) -> list[str]:
    """The value columns of one domain, where several domains share a frame."""
    named = (config.get("domain_columns") or {}).get(domain)
    return [c for c in (named or ruled) if c in df.columns]


def cleaning(df: DataFrame, config: Mapping) -> DataFrame:
    time = _time_in(config, "Time")
    pruned = _prune(df, config, time)
    keys = [c for c in ("device_id", "domain", "day") if c in df.columns]

    def apply(rows: DataFrame, rules: Mapping, domain: str | None) -> DataFrame:
        looked_at = [time, *_own_columns(rows, config, domain, list(rules))]
        return clean(
            rows,
            rules,
            keys=keys,
            ts=time,
            add_quality=_output(config).get("add_quality_column", False),
            flag_mode=(config.get("domain_flag_mode") or {}).get(domain) or config.get("flag_mode", "documented"),
            flag_columns=looked_at,
        )

    return _finish(_per_domain(pruned, config.get("domain_rules", {}), apply), config, time)


def transfo(df: DataFrame, config: Mapping) -> DataFrame:
    time = _time_in(config, "Time")
    names = config.get("domain_transfo", {})
    return _finish(_per_domain(_prune(df, config, time), names, lambda rows, t, _: derive(rows, t)), config, time)


def canonical(df: DataFrame, config: Mapping) -> DataFrame:
    time = _time_in(config, "Time")
    pruned = sel.ensure_identity(_prune(df, config, time), device_id=config.get("device_id", ""))
    pruned = pruned.withColumn("device_id", F.coalesce("device_id", F.lit(config.get("device_id", ""))))
    frames = []
    for domain, columns in config["domain_columns"].items():
        rows = pruned.filter(F.col("domain") == domain) if "domain" in pruned.columns else pruned
        if any(c in rows.columns for c in columns):
            frames.append(to_canonical(rows, columns, ts=time, domain=F.lit(domain), units=config.get("unit_map")))
    if not frames:
        raise ValueError("no configured value column is present")
    return _finish(reduce(DataFrame.unionByName, frames), config, "ts", long=True)


def resample(df: DataFrame, config: Mapping) -> DataFrame:
    time = _time_in(config, "ts")
    rows = sel.rename_time(_prune(df, config, time), time, "ts")
    return _finish(resample_by_domain(rows, config["resample_by_domain"], strict=config.get("strict", False)), config, "ts", long=True)


def aggregated(df: DataFrame, config: Mapping) -> DataFrame:
    time = _time_in(config, "ts")
    rows = sel.rename_time(_prune(df, config, time), time, "ts")
    level = config.get("aggregation_level", "1h")
    if config.get("metrics_aggregation"):
        out = bucket_aggregate(rows, level, config["metrics_aggregation"], exclude_flags=config.get("exclude_flags", ()))
    elif config.get("aggregation_by_domain"):
        out = aggregate_by_domain(rows, level, config["aggregation_by_domain"], metrics=config.get("metrics"))
    else:
        raise ValueError("no aggregation is configured")
    return _finish(out, config, "ts")


def import_postgres(df: DataFrame, config: Mapping) -> DataFrame:
    """Aggregated wide frame to the long rows of the sink."""
    db, time = _output(config).get("database", {}), _time_in(config, "ts")
    rows = sel.ensure_identity(sel.rename_time(_prune(df, config, time), time, "ts"))
    rows = rows.select("ts", "device_id", "domain", *[c for c in rows.columns if c not in (*IDENTITY, "ts", "source_path")])
    return to_sink_long(rows, include_metrics=db.get("include_metrics"), column_to_sensor=db.get("column_to_sensor"))


def import_raw_postgres(df: DataFrame, config: Mapping) -> DataFrame:
    """Raw long rows, or raw text lines, to the long rows of the sink."""
    db = _output(config).get("database", {})
    long = df if "sensor" in df.columns else files.raw_lines_to_long(df)
    settings = _input(config)
    long = sel.prune_days(long, settings.get("from"), settings.get("to"), ts="Time")
    long = sel.keep_metrics(long, db.get("include_sensors"), db.get("exclude_columns") or ())
    level = db.get("aggregation")
    if level and level != "raw":
        long = long_aggregate(long, level, db.get("aggregation_method", "average"))
    else:
        long = long.select("Time", "device_id", "sensor", F.round(F.col("value").cast("double"), 2).alias("value"))
    limit = db.get("limit_rows") or 0
    return limit_rows(long, limit, ["Time", "device_id", "sensor", "value"])


def preprocess(df: DataFrame, config: Mapping) -> DataFrame:
    """Raw text lines: rules and fills, gaussianise, long without nulls."""
    rules = config.get("rules_and_filters") or {}
    metrics = config.get("metrics") or {c: r.get("type", "float") for c, r in rules.items()} or None
    parsed = parse_lines(df)
    if metrics is None:
        metrics = _metrics_found(parsed)
    timed = parsed.withColumn("Time", parse_time(F.col("time_text")))
    wide = project_metrics(timed, metrics, keep=["source_file", "Time"])
    filled = rules_fill_drop(wide, rules, keys=["source_file"])
    return to_variable_long(gaussianise(filled), drop=["source_file"])


# Step names used in configurations, without ordering prefix and file ending.
STEPS = {
    "parser": parser,
    "split": split,
    "clean": cleaning,
    "transfo": transfo,
    "canonical": canonical,
    "resample": resample,
    "aggregated": aggregated,
    "import_postgres": import_postgres,
    "import_raw_postgres": import_raw_postgres,
    "preprocess": preprocess,
    "parquet_to_csv": lambda df, config: df,
    "convert_timestamps": lambda df, config: rewrite_line_times(df),
}
_TEXT = {"parser", "preprocess", "convert_timestamps"}
_SINK_TIME = {"import_postgres": "ts", "import_raw_postgres": "Time"}


def step_name(run: str) -> str:
    """A number in front and a file ending do not matter: ``07_clean.py`` is ``clean``."""
    name = re.sub(r"\.py$", "", re.sub(r"^\d+_", "", run.rsplit("/", 1)[-1]))
    if name not in STEPS:
        raise ValueError(f"unknown step {run!r}")
    return name


@dataclass(frozen=True)
class Step:
    name: str
    config: Mapping

    @classmethod
    def of(cls, run: str, config: Mapping) -> Step:
        return cls(step_name(run), config)


class Flow:
    """An ordered list of steps; a failing step stops the flow."""

    def __init__(self, steps: Sequence[Step | Mapping], start: str | datetime | None = None, end: str | datetime | None = None):
        made = [s if isinstance(s, Step) else Step.of(s["run"], s["with"]) for s in steps]
        bounds = {k: v for k, v in (("from", start), ("to", end)) if v}
        self.steps = [Step(s.name, {**s.config, "input": {**_input(s.config), **bounds}}) for s in made]

    @classmethod
    def load(cls, spark: SparkSession, path: str, **bounds) -> Flow:
        """A JSON file with ``items: [{"run": step, "with": settings file}]``."""
        plan = _read_json(spark, path)
        items = plan.get("items")
        if not isinstance(items, list) or not all("run" in i and "with" in i for i in items):
            raise ValueError(f"{path}: 'items' must list objects with 'run' and 'with'")
        return cls([Step.of(i["run"], _read_json(spark, i["with"])) for i in items], **bounds)

    def chain(self, df: DataFrame, stage: bool = True) -> DataFrame:
        """The steps one after the other on a frame.

        Lines that cannot be placed in time are in ``rejects`` afterwards, a frame by name of the step.

        A step may read its input several times, so each result but the last is written once to the shared folder;
        ``stage=False`` leaves everything to one lazy plan, for short chains.
        """
        self.rejects = {}
        for number, step in enumerate(self.steps):
            if (bad := rejected(df, step)) is not None:
                self.rejects[step.name] = bad
            df = STEPS[step.name](df, step.config)
            if stage and number + 1 < len(self.steps):
                df = staged(df)
        return df

    def run(self, spark: SparkSession) -> list[tuple[str, DataFrame | None]]:
        """Read, compute and write each step in turn.

        Returns per step its name and the rows per source file before and after, where both sides know the file.
        """
        reports = []
        for step in self.steps:
            before = read_step(spark, step)
            after = STEPS[step.name](before, step.config)
            write_step(step, after)
            bad = rejected(before, step)
            if bad is not None:
                bad.write.mode("overwrite").parquet(rejects_path(step))
            known = "source_file" in before.columns and "source_file" in after.columns
            reports.append((step.name, source_report(before, after, rejected=bad) if known else None))
        return reports


def rejects_path(step: Step) -> str:
    """Where a run keeps the rejected lines of a step: ``output.rejects_directory``, else next to its output."""
    out = _output(step.config)
    return out.get("rejects_directory") or f"{out['output_directory'].rstrip('/')}_rejects"


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


def read_step(spark: SparkSession, step: Step) -> DataFrame:
    settings = _input(step.config)
    path = settings["input_directory"]
    recursive = str(settings.get("search_in_subdirectory", "no")).lower() == "yes"
    exclude = settings.get("except") or None
    if step.name in _TEXT:
        pattern = settings.get("file_pattern", "*.csv")
        return files.read_text(spark, path, pattern=pattern, recursive=recursive, exclude=exclude)
    if step.name == "import_raw_postgres":
        raw = files.read_raw_long(
            spark,
            path,
            pattern=settings.get("file_pattern", "*.csv"),
            recursive=recursive,
            exclude=exclude,
            time_column=settings.get("timestamp_column", "Time"),
            zone=settings.get("time_zone", "convert"),
        )
        return _not_loaded(raw, step)
    pattern = settings.get("file_pattern", "*.parquet")
    if pattern == "*.parquet" and not exclude and (few := _zoned(spark, path, settings)) is not None:
        return few
    reader = files.read_parquet if pattern.endswith("parquet") else files.read_csv
    # Folders named key=value are searched without asking and give columns. Identity is in columns from here on, so
    # the names of the files between steps say nothing.
    df = files.with_domain(reader(spark, path, pattern=pattern, exclude=exclude))
    return df.drop("source_path", "source_file")


def _groups(columns: Sequence[str]) -> list[str]:
    return [c for c in ("device_id", "domain", "day") if c in columns]


def _zoned(spark: SparkSession, path: str, settings: Mapping) -> DataFrame | None:
    """A stage with zones, read over a range: only files with a group that overlaps it. None where that is not so."""
    bounds = settings.get("from"), settings.get("to")
    if settings.get("granularity") == "row" or not (parse_bound(bounds[0]) or parse_bound(bounds[1], end=True)) or not table_exists(spark, f"{path.rstrip('/')}/_zones"):
        return None
    fields = spark.read.option("mergeSchema", "true").parquet(path).schema.fields
    times = [f.name for f in fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
    by = _groups([f.name for f in fields])
    if len(times) != 1 or "domain" not in by or not table_exists(spark, zones.zones_path(path, times[0], by)):
        return None
    return zones.read_overlapping(spark, path, *bounds, ts=times[0], by=by)


def write_step(step: Step, df: DataFrame) -> None:
    out = _output(step.config)
    if step.name in _SINK_TIME:
        _write_sink(step, df)
    elif step.name == "parquet_to_csv":
        export_csv(df, out["output_directory"], decimals=out.get("decimal_places"), ts=_time_in(step.config, "ts"))
    elif step.name == "convert_timestamps":
        rewrite_lines(df, out["output_directory"])
    else:
        times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
        # The source file has done its work once rows carry device and day.
        rows = df.drop("source_file")
        if "day" not in rows.columns and times:
            rows = rows.withColumn("day", F.to_date(times[0]))
        partitions = [c for c in ("domain", "day") if c in rows.columns]
        bounds = _input(step.config)
        ranged = parse_bound(bounds.get("from")) or parse_bound(bounds.get("to"), end=True)
        codec = out.get("compression") or "snappy"
        if out.get("clear") and ranged and partitions:
            # A run over a range replaces what it computed and leaves the other days alone.
            overwrite_partitions(rows, out["output_directory"], partitions, codec)
        else:
            clear = bool(out.get("clear"))
            write_dataset(rows, out["output_directory"], partition_by=partitions, clear=clear, compression=codec)
        spark = df.sparkSession
        if times and _groups(rows.columns) and table_exists(spark, out["output_directory"]):
            zones.refresh(spark, out["output_directory"], times[0], _groups(rows.columns))


def _database(step: Step) -> tuple[Mapping, dict[str, str], str]:
    """Sink settings, physical column names, and the physical time column."""
    db, ts = _output(step.config)["database"], _SINK_TIME[step.name]
    schema = db.get("schema") or {}
    logical = {"timestamp_column": ts, **{f"{c}_column": c for c in ("device_id", "domain", "sensor", "value")}}
    names = {column: schema[key] for key, column in logical.items() if key in schema}
    return db, names, names.get(ts, ts)


def _not_loaded(df: DataFrame, step: Step) -> DataFrame:
    """What the sink lacks: by high-water mark (``max_ts``) or by missing days (``true`` or ``missing_days``)."""
    db, _, time = _database(step)
    mode = {True: "missing_days", False: "none", None: "none"}.get(db.get("auto_mode"), db.get("auto_mode"))
    if mode == "none" or not table_exists(df.sparkSession, db["path"]):
        return df
    return select_new(df, df.sparkSession.read.parquet(db["path"]), mode, ts="Time", sink_ts=time)


def _write_sink(step: Step, df: DataFrame) -> None:
    db, names, time = _database(step)
    raw = step.name == "import_raw_postgres"
    settings = _input(step.config)
    kind = db.get("value_type") or ("numeric" if raw else None)
    rows = cast_value(df, kind, int(db.get("value_precision", 18)), int(db.get("value_scale", 2 if raw else 6)))
    write_table(
        map_columns(rows, names),
        db["path"],
        policy=db.get("policy", "replace"),
        ts=time,
        start=settings.get("from") if raw else None,
        end=settings.get("to") if raw else None,
        scope=db.get("scope", ()),
        autocreate=db.get("autocreate", True),
        destroy=bool(db.get("destroy", False)),
    )
