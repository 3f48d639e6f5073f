"""Sinks, incremental loads, streams, and the whole chain over files."""

import json

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators.aggregate import long_aggregate
from sensorpipe.plans.flow import Flow, step_name
from sensorpipe.sinks import export, tables
from sensorpipe.sinks.report import source_report, totals
from sensorpipe.sources import files
from sensorpipe.streaming import ingest
from sensorpipe.streaming.incremental import select_new


def points(spark, *items):
    data = [(f"2026-01-{d:02d} {h:02d}:00:00", dev, float(v)) for d, h, dev, v in items]
    df = spark.createDataFrame(data, "t string, device_id string, value double")
    return df.select(F.col("t").cast("timestamp_ntz").alias("ts"), "device_id", "value")


def stored(spark, path):
    return sorted((str(r["ts"])[5:13], r["device_id"], float(r["value"])) for r in spark.read.parquet(path).collect())


def part_files(path, day):
    return {f.name: f.read_bytes() for f in (path / f"day=2026-01-{day:02d}").iterdir() if f.name.startswith("part")}


def test_table_policies(spark, tmp_path):
    path = tmp_path / "t"
    held = points(spark, (1, 0, "a", 1), (2, 0, "a", 2), (2, 6, "b", 3), (2, 9, "a", 4), (3, 0, "a", 5))
    with pytest.raises(ValueError, match="no table"):
        tables.write_table(held, str(path), autocreate=False)
    tables.write_table(held, str(path))
    untouched = part_files(path, 1)
    batch = points(spark, (2, 0, "a", 20), (2, 6, "a", 30))
    for _ in range(2):  # replacing twice is replacing once
        tables.write_table(batch, str(path), policy="replace")
        # Both ends of the range are closed, and all devices are replaced.
        assert stored(spark, str(path)) == [("01-01 00", "a", 1), ("01-02 00", "a", 20), ("01-02 06", "a", 30), ("01-02 09", "a", 4), ("01-03 00", "a", 5)]
    assert part_files(path, 1) == untouched
    tables.write_table(points(spark, (2, 6, "z", 9)), str(path), scope=["device_id"])
    assert ("01-02 06", "a", 30) in stored(spark, str(path)) and ("01-02 06", "z", 9) in stored(spark, str(path))
    # A range wider than the batch empties whole days.
    tables.write_table(points(spark, (2, 12, "a", 7)), str(path), start="2026-01-02", end="2026-01-03")
    assert stored(spark, str(path)) == [("01-01 00", "a", 1), ("01-02 12", "a", 7)]
    for policy in ("replace", "replace_all"):  # nothing to load, nothing to delete
        tables.write_table(held.limit(0), str(path), policy=policy, start="2026-01-01", end="2026-01-09")
        assert len(stored(spark, str(path))) == 2
    tables.write_table(points(spark, (2, 12, "a", 7)), str(path), policy="append")
    assert len(stored(spark, str(path))) == 3
    tables.write_table(spark.read.parquet(str(path)).drop("day"), str(path), policy="replace_all")  # reads what it overwrites
    assert len(stored(spark, str(path))) == 3
    tables.write_table(points(spark, (9, 1, "q", 1)), str(path), destroy=True, policy="append")
    assert stored(spark, str(path)) == [("01-09 01", "q", 1)]


def test_replace_on_empty_sink(spark, rows):
    held = points(spark, (1, 0, "a", 1))
    assert rows(tables.replace_range(held.limit(0), held)) == rows(held)
    assert rows(tables.replace_range(held, held.limit(0))) == rows(held)


def test_value_types(spark):
    df = spark.sql("select double(3) value union all select 4.0000000001D")
    assert tables.infer_value_type(df).first()[0] == "int"
    assert [r[0] for r in tables.cast_value(df).collect()] == [3, 4]
    assert tables.infer_value_type(spark.sql("select -2.5D value")).first()[0] == "numeric"
    assert tables.infer_value_type(spark.sql("select cast(null as double) value")).first()[0] == "numeric"
    assert str(tables.cast_value(spark.sql("select 2.345D value"), "numeric", 18, 2).schema["value"].dataType) == "DecimalType(18,2)"
    with pytest.raises(ValueError):
        tables.cast_value(df, "text")


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("POSTGRES_PASSWORD", "secret")
    options = tables.jdbc_options({"dbname": "d", "user": "u", "password": "ignored"}, "t")
    assert options["password"] == "secret" and options["batchsize"] == "10000" and options["url"].endswith("localhost:5432/d")


def test_csv_export(spark, tmp_path):
    df = spark.sql("select timestamp_ntz'2026-01-01 00:00:00.9' ts, 'a' metric, 1.5D value union all select null, 'b', null union all select null, 'c', 2D")
    path = str(tmp_path / "csv")
    export.export_csv(df.coalesce(1), path, decimals={"a": 2})
    text = sorted(r[0] for r in spark.read.text(path).collect())
    assert text == ["2026-01-01T00:00:00Z,a,1.50", "NaN,b,NaN", "NaN,c,2.0", "ts,metric,value"]


def test_report(spark):
    before = spark.createDataFrame([("a",), ("a",), ("b",)], "source_file string")
    out = source_report(before, before.filter("source_file = 'a'").limit(1))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2, 1, False), ("b", 1, 0, True)]
    assert tuple(totals(out).first()) == (2, 1, 3, 1)


def test_incremental(spark, rows):
    new = points(spark, (1, 0, "a", 1), (2, 0, "a", 2), (2, 1, "a", 3), (3, 0, "a", 4))
    sink = points(spark, (1, 5, "x", 0), (2, 0, "x", 0))
    assert len(rows(select_new(new, sink, "max_ts", ts="ts"))) == 2
    assert len(rows(select_new(new, sink.limit(0), "max_ts", ts="ts"))) == 4
    named = new.withColumns({"day": F.to_date("ts"), "source_file": F.concat(F.lit("f"), F.day("ts").cast("string"))})
    assert rows(select_new(named, sink, "missing_days", ts="ts"), "value") == [(4.0,)]
    unnamed = named.withColumn("day", F.lit(None).cast("date"))
    assert rows(select_new(unnamed, sink, "missing_days", ts="ts"), "value") == [(4.0,)]
    unknown = unnamed.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert len(rows(select_new(unknown, sink, "missing_days", ts="ts"))) == 4  # no day is known at all
    assert select_new(new, sink) is new
    with pytest.raises(ValueError):
        select_new(new, sink, "true")


def test_stream_equals_batch(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "x_dev_2026-01-01.csv").write_text("".join(f"2026-01-01T00:{m:02d}:{s:02d}Z;a:{m}.{s};b:{s}\n" for m in range(30) for s in (1, 30, 59)))
    target, state = str(tmp_path / "agg"), str(tmp_path / "state")
    stream = ingest.stream_raw_long(spark, str(landing)).drop("day", "source_file")
    ingest.aggregate_new(stream, "60s", target, state, method="median")
    raw = files.read_raw_long(spark, str(landing)).drop("day", "source_file")
    assert rows(spark.read.parquet(target).drop("day")) == rows(long_aggregate(raw, "60s", "median"))
    for _ in range(2):
        ingest.ingest_new_files(spark, str(landing), str(tmp_path / "out"), str(tmp_path / "ck"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == 180
    (landing / "x_dev_2026-01-02.csv").write_text("2026-01-02T00:00:00Z;a:1\n")
    ingest.ingest_new_files(spark, str(landing), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 181
    with pytest.raises(ValueError):
        ingest.windowed(raw, "1mo")


@pytest.fixture
def project(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for day in (21, 22):
        lines = [f"2026-01-{day}T00:00:{s:02d}.5Z;gap_a:{s % 7};gap_b:{25 if s == 3 else 4};porch_temp:{s}.25" for s in range(0, 40, 2)]
        lines += [lines[0], f"2026-01-{day - 1}T23:59:59Z;gap_a:1"]
        (raw / f"lab_node-01_2026-01-{day}.csv").write_text("\n".join(lines) + "\n")
    folder = lambda n: str(tmp_path / n)
    io = lambda a, b, **o: {"input": {"input_directory": folder(a), "from": "yyyy-mm-ddTh:m:sZ"}, "output": {"output_directory": folder(b), "clear": True, **o}}
    domains = {"bio_signal": ["gap_a", "gap_b"], "environment": ["porch_temp"]}
    steps = [
        ("01_parser.py", {**io("raw", "10", decimal_places={"default": 1}), "metrics": None}),
        ("02_split.py", {**io("10", "20"), "domain_columns": domains}),
        (
            "03_clean.py",
            {
                **io("20", "30", add_quality_column=True),
                "domain_columns": domains,
                "domain_rules": {"bio_signal": {"gap_a": {"type": "int", "max_diff": 5}, "gap_b": {"type": "int", "max": 20}}, "environment": {"porch_temp": {"type": "float", "min": 5}}},
            },
        ),
        ("04_transfo.py", {**io("30", "40"), "domain_transfo": {"environment": {"porch_temp": {"porch_f": "celsius_to_fahrenheit"}}}}),
        ("05_canonical.py", {**io("40", "50", decimal_places={"default": 3}), "domain_columns": {"bio_signal": ["gap_a", "gap_b"], "environment": ["porch_temp", "porch_f"]}, "unit_map": {"porch_f": "F"}}),
        ("06_resample.py", {**io("50", "55"), "resample_by_domain": {d: {"freq": "1s", "independent_by_day": True} for d in domains}}),
        ("07_aggregated.py", {**io("55", "70"), "aggregation_level": "10s", "metrics_aggregation": {"gap_a": [{"method": "median", "output": "col_a"}], "porch_f": [{"method": "average", "output": "t"}]}}),
        (
            "08_import_postgres.py",
            {
                "input": {"input_directory": folder("70")},
                "output": {"database": {"path": folder("table"), "policy": "replace", "include_metrics": ["col_a"], "column_to_sensor": {"col_a": "gap_a"}, "schema": {"timestamp_column": "time"}}},
            },
        ),
        (
            "09_import_raw_postgres.py",
            {"input": {"input_directory": folder("raw"), "file_pattern": "*.csv"}, "output": {"database": {"path": folder("rawtable"), "aggregation": "10s", "auto_mode": True, "include_sensors": ["gap_a"]}}},
        ),
    ]
    items = []
    for run, config in steps:
        name = tmp_path / f"{run}.json"
        name.write_text(json.dumps({k: v for k, v in config.items() if v is not None}))
        items.append({"run": run, "with": str(name)})
    (tmp_path / "plan.json").write_text(json.dumps({"items": items}))
    return tmp_path


def test_flow_over_files(spark, project, rows):
    flow = Flow.load(spark, str(project / "plan.json"))
    reports = dict(flow.run(spark))
    assert rows(reports["parser"], "rows_before", "rows_after") == [(22, 20), (22, 20)]
    read = lambda n: spark.read.parquet(str(project / n))
    cleaned = read("30")
    flags = {d: rows(cleaned.filter(F.col("domain") == d).groupBy("quality_flag").count()) for d in ("bio_signal", "environment")}
    # gap_a runs 0 2 4 6 1 3 5 0 ...: no jump exceeds 5; gap_b is 25 never, since seconds are even; 0, 2 and 4 degrees are too cold.
    assert flags["bio_signal"] == [(0, 40)]
    assert flags["environment"] == [(0, 34), (3, 6)]
    assert read("50").count() == 2 * 20 * 4
    resampled = read("55")
    assert resampled.count() == 2 * 39 * 4
    assert resampled.filter("quality_flag = 5").count() == 2 * 19 * 4
    aggregated = read("70")
    assert aggregated.count() == 2 * 4 * 2
    first = aggregated.filter("domain = 'bio_signal'").orderBy("ts").first()
    assert (first["device_id"], first["col_a"]) == ("node-01", 2.0)  # 0 0 2 2 4 4 6 6 1 1
    table = read("table")
    assert set(table.columns) == {"time", "device_id", "domain", "sensor", "value", "day"}
    assert table.select("sensor").distinct().collect()[0][0] == "gap_a" and table.count() == aggregated.count()
    raw = read("rawtable").count()
    before = rows(read("20")), rows(read("70"))
    # A second run over one day replaces that day and leaves the rest; the automatic load finds nothing new.
    Flow.load(spark, str(project / "plan.json"), start="2026-01-22", end="2026-01-22").run(spark)
    assert (rows(read("20")), rows(read("70"))) == before
    assert read("rawtable").count() == raw > 0


def test_chain_equals_files(spark, project, rows):
    flow = Flow.load(spark, str(project / "plan.json"))
    flow.run(spark)
    lines = files.read_text(spark, str(project / "raw"))
    chained = Flow(flow.steps[:7]).chain(lines)
    stored_rows = spark.read.parquet(str(project / "70")).select(*chained.columns)
    assert rows(chained) == rows(stored_rows)


def test_legacy_step(spark, project, rows):
    lines = files.read_text(spark, str(project / "raw"), pattern="*21.csv")
    config = {"rules_and_filters": {"gap_a": {"type": "int", "min": 1}, "porch_temp": {"type": "float"}}}
    out = Flow([{"run": "preprocess", "with": config}]).chain(lines)
    assert out.columns == ["timestamp", "variable", "value"]
    assert out.filter("value is null").count() == 0
    assert out.filter("variable = 'gap_a' and value > 1").count() == 0


def test_step_names():
    assert step_name("03_clean.py") == step_name("steps/clean") == "clean"
    with pytest.raises(ValueError):
        step_name("99_other.py")
