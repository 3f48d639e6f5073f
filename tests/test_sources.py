"""Reading, parsing and what names say."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from sensorpipe.functions import naming
from sensorpipe.functions.rounding import round_by_metric, round_columns
from sensorpipe.functions.times import Duration, format_time, normalize_time_text, parse_bound, parse_time, time_bucket, whole_seconds_between
from sensorpipe.functions.transforms import derive, gaussianise, register
from sensorpipe.operators import select as sel
from sensorpipe.operators.aggregate import aggregate_by_domain, bucket_aggregate, long_aggregate, specs_of
from sensorpipe.operators.reshape import to_canonical, to_raw_long, to_sink_long, to_variable_long
from sensorpipe.sources import files
from sensorpipe.sources import keyvalue as kv

LINES = """2026-01-21T00:00:00.748320Z;m0:7;m1:12;outdoor_temp:18.81
2026-01-21T00:00:01Z;m0:7;m1:12
2026-01-21T00:00:02;m0:19;m0:8;bad;note:a:b
2026-01-20T23:59:59Z;m0:5

2026-01-21T10:00:00+02:00;m0:x;m1:NaN;outdoor_temp:-40.0
junk;m0:1
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    (base / "sample_node-01_2026-01-21.csv").write_text(LINES)
    (base / "sample_node-02_2026-01-21.csv").write_text("2026-01-21T00:00:05Z; m0 : 3 ;m1: ;: 4;m2:nan\n;m0:1\n2026-01-21T00:00:06Z;nothing\n")
    (base / "skip_me.csv").write_text("2026-01-21T00:00:05Z;m0:3\n")
    (base / "sub").mkdir()
    (base / "sub" / "sample_node-03_2026-01-22.csv").write_text("2026-01-22T00:00:00Z;m0:1\n")
    return str(base)


def test_selection(spark, folder):
    names = lambda **o: sorted(r[0] for r in files.read_text(spark, folder, **o).select("source_file").distinct().collect())
    assert names(exclude="skip*") == ["sample_node-01_2026-01-21.csv", "sample_node-02_2026-01-21.csv"]
    assert len(names(recursive=True)) == 4
    assert names(pattern="*node-0[!2]*") == ["sample_node-01_2026-01-21.csv"]


def test_parse(spark, folder):
    lines = files.read_text(spark, folder, pattern="*node-01*")
    parsed = kv.with_time(kv.parse_lines(lines))
    out = kv.project_metrics(parsed, {"m0": "int", "m1": "int", "outdoor_temp": "float", "note": "string", "absent": "int"}, keep=["Time"])
    got = {str(r["Time"]): tuple(r)[1:] for r in out.collect()}
    assert got == {
        "2026-01-21 00:00:00": (7, 12, 18.81, None, None),
        "2026-01-21 00:00:01": (7, 12, None, None, None),
        "2026-01-21 00:00:02": (8, None, None, "a:b", None),
        "2026-01-20 23:59:59": (5, None, None, None, None),
        "2026-01-21 08:00:00": (None, None, -40.0, None, None),
        "None": (1, None, None, None, None),
    }
    assert kv.rejects(parsed).count() == 1
    found = {r["metric"]: (r["readings"], r["type"]) for r in kv.discover_metrics(parsed).collect()}
    assert found == {"m0": (6, "string"), "m1": (3, "long"), "outdoor_temp": (2, "double"), "note": (1, "string")}


def test_lenient(spark, folder, rows):
    lines = files.read_text(spark, folder, pattern="*node-02*")
    parsed = kv.parse_lines_lenient(lines)
    assert [r["readings"] for r in parsed.collect()] == [{"m0": 3.0}]
    long = files.read_raw_long(spark, folder, pattern="*node-0*")
    assert rows(long.filter("device_id = 'node-02'"), "device_id", "sensor", "value", F.col("day").cast("string")) == [
        ("node-02", "m0", 3.0, "2026-01-21")
    ]
    assert list(files.sniff_formats(spark, folder, pattern="*node-01*")) == ["keyvalue"]


def test_last_valid_value_wins(spark):
    df = spark.createDataFrame([("t;a:1;a:x;b:2;a:3;b:",)], "value string")
    assert kv.parse_lines_lenient(df).first()["readings"] == {"a": 3.0, "b": 2.0}
    assert kv.parse_lines(df).first()["readings"] == {"a": "3", "b": ""}


def test_render_parse_round_trip(spark, rows):
    df = spark.sql("select timestamp_ntz'2026-01-01 10:00:00' ts, 1.5D a, cast(null as double) b union all select timestamp_ntz'2026-01-01 10:00:01', 2D, 3D")
    parsed = kv.with_time(kv.parse_lines(kv.render_lines(df, "ts", ["a", "b"])), "ts")
    assert rows(kv.project_metrics(parsed, ["a", "b"], keep=["ts"])) == rows(df)


def test_raw_csv_and_parquet(spark, tmp_path, rows):
    base = tmp_path / "csv"
    base.mkdir()
    (base / "lab_dev_2026-01-21.csv").write_text(" TIME ,a,b\n2026-01-21T00:00:00.5Z,1,NaN\n2026-01-21T00:00:01Z,2,3.5\n")
    expected = [("dev", "a", 1.0), ("dev", "a", 2.0), ("dev", "b", None), ("dev", "b", 3.5)]
    long = files.read_raw_long(spark, str(base), time_column="time")
    assert rows(long, "device_id", "sensor", "value") == expected
    assert sorted({str(r["Time"]) for r in long.collect()}) == ["2026-01-21 00:00:00", "2026-01-21 00:00:01"]
    wide = spark.sql("select '2026-01-21T00:00:00Z' t, 1D a, 'dev' device_id, 9 junk")
    wide.coalesce(1).write.parquet(str(tmp_path / "pq"))
    long = files.read_raw_long(spark, str(tmp_path / "pq"), pattern="*.parquet", time_column="missing", exclude_columns=["junk"])
    assert rows(long, "Time", "device_id", "sensor", "value") == [(dt.datetime(2026, 1, 21), "dev", "a", 1.0)]
    assert list(files.sniff_formats(spark, str(base))) == ["csv"]


def test_rewrite(spark):
    df = spark.createDataFrame([("2026-01-23T00:00:00.748320Z;a:1;b:2\r",), ("no separator",), ("2026-1-23T06:52:52;x",)], "value string")
    assert [r[0] for r in kv.rewrite_line_times(df).collect()] == ["2026-01-23T00:00:00Z;a:1;b:2", "no separator", "2026-01-23T06:52:52Z;x"]
    for text in ("2026-01-23T00:00:00.5;a:1", "yesterday;a:1", "2026-13-23T00:00:00Z;a:1"):
        bad = spark.createDataFrame([(text,)], "value string")
        assert kv.rewrite_line_times(bad, on_error="keep").first()[0] == text
        with pytest.raises(Exception, match="unknown time format"):
            kv.rewrite_line_times(bad).collect()


def test_times(spark):
    texts = ["2026-01-21T10:00:00.9Z", "2026-01-21T10:00:00+02:00", "20260123", "2026-01-21", "12:30", "today", "2026", "junk", "  ", None, "2026-01-21T25:00:00Z", "2026-1-2T3:4:5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r[0] for r in df.select(format_time(parse_time(F.col("t")))).collect()]
    assert got == ["2026-01-21T10:00:00Z", "2026-01-21T08:00:00Z", "2026-01-23T00:00:00Z", "2026-01-21T00:00:00Z"] + [None] * 7 + ["2026-01-02T03:04:05Z"]
    assert df.select(format_time(parse_time(F.col("t"), "wall"))).collect()[1][0] == "2026-01-21T10:00:00Z"
    kept = [r[0] for r in df.select(normalize_time_text(F.col("t"))).collect()]
    assert kept[4:10] == ["12:30", "today", "2026", "junk", None, None]
    with pytest.raises(ValueError):
        parse_time(F.col("t"), "other")


def test_durations_and_bounds(spark):
    assert Duration.of("5m").micros == 300_000_000 and Duration.of("2mo").months == 2 and Duration.of("1d").unit == "d"
    for bad in ("5", "0s", "m", "5 minutes", "1.5s"):
        with pytest.raises(ValueError):
            Duration.of(bad)
    assert parse_bound("2026-01-21", end=True) == dt.datetime(2026, 1, 21, 23, 59, 59)
    assert parse_bound("yyyy-mm-ddTh:m:sZ") is None and parse_bound("") is None and parse_bound("x") is None
    df = spark.sql("select timestamp_ntz'1969-12-31 23:59:58.5' a, timestamp'2026-03-04 05:06:07' b")
    assert df.select(time_bucket(F.col("a"), "10s")).first()[0] == dt.datetime(1969, 12, 31, 23, 59, 50)
    assert [f.dataType.typeName() for f in df.select(time_bucket(F.col("a"), "1w"), time_bucket(F.col("b"), "1mo")).schema] == ["timestamp_ntz", "timestamp"]
    assert df.select(whole_seconds_between(F.expr("a + interval 2700 milliseconds"), F.col("a"))).first()[0] == -2.0
    with pytest.raises(ValueError):
        time_bucket(F.col("a"), "2w")


def test_names(spark):
    df = spark.createDataFrame([("exp_node-1_2026-01-21_x.csv",), ("plain.csv",), ("a_b.csv",), ("x_AGG5M_y_agg10s_z.csv",), ("t_2026-01-21.csv",)], "n string")
    stem = naming.stem(F.col("n"))
    out = df.select(
        naming.experience_of(stem), naming.device_of(stem), naming.day_of(stem).cast("string"), naming.aggregation_level_of(stem), naming.closing_date_of(stem).cast("string")
    )
    assert [tuple(r) for r in out.collect()] == [
        ("exp", "node-1", "2026-01-21", None, None),
        (None, None, None, None, None),
        (None, "b", None, None, None),
        ("x", "AGG5M", None, "10s", None),
        (None, "2026-01-21", "2026-01-21", None, "2026-01-21"),
    ]
    assert df.select(naming.device_of(stem, r"_(node-\d+)_")).first()[0] == "node-1"
    path = spark.createDataFrame([("/a/domain=x/domain=bio/day=1/f.parquet",), ("/a/b",)], "p string")
    assert [r[0] for r in path.select(naming.partition_value(F.col("p"), "domain")).collect()] == ["bio", None]


def test_select(spark):
    df = spark.sql("select 1 a, 2 b")
    assert sel.select_rename(df, ["b->c", "x", " a "]).columns == ["c", "a"]
    assert sel.select_rename(df, ["x"]).columns == ["a", "b"] and sel.select_rename(df, None) is df
    assert sel.resolve_time_column([" TS ", "b"], "ts") == " TS " and sel.resolve_time_column(["a", "b"], "ts") == "a"
    with pytest.raises(ValueError):
        sel.split_domains(df, {})
    out = sel.ensure_identity(df, device_id="d", device_from=F.lit(None).cast("string"), domain="x").first()
    assert (out["device_id"], out["domain"]) == ("d", "x")


def test_round_and_transforms(spark):
    df = spark.sql("select 'a' metric, 0.125D value, 2.5D x, 3 n union all select 'b', 2.675D, -1D, 0")
    out = round_by_metric(df, {"a": 2, "default": None}).orderBy("metric").collect()
    assert [r["value"] for r in out] == [0.13, 2.675]
    assert round_columns(df, 0, ties="half_even").orderBy("metric").first()["x"] == 2.0
    assert [r["value"] for r in round_by_metric(df, 1).orderBy("metric").collect()] == [0.1, 2.7]
    register("double", lambda x: x * 2)
    out = derive(df, {"x": {"l": "log", "s": "sqrt_inv", "f": "celsius_to_fahrenheit", "d": "double"}, "d": {"dd": "double"}}).orderBy("metric").collect()
    assert out[1]["l"] is None and out[1]["s"] is None and out[0]["f"] == 36.5 and out[0]["dd"] == 10.0
    out = gaussianise(df, exclude=["value"]).orderBy("metric").collect()
    assert [r["x"] for r in out] == [pytest.approx(0.4**0.5), -1.0] and [r["n"] for r in out] == [pytest.approx(3**-0.5), 0.0]


def test_reshape(spark, rows):
    wide = spark.sql("select timestamp_ntz'2026-01-01' Time, 'd' device_id, 1 a, cast(null as double) b")
    out = to_canonical(wide, ["a", "b", "zz"], domain=F.lit("bio"), units={"a": "°C"})
    assert rows(out, "metric", "value", "unit", "quality_flag") == [("a", 1.0, "°C", None), ("b", None, "", None)]
    with pytest.raises(ValueError):
        to_canonical(wide, ["zz"], domain=F.lit("bio"))
    keys = wide.select(F.col("Time").alias("ts"), "device_id", F.lit("bio").alias("domain"))
    assert rows(to_sink_long(keys), "sensor", "value") == [(None, None)]
    assert to_raw_long(wide.select("Time", "device_id")).count() == 0
    assert rows(to_variable_long(wide, drop=["device_id"]), "variable", "value") == [("a", 1.0)]
    with pytest.raises(ValueError):
        to_variable_long(wide.select("Time"))


def test_aggregate(spark, rows):
    data = [("2026-01-01 00:00:01", "a", 1.0), ("2026-01-01 00:00:09", "a", 4.0), ("2026-01-01 00:00:12", "b", None), ("2026-01-01 00:00:15", "c", 3.0)]
    df = spark.createDataFrame(data, "t string, metric string, value double")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("ts"), F.lit("d").alias("device_id"), F.lit("bio").alias("domain"), "metric", "value", F.lit(0).alias("quality_flag"))
    out = bucket_aggregate(df, "10s", [{"metric": "a", "method": "median", "output": "c0"}, {"metric": "b"}])
    assert rows(out, F.second("ts"), "c0", "b") == [(0, 2.5, None), (10, None, None)]
    out = bucket_aggregate(df, "10s", {"a": [{"method": "approx_median"}]}, exclude_flags=[0])
    assert rows(out, "a") == [(None,), (None,)]
    assert rows(aggregate_by_domain(df, "1m", {"bio": {"method": "median"}}), "a", "b", "c") == [(2.5, None, 3.0)]
    raw = df.select(F.col("ts").alias("Time"), "device_id", F.col("metric").alias("sensor"), "value")
    assert rows(long_aggregate(raw, "60s"), "sensor", "value") == [("a", 2.5), ("b", None), ("c", 3.0)]
    with pytest.raises(ValueError, match="more than once"):
        specs_of({"a": [{"method": "median"}, {"method": "mean"}]})
    with pytest.raises(ValueError, match="method"):
        specs_of([{"metric": "a", "method": "max"}])
    with pytest.raises(ValueError):
        long_aggregate(raw, "sixty")


def test_first_lines_are_those_of_a_scan(spark, tmp_path, monkeypatch):
    folder = tmp_path / "a +b%20"
    (folder / "sub").mkdir(parents=True)
    texts = {
        "plain.csv": b"a,b\n1,2\n",
        "blank first.csv": b"\r\n  \r\n\na,c\r\n1,2",
        "old mac.csv": b"a,b\r1,2\r",
        "one line.csv": b"x,y",
        "nothing.csv": b"",
        "blank.csv": b"\n \n",
        "long+.csv": b"c" * 200_000 + b",d\n1,2\n",
        "marked.csv": b"\xef\xbb\xbfa,b\n",
        "other.csv.gz": gzip.compress(b"\nt;a:1\nt;a:2\n"),
        "sub/deep.csv": b"a,b\n",
    }
    for name, content in texts.items():
        (folder / name).write_bytes(content)
    spark.range(1).write.parquet(str(folder / "sub" / "pq"))
    names = lambda df: {(r.file_path.rsplit("/", 1)[-1], r.line) for r in df.collect()}
    probed = names(files.first_lines(spark, str(folder), recursive=True))
    assert len(probed) == 8 and probed == names(files._scanned_first_lines(spark, str(folder), "*", True))
    kinds = files.sniff_formats(spark, str(folder), recursive=True)
    assert {k: len(v) for k, v in kinds.items()} == {"csv": 7, "keyvalue": 1, "parquet": len(list(folder.glob("sub/pq/*.parquet")))}
    assert spark.read.text(kinds["csv"]).count() > 0
    monkeypatch.setattr(files, "OPENED", {})
    assert names(files.first_lines(spark, str(folder), recursive=True)) == probed


def test_a_folder_of_one_header_lists_no_files(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"a,b\n{i},2\n")
    assert files.sniff_formats(spark, str(tmp_path)) == {"csv": []}
    assert files.read_csv(spark, str(tmp_path), schema="a int, b int").agg(F.sum("a")).first()[0] == 10
    listed = spark.read.format("binaryFile").load(str(tmp_path)).select("path")
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
