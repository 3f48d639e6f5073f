"""Reading files: selection by name, formats, and what names and paths say."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.constants import CSV_NULL
from sensorpipe.functions import naming
from sensorpipe.functions.times import parse_bound, parse_time
from sensorpipe.operators.reshape import readings_to_long, to_raw_long
from sensorpipe.operators.select import filter_range, resolve_time_column
from sensorpipe.session import staged
from sensorpipe.sources.keyvalue import parse_lines_lenient


def glob_to_regex(pattern: str) -> str:
    """A file-name glob (``*``, ``?``, ``[...]``) as an anchored regular expression."""
    out, rest = "", pattern
    while rest:
        group = re.match(r"\[(!?)([^\]]+)\]", rest)
        if group:
            out += "[" + ("^" if group[1] else "") + group[2].replace("\\", "\\\\") + "]"
            rest = rest[group.end() :]
            continue
        out += {"*": ".*", "?": "."}.get(rest[0], re.sub(r"(\W)", r"\\\1", rest[0]))
        rest = rest[1:]
    return f"^{out}$"


def _reader(spark: SparkSession, pattern: str, recursive: bool) -> DataFrameReader:
    reader = spark.read.option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", "true") if recursive else reader


def with_source(df: DataFrame, exclude: str | None = None) -> DataFrame:
    """Add ``source_file`` and ``source_path`` of each row; leave out files whose name matches ``exclude``."""
    out = df.select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("source_path"))
    return out.filter(~F.col("source_file").rlike(glob_to_regex(exclude))) if exclude else out


def read_text(
    spark: SparkSession, path: str | Sequence[str], *, pattern: str = "*.csv", recursive: bool = False, exclude: str | None = None
) -> DataFrame:
    return with_source(_reader(spark, pattern, recursive).text(path), exclude)


def read_parquet(
    spark: SparkSession,
    path: str,
    *,
    pattern: str = "*.parquet",
    recursive: bool = False,
    exclude: str | None = None,
    source: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Parquet files; ``key=value`` folders become partition columns unless ``recursive`` reads all folders alike."""
    reader = _reader(spark, pattern, recursive)
    if schema is not None:
        reader = reader.schema(schema)
    # Files of one stage may have different columns; their union is the schema.
    paths = [path] if isinstance(path, str) else path
    df = reader.option("mergeSchema", "true").parquet(*paths) if schema is None else reader.parquet(*paths)
    return with_source(df, exclude) if source or exclude else df


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    pattern: str = "*.csv",
    recursive: bool = False,
    exclude: str | None = None,
    schema: T.StructType | str | None = None,
    source: bool = True,
    null_text: str | None = CSV_NULL,
) -> DataFrame:
    """Comma-separated files with a header. Without a schema the types are inferred, which reads the files twice.

    Files with unlike headers, in order or in names, are read each by its own header; a column that a file lacks is
    null. The first block of every file is looked at for that (``first_lines``); the driver gets the distinct headers,
    and names of files only where headers differ.
    """
    headers = _by_kind(staged(first_lines(spark, path, pattern=pattern, recursive=recursive).withColumnRenamed("line", "kind")))
    options = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]['Z']"}
    if null_text is not None:
        options |= {"nullValue": null_text, "nanValue": null_text}
    wanted = spark.createDataFrame([], schema).schema if schema is not None else None

    def read(reader: DataFrameReader, files, header: str | None) -> DataFrame:
        reader = reader.options(**options)
        if wanted is None:
            return reader.option("inferSchema", "true").csv(files)
        if header is None:
            return reader.schema(wanted).csv(files)
        names = spark.read.options(header="true").csv(spark.sparkContext.parallelize([header], 1)).columns
        known = {f.name.lower(): f for f in wanted.fields}
        own = T.StructType([known.get(n.strip().lower(), T.StructField(n, T.StringType())) for n in names])
        return reader.schema(own).csv(files).select(*[f.name for f in own.fields if f.name.lower() in known])

    if len(headers) <= 1:
        return _sourced(read(_reader(spark, pattern, recursive), path, None), source, exclude)
    parts = [_sourced(read(spark.read, files, header), source, exclude) for header, files in headers.items()]
    whole = _stacked(parts)
    return whole if wanted is None else whole.select(*[f.name if f.name in whole.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields], *[c for c in ("source_file", "source_path") if c in whole.columns])


def _sourced(df: DataFrame, source: bool, exclude: str | None) -> DataFrame:
    return with_source(df, exclude) if source or exclude else df


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts by column name; where inferred types differ, numbers become doubles and all else text."""
    kinds: dict[str, set] = {}
    for part in parts:
        for field in part.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType)
    unlike = {n: "double" if all(isinstance(k, T.NumericType) for k in found) else "string" for n, found in kinds.items() if len(found) > 1}
    same = [p.select(*[F.col(f"`{c}`").cast(unlike[c]).alias(c) if c in unlike else F.col(f"`{c}`") for c in p.columns]) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), same)


#: Schemes of paths whose files a task can open by itself, and what its library calls them. Others are scanned.
OPENED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}
#: Bytes that are read of a file at a time until it has a line that is not blank.
PROBE = 1 << 16


def first_lines(spark: SparkSession, path: str | Sequence[str], *, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(file_path, line): each text file with its first line that is not blank; Parquet and blank files have no row.

    Files are listed without their contents, dealt out to tasks, and read up to that line only; what a suffix says is
    compressed is unpacked. Where tasks cannot open the paths, all text is scanned instead, with the same rows.
    """
    listed = _reader(spark, pattern, recursive).format("binaryFile").load(path).select("path")
    listed = listed.filter(~F.lower("path").endswith(".parquet"))
    schemes = {p.split(":", 1)[0] for p in ([path] if isinstance(path, str) else path) if re.match(r"[a-z][a-z0-9+.-]+:", p)}
    schemes = schemes or {spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").split(":", 1)[0]}
    if not schemes <= OPENED.keys():
        return _scanned_first_lines(spark, path, pattern, recursive)
    names, size = OPENED, PROBE

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            files, lines = [], []
            for file in batch.column("path").to_pylist():
                scheme, rest = file.split(":", 1)
                if scheme == "file":
                    system, at = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    system, at = fs.FileSystem.from_uri(f"{names[scheme]}:{quote(rest)}")
                text, line = b"", None
                with system.open_input_stream(at, compression="detect") as stream:
                    while line is None:
                        block = stream.read(size)
                        # Only whole lines count, until the file ends.
                        *whole, text = (text + block).splitlines(keepends=True) or [b""]
                        if not block or text.endswith(b"\n"):
                            whole, text = [*whole, text], b""
                        line = next((w for w in whole if w.strip(b" \r\n")), None)
                        if not block:
                            break
                if line is not None:
                    files.append(file)
                    lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace").removeprefix("\ufeff"))
            yield pa.RecordBatch.from_pydict({"file_path": pa.array(files, pa.string()), "line": pa.array(lines, pa.string())})

    return listed.mapInArrow(probe, "file_path string, line string")


def _scanned_first_lines(spark: SparkSession, path: str | Sequence[str], pattern: str, recursive: bool) -> DataFrame:
    """The rows of ``first_lines`` from a scan of all text."""
    lines = _reader(spark, pattern, recursive).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("number"))
    place = F.struct("file_block_start", "number")
    first = lines.filter((F.trim("value") != "") & ~F.lower("file_path").endswith(".parquet")).groupBy("file_path").agg(F.min_by("value", place).alias("line"))
    # Paths in metadata are encoded as in a URL.
    return first.select(F.url_decode(F.replace("file_path", F.lit("+"), F.lit("%2B"))).alias("file_path"), F.regexp_replace("line", "^\ufeff", "").alias("line"))


def _by_kind(files: DataFrame) -> dict[str, list[str]]:
    """The distinct ``kind`` of files, each with its files; of one kind alone the files are not listed."""
    kinds = sorted(r["kind"] for r in files.select("kind").distinct().collect())
    found: dict[str, list[str]] = {kind: [] for kind in kinds}
    if len(kinds) > 1:
        for row in files.orderBy("file_path").toLocalIterator():
            found[row["kind"]].append(row["file_path"])
    return found


def _kind_of(line: Column) -> Column:
    """``keyvalue`` or ``csv``, by the first line of a file."""
    keyvalue = line.contains(";") & line.contains(":") & ~F.substring_index(line, ";", 1).contains(",")
    return F.when(keyvalue, "keyvalue").otherwise("csv")


def sniff_formats(spark: SparkSession, path: str, *, pattern: str = "*", recursive: bool = False) -> dict[str, list[str]]:
    """Files by format: ``parquet`` by suffix, others ``keyvalue`` or ``csv`` by their own first line.

    A folder of one format alone gives that format and no names of files.
    """
    listed = _reader(spark, pattern, recursive).format("binaryFile").load(path).select(F.col("path").alias("file_path"))
    parquet = listed.filter(F.lower("file_path").endswith(".parquet")).withColumn("kind", F.lit("parquet"))
    texts = first_lines(spark, path, pattern=pattern, recursive=recursive).select("file_path", _kind_of(F.col("line")).alias("kind"))
    return _by_kind(staged(parquet.unionByName(texts)))


def identify(
    df: DataFrame, *, substitutions: Sequence[Mapping[str, str]] = (), device_id_pattern: str | None = None, source: str = "source_file"
) -> DataFrame:
    """Add ``experience``, ``device_id`` and ``day`` read from the file name, where they are not columns yet."""
    stem = naming.substitute(naming.stem(F.col(source)), substitutions)
    found = {
        "experience": naming.experience_of(stem),
        "device_id": naming.device_of(stem, device_id_pattern),
        "day": naming.day_of(stem),
    }
    return df.withColumns({name: column for name, column in found.items() if name not in df.columns})


def with_domain(df: DataFrame, path: str = "source_path") -> DataFrame:
    """Add ``domain`` from the nearest ``domain=`` folder, where it is not a partition column already."""
    return df if "domain" in df.columns else df.withColumn("domain", naming.partition_value(F.col(path), "domain"))


def read_raw_long(
    spark: SparkSession,
    path: str,
    *,
    pattern: str = "*.csv",
    recursive: bool = False,
    exclude: str | None = None,
    time_column: str = "Time",
    format: str = "auto",
    exclude_columns: Sequence[str] = (),
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    zone: str = "convert",
) -> DataFrame:
    """Raw files of any of the three formats, also mixed, as ``Time, device_id, sensor, value, day, source_file``."""
    options = {"pattern": pattern, "recursive": recursive, "exclude": exclude}
    kinds = {format: path} if format != "auto" else sniff_formats(spark, path, pattern=pattern, recursive=recursive) or {"csv": path}
    if len(kinds) > 1:
        options = {"pattern": "*", "recursive": False, "exclude": exclude}
    else:
        kinds = dict.fromkeys(kinds, path)
    parts = []
    for kind, where in kinds.items():
        if kind == "keyvalue":
            parts.append(raw_lines_to_long(read_text(spark, where, **options), zone, exclude_columns))
        elif kind == "parquet":
            parts.append(_wide_to_long(read_parquet(spark, where, **options), time_column, exclude_columns, zone))
        else:
            parts.append(_wide_to_long(read_csv(spark, where, **options), time_column, exclude_columns, zone))
    return _ranged(reduce(DataFrame.unionByName, parts), start, end)


def _wide_to_long(wide: DataFrame, time_column: str, exclude_columns: Sequence[str], zone: str) -> DataFrame:
    names = ["source_file", "source_path"]
    time = resolve_time_column([c for c in wide.columns if c not in names], time_column)
    wide = identify(wide)
    # Raw times are kept at whole seconds, whatever the format.
    whole = F.date_trunc("second", F.col(time).cast("timestamp")).cast("timestamp_ntz")
    text = isinstance(wide.schema[time].dataType, T.StringType)
    wide = wide.withColumn(time, parse_time(F.col(time), zone) if text else whole)
    identity = wide.withColumn("device_id", F.coalesce("device_id", F.lit("")))
    # The identity columns ride along in the device column's struct, so the melt stays one expand.
    packed = identity.withColumn("device_id", F.struct("device_id", "day", "source_file"))
    packed = packed.drop("day", "experience", *names)
    long = to_raw_long(packed, time_column=time, exclude_columns=exclude_columns)
    return long.select("Time", "device_id.device_id", "sensor", "value", "device_id.day", "device_id.source_file")


def raw_lines_to_long(lines: DataFrame, zone: str = "convert", exclude_columns: Sequence[str] = ()) -> DataFrame:
    """Raw text lines with ``source_file``, batch or stream, to ``Time, device_id, sensor, value, day, source_file``."""
    parsed = identify(parse_lines_lenient(lines, drop_empty=False))
    named = parsed.select(
        parse_time(F.col("time_text"), zone).alias("Time"),
        F.coalesce("device_id", F.lit("")).alias("device_id"),
        "readings",
        "day",
        "source_file",
    )
    long = readings_to_long(named, keep=["device_id", "day", "source_file"])
    long = long.select("Time", "device_id", "sensor", "value", "day", "source_file")
    return long.filter(~F.col("sensor").isin(list(exclude_columns))) if exclude_columns else long


def _ranged(df: DataFrame, start, end) -> DataFrame:
    return filter_range(df, start, end, "Time") if parse_bound(start) or parse_bound(end, end=True) else df
