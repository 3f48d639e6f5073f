"""Text lines ``time;key:value;key:value;...``.

A line is parsed once into a map, and columns are projected from the map by configured names, so all files have one
schema whatever keys they hold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorpipe.functions.times import format_time, parse_time

_TYPES = {"int": "bigint", "long": "bigint", "float": "double", "double": "double", "string": "string"}
_BLANKS = " \t\r\n"
# One part of a line: a key, a colon and a value that may hold more colons.
_PAIR = r";([^;:]*):([^;]*)"
_SPACED_PAIR = r";\s*([^;:]*?)\s*:\s*([^;]*?)\s*(?=;|$)"


# The whole of a decimal number, or infinity; forms that only some languages read (``12d``, ``0x1p3``) are none.
_NUMBER = r"^\s*[-+]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"


def _number(text: Column) -> Column:
    """The text as a double; null where it is no number or NaN. A failed cast costs far more than this test."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _pairs(line: Column, pattern: str) -> list[Column]:
    """The time text, the keys and the values of a line: two scans of the text, no per-part expression."""
    text = F.btrim(line, F.lit(_BLANKS))
    keys, values = (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) for group in (1, 2))
    return [F.substring_index(text, ";", 1).alias("time_text"), keys.alias("_keys"), values.alias("_values")]


def _with_readings(df: DataFrame, keys: Column, values: Column) -> DataFrame:
    """Key and value arrays to one map; of entries with the same key the last is kept."""
    others = [c for c in df.columns if not c.startswith("_")]
    # Separate projections, so that neither arrays nor reversed arrays are computed once per use.
    pairs = df.select(*others, keys.alias("_keys"), values.alias("_values"))
    turned = pairs.select("*", F.reverse("_keys").alias("_last_keys"), F.reverse("_values").alias("_last_values"))
    unique = F.array_distinct("_last_keys")
    last = F.transform(
        unique, lambda k: F.element_at(F.col("_last_values"), F.array_position(F.col("_last_keys"), k).cast("int"))
    )
    plain = F.map_from_arrays("_keys", "_values")
    readings = F.when(F.size(unique) == F.size("_keys"), plain).otherwise(F.map_from_arrays(unique, last))
    return turned.select(*others, readings.alias("readings"))


def parse_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Replace the line by ``time_text`` and ``readings`` (map of text to text); blank lines are dropped.

    A part is split at its first colon; parts without one are ignored.
    """
    others = [c for c in df.columns if c != line]
    kept = df.filter(F.btrim(F.col(line), F.lit(_BLANKS)) != "")
    return _with_readings(kept.select(*others, *_pairs(F.col(line), _PAIR)), F.col("_keys"), F.col("_values"))


def parse_lines_lenient(df: DataFrame, line: str = "value", drop_empty: bool = True) -> DataFrame:
    """As ``parse_lines``, with keys and values stripped and all values numbers.

    Values that are no number are ignored; lines without a time or, unless told otherwise, without any valid pair are
    dropped.
    """
    others = [c for c in df.columns if c != line]
    scanned = df.select(*others, *_pairs(F.col(line), _SPACED_PAIR))
    numbers = F.transform("_values", _number)
    zipped = F.arrays_zip(F.col("_keys").alias("k"), numbers.alias("v"))
    valid = F.filter(zipped, lambda e: (e["k"] != "") & e["v"].isNotNull())
    time = F.btrim("time_text", F.lit(_BLANKS))
    out = scanned.select(*others, time.alias("time_text"), valid.alias("_valid"))
    out = out.filter(F.col("time_text") != "")
    if drop_empty:
        out = out.filter(F.size("_valid") > 0)
    return _with_readings(out, F.col("_valid.k"), F.col("_valid.v"))


def discover_metrics(df: DataFrame) -> DataFrame:
    """The keys that occur, how often, and the narrowest type that holds all their values."""
    pairs = df.select(F.explode_outer("readings").alias("metric", "text")).filter(F.col("metric").isNotNull())
    pairs = pairs.withColumn("text", F.col("text").cast("string"))
    is_nan = F.lower(F.trim("text")) == "nan"
    whole = F.bool_and(is_nan | (~F.contains("text", F.lit(".")) & F.col("text").try_cast("bigint").isNotNull()))
    number = F.bool_and(is_nan | _number(F.col("text")).isNotNull())
    kind = F.when(whole, "long").when(number, "double").otherwise("string")
    return pairs.groupBy("metric").agg(F.count(F.lit(1)).alias("readings"), kind.alias("type"))


def reading(metric: str, kind: str, readings: str = "readings") -> Column:
    """One typed value out of the map; absent, not castable and NaN are null."""
    text = F.try_element_at(F.col(readings), F.lit(metric))
    return _number(text) if _TYPES[kind] == "double" else text.try_cast(_TYPES[kind])


def project_metrics(df: DataFrame, metrics: Mapping[str, str] | Sequence[str], *, keep: Sequence[str] | None = None) -> DataFrame:
    """The configured metrics as columns: ``{name: int | float | string}``, or a list of names read as numbers."""
    kinds = metrics if isinstance(metrics, Mapping) else dict.fromkeys(metrics, "double")
    others = [c for c in df.columns if c != "readings"] if keep is None else list(keep)
    return df.select(*others, *[reading(m, k).alias(m) for m, k in kinds.items()])


def with_time(df: DataFrame, name: str = "Time", zone: str = "convert", text: str = "time_text") -> DataFrame:
    return df.withColumn(name, parse_time(F.col(text), zone))


def rejects(df: DataFrame, name: str = "Time") -> DataFrame:
    """Parsed lines whose time cannot be read."""
    return df.filter(F.col(name).isNull())


def rejected_lines(df: DataFrame, line: str = "value", zone: str = "convert") -> DataFrame:
    """The lines, blank ones left out, whose leading time cannot be read, with their other columns."""
    text = F.btrim(F.col(line), F.lit(_BLANKS))
    time = parse_time(F.substring_index(text, ";", 1), zone)
    return df.filter((text != "") & time.isNull())


def render_lines(df: DataFrame, ts: str, metrics: Sequence[str], line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The inverse of parsing: one ``time;key:value;...`` line per row, nulls left out."""
    pairs = [F.when(F.col(m).isNotNull(), F.concat(F.lit(f"{m}:"), F.col(m).cast("string"))) for m in metrics]
    return df.select(*keep, F.concat_ws(";", format_time(F.col(ts)), *pairs).alias(line))


# Time forms accepted when raw lines are rewritten.
_REWRITABLE = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6}Z|Z)?$"


def rewrite_line_times(df: DataFrame, line: str = "value", on_error: str = "fail") -> DataFrame:
    """Cut fractions of a second from the time that leads each line; lines without ``;`` stay as they are.

    An unreadable time fails the job, or with ``on_error="keep"`` leaves its line unchanged.
    """
    if on_error not in ("fail", "keep"):
        raise ValueError(f"on_error must be 'fail' or 'keep', not {on_error!r}")
    text = F.rtrim(F.col(line), F.lit("\r\n"))
    time = F.substring_index(text, ";", 1)
    iso = F.when(time.rlike(_REWRITABLE), format_time(parse_time(time)))
    rest = F.substring(text, F.length(time) + 1, F.length(text))
    bad = text if on_error == "keep" else F.raise_error(F.concat(F.lit("unknown time format: "), time)).cast("string")
    fixed = F.when(~F.contains(text, F.lit(";")), text).when(iso.isNotNull(), F.concat(iso, rest)).otherwise(bad)
    return df.withColumn(line, fixed)
