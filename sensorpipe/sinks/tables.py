"""Partitioned tables: write policies, column names, value types."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.functions.times import parse_bound, time_literal
from sensorpipe.operators.skew import ROWS_PER_TASK, attach
from sensorpipe.session import shared_dir, staged
from sensorpipe.sinks.publish import publish, recover

#: Files that a task writes to at a time; where it meets more partitions, it sorts the rows of the others.
OPEN_FILES = 8
POLICIES = ("append", "replace", "replace_all")


def write_dataset(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    clear: bool = False,
    compression: str = "snappy",
    row_group_bytes: int | None = None,
) -> None:
    """Parquet, partitioned; ``clear`` drops all earlier output first, otherwise rows are added.

    Rows are rebalanced by partition before the write: few files per folder, and a large folder is split over tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite" if clear else "append").option("compression", compression)
    # Dropping all output is a static overwrite, whatever the session's default.
    writer = writer.option("partitionOverwriteMode", "static")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], compression: str = "snappy", together: bool = False) -> None:
    """Replace just the partitions that occur in ``df``; ``together`` says that it has been rebalanced by them."""
    rows = df if together else df.hint("rebalance", *partition_by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    held = conf.get(name)
    try:
        # Rebalanced rows of a task belong to few partitions: that many files may be open, rather than all rows be sorted.
        conf.set(name, max(int(held), OPEN_FILES))
        writer.partitionBy(*partition_by).parquet(path)
    finally:
        conf.set(name, held)


def map_columns(df: DataFrame, names: Mapping[str, str] | None) -> DataFrame:
    """Logical to physical column names."""
    return df.withColumnsRenamed({k: v for k, v in (names or {}).items() if k in df.columns})


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider(held: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds the numbers of both without loss of their fractions; other types stay as the table has them.

    Raises where whole digits and fractions of both do not fit into one decimal.
    """
    if held == new or not isinstance(held, T.NumericType) or not isinstance(new, T.NumericType):
        return held
    if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (held, new)):
        return T.DoubleType()
    if type(held) in _WHOLE and type(new) in _WHOLE:
        return held if _WHOLE[type(held)] >= _WHOLE[type(new)] else new
    parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (held, new)]
    digits, scale = max(d for d, _ in parts), max(s for _, s in parts)
    if digits + scale > 38:
        raise ValueError(f"no number type holds both {held.simpleString()} and {new.simpleString()}")
    return T.DecimalType(digits + scale, scale)


def refuse_lost_digits(df: DataFrame, target: T.StructType) -> None:
    """Raise if a number of ``df`` has digits that the double which ``target`` wants for it does not hold. One scan."""
    wanted = {f.name.lower(): f.dataType for f in target.fields}
    lost = []
    for f in df.schema.fields:
        exact = isinstance(f.dataType, T.DecimalType) or type(f.dataType) in (T.LongType,)
        if exact and isinstance(wanted.get(f.name.lower()), T.DoubleType):
            kind = f.dataType if isinstance(f.dataType, T.DecimalType) else T.DecimalType(20, 0)
            same = F.col(f.name).cast(kind).eqNullSafe(F.col(f.name).cast("double").try_cast(kind))
            lost.append(F.coalesce(F.bool_or(~same), F.lit(False)).alias(f.name))
    found = [name for name, is_lost in df.agg(*lost).first().asDict().items() if is_lost] if lost else []
    if found:
        raise ValueError(f"a double does not hold all digits of {', '.join(found)}; cast one side first")


def widened(existing: T.StructType, new: T.StructType) -> T.StructType:
    """The table's columns, with the type that also holds what the new rows bring."""
    kinds = {f.name.lower(): f.dataType for f in new.fields}
    return T.StructType([T.StructField(f.name, wider(f.dataType, kinds.get(f.name.lower(), f.dataType))) for f in existing.fields])


def align_columns(df: DataFrame, existing: T.StructType) -> DataFrame:
    """Name and order columns as the table does, ignoring case; add its missing ones as null, keep new ones last.

    Numbers keep a wider type than the table's, so no fraction is lost.
    """
    alike = {c.lower(): c for c in df.columns}
    known = [
        (F.col(alike[f.name.lower()]) if f.name.lower() in alike else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in widened(existing, df.schema).fields
    ]
    taken = {f.name.lower() for f in existing.fields}
    return df.select(*known, *[c for c in df.columns if c.lower() not in taken])


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def evolve(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Existing and new rows under the union of their columns; a number column takes the wider type of the two."""
    held = _cast(existing, widened(existing.schema, new.schema))
    return held.unionByName(align_columns(new, existing.schema), allowMissingColumns=True)


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    return evolve(existing, new)


def replace_range(
    existing: DataFrame,
    new: DataFrame,
    *,
    ts: str = "ts",
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    scope: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Existing rows outside the closed range, plus the new rows. A missing bound is the batch's first or last time.

    All devices and domains are replaced; with ``scope`` only those that occur in the batch, each over its own span
    where no bound is given.
    """
    return evolve(rows_outside(existing, new, ts, start, end, scope, rows_per_task), new)


def rows_outside(existing, new, ts, start, end, scope=(), rows_per_task=ROWS_PER_TASK) -> DataFrame:
    ltz = isinstance(existing.schema[ts].dataType, T.TimestampType)
    lo, hi = parse_bound(start), parse_bound(end, end=True)
    low = F.min(ts) if lo is None else F.lit(time_literal(lo, ltz))
    high = F.max(ts) if hi is None else F.lit(time_literal(hi, ltz))
    if scope:
        spans = new.groupBy(*scope).agg(low.alias("_low"), high.alias("_high"))
        rows = attach(existing, spans, scope, ["_low", "_high"], rows_per_task=rows_per_task)
        inside = F.col(ts).between(F.col("_low"), F.col("_high"))
        return rows.filter(~F.coalesce(inside, F.lit(False))).drop("_low", "_high")
    # Both bounds in one scalar, computed when the query runs.
    span = new.agg(F.struct(low.alias("low"), high.alias("high")).alias("span")).scalar()
    inside = F.col(ts).between(span["low"], span["high"])
    # An empty batch has no bounds and deletes nothing; rows without a time are in no range.
    return existing.filter(~F.coalesce(inside, F.lit(False)))


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath) and any(s.getPath().getName()[0] not in "_." for s in fs.listStatus(jpath))


def _delete(spark: SparkSession, path: str) -> None:
    jpath, fs = _path(spark, path)
    fs.delete(jpath, True)


def write_table(
    df: DataFrame,
    path: str,
    *,
    policy: str = "replace",
    ts: str = "ts",
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    scope: Sequence[str] = (),
    autocreate: bool = True,
    destroy: bool = False,
    compression: str = "snappy",
) -> None:
    """Publish rows to a Parquet table partitioned by ``day`` of ``ts``.

    ``replace`` rewrites only the days it touches: the days of the batch and those that meet the range. New content is
    written beside the old and then swapped in; a swap that failed is finished or undone by the next call. A batch
    without rows changes nothing, whatever the range. Numbers that would lose digits in the table's type raise.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    spark = df.sparkSession
    recover(spark, path)
    rows = df.withColumn("day", F.to_date(ts))
    exists = table_exists(spark, path)
    if not exists and not (autocreate or destroy):
        raise ValueError(f"there is no table at {path}")
    if exists and policy == "append" and not destroy:
        table = _fit_table(spark, path, rows, compression)
        write_dataset(align_columns(rows, table.schema), path, partition_by=["day"], compression=compression)
        return
    # The batch is computed once; it may be read from the table itself.
    batch_path = shared_dir(spark, "batch")
    batch = staged(rows, compression, batch_path)
    if exists and not destroy and batch.isEmpty():
        pass
    elif destroy or not exists or policy == "replace_all":
        publish(batch, path, ["day"], whole=True, compression=compression)
    else:
        _fit_table(spark, path, batch, compression)
        _replace_days(batch, path, ts, start, end, scope, compression)
    _delete(spark, batch_path)


def _fit_table(spark: SparkSession, path: str, new: DataFrame, compression: str) -> DataFrame:
    """The table; it is first written anew if the new rows need a wider number type, since its files share one."""
    table = spark.read.option("mergeSchema", "true").parquet(path)
    target = widened(table.schema, new.schema)
    refuse_lost_digits(new, target)
    if all(a.dataType == b.dataType for a, b in zip(table.schema.fields, target.fields)):
        return table
    refuse_lost_digits(table, target)
    publish(_cast(table, target), path, ["day"], whole=True, compression=compression)
    return spark.read.option("mergeSchema", "true").parquet(path)


def _replace_days(batch, path, ts, start, end, scope, compression) -> None:
    """Write the touched days anew; those of them that have no rows left go."""
    spark = batch.sparkSession
    span = batch.agg(F.min(ts), F.max(ts)).first()
    lo, hi = parse_bound(start) or span[0], parse_bound(end, end=True) or span[1]
    table = spark.read.option("mergeSchema", "true").parquet(path)
    # A batch of rows without time spans no range.
    in_range = F.coalesce(F.col("day").between(F.lit(lo.date()), F.lit(hi.date())), F.lit(False)) if lo and hi else F.lit(False)
    touched = table.filter(in_range)
    # The calendar bounds the number of distinct days; rows without time share the null day.
    batch_days = F.broadcast(batch.select(F.col("day").alias("_day")).distinct())
    other_days = table.filter(~in_range).join(batch_days, F.col("day").eqNullSafe(F.col("_day")), "left_semi")
    kept = rows_outside(touched.unionByName(other_days), batch, ts, start, end, scope)
    days = [f"day={r[0]}" for r in touched.select("day").distinct().collect()]
    publish(evolve(kept, batch), path, ["day"], among=days, compression=compression)


def value_type_of(value: Column) -> Column:
    """Aggregate: ``int`` when all values are whole within 1e-9, else ``numeric``; also ``numeric`` without values."""
    off = F.max(F.abs(value - F.signum(value) * F.floor(F.abs(value))))
    return F.when(off < 1e-9, "int").otherwise("numeric")


def infer_value_type(df: DataFrame, by: Sequence[str] = (), value: str = "value") -> DataFrame:
    """``value_type`` of the frame, or per key."""
    return df.groupBy(*by).agg(value_type_of(F.col(value).cast("double")).alias("value_type"))


def cast_value(
    df: DataFrame, value_type: str | None = None, precision: int = 18, scale: int = 6, value: str = "value"
) -> DataFrame:
    """Cast the value for the sink: whole number or decimal; without a configured type it is inferred first."""
    if value_type is None:
        value_type = infer_value_type(df, value=value).first()[0]
    kind = value_type.strip().lower()
    if kind not in ("int", "integer", "numeric"):
        raise ValueError(f"value_type must be 'int' or 'numeric', not {value_type!r}")
    if kind == "numeric":
        return df.withColumn(value, F.col(value).try_cast(T.DecimalType(precision, scale)))
    return df.withColumn(value, F.round(F.col(value).cast("double")).try_cast("bigint"))


def jdbc_options(parameters: Mapping, table: str, password_env: str = "POSTGRES_PASSWORD", batch_rows: int = 10_000) -> dict[str, str]:
    """Options for ``df.write.format("jdbc")``. The password comes from the environment only."""
    host, port = parameters.get("host", "localhost"), int(parameters.get("port", 5432))
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{parameters['dbname']}",
        "dbtable": table,
        "user": parameters["user"],
        "batchsize": str(batch_rows),
        "driver": "org.postgresql.Driver",
    }
    password = os.environ.get(password_env)
    return {**options, "password": password} if password else options
