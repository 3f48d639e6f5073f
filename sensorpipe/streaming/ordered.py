"""Ordered steps on what is new: cleaning and resampling that redo only the days and series a late or new file touches.

Rows seen so far are kept in folders by day and bucket of series. Beside them stands one state row per series and day:
its first time, its last row, its unit. A batch is merged in four steps, each of which can run again after a failure:
its rows replace those of the same batch number; the partitions it affects are found from the states before and after and
written down as a plan; the states of touched partitions are computed anew; the results of affected partitions are
computed from their rows, plus the last row before them, and replaced.

What one run reads: rows of affected partitions and states of their buckets. No other row is opened.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sensorpipe.functions.times import Duration, micros, plus_micros
from sensorpipe.operators.clean import clean
from sensorpipe.operators.resample import aligned_in_places, series_bounds
from sensorpipe.operators.skew import ROWS_PER_TASK, content_hash, lookup
from sensorpipe.session import checkpointed, drop_staged, staged
from sensorpipe.sinks.tables import overwrite_partitions, table_exists

DAY, BUCKET, BATCH = "part_day", "part_bucket", "part_batch"
#: Rows without a time stand before all others.
NO_DAY = date(1000, 1, 1)
#: Buckets of series; choose so many that a day of a bucket is a good file or more.
BUCKETS = 16
_DAY_MICROS = 86_400_000_000
_KINDS = {DAY: "date", BUCKET: "int", BATCH: "bigint"}


def _partitions(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    return T.StructType([*[f for f in schema.fields if f.name not in _KINDS], *[T.StructField(n, T._parse_datatype_string(_KINDS[n])) for n in names]])


def _places(spark: SparkSession, pairs: Sequence) -> DataFrame:
    """Days and buckets as a frame to broadcast: the calendar times the number of buckets bounds them."""
    return F.broadcast(spark.createDataFrame([(p[0], p[1]) for p in pairs], f"{DAY} date, {BUCKET} int"))


class _Store:
    """The folders of one incremental job."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], ts: str, buckets: int):
        self.spark, self.base, self.keys, self.ts, self.buckets = spark, base.rstrip("/"), list(keys), ts, buckets
        self.rows, self.states, self.plans = (f"{self.base}/{n}" for n in ("rows", "states", "plans"))

    def placed(self, df: DataFrame) -> DataFrame:
        return self.bucketed(df.withColumn(DAY, F.coalesce(F.to_date(self.ts), F.lit(NO_DAY))))

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def held(self, schema: T.StructType, pairs: Sequence) -> DataFrame:
        """Rows of some days and buckets: no other folder is listed or opened."""
        whole = _partitions(schema, [DAY, BUCKET, BATCH])
        if not pairs:
            return self.spark.createDataFrame([], whole)
        paths = [f"{self.rows}/{DAY}={p[0]}/{BUCKET}={p[1]}" for p in pairs]
        return self.spark.read.schema(whole).option("basePath", self.rows).parquet(*paths)

    def state(self, schema: T.StructType, buckets: Sequence[int]) -> DataFrame:
        """States of some buckets."""
        whole = _partitions(schema, [BUCKET, DAY])
        paths = [p for p in (f"{self.states}/{BUCKET}={b}" for b in sorted(set(buckets))) if table_exists(self.spark, p)]
        return self.spark.read.schema(whole).option("basePath", self.states).parquet(*paths) if paths else self.spark.createDataFrame([], whole)


def _merge(
    batch: DataFrame,
    number: int,
    store: _Store,
    series: Sequence[str],
    summary: Sequence[Column],
    reach: Callable[[DataFrame], DataFrame],
    compute: Callable[[DataFrame, DataFrame, list], tuple[DataFrame, list]],
    target: str,
    together: bool = False,
) -> None:
    """Bring ``target`` up to date with one batch. ``reach`` and ``compute`` are what differs between steps.

    ``reach(states)`` gives the affected (day, bucket) from the states ``_old`` (before) and ``_new`` (after), most of them
    both, where ``touched`` marks new ones of the batch; ``compute(rows, state, affected)`` the results of these, rebalanced
    if ``together``, and which of them have none.
    """
    spark = store.spark
    new = staged(store.placed(batch))
    touched = [tuple(r) for r in new.select(DAY, BUCKET).distinct().collect()]
    if touched:
        overwrite_partitions(new.withColumn(BATCH, F.lit(number).cast("bigint")), store.rows, [DAY, BUCKET, BATCH])
        fresh = staged(store.held(batch.schema, touched).groupBy(*series, DAY, BUCKET).agg(*summary))
        plan = f"{store.plans}/{number}"
        if not table_exists(spark, f"{plan}/_done"):
            here = _places(spark, touched).withColumn("_here", F.lit(True))
            before = store.state(fresh.schema, [b for _, b in touched]).join(here, [DAY, BUCKET], "left")
            before = before.withColumns({"_old": F.lit(True), "_new": F.col("_here").isNull(), "touched": F.lit(False)}).drop("_here")
            after = fresh.withColumns({"_old": F.lit(False), "_new": F.lit(True), "touched": F.lit(True)})
            found = reach(before.unionByName(after)).select(DAY, BUCKET).distinct()
            found.write.mode("overwrite").parquet(plan)
            spark.range(1).write.mode("overwrite").parquet(f"{plan}/_done")
        affected = [tuple(r) for r in spark.read.schema(f"{DAY} date, {BUCKET} int").parquet(plan).collect()]
        overwrite_partitions(fresh, store.states, [BUCKET, DAY])
        state = store.state(fresh.schema, [b for _, b in affected])
        full = [tuple(r) for r in state.join(_places(spark, affected), [DAY, BUCKET], "left_semi").select(DAY, BUCKET).distinct().collect()]
        out, emptied = compute(store.held(batch.schema, full).drop(BATCH), state, affected)
        overwrite_partitions(out, target, [DAY, BUCKET], "snappy", together)
        for day, bucket in emptied:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{DAY}={day}/{BUCKET}={bucket}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        drop_staged(fresh)
    drop_staged(new)


def result(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a target, without the columns that say where they are kept."""
    return spark.read.parquet(target).drop(DAY, BUCKET)


# --- cleaning --------------------------------------------------------------------------------------------------


def merge_clean(
    batch: DataFrame,
    number: int,
    rules: Mapping[str, Mapping],
    target: str,
    base: str,
    *,
    keys: Sequence[str] = ("device_id",),
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    **options,
) -> None:
    """Add batch ``number`` to cleaned rows in ``target``: the same rows as ``clean`` over everything seen so far.

    A spike check needs the row before. So a touched day of a series affects that day and the next one with rows.
    """
    store = _Store(batch.sparkSession, base, keys, ts, buckets)
    columns = batch.columns
    order = list(tie) if tie else ["_order"]
    content = content_hash(batch)
    place = F.struct(F.col(ts), *[content if c == "_order" else F.col(c) for c in order])
    summary = [F.max_by(F.struct(*columns), place).alias("last")]
    along = Window.partitionBy(*keys).orderBy(DAY)

    def reach(states: DataFrame) -> DataFrame:
        next_day = states.filter("_new").withColumn("_next", F.lead(DAY).over(along)).filter("touched")
        return next_day.select(F.explode(F.array_compact(F.array(DAY, "_next"))).alias(DAY), BUCKET)

    def compute(rows: DataFrame, state: DataFrame, affected: list) -> tuple[DataFrame, list]:
        before = state.withColumn("_before", F.lag("last").over(along)).filter("_before IS NOT NULL")
        carried = before.join(_places(store.spark, affected), [DAY, BUCKET], "left_semi").select("_before.*", DAY, BUCKET)
        both = rows.withColumn("_carried", F.lit(False)).unionByName(carried.withColumn("_carried", F.lit(True)))
        both = both.withColumn("_order", F.xxhash64(*[f.name for f in batch.schema.fields if not isinstance(f.dataType, T.MapType)]))
        looked_at = options.get("flag_columns") or columns
        done = clean(both, rules, keys=[*keys, DAY], ts=ts, tie=order, **{**options, "flag_columns": looked_at})
        return done.filter(~F.col("_carried")).drop("_carried", "_order"), []

    _merge(batch, number, store, keys, summary, reach, compute, target)


def clean_new(stream: DataFrame, rules: Mapping[str, Mapping], target: str, checkpoint: str, **options) -> None:
    """Clean what is new in a stream, in whatever order it comes; see ``merge_clean``."""
    _run(stream, checkpoint, lambda batch, number: merge_clean(batch, number, rules, target, f"{checkpoint.rstrip('/')}-kept", **options))


# --- resampling ------------------------------------------------------------------------------------------------


def merge_resample(
    batch: DataFrame,
    number: int,
    freq: str | Duration,
    target: str,
    base: str,
    *,
    interpolation: str | None = None,
    by_day: bool = False,
    day_anchor: str = "first",
    keys: Sequence[str] = ("device_id", "domain"),
    ts: str = "ts",
    tie: Sequence[str] | None = None,
    buckets: int = BUCKETS,
    rows_per_task: int = ROWS_PER_TASK,
) -> None:
    """Add batch ``number`` to resampled rows in ``target``: the same rows as ``resample`` over everything seen so far.

    ``by_day`` a touched day affects itself alone. Otherwise a touched day of a series affects the days up to its next
    observation, a later end of the grid the days from the old end on, and an earlier start the whole bucket, since all
    cells move. A unit that changes affects the days of its series. Without ``by_day`` values may be carried forward
    only: ``linear`` and ``nearest`` look ahead without bound. Steps have a fixed length. Rows without a time are in no
    grid.
    """
    step = Duration.of(freq).micros
    if step is None:
        raise ValueError(f"an incremental grid needs a fixed length, not {freq!r}")
    if not by_day and interpolation not in (None, "forward"):
        raise ValueError(f"{interpolation!r} looks ahead: it needs by_day")
    store = _Store(batch.sparkSession, base, keys, ts, buckets)
    keys, series = list(keys), [*keys, "metric"]
    timed = batch.filter(F.col(ts).isNotNull())
    ties = [F.struct(*tie).alias("tie")] if tie else []
    match = F.struct(F.col(ts).alias("obs_ts"), F.col("value").cast("double").alias("value"), "quality_flag").alias("match")
    unit = F.max("unit") if "unit" in batch.columns else F.lit("")
    summary = [F.min(ts).alias("first"), F.max(F.struct(F.col(ts).alias("at"), *ties, match)).alias("last"), F.count(F.lit(1)).alias("n"), unit.alias("unit")]
    of_keys, of_series = Window.partitionBy(*keys), Window.partitionBy(*series)

    def reach(states: DataFrame) -> DataFrame:
        old = lambda c: F.when(F.col("_old"), F.col(c))
        new = lambda c: F.when(F.col("_new"), F.col(c))
        units = ~F.max(old("unit")).over(of_series).eqNullSafe(F.max(new("unit")).over(of_series)) & F.max(old("unit")).over(of_series).isNotNull()
        # One exchange by the keys serves all windows.
        both = states.withColumn("at", F.col("last.at")).drop("last", "n")
        both = both.repartition(*keys) if keys else both
        if by_day:
            return both.withColumn("_unit", units).filter((F.col("touched") | F.col("_unit")) & F.col("_new"))
        found = both.withColumns({
            "_lo0": F.min(old("first")).over(of_keys), "_lo": F.min(new("first")).over(of_keys),
            "_hi0": F.max(old("at")).over(of_keys), "_hi": F.max(new("at")).over(of_keys),
            "_unit": units, "_next": F.lead(DAY).over(Window.partitionBy(*series, "_new").orderBy(DAY)),
        }).filter("_new")
        start, end = F.to_date("_lo"), F.to_date("_hi")
        span = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
        moved = F.col("_unit") | ~F.col("_lo0").eqNullSafe(F.col("_lo"))
        spans = F.array_compact(F.array(
            F.when(moved, span(start, end)),
            F.when(F.col("_hi") > F.col("_hi0"), span(F.to_date("_hi0"), end)),
            F.when(F.col("touched"), span(F.col(DAY), F.coalesce("_next", end))),
        ))
        ranges = found.select(BUCKET, F.explode(spans).alias("s")).distinct()
        return ranges.select(BUCKET, F.explode(F.sequence("s.a", "s.b")).alias(DAY))

    def by_days(rows: DataFrame, state: DataFrame, affected: list) -> tuple[DataFrame, list]:
        units = checkpointed(state.groupBy(*series).agg(F.max("unit").alias("_unit")))
        bounds = lookup(series_bounds(rows, keys, ts, True, day_anchor), units, series, ["_unit"])
        bounds = staged(bounds.withColumn("unit", F.col("_unit")).drop("_unit"))
        observed = rows.withColumns({"value": F.col("value").cast("double"), "_day": F.col(DAY)})
        seen = bounds.agg(F.max("observations")).first()[0]
        return _grid(observed, bounds, lambda found: store.bucketed(found).withColumn(DAY, F.col("_day")), seen), []

    def carried(rows: DataFrame, state: DataFrame, affected: list) -> tuple[DataFrame, list]:
        here = _places(store.spark, affected)
        per_unit = state.groupBy(*series, "unit").agg(F.min("first").alias("_lo"), F.max("last.at").alias("_hi"), F.sum("n").alias("_n"))
        per_unit = per_unit.repartition(*keys) if keys else per_unit
        bounds = per_unit.select(
            *series, F.max("unit").over(of_series).alias("unit"), F.min("_lo").over(of_keys).alias("lo"), F.max("_hi").over(of_keys).alias("hi"),
            F.sum("_n").over(of_series).alias("observations"), F.row_number().over(of_series.orderBy("unit")).alias("_number"),
        ).filter("_number = 1").drop("_number")
        sizes = Observation()
        bounds = staged(bounds.observe(sizes, F.max("observations").alias("seen")))
        # A day whose rows are not read is stood for by its last one: nothing else of it reaches an affected day.
        last = state.join(here, [DAY, BUCKET], "left_anti").select(*series, "last.match.*").withColumnRenamed("obs_ts", ts)
        own = rows.select(*series, ts, F.col("value").cast("double").alias("value"), "quality_flag", *[c for c in tie or () if c not in (ts, "value", "quality_flag")])
        out = _grid(own.unionByName(last, allowMissingColumns=True), bounds, lambda found: _days(found, here), sizes.get.get("seen"))
        emptied = []
        if step > _DAY_MICROS:
            cell = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((micros(F.col("hi")) - micros(F.col("lo"))) / step)))
            cells = bounds.select(*keys, "lo", "hi").distinct().withColumn("_cell", cell).withColumn(ts, plus_micros(F.col("lo"), F.col("_cell") * step))
            full = {tuple(r) for r in store.placed(cells).select(DAY, BUCKET).distinct().collect()}
            emptied = [p for p in affected if p not in full]
        return out, emptied

    def _days(found: DataFrame, here: DataFrame) -> DataFrame:
        """Intervals parted by day, without the days that are not affected."""
        lo = F.col("grid.lo").cast("timestamp_ntz")
        day_of = lambda cell: F.to_date(plus_micros(lo, F.col(cell) * step))
        parted = store.bucketed(found).withColumn(DAY, F.explode(F.sequence(day_of("first"), day_of("last")))).join(here, [DAY, BUCKET], "left_semi")
        ahead = micros(F.col(DAY).cast("timestamp_ntz")) - micros(lo)
        cells = {"first": F.greatest("first", F.ceil(ahead / step)), "last": F.least("last", F.floor((ahead + (_DAY_MICROS - 1)) / step))}
        return parted.withColumns(cells).filter("first <= last")

    def _grid(observed: DataFrame, bounds: DataFrame, place: Callable[[DataFrame], DataFrame], seen: int | None) -> DataFrame:
        return aligned_in_places(
            observed, bounds, step, place, [DAY, BUCKET], series=[*series, "_day"] if by_day else series, ts=ts, tie=tie,
            interpolation=interpolation, by_day=by_day, seen=seen, rows_per_task=rows_per_task,
        )

    _merge(timed, number, store, series, summary, reach, by_days if by_day else carried, target, together=True)


def resample_new(stream: DataFrame, freq: str | Duration, target: str, checkpoint: str, **options) -> None:
    """Resample what is new in a stream, in whatever order it comes; see ``merge_resample``."""
    _run(stream, checkpoint, lambda batch, number: merge_resample(batch, number, freq, target, f"{checkpoint.rstrip('/')}-kept", **options))


def _run(stream: DataFrame, checkpoint: str, merge: Callable[[DataFrame, int], None]) -> None:
    """All that is there, in as many batches as the source makes, then stop."""
    stream.writeStream.foreachBatch(merge).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()
