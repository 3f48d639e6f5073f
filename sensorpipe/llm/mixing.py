"""Mix sources to target weights: repetition rates per source, then whole copies and one random copy per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.llm.spread import attach_small
from sensorpipe.session import drop_staged, staged

WEIGHTS = (5, 2, 1)
#: A source is repeated at most so often.
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 13


def words(text: str | Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A key that is never null; null sorts last, other names by code point."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds ``position``, from 0 in the order of ``key``, without one task for all: offsets of sorted ranges."""
    ranged = staged(sources.repartitionByRange("key").withColumn("part", F.spark_partition_id()))
    local = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("key")))
    parts = ranged.groupBy("part").count()
    later = parts.select(F.col("part").alias("earlier"), F.col("count").alias("rows"))
    offsets = parts.join(F.broadcast(later), F.col("earlier") < F.col("part"), "left").groupBy("part").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("before"))
    return local.join(offsets, "part").withColumn("position", F.col("at") + F.col("before") - 1).drop("part", "at", "before")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to (key, source_size): all sizes are shared by weight, at most ``most`` times a source's own size.

    The excess of capped sources is shared anew by weight among the others until none is above its cap. One round sums
    over the sources and hands three sums to the driver; sources are never collected.
    """
    pattern = F.array(*[F.lit(w) for w in weights])
    weighted = staged(
        _numbered(sources)
        .withColumn("weight", F.element_at(pattern, (F.col("position") % len(weights) + 1).cast("int")))
        .select("key", "source_size", F.col("weight").cast("decimal(38,0)").alias("weight"), (F.col("source_size") * most).cast("decimal(38,0)").alias("cap"))
    )
    total = int(weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    rest, weight, capped = total, None, 0
    while True:
        full = F.lit(False) if weight is None else F.col("weight") * F.lit(rest).cast("decimal(38,0)") > F.col("cap") * F.lit(weight).cast("decimal(38,0)")
        spent, open_weight, now = weighted.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count_if(full)
        ).first()
        if weight is not None and now == capped:
            break
        rest, weight, capped = total - int(spent), int(open_weight), now
        if not weight:
            break
    share = F.col("weight").cast("double") * float(rest) / float(weight or 1)
    full = F.lit(True) if not weight else F.col("weight") * F.lit(rest).cast("decimal(38,0)") > F.col("cap") * F.lit(weight).cast("decimal(38,0)")
    return weighted.select("key", "source_size", F.when(full, F.col("cap").cast("double")).otherwise(share).alias("target"))


def draw(doc_id: str | Column, seed: str = "mix") -> Column:
    """A number in [0, 1) that depends on the doc_id and the seed only."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def _rates(docs: DataFrame, weights: Sequence[int], most: int, text: str) -> DataFrame:
    """(key, source_size, target) of each source."""
    sources = staged(docs.select(_key(F.col("source")).alias("key"), words(text).alias("size")).groupBy("key").agg(F.sum("size").alias("source_size")))
    rates = staged(targets(sources, weights, most))
    drop_staged(sources)
    return rates


def _copies(most: int, seed: str) -> Column:
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return whole + F.when(draw("doc_id", seed) < rate - whole, F.lit(1)).otherwise(F.lit(0))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = "mix", text: str = "text") -> DataFrame:
    """(doc_id, size, key, source_size, target, copies) for every row: how often the mix takes it.

    A source's rate is its target over its size. Each document is taken floor(rate) times, and once more with the
    fraction as chance, drawn from a hash of its doc_id, so reruns agree and repeated rows are taken alike. A null text
    has size 0; null is a source of its own; a source without words has target and rate 0. Other columns are not read.
    """
    rows = staged(docs.select("doc_id", _key(F.col("source")).alias("key"), words(text).alias("size")))
    sources = staged(rows.groupBy("key").agg(F.sum("size").alias("source_size")))
    rates = staged(targets(sources, weights, most))
    drop_staged(sources)
    return attach_small(rows, rates, ["key"], F.struct("doc_id", "size")).withColumn("copies", _copies(most, seed))


def emit(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = "mix", text: str = "text") -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as ``mix`` takes it."""
    rates = _rates(docs, weights, most, text).select("key", F.struct("source_size", "target").alias("_rate"))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), _key(F.col("source")).alias("key"))
    joined = attach_small(keyed, rates, ["key"], F.col("_row.doc_id"))
    counted = joined.select("_row", F.col("_row.doc_id").alias("doc_id"), "_rate.source_size", "_rate.target").withColumn("copies", _copies(most, seed).cast("int"))
    taken = counted.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select("_row.*")
