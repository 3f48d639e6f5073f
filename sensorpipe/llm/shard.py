"""A uniform shuffle into shards of exact size, by a hypergeometric matrix of block-to-shard counts.

DataFrame functions only: no Python code runs per row.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.session import staged

SHARDS = 40
#: Rows in a block on average, until there are MOST_BLOCKS; from then on blocks grow with the number of rows.
BLOCK_ROWS = 400
MOST_BLOCKS = 8192
#: Repeated rows that one row of counts is unrolled into at a time.
COPIES = 10_000


def hypergeometric(draws: int, good: int, bad: int, rng: random.Random) -> int:
    """How many of ``draws`` items taken from good + bad are good: inversion that starts at the mode."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    peak = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = right = mode
    below = above = peak
    u = rng.random() - peak
    while u >= 0 and (left > low or right < high):
        if right < high:
            above *= (good - right) * (draws - right) / ((right + 1) * (bad - draws + right + 1))
            right += 1
            u -= above
            if u < 0:
                return right
        if left > low:
            below *= left * (bad - draws + left) / ((good - left + 1) * (draws - left + 1))
            left -= 1
            u -= below
            if u < 0:
                return left
    return mode


def _row(count: int, free: list[int], rng: random.Random) -> list[int]:
    """How many of a block's rows go to each shard, given the free places: a multivariate hypergeometric draw."""
    rest, taken = sum(free), []
    for places in free:
        n = hypergeometric(count, places, rest - places, rng) if count else 0
        taken.append(n)
        count, rest = count - n, rest - places
    return taken


def matrix(spark: SparkSession, blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """(block, ends): running totals of the counts with which a block's rows fill the shards.

    The driver sees the number of rows of each block and nothing else: at most MOST_BLOCKS numbers, which give a matrix
    of at most MOST_BLOCKS times the number of shards.
    """
    counts = [(r["block"], r["n"]) for r in blocks.orderBy("block").collect()]
    total, rng = sum(n for _, n in counts), random.Random(seed)
    free = [total // shards + (s < total % shards) for s in range(shards)]
    rows = []
    for block, n in counts:
        taken = _row(n, free, rng)
        free = [f - t for f, t in zip(free, taken)]
        ends, sofar = [], 0
        for t in taken:
            sofar += t
            ends.append(sofar)
        rows.append((block, ends))
    return spark.createDataFrame(rows, "block int, ends array<int>")


def _mixed(seed: str, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _unrolled(counted: DataFrame, own: list[str]) -> DataFrame:
    """Rows as often as ``n`` says, repeated ones told apart by ``salt`` from 0; many copies are dealt over tasks."""
    few = counted.filter(F.col("n") <= COPIES).select(*own, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("salt"))
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))
    many = counted.filter(F.col("n") > COPIES).select(*own, "n", F.explode(pieces).alias("piece")).repartition(*own, "piece")
    first = F.col("piece") * COPIES
    return few.unionByName(many.select(*own, F.explode(F.sequence(first, F.least(F.col("n"), first + COPIES) - 1)).alias("salt")))


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 7, text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row; shard sizes differ by one row at most.

    Rows stand in blocks by a hash. The matrix says exactly how many rows of each block each shard gets; rows are
    permuted inside their block and dealt out by it, exchanged, and permuted again inside the shard, where ``slot``
    numbers them from 0. All choices are hashes of row values, of the number of a row among its equals, and of the seed:
    a task or a job that runs again chooses alike, also where files are split in another way.

    ``size`` is the UTF-8 length plus 16, or 16 for null, whose crc32 is that of the empty text. Repeated rows are
    counted and take places of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(value) + 16).cast("long").alias("size"), F.crc32(F.encode(value, "utf-8")).alias("text_crc32"))
    own = rows.columns
    counted = staged(rows.groupBy(*own).agg(F.count(F.lit(1)).alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, min(MOST_BLOCKS, math.ceil(total / BLOCK_ROWS)))
    dealt = _unrolled(counted, own)
    placed = staged(dealt.withColumn("block", F.pmod(_mixed(f"block{seed}", *own, "salt"), F.lit(blocks)).cast("int")))
    ends = matrix(spark, placed.groupBy("block").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    order = Window.partitionBy("block").orderBy(_mixed(f"deal{seed}", *own, "salt"), *own, "salt")
    inside = placed.withColumn("place", F.row_number().over(order))
    shard = F.size(F.filter("ends", lambda end: end < F.col("place")))
    exchanged = inside.join(F.broadcast(ends), "block").select(*own, "salt", shard.cast("int").alias("shard"))
    stretches = max(1, math.ceil(blocks / shards))
    again = _mixed(f"again{seed}", *own, "salt")
    exchanged = staged(exchanged.withColumn("stretch", F.pmod(again, F.lit(stretches)).cast("int")))
    lengths = exchanged.groupBy("shard", "stretch").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    starts = lengths.select("shard", "stretch", F.coalesce(before, F.lit(0)).alias("start"))
    at = F.row_number().over(Window.partitionBy("shard", "stretch").orderBy(F.xxhash64(again), *own, "salt")) - 1
    numbered = exchanged.withColumn("at", at).join(starts, ["shard", "stretch"])
    return numbered.select(*own, "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"))
