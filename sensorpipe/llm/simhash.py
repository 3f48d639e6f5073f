"""SimHash near-duplicates: two binary tries are joined with themselves, node pair by node pair."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm import fingerprint
from sensorpipe.llm.graph import components
from sensorpipe.llm.spread import attach
from sensorpipe.llm.ship import ship
from sensorpipe.session import drop_staged, staged

BITS = 64
STEP = 4
#: Leaves of one node times leaves of the other, up to which a node pair is finished inside one task.
PAIR_WORK = 1 << 18


def fingerprints(docs: DataFrame, text: str = "text", number: str | None = None) -> DataFrame:
    """(doc_id, row, fingerprint) of every row; ``row`` is the column ``number``, or counted; a text that is null or has no words has fingerprint 0."""
    ship(docs.sparkSession)
    row = F.col(number) if number else F.monotonically_increasing_id()
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(fingerprint.add_fingerprints("text"), "doc_id long, row long, fingerprint long")


def _budget(depth: int, errors: int) -> int:
    """Bits that may differ in the first ``depth`` bits. Of two halves one differs in at most half of the errors."""
    return errors // 2 if depth <= BITS // 2 else errors


def _masks(step: int, most: int) -> list[int]:
    return [m for m in range(1 << step) if m.bit_count() <= most]


def _nodes(leaves: DataFrame, depth: int) -> DataFrame:
    """Nodes of both tries at a depth, with their number of leaves and the node above."""
    node = F.shiftrightunsigned("leaf", BITS - depth)
    counted = leaves.groupBy("trie", node.alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("above", F.shiftrightunsigned("node", STEP))


def _descend(pairs: DataFrame, nodes: DataFrame, depth: int, errors: int) -> DataFrame:
    """Children of node pairs that stay within the error budget; pairs and nodes are unordered: a <= b."""
    allowed = _budget(depth, errors)
    first = nodes.select("trie", F.col("above").alias("a"), F.col("node").alias("next_a"), F.col("n").alias("n_a"))
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(STEP, allowed)])
    low = F.col("next_a").bitwiseAND((1 << STEP) - 1)
    grown = (
        pairs.join(first, ["trie", "a"])
        .withColumn("mask", F.explode(masks))
        .withColumn("differ", F.col("differ") + F.bit_count("mask"))
        .filter(F.col("differ") <= allowed)
        .withColumn("next_b", F.shiftleft("b", STEP).bitwiseOR(low.bitwiseXOR(F.col("mask"))))
        .filter("a <> b or next_a <= next_b")
    )
    second = nodes.select("trie", F.col("node").alias("next_b"), F.col("n").alias("n_b"))
    return grown.join(second, ["trie", "next_b"]).select("trie", F.col("next_a").alias("a"), F.col("next_b").alias("b"), "differ", "n_a", "n_b")


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of links that already connect what all links (a, b) connect."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = above[x]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            above[max(x, y)] = min(x, y)
            keep.append(i)
    return np.array(keep, np.int64)


def _links(errors: int):
    """For ``mapInPandas``: compares the leaves of node pairs; of the links in a pair of nodes a spanning forest is kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for left, right in zip(batch["of_a"], batch["of_b"]):
                left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
                differ = (left[:, None] ^ right[None, :]).view(np.uint64)
                i, j = np.nonzero(np.bitwise_count(differ) <= errors)
                a, b = left[i], right[j]
                if len(a) > len(left) + len(right):
                    keep = _forest(a, b)
                    a, b = a[keep], b[keep]
                other = a != b
                if other.any():
                    yield pd.DataFrame({"a": a[other], "b": b[other]})

    return run


def _finish(pairs: DataFrame, leaves: DataFrame, depth: int, errors: int) -> DataFrame:
    """Links between the leaves of node pairs; a node in ``pairs`` has at most ``PAIR_WORK`` leaves."""
    node = F.shiftrightunsigned("leaf", BITS - depth)
    wanted = pairs.select("trie", F.explode(F.array("a", "b")).alias("node")).distinct()
    below = leaves.withColumn("node", node).join(wanted, ["trie", "node"], "left_semi").groupBy("trie", "node").agg(F.collect_list("leaf").alias("of"))
    joined = pairs.join(below.select("trie", F.col("node").alias("a"), F.col("of").alias("of_a")), ["trie", "a"])
    joined = joined.join(below.select("trie", F.col("node").alias("b"), F.col("of").alias("of_b")), ["trie", "b"])
    half = BITS // 2
    swap = lambda c: F.shiftleft(c, half).bitwiseOR(F.shiftrightunsigned(c, half))
    links = joined.select("trie", "of_a", "of_b").mapInPandas(_with_trie(errors), "trie int, a long, b long")
    return links.select(*[F.when(F.col("trie") == 0, F.col(c)).otherwise(swap(F.col(c))).alias(c) for c in "ab"])


def _with_trie(errors: int):
    run = _links(errors)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for trie, part in batch.groupby("trie"):
                for out in run(iter([part])):
                    yield out.assign(trie=int(trie))[["trie", "a", "b"]]

    return split


def similar_pairs(values: DataFrame, errors: int = 3) -> DataFrame:
    """Links (a, b) that connect all distinct ``fingerprint`` values which differ in at most ``errors`` bits.

    A pair that differs in e bits differs in at most e // 2 of the first or of the last 32 bits. So the values stand in
    two tries, one with its halves exchanged, and in each the join of the trie with itself allows e // 2 errors in the
    first 32 levels and e below. It goes down STEP levels at a time: a pair of nodes is followed to those pairs of
    children whose accumulated differing bits stay within the budget, and given up otherwise. Pairs with few leaves are
    finished in one task. Only chains of links are written inside a pair of nodes, never all pairs of a dense group.
    """
    ship(values.sparkSession)
    distinct = values.select("fingerprint").distinct()
    half = BITS // 2
    turned = F.shiftleft("fingerprint", half).bitwiseOR(F.shiftrightunsigned("fingerprint", half))
    leaves = staged(distinct.select(F.explode(F.array(*[F.struct(F.lit(t).alias("trie"), c.alias("leaf")) for t, c in ((0, F.col("fingerprint")), (1, turned))])).alias("x")).select("x.*"))
    spark = values.sparkSession
    pairs = spark.range(2).select(F.col("id").cast("int").alias("trie"), *[F.lit(0).cast("long").alias(c) for c in "ab"], F.lit(0).alias("differ"))
    found, work = [], F.col("n_a") * F.col("n_b")
    for depth in range(STEP, BITS + 1, STEP):
        live = staged(_descend(pairs, _nodes(leaves, depth), depth, errors))
        small = work <= PAIR_WORK if depth < BITS else F.lit(True)
        large, done = live.agg(F.count_if(~small), F.count_if(small)).first()
        if done:
            found.append(_finish(live.filter(small), leaves, depth, errors))
        if not large:
            break
        pairs = live.filter(~small).drop("n_a", "n_b")
    return reduce(DataFrame.unionByName, found).distinct() if found else spark.createDataFrame([], "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", errors: int = 3, number: str | None = None) -> DataFrame:
    """(doc_id, row, fingerprint, component_id, kept) for every row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``errors`` bits; ``component_id`` is the smallest doc_id
    that can be reached over links, and null only if no linked row has a doc_id. Of each component one row is kept, one
    with that doc_id. ``row`` parts rows that are otherwise equal. Null and empty texts have no words and fingerprint
    zero, which links like any other. Repeated rows are one text with itself. Other columns are not read.
    """
    marked = staged(fingerprints(docs, text, number))
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    first = staged(marked.groupBy("fingerprint").agg(F.min(own).alias("first")))
    links = staged(similar_pairs(first, errors))
    roots = staged(components(links))
    drop_staged(links)
    rooted = first.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    per_value = attach(rooted, smallest, ["root"], F.col("fingerprint")).select("fingerprint", "stays")
    found = attach(marked, per_value, ["fingerprint"], F.col("row"))
    return found.select("doc_id", "row", "fingerprint", F.col("stays.doc_id").alias("component_id"), (F.col("row") == F.col("stays.row")).alias("kept"))


def hexadecimal(value):
    """Sixteen lower-case hexadecimal digits of a signed 64-bit column."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
