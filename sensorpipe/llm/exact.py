"""Exact deduplication: static filters of an immutable snapshot screen the digests of a new batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm.fuse import BinaryFuse
from sensorpipe.llm.spread import attach, attach_small
from sensorpipe.llm.ship import ship
from sensorpipe.session import drop_staged, staged

#: Digests in one filter; the number of filters follows from the number of digests.
PER_FILTER = 50_000


def normalised(text: str | None) -> bytes:
    """UTF-8 of a text with A-Z in lower case; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _digests(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalised(t.as_py()) for t in batch.column("text")]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            columns["digest"] = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            if keep_text:
                columns["bytes"] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def with_digest(docs: DataFrame, text: str = "text", number: str | None = None) -> DataFrame:
    """(doc_id, row, digest) of every row; ``row`` is the column ``number``, or counted, and parts rows that are otherwise equal."""
    row = F.col(number) if number else F.monotonically_increasing_id()
    picked = docs.select("doc_id", row.alias("row"), F.col(text).alias("text"))
    return picked.mapInArrow(_digests(False), "doc_id long, row long, digest binary")


def _grouped(rows: DataFrame) -> DataFrame:
    """The rows of one batch by digest; the last row is that with the largest doc_id (null counts as smallest)."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("n"))


def _bucket(filters: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(filters)).cast("int")


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), "<u8")


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One static binary-fuse filter for each bucket of a snapshot's digests: (bucket, filter)."""
    filters = max(1, -(-snapshot.count() // PER_FILTER))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": part["bucket"].iloc[:1], "filter": [BinaryFuse.build(_keys(part["digest"])).to_bytes()]})

    built = snapshot.select("digest").withColumn("bucket", _bucket(filters)).groupBy("bucket").applyInPandas(build, "bucket int, filter binary")
    return built.withColumn("filters", F.lit(filters))


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """Digests of a new batch that the snapshot may hold: all that it does hold, and about one in 256 others."""
    head = filters.select("filters").first()
    if head is None:
        return incoming.select("digest").limit(0)

    def look(new: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(new) or not len(held):
            return pd.DataFrame({"digest": []})
        return new.loc[BinaryFuse.from_bytes(held["filter"].iloc[0]).contains(_keys(new["digest"])), ["digest"]]

    bucketed = incoming.select("digest").withColumn("bucket", _bucket(head[0]))
    return bucketed.groupBy("bucket").cogroup(filters.select("bucket", "filter").groupBy("bucket")).applyInPandas(look, "digest binary")


def _checked(docs: DataFrame, text: str, positive: DataFrame) -> None:
    """Compare the whole texts of positives: raises if two different texts share a digest."""
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    texts = picked.mapInArrow(_digests(True), "row long, digest binary, bytes binary")
    held = attach_small(texts, positive.select("digest"), ["digest"], F.col("row"))
    different = held.groupBy("digest", "bytes").agg(F.lit(1).alias("one")).groupBy("digest").count().filter("count > 1")
    if (found := different.first()) is not None:
        raise ValueError(f"two texts share the digest {bytes(found['digest']).hex()}")


def exact_duplicates(docs: DataFrame, text: str = "text", batches: int = 2, number: str | None = None) -> DataFrame:
    """(doc_id, row, digest, keep_id, keep_row, group_size, kept) for every row.

    Rows come in ``batches`` (by a hash of the doc_id). The rows of a batch are grouped by themselves. Its digests are
    screened by the static filters of each earlier snapshot; positives are joined with that snapshot's exact digests, the
    texts of what matches are compared byte by byte, and only these groups are merged into the snapshot's. What no snapshot
    holds becomes a snapshot of its own and is grouped with nothing else. Snapshots are immutable and share no digest.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the largest doc_id stays;
    a null doc_id counts as smallest. Of repeated rows with that doc_id exactly one stays. Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = staged(with_digest(docs, text, number).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")))
    snapshots: list[DataFrame] = []
    added: list[list[DataFrame]] = []
    for batch in range(batches):
        own = staged(_grouped(rows.filter(F.col("batch") == batch)))
        for held, more in zip(snapshots, added):
            filters = staged(build_filters(held))
            positive = staged(screen(own, filters).join(held.select("digest"), "digest", "left_semi"))
            _checked(docs, text, positive)
            tested = staged(own.join(positive.withColumn("known", F.lit(True)), "digest", "left"))
            more.append(tested.filter("known").select(F.lit(batch).alias("batch"), "digest", "last", "n"))
            own = tested.filter("known IS NULL").drop("known")
            drop_staged(filters)
            drop_staged(positive)
        snapshots.append(own)
        added.append([])
    joined = attach(rows, staged(_members(snapshots, added)), ["batch", "digest"], F.struct("doc_id", "row"))
    return joined.select(
        "doc_id", "row", "digest", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept")
    )


def _members(snapshots: list[DataFrame], added: list[list[DataFrame]]) -> DataFrame:
    """(batch, digest, last, group_size): the whole group of each digest, for the snapshot and the batches that met it."""
    out = []
    for home, (held, more) in enumerate(zip(snapshots, added)):
        own = held.select(F.lit(home).alias("batch"), "digest", "last", "n")
        if not more:
            out.append(own.withColumnRenamed("n", "group_size"))
            continue
        met = reduce(DataFrame.unionByName, more)
        sums = met.groupBy("digest").agg(F.max("last").alias("more"), F.sum("n").alias("extra"))
        grown = own.join(sums, "digest", "left").select(
            "batch", "digest", F.greatest("last", "more").alias("last"), (F.col("n") + F.coalesce("extra", F.lit(0))).alias("group_size"), F.col("more").isNotNull().alias("met")
        )
        grown = staged(grown)
        out += [grown.drop("met"), met.select("batch", "digest").join(grown.filter("met").drop("batch", "met"), "digest")]
    return reduce(DataFrame.unionByName, out)
