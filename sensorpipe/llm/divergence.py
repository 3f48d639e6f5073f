"""Divergence of sources: term-id bitsets per source and count; AND and popcount give the joint cells of each pair."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.llm.ship import ship
from sensorpipe.llm.spread import attach_small
from sensorpipe.session import staged

#: A term counts in a language if it stands in so many of its documents.
DOCUMENTS = 3
SCALE = 1_000_000_000
#: Ranks of terms that a source reports.
TOP_TERMS = 200
#: Sources of a language that a task compares with as many others.
SOURCE_BLOCK = 32
#: Term ids of the widest chunk; chunks of the first ids, those of frequent terms with many counts, hold fewer.
CHUNK = 4096
#: Terms that a task remembers before it hands on its counts, and bytes of a text that are split at once.
REMEMBERED, SLICE = 300_000, 1 << 20
#: Pairs of words that are ANDed at once.
AND_WORDS = 1 << 21

# A-Z become a-z, other letters of ASCII and all other bytes above stay; what stands between terms becomes a blank.
_TERM = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _slices(text: str) -> Iterator[list[bytes]]:
    """Terms of a text, so many bytes of it at a time; no term is cut."""
    data = text.encode("utf-8", "surrogatepass").translate(_TERM)
    at = 0
    while at < len(data):
        end = len(data) if at + SLICE >= len(data) else data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms, and of documents with them, by language and source over many rows of a task.

    Each language and source that occurs gets a line without a term.
    """
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            terms = [None, *(t.decode("utf-8", "surrogatepass") for t in counts)]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()), "term": pa.array(terms, pa.string()),
                "n": pa.array([0, *counts.values()], pa.int64()), "docs": pa.array([0, *(docs[t] for t in counts)], pa.int64()),
            })
        groups.clear()

    for batch in batches:
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
            counts, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(counts), set()
            for terms in _slices(text):
                counts.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(counts) - before
            if held > REMEMBERED:
                yield from out()
                held = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), and a line with a null term for each language and source that occurs."""
    empty = F.lit("")
    picked = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("text", "lang", "source")])
    parts = picked.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _numbered(terms: DataFrame) -> DataFrame:
    """Adds ``id``, from 0 within a language by falling total, from sorted ranges: no language is sorted in one task."""
    ranged = staged(terms.repartitionByRange("lang", F.desc("whole"), "term").withColumn("part", F.spark_partition_id()))
    local = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part", "lang").orderBy(F.desc("whole"), "term")))
    ends = ranged.groupBy("lang", "part").count()
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("lang", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return local.join(offsets, ["lang", "part"]).select("lang", "term", "whole", (F.col("at") - 1 + F.col("before")).alias("id"))


def kept_terms(counts: DataFrame) -> DataFrame:
    """(lang, term, whole, id) of the terms that stand in enough documents of their language."""
    terms = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs"))
    return staged(_numbered(terms.filter(F.col("docs") >= DOCUMENTS).select("lang", "term", "whole")))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)), exact; without terms and counts the divisor is 1."""
    return F.lit(1).cast("long") + F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), F.greatest(total + terms, F.lit(1)).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), exact: shares are at most 10^9 + 1."""
    apart = p.cast("long") - q
    return F.call_function("div", apart * apart, q)


def _chunk(term: Column) -> Column:
    """First id of the chunk of a term id: 64 ids at first, then a quarter of what lies before, CHUNK at most."""
    width = F.when(term < 256, F.lit(64)).otherwise(F.least(F.lit(CHUNK), F.call_function("shiftleft", F.lit(1), F.length(F.bin(term)) - 3)))
    return term - term % width.cast("long")


def bitsets(cells: DataFrame) -> DataFrame:
    """(lang, chunk, source, n, word, bits) of cells (lang, source, id, n): bit ``id % 64`` of ``word`` is set in the bitset of that source and count."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % 64).cast("int"))
    placed = cells.withColumn("chunk", _chunk(F.col("id"))).withColumn("word", F.call_function("div", F.col("id") - F.col("chunk"), F.lit(64)).cast("int"))
    return placed.groupBy("lang", "chunk", "source", "n", "word").agg(F.bit_or(bit).alias("bits"))


class _Levels:
    """The bitsets of some sources in one chunk: a row of words per source and count above zero."""

    def __init__(self, part: pd.DataFrame, size: int):
        present = part["n"].to_numpy() == 0
        zero = part[present].drop_duplicates("source").sort_values("source")
        self.sources, self.p0 = zero["source"].to_numpy(), zero["p0"].to_numpy(np.int64)
        rows = part[~present]
        rows = rows.assign(own=np.searchsorted(self.sources, rows["source"].to_numpy())).sort_values(["own", "n"])
        own, n = rows["own"].to_numpy(), rows["n"].to_numpy()
        first = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (n[1:] != n[:-1])]) if len(own) else np.zeros(0, int)
        level = np.cumsum(np.r_[True, (own[1:] != own[:-1]) | (n[1:] != n[:-1])]) - 1 if len(own) else np.zeros(0, int)
        self.own, self.p = own[first], rows["p"].to_numpy(np.int64)[first]
        self.bits = np.zeros((len(first), max(1, -(-size // 64))), np.uint64)
        self.bits[level, rows["word"].to_numpy()] = rows["bits"].to_numpy(np.int64).view(np.uint64)
        self.held = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)


def _quotient(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _cells(a: _Levels, b: _Levels) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(level of a, level of b, joint terms) where both counts are above zero, by AND and popcount.

    Frequent terms have a count of their own in every source: there each word of 64 ids is looked at by itself, among
    the levels that have a bit in it.
    """
    words = a.bits.shape[1]
    filled_a, filled_b = a.bits != 0, b.bits != 0
    apart = int((filled_a.sum(axis=0).astype(np.int64) * filled_b.sum(axis=0)).sum())
    if apart < len(a.bits) * len(b.bits) * words // 4:
        parts = [(np.flatnonzero(filled_a[:, w]), np.flatnonzero(filled_b[:, w]), slice(w, w + 1)) for w in range(words)]
    else:
        parts = [(np.arange(len(a.bits)), np.arange(len(b.bits)), slice(0, words))]
    for rows, columns, where in parts:
        if not len(rows) or not len(columns):
            continue
        right = b.bits[columns, where]
        step = max(1, AND_WORDS // right.size)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            joint = np.bitwise_count(a.bits[some, where][:, None, :] & right[None, :, :]).sum(axis=2, dtype=np.int64)
            i, j = np.nonzero(joint)
            yield some[i], columns[j], joint[i, j]


def _pair_sums(a: _Levels, b: _Levels, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the ``size`` terms of a chunk of f(p of a, q of b), and of f(p of b, q of a), by source of a and of b.

    Terms that one source or both lack follow from what the joint cells leave over.
    """
    shape = (len(a.sources), len(b.sources))
    there, back, both = (np.zeros(shape, np.int64) for _ in range(3))
    left_a = np.repeat(a.held[:, None], shape[1], axis=1)
    left_b = np.repeat(b.held[:, None], shape[0], axis=1)
    for i, j, joint in _cells(a, b):
        at = (a.own[i], b.own[j])
        np.add.at(there, at, joint * _quotient(a.p[i], b.p[j]))
        np.add.at(back, at, joint * _quotient(b.p[j], a.p[i]))
        np.add.at(both, at, joint)
        np.subtract.at(left_a, (i, at[1]), joint)
        np.subtract.at(left_b, (j, at[0]), joint)
    np.add.at(there, a.own, left_a * _quotient(a.p[:, None], b.p0[None, :]))
    np.add.at(back, a.own, left_a * _quotient(b.p0[None, :], a.p[:, None]))
    np.add.at(there.T, b.own, left_b * _quotient(a.p0[None, :], b.p[:, None]))
    np.add.at(back.T, b.own, left_b * _quotient(b.p[:, None], a.p0[None, :]))
    of_a, of_b = np.zeros(shape[0], np.int64), np.zeros(shape[1], np.int64)
    np.add.at(of_a, a.own, a.held)
    np.add.at(of_b, b.own, b.held)
    neither = size - of_a[:, None] - of_b[None, :] + both
    there += neither * _quotient(a.p0[:, None], b.p0[None, :])
    back += neither * _quotient(b.p0[None, :], a.p0[:, None])
    return there, back


def _compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Sums of all pairs between two blocks of sources in one chunk."""
    lang, _, first, second = key
    size = int(part["size"].iloc[0])
    a = _Levels(part[part["block"] == first], size)
    b = a if first == second else _Levels(part[part["block"] == second], size)
    there, back = _pair_sums(a, b, size)
    i, j = np.divmod(np.arange(there.size), max(1, there.shape[1]))
    if first == second:
        i, j = i[i != j], j[i != j]
        sides = [(a.sources[i], a.sources[j], there[i, j])]
    else:
        sides = [(a.sources[i], b.sources[j], there[i, j]), (b.sources[j], a.sources[i], back[i, j])]
    return pd.concat([pd.DataFrame({"lang": lang, "source": s, "item": t, "value": v}) for s, t, v in sides])


def pair_values(cells: DataFrame, groups: DataFrame, chunks: DataFrame, block: int = SOURCE_BLOCK) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language.

    ``cells``: (lang, source, id, n) above zero; ``groups``: (lang, source, total, terms), every one that occurs;
    ``chunks``: (lang, chunk, size), one at least per language. A task holds one chunk of two blocks of sources, at most
    2 x ``block`` x CHUNK counts or so (sources are dealt into blocks by hash); every source is there in each chunk, so zeros
    are counted by complement. Sums stay below 2^63 as long as a language keeps under 5 x 10^8 terms.
    """
    known = ["source", "n", "word", "bits"]
    zero = groups.select("lang", "source").join(chunks.select("lang", "chunk"), "lang").select("lang", "chunk", "source", F.lit(0).cast("long").alias("n"), F.lit(0).alias("word"), F.lit(0).cast("long").alias("bits"))
    rows = bitsets(cells).select("lang", "chunk", *known).unionByName(zero)
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    shared = groups.join(F.broadcast(blocks) if blocks.count() <= 20_000 else blocks, "lang").select(
        "lang", "source", "total", "terms", "blocks", share(F.lit(0), F.col("total"), F.col("terms")).alias("p0"), F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    )
    shared = staged(shared)
    rows = attach_small(staged(rows), shared, ["lang", "source"], F.struct("chunk", "n", "word"))
    rows = rows.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    sized = attach_small(staged(rows.drop("total", "terms")), staged(chunks), ["lang", "chunk"], F.struct("source", "n", "word"))
    paired = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")}).drop("other", "blocks")
    sums = paired.groupBy("lang", "chunk", "first", "second").applyInPandas(_compare, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of each language lie apart, and by which terms.

    Reads ``text``, ``lang`` and ``source``; null counts as '', and columns of other names are not read. Terms are runs
    of letters and non-ASCII characters, A-Z in lower case; a language keeps those in DOCUMENTS of its documents or more.
    A group is a language and source; a term's share of a group is 1 + floor(10^9 (count + 1) / (N + V)) with N the
    group's count over kept terms and V their number. Part ``pair``: for each other source of the language the sum over
    all kept terms of floor((p - q)^2 / q), q the other's share; 0 where nothing is kept. Part ``term``: kept terms that
    occur in the group with p above the share q of the whole language, the ``top`` first. Ranks count from 1 by falling
    value, then item by code point. Repeated rows count as often as they stand there. A language with one source has no
    pairs, and no rows give no rows.
    """
    ship(docs.sparkSession)
    counts = staged(term_counts(docs), compression="zstd")
    terms = kept_terms(counts)
    cells = staged(counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(terms, ["lang", "term"]), compression="zstd")
    langs = terms.groupBy("lang").agg(F.sum("whole").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = staged(groups.na.fill(0, ["total", "terms", "lang_total"]))
    chunks = terms.select("lang", _chunk(F.col("id")).alias("chunk")).groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("size"))
    none = F.lit(0).cast("long")
    bare = groups.filter("terms = 0").select("lang").distinct().select("lang", none.alias("chunk"), none.alias("size"))
    pairs = pair_values(cells.select("lang", "source", "id", "n"), groups.drop("lang_total"), chunks.unionByName(bare))
    own = attach_small(cells, groups, ["lang", "source"], F.col("id"))
    own = own.withColumns({"p": share(F.col("n"), F.col("total"), F.col("terms")), "q": share(F.col("whole"), F.col("lang_total"), F.col("terms"))})
    own = own.filter("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    listed = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))
    return listed(pairs, "pair").unionByName(listed(own, "term").filter(F.col("rank") <= top))
