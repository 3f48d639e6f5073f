"""Benchmark decontamination with DataFrame functions: a broadcast set of test windows, scanned against training words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensorpipe.llm.licenses import ANY_WORD, LOWER, UPPER, WORD
from sensorpipe.llm.spread import BROADCAST_ROWS, attach_small, free_name, numbered, without
from sensorpipe.session import staged

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Windows of a document that are looked at together.
BLOCK = 4096
#: Windows that one broadcast may hold (some hundred bytes each); more are scanned for in several passes.
BROADCAST_WINDOWS = 500_000
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words(text: Column) -> Column:
    """Words with A-Z in lower case; a null text has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, text: str = "text", item: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Each distinct window as (window, len, words, hash), and (window, item) for the items it stands in.

    An item of fewer than ``size`` words, but not none, is one window. Both frames are written to the shared folder.
    """
    split = benchmark.select(F.col(item).alias("item"), words(F.col(text)).alias("all")).withColumn("len", F.least(F.size("all"), F.lit(size)))
    placed = split.filter("len > 0").select("item", "all", "len", F.explode(F.sequence(F.lit(0), F.size("all") - F.col("len"))).alias("at"))
    found = placed.select("item", "len", F.slice("all", F.col("at") + 1, F.col("len")).alias("words")).distinct()
    known = staged(found.select("len", "words").distinct().select(F.monotonically_increasing_id().alias("window"), "len", "words", F.xxhash64("words").alias("hash")))
    return known, staged(found.join(known, ["len", "words"]).select("window", "item").distinct())


def _hashes(found: Column, starts: Column, length: int) -> Column:
    return F.transform(starts, lambda i: F.xxhash64(F.slice(found, i + 1, length)))


def _scan(docs: DataFrame, text: str, known: DataFrame, lengths: Sequence[int], block: int) -> DataFrame:
    """(row, n_words, at, len, window): a line with null ``at`` per document, and one per place where a window stands.

    ``docs`` has ``row`` and the text. Documents are cut into blocks that overlap by a window less one word. The hashes
    of their windows meet the broadcast set, of equal hashes the words are compared; nothing is shuffled.
    """
    size = F.size("_words")
    others = [c for c in docs.columns if c != text]
    cut = docs.select(*others, words(F.col(text)).alias("_all")).withColumn("n_words", F.size("_all").cast("long"))
    firsts = F.sequence(F.lit(0), F.greatest(F.size("_all") - 1, F.lit(0)), F.lit(block))
    blocks = cut.withColumn("_first", firsts).select(*others, "n_words", "_all", F.explode_outer("_first").alias("_first"))
    opened = blocks.select(*others, "n_words", "_first", F.slice("_all", F.col("_first") + 1, block + max(lengths, default=1) - 1).alias("_words"))
    # Hashes stand behind a null for the document itself; windows of each length follow those of the one before.
    parts, ends = [F.array(F.lit(None).cast("bigint"))], [F.lit(1)]
    for length in lengths:
        count = F.greatest(F.least(size - (length - 1), F.lit(block)), F.lit(0))
        at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        parts.append(_hashes(F.col("_words"), at, length))
        ends.append(ends[-1] + count)
    hashed = opened.withColumn("_hashes", F.concat(*parts))
    placed = hashed.select(*others, "n_words", "_first", "_words", F.posexplode_outer("_hashes").alias("_pos", "_hash"))
    length, at = F.lit(None).cast("int"), F.lit(None).cast("int")
    for k in reversed(range(len(lengths))):
        here = F.col("_pos") < ends[k + 1]
        length, at = F.when(here, F.lit(lengths[k])).otherwise(length), F.when(here, F.col("_pos") - ends[k]).otherwise(at)
    seen = F.broadcast(known.select(F.col("hash").alias("_known"), F.col("words").alias("_window_words"), F.col("len").alias("_len"), "window"))
    # Only the hash is a key of the join: the words are compared where hashes are equal, not built for every place.
    same = (F.col("_len") == length) & (F.slice("_words", F.greatest(at, F.lit(0)) + 1, F.col("_len")) == F.col("_window_words"))
    hits = placed.join(seen, F.col("_hash") == F.col("_known"), "left").filter((F.col("window").isNotNull() & same) | ((F.col("_pos") == 0) & (F.col("_first") == 0)))
    hit = F.col("window").isNotNull()
    return hits.select(*others, "n_words", F.when(hit, F.col("_first") + at).alias("at"), F.when(hit, length).alias("len"), "window")


def _found(docs: DataFrame, benchmark: DataFrame, size: int, text: str, item: str, block: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The scan of ``docs`` (any columns, ``row`` among them), written once, and (window, item)."""
    known, items = benchmark_windows(benchmark, size, text, item)
    lengths = sorted(r[0] for r in known.select("len").distinct().collect())
    passes = max(1, -(-known.count() // most))
    if passes == 1:
        return staged(_scan(docs, text, known, lengths, block)), items
    part = F.pmod(F.col("window"), F.lit(passes))
    scans = [_scan(docs, text, known.filter(part == k), lengths, block).filter(F.lit(k == 0) | F.col("at").isNotNull()) for k in range(passes)]
    out = scans[0]
    for more in scans[1:]:
        out = out.unionByName(more)
    return staged(out), items


def _spans(hits: DataFrame) -> DataFrame:
    """(row, spans, n_hit): merged spans of words (start, end) of each document that has any, in order."""
    ends = hits.groupBy("row", "at").agg(F.max(F.col("at") + F.col("len")).alias("end"))
    order = Window.partitionBy("row").orderBy("at")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = ends.withColumn("_new", F.coalesce((F.col("at") > before).cast("int"), F.lit(1)))
    island = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = island.groupBy("row", "_island").agg(F.min("at").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text", item: str = "item_id", block: int = BLOCK, most: int = BROADCAST_WINDOWS, number: str | None = None
) -> DataFrame:
    """(doc_id, row, n_words, n_hit, spans, items) of every row of ``docs``.

    Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. A window is ``size`` consecutive words
    of a benchmark item, or a whole item of fewer words. ``n_hit`` counts the words of a document inside any place where
    a window stands, ``spans`` are these places (word numbers from 0, end excluded, merged), and ``items`` the distinct
    ids of items that any of those windows stands in. A null text has no words, and a text or item without words no hit;
    an item with a null id hits but is not listed. Repeated rows give repeated results. ``row`` is the column
    ``number`` or counted; other columns are not read, so their names may clash.

    The set of windows is counted before it is broadcast; above ``most`` windows it is split and ``docs`` is scanned for
    each part. Only hits, and a line per document, are shuffled.
    """
    if number is None and benchmark.count() > most // 64:
        # Several scans may follow: they must see the same numbers.
        docs, number = numbered(docs.select("doc_id", text))
    row = F.col(number) if number else F.monotonically_increasing_id()
    found, items = _found(docs.select("doc_id", row.alias("row"), F.col(text).alias("text")), benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("text")), size, "text", "item_id", block, most)
    hits = found.filter("at IS NOT NULL")
    listed = attach_small(hits.select("row", "window").distinct(), items, ["window"], F.col("row"))
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    kind = items.schema["item"].dataType.simpleString()
    whole = found.filter("at IS NULL").select("doc_id", "row", "n_words").join(_spans(hits), "row", "left").join(listed, "row", "left")
    return whole.select(
        "doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"), F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"),
    )


def _without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of ``spans`` and what stands before each of them."""
    pieces = F.regexp_extract_all(text, F.lit(f"{_OTHER}*{ANY_WORD}"), F.lit(0))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(pieces)))
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    kept = F.flatten(F.zip_with(ends, starts, lambda a, b: F.slice(pieces, a + 1, b - a)))
    tail = F.regexp_extract(text, f"{_OTHER}*$", 0)
    return F.concat(F.array_join(kept, ""), tail)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` with all their columns, without what ``contaminated`` finds.

    ``remove="documents"`` drops the rows with a hit. ``"spans"`` keeps every row and cuts the hit words, with the
    characters in front of each, out of its text; other texts stay as they are, null among them.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove!r}")
    kept, number = numbered(docs)
    found = contaminated(kept, benchmark, size, text, item, number=number).filter("n_hit > 0")
    if remove == "documents":
        return without(kept, found, number)
    spans = free_name(kept)
    cut = staged(found.select(F.col("row").alias(number), F.col("spans").alias(spans)))
    if cut.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS and cut.agg(F.coalesce(F.sum(F.size(spans)), F.lit(0))).first()[0] <= 50 * BROADCAST_ROWS:
        cut = F.broadcast(cut)
    joined = kept.join(cut, number, "left")
    new = F.when(F.col(spans).isNull(), F.col(text)).otherwise(_without_spans(F.col(text), F.col(spans)))
    return joined.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])
