"""License scan with DataFrame functions: keyword gates, ordered signatures, containment decides overlaps.

Everything about a text happens in its own row: there is no shuffle and no Python code on the way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm.license_rules import BASE, GAP, SHORT, WEIGHT, Rule, gates, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Items of a text that are gathered at a time.
PIECE = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(words: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other, from 0."""
    parts = phrase.split(" ")

    def stands(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return found

    return F.when(F.size(words) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), stands)).otherwise(F.array().cast("array<int>"))


def _base(text: Column) -> Column:
    """Places and labels of the base phrases in a lower-cased text."""

    def find(words: Column) -> Column:
        each = F.array(*[F.struct(F.lit(label).alias("label"), _places(words, phrase).alias("at")) for label, phrase in BASE.items()])
        return let(each, lambda found: F.struct(
            F.flatten(F.transform(found, lambda x: x["at"])).alias("at"),
            F.transform(F.filter(found, lambda x: F.size(x["at"]) > 0), lambda x: x["label"]).alias("labels"),
        ))

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), find)


def _gates(all_rules: list[Rule]) -> Column:
    """Rules by keyword: an array of (keyword, rules), rules with their order."""
    by: dict[str, list[Column]] = {}
    for order, r in enumerate(all_rules):
        by.setdefault(r.keyword, []).append(
            F.struct(F.lit(order).alias("rule"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"))
        )
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*group).alias("rules")) for k, group in by.items()])


def _blocks(array: Column) -> Column:
    """An array in pieces, so that what grows item by item is copied within a piece only."""

    def cut(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / PIECE).cast("int")
        pieces = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * PIECE + 1, PIECE))
        return F.when(F.size(items) > 0, pieces).otherwise(F.slice(F.array(items), 1, 0))

    return let(array, cut)


def _spans(text: Column, rule: Column) -> Column:
    """Detections of one rule: the pieces between matches and the matches give their places."""
    matched = F.regexp_extract_all(text, rule["pattern"], F.lit(0))

    def inside(block: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

        def grow(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            return F.struct((start + x["own"]).alias("at"), F.concat(state["spans"], F.array(F.struct(start.alias("start"), (start + x["own"]).alias("end")))).alias("spans"))

        return F.aggregate(block, none, grow)

    def place(found: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, rule["pattern"]), 1, F.size(found)), found, lambda piece, m: F.struct(F.length(piece).alias("gap"), F.length(m).alias("own")))

        def shift(blocks: Column) -> Column:
            none = F.array(F.lit(0))
            starts = F.aggregate(blocks, none, lambda seen, b: F.concat(seen, F.array(F.element_at(seen, -1) + b["at"])))
            return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), lambda b, at: F.transform(b["spans"], lambda s: F.struct(
                (at + s["start"]).alias("start"), (-at - s["end"]).alias("back"), rule["priority"].alias("priority"), rule["rule"].alias("rule"), rule["label"].alias("label")))))

        return let(F.transform(_blocks(lengths), inside), shift)

    return let(matched, place)


def _kept(detections: Column) -> Column:
    """Detections that no other one of the same or a better priority contains."""
    levels = range(len(WEIGHT))
    kind = "array<struct<start:int,back:int,priority:int,rule:int,label:string>>"

    def farthest(block: Column) -> Column:
        ends = lambda level: F.array_max(F.transform(F.filter(block, lambda d: d["priority"] == level), lambda d: -d["back"]))
        return F.array(*[F.coalesce(ends(level), F.lit(-1)) for level in levels])

    def stand(block: Column, ends: Column) -> Column:
        none = F.struct(ends.alias("ends"), F.array().cast(kind).alias("kept"))

        def step(state: Column, d: Column) -> Column:
            end = -d["back"]
            inside = F.exists(F.slice(state["ends"], 1, d["priority"] + 1), lambda e: e >= end)
            reached = F.transform(state["ends"], lambda e, level: F.when(level == d["priority"], F.greatest(e, end)).otherwise(e))
            return F.struct(reached.alias("ends"), F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"))

        return F.aggregate(block, none, step, lambda state: state["kept"])

    def blockwise(blocks: Column) -> Column:
        none = F.array(F.array_repeat(F.lit(-1), len(levels)))
        grow = lambda seen, block: F.concat(seen, F.array(F.zip_with(F.element_at(seen, -1), farthest(block), lambda a, b: F.greatest(a, b))))
        return F.flatten(F.zip_with(blocks, F.slice(F.aggregate(blocks, none, grow), 1, F.size(blocks)), stand))

    return let(_blocks(F.array_sort(detections)), blockwise)


def _scan(text: Column, gates: Column) -> Column:
    """Keywords are looked for where gaps between words are one blank; rules are matched on the text itself."""
    opened = lambda folded: F.flatten(F.transform(F.filter(gates, lambda g: F.contains(folded, g["keyword"])), lambda g: g["rules"]))
    open_rules = let(F.regexp_replace(text, GAP, " "), opened)
    detections = F.flatten(F.transform(open_rules, lambda rule: _spans(text, rule)))
    return F.struct(_base(text).alias("base"), _kept(detections).alias("kept"))


def _candidate(text: Column) -> Column:
    """Whether any rule or base phrase may match a text, by plain searches for single words."""

    def look(low: Column) -> Column:
        found = F.lit(False)
        for word in gates():
            found = found | F.contains(low, F.lit(word))
        return found | low.rlike(SHORT) | low.rlike(r"(?<![a-z0-9])cc[^a-z0-9]+by")

    return let(F.lower(text), look)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the detections in it.

    ``n_words``; ``base``: places (word numbers from 0) and labels of the base phrases; ``detections``: start, end,
    priority and label of every signature match that stands; a match inside another of the same or a better priority
    does not, and of matches with one span the better priority, then the earlier rule, stands. Lower case means A-Z
    only. A null text is empty: no words, no labels. Repeated rows give repeated results; other columns stay, but those
    named as the new ones are replaced.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lowered = F.translate(value, UPPER, LOWER)
    all_gates = _gates(rules())
    found = F.when(_candidate(value), let(lowered, lambda t: _scan(t, all_gates)))
    others = [c for c in docs.columns if c not in (text, "n_words", "base", "detections")]
    scanned = docs.select(*others, F.regexp_count(value, F.lit(ANY_WORD)).cast("long").alias("n_words"), found.alias("_found"))
    empty = F.array().cast("array<struct<start:int,back:int,priority:int,rule:int,label:string>>")
    kept = F.transform(F.coalesce("_found.kept", empty), lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["priority"].alias("priority"), d["label"].alias("label")))
    return scanned.select(*others, "n_words", F.col("_found.base").alias("base"), kept.alias("detections"))


def summary(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of scanned documents.

    ``score`` is the weight of the surest detection, at least that of a name where a base phrase stands, else 0.
    """
    at, base = F.col("base.at"), F.coalesce("base.labels", F.array().cast("array<string>"))
    own = F.transform("detections", lambda d: d["label"])
    weights = F.array(*[F.lit(w) for w in WEIGHT])
    surest = F.coalesce(F.array_max(F.transform("detections", lambda d: F.get(weights, d["priority"]))), F.lit(0.0))
    n_base = F.coalesce(F.size(at), F.lit(0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.when(at.isNull(), 0).otherwise(n_base).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        F.when(F.size(base) > 0, F.greatest(surest, F.lit(WEIGHT[2]))).otherwise(surest).alias("score"),
    )
