"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.llm.ship import ship
from sensorpipe.session import staged

#: Labelled rows that are used to learn, at most; chosen by a hash of the doc_id.
MOST_LABELLED = 20_000
#: Entries of the learned lexicon, at most.
MOST_TERMS = 2_000
STEMS = (4, 5, 6)
FOLDS = 5
NEAR = 5

# A hand-written lexicon, and words that address somebody, in four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers scum trash clown pathetic worthless disgusting ugly hate kill die bastard bitch "
    "dumm idioten trottel arschloch hass widerlich abschaum imbécile stupide connard salaud dégoûtant haine estúpido idiota imbécil basura odio asqueroso".split()
)
ADDRESS = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer ihr ihre tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros vuestra vuestro".split()
)

WORDS = re.compile(r"[^\W_]+")
MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[@$!*#0-9]++[^\W\d_]")
STRETCHED = re.compile(r"(\w)\1\1")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
RUNS = re.compile(r"[!?]{2,}")


class Model(NamedTuple):
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id as text, modulo FOLDS; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def terms_of(word: str) -> Iterator[str]:
    """A word, and its first letters as stems, marked by an asterisk."""
    yield word
    for n in STEMS:
        if len(word) > n:
            yield f"{word[:n]}*"


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Densities and rates of one whole text; all zero but the constants for a text without words."""
    text = text or ""
    words = WORDS.findall(text.lower())
    n = max(1, len(words))
    weight = {}
    for word in set(words):
        found = max((lexicon.get(t, 0.0) for t in terms_of(word)), default=0.0)
        if found or word in INSULTS:
            weight[word] = found
    hits = [i for i, w in enumerate(words) if w in weight]
    fixed = sum(w in INSULTS for w in words) if weight else 0
    addressed = [i for i, w in enumerate(words) if w in ADDRESS] if hits else []
    near = 0
    if addressed:
        at = np.searchsorted(addressed, hits)
        known = np.array([-(10**9), *addressed, 10**9])
        near = int((np.minimum(np.array(hits) - known[at], known[at + 1] - np.array(hits)) <= NEAR).sum())
    total = sum(weight[words[i]] for i in hits)
    count = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    capitals, small = int(count[65:91].sum()), int(count[97:123].sum())
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    size = max(1, len(text))
    return [
        math.log1p(len(words)),
        math.log1p(len(hits)),
        len(hits) / n,
        total / n,
        total / math.sqrt(n),
        max(weight.values(), default=0.0),
        math.log1p(len(weight)),
        math.log1p(fixed),
        fixed / n,
        near / max(1, len(hits)),
        math.log1p(near),
        capitals / max(1, capitals + small),
        len(SHOUTED.findall(text)) / n,
        marks / size,
        int(count[33]) / n,
        len(RUNS.findall(text)) / n,
        len(MASKED.findall(text)) / n,
        len(STRETCHED.findall(text)) / n,
    ]


def with_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` and the vector ``features``."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), held.value) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=[*batch.schema.names[:-1], "_features"])

    schema = docs.select(*keep).schema.add("_features", T.ArrayType(T.DoubleType()))
    made = docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)
    return made.withColumn("features", array_to_vector("_features")).drop("_features")


def _sample(docs: DataFrame, labels: DataFrame, text: str) -> DataFrame:
    """Labelled rows to learn from: (text, label, fold); never rows of fold 0. At most MOST_LABELLED labels."""
    known = labels.filter(F.col("toxic").isNotNull() & (remainder() != 0)).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    some = staged(known.orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(MOST_LABELLED))
    picked = docs.select("doc_id", F.col(text).alias("text"))
    return staged(picked.join(F.broadcast(some), "doc_id").select("text", F.col("label").cast("double").alias("label"), remainder().alias("fold")))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and stems that stand in toxic texts more often than chance explains, with the logarithm of how much more.

    A term's evidence is the G statistic of its document counts; it must exceed what the best of all terms could reach
    by chance.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label")):
                words = set(WORDS.findall((text.as_py() or "").lower()))
                both[int(label.as_py() > 0)].update({t for w in words for t in terms_of(w)})
        names = list(both[0].keys() | both[1].keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(names, pa.string()), **{f"n{y}": pa.array([both[y][t] for t in names], pa.int64()) for y in (0, 1)}})

    counted = sample.mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counted = staged(counted.filter("n1 > 1"))
    clean, toxic = sample.agg(F.count_if(F.col("label") <= 0), F.count_if(F.col("label") > 0)).first()
    if not clean or not toxic:
        return {}
    share = toxic / (clean + toxic)
    part = F.col("n1") / (F.col("n0") + F.col("n1"))
    other = F.when(F.col("n0") > 0, F.col("n0") * F.log((1 - part) / (1 - share))).otherwise(0.0)
    judged = counted.withColumn("g", F.col("n1") * F.log(part / share) + other).filter(part > share)
    floor = math.log(max(2, counted.count())) + 4
    best = judged.filter(F.col("g") > floor).orderBy(F.desc("g"), "term").limit(MOST_TERMS).collect()
    return {r["term"]: math.log((r["n1"] + 0.5) / (toxic + 1) / ((r["n0"] + 0.5) / (clean + 1))) for r in best}


def train(docs: DataFrame, labels: DataFrame, text: str = "text", rounds: int = 25, depth: int = 3) -> Model:
    """Learn the lexicon and the trees from folds 2 and up, and the calibration from fold 1.

    Only ``toxic`` is used of the labels, and only the text of a document. Without rows of both classes there is no
    model, and every score is 0.
    """
    ship(docs.sparkSession)
    sample = _sample(docs, labels, text)
    fit = sample.filter("fold > 1")
    lexicon = learn_lexicon(fit)
    made = staged(with_features(sample, lexicon, ["label", "fold"], "text").withColumn("features", vector_to_array("features")))
    made = made.withColumn("features", array_to_vector("features"))
    counts = {(r[0], r[1]): r[2] for r in made.groupBy(F.col("fold") > 1, F.col("label") > 0).count().collect()}
    if not counts.get((True, True)) or not counts.get((True, False)):
        return Model(lexicon, None, None)
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=11, labelCol="label").fit(made.filter("fold > 1"))
    if not counts.get((False, True)) or not counts.get((False, False)):
        return Model(lexicon, trees, None)
    raw = trees.transform(made.filter("fold = 1")).select(_raw().alias("raw"), "label")
    return Model(lexicon, trees, IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(raw))


def _raw() -> Column:
    return vector_to_array("probability")[1]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``score`` from 0 to 1.

    Other columns stay, whatever their names, but one named ``score`` is replaced. Null and empty texts are scored like a
    text without words; repeated rows get one score.
    """
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text, "score")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text).alias("text"))
    if model.trees is None:
        return rows.select("row.*", F.lit(0.0).alias("score"))
    found = model.trees.transform(with_features(rows, model.lexicon, ["row"], "text")).withColumn("raw", _raw())
    if model.calibration is None:
        return found.select("row.*", F.col("raw").alias("score"))
    # Steps of the calibration are kept apart by a hundredth of the uncalibrated score.
    blend = F.col("calibrated") * 0.99 + F.col("raw") * 0.01
    return model.calibration.transform(found).select("row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), blend)).alias("score"))
