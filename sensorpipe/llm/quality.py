"""Quality without labels: heuristic labellers vote, EM weighs them, their posterior trains a hashed linear scorer."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm.ship import ship
from sensorpipe.session import staged

GOOD, BAD, SILENT = 1, 0, -1
#: Documents that the linear scorer is fitted on, at most; chosen by a hash of doc_id and text.
MOST_FITTED = 12_000
HASH_BITS = 15
EPOCHS = 6
#: Words whose hashes a worker remembers before it starts anew.
REMEMBERED = 400_000


class Shape(NamedTuple):
    """What the labellers see of a whole text."""

    words: int
    top_share: float
    repeats: float
    symbols: float
    capitals: float
    bars: float
    ended_lines: float
    word_length: float
    variety: float


def shape(text: str | None) -> Shape:
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    count = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    capitals, small = int(count[65:91].sum()), int(count[97:123].sum())
    marks = int(count[33:39].sum() + count[42:44].sum() + count[60:65].sum() + count[91:97].sum() + count[123:127].sum())
    return Shape(
        len(words),
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        marks / max(1, len(text)),
        capitals / max(1, capitals + small),
        int(count[124]) / n,
        sum(line.rstrip()[-1] in ".!?\"'”»" for line in lines) / max(1, len(lines)),
        sum(map(len, words)) / n,
        len(counts) / n,
    )


def _above(name: str, bad: float, good: float) -> Callable[[Shape], int]:
    """Bad from ``bad`` on, good up to ``good``, silent between."""
    return lambda s: BAD if getattr(s, name) >= bad else GOOD if getattr(s, name) <= good else SILENT


#: The labellers: each sees one side of a text, may be wrong, and may say nothing.
LABELLERS: tuple[Callable[[Shape], int], ...] = (
    lambda s: BAD if s.words < 5 else GOOD if s.words >= 60 else SILENT,
    _above("top_share", 0.3, 0.12),
    _above("repeats", 0.15, 0.03),
    _above("symbols", 0.05, 0.015),
    _above("capitals", 0.4, 0.08),
    _above("bars", 0.2, 0.01),
    lambda s: GOOD if s.ended_lines >= 0.8 else BAD if s.ended_lines <= 0.2 else SILENT,
    lambda s: BAD if s.word_length > 11 or s.word_length < 2 else GOOD if 3 <= s.word_length <= 8 else SILENT,
    lambda s: BAD if s.words >= 30 and s.variety < 0.2 else GOOD if s.variety >= 0.3 else SILENT,
)


class Labels(NamedTuple):
    """What EM found: the share of good texts, and of each labeller what it says of good and of bad texts."""

    share: float
    says: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of being good for rows of votes."""
        at = votes + 1
        logs = [np.log(p) + np.log(self.says[y][np.arange(votes.shape[1])[None, :], at]).sum(axis=1) for y, p in ((BAD, 1 - self.share), (GOOD, self.share))]
        return 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -500, 500)))


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Labels:
    """Accuracies of the labellers from how often each pattern of votes occurs; no true labels are used.

    The start takes every labeller to be right in four of five votes, which settles which class is the good one.
    """
    m = votes.shape[1]
    spoken = np.array([(counts[:, None] * (votes == v)).sum(axis=0) for v in (SILENT, BAD, GOOD)]) / counts.sum()
    says = np.empty((2, m, 3))
    for y in (BAD, GOOD):
        says[y, :, 0] = spoken[0]
        right = np.where(y == GOOD, 0.8, 0.2)
        says[y, :, 2], says[y, :, 1] = (1 - spoken[0]) * right, (1 - spoken[0]) * (1 - right)
    found = Labels(0.5, np.clip(says, 1e-4, 1))
    for _ in range(rounds):
        good = found.posterior(votes)
        says = np.empty((2, m, 3))
        for y, chance in ((BAD, 1 - good), (GOOD, good)):
            weight = counts * chance
            for v in (SILENT, BAD, GOOD):
                says[y, :, v + 1] = (weight[:, None] * (votes == v)).sum(axis=0) + 0.1
            says[y] /= says[y].sum(axis=1, keepdims=True)
        share = float(np.clip((counts * good).sum() / counts.sum(), 0.01, 0.99))
        done = abs(share - found.share) < 1e-9 and np.abs(says - found.says).max() < 1e-9
        found = Labels(share, says)
        if done:
            break
    return found


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t in batch.column("text"):
            seen = shape(t.as_py())
            rows.append([labeller(seen) for labeller in LABELLERS])
        columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
        yield pa.RecordBatch.from_pydict(columns | {"votes": pa.array(rows, pa.list_(pa.int32()))})


_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


class Hasher:
    """Sparse hashed features of a text: words, shapes of words, repetitions and ends of lines."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def _of(self, word: str) -> tuple[int, int]:
        got = self.known.get(word)
        if got is None:
            form = _LETTERS.sub(lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "x", _DIGITS.sub("0", word))
            mask = (1 << HASH_BITS) - 1
            got = zlib.crc32(b"w" + word.lower().encode("utf-8", "surrogatepass")) & mask, zlib.crc32(b"s" + form.encode("utf-8", "surrogatepass")) & mask
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = got
        return got

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Indices and values; the square of all values sums to one, but for a text without words, which has none."""
        text = text or ""
        words = text.split()
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        ids = np.array([self._of(w) for w in words], np.int64)
        again = sum(a == b for a, b in zip(words, words[1:]))
        extra = [zlib.crc32(f"l{line[-1:]}".encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1) for line in text.split("\n")]
        extra += [zlib.crc32(b"again") & ((1 << HASH_BITS) - 1)] * again
        index, count = np.unique(np.concatenate([ids.ravel(), np.array(extra, np.int64)]), return_counts=True)
        value = np.log1p(count)
        return index, value / math.sqrt((value**2).sum())


_HASHER = Hasher()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as sparse features: from here on no text travels."""
    for batch in batches:
        made = [_HASHER.features(t.as_py()) for t in batch.column("text")]
        columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
        index, value = pa.array([i for i, _ in made], pa.list_(pa.int32())), pa.array([v for _, v in made], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_pydict(columns | {"index": index, "value": value})


def _fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels by AdaGrad; the last weight is the constant."""
    weight, seen = np.zeros((1 << HASH_BITS) + 1), np.full((1 << HASH_BITS) + 1, 1e-6)
    order = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            z = weight[index] @ value + weight[-1]
            error = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - target[i]
            slope = error * value + 1e-6 * weight[index]
            seen[index] += slope**2
            weight[index] -= 0.3 * slope / np.sqrt(seen[index])
            seen[-1] += error**2
            weight[-1] -= 0.3 * error / math.sqrt(seen[-1])
    return weight


class Model(NamedTuple):
    labels: Labels | None
    weight: np.ndarray


def train(docs: DataFrame, text: str = "text") -> Model:
    """Votes of all documents give the accuracies; a bounded sample with posterior labels fits the scorer in one task,
    which gets hashed features, at most 2 to the power of ``HASH_BITS`` a document, and no text.

    There are at most 3 to the power of the number of labellers patterns of votes, whatever the number of documents.
    """
    ship(docs.sparkSession)
    picked = docs.select(F.xxhash64("doc_id", F.col(text)).alias("key"), F.col(text).alias("text"))
    voted = staged(picked.mapInArrow(_vote, "key long, votes array<int>"))
    patterns = voted.groupBy("votes").count().collect()
    if not patterns:
        return Model(None, np.zeros((1 << HASH_BITS) + 1))
    votes, counts = np.array([r["votes"] for r in patterns]), np.array([r["count"] for r in patterns], np.float64)
    labels = expectation_maximisation(votes, counts)
    some = staged(voted.dropDuplicates(["key"]).orderBy("key").limit(MOST_FITTED))
    sample = picked.join(F.broadcast(some), "key")
    hashed = sample.mapInArrow(_hash, "key long, votes array<int>, index array<int>, value array<double>").dropDuplicates(["key"])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        if frames:
            rows = pd.concat(frames, ignore_index=True)
            yield pd.DataFrame({"weight": [_fit(list(zip(rows["index"], rows["value"])), labels.posterior(np.stack(rows["votes"].to_numpy())))]})

    weight = hashed.repartition(1).sortWithinPartitions("key").mapInPandas(fit, "weight array<double>").first()
    return Model(labels, np.array(weight["weight"]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the chance that a text is good, from 0 to 1.

    Null and empty texts have no features and get 0. Repeated rows get one score. Other columns are not read.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model.weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = held.value
        for batch in batches:
            scores = []
            for t in batch.column("text"):
                index, value = _HASHER.features(t.as_py())
                z = weight[index] @ value + weight[-1]
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) if len(index) else 0.0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())})

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double")
