"""Whitening of embeddings: sums and covariance over distinct vectors on Spark, eigenvectors in mixed precision."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorpipe.llm.eigen import eigenvectors
from sensorpipe.llm.ship import ship
from sensorpipe.session import staged

#: Entries are rounded down to steps of one over this.
STEPS = 256
#: The covariance, dimension squared, is all that reaches the driver.
MOST_DIMENSIONS = 8192
#: First sums of covariance rows are formed over so many groups of tasks.
GROUPS = 64
#: A component has variance if its eigenvalue is above this share of the largest, a dimension.
NO_VARIANCE = 1e-14
_DIGITS = 38


@dataclass
class Whitening:
    """What whitening needs to know: sizes, exact sums, and per component (columns of ``vectors``) its eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.values]

    def has_variance(self) -> np.ndarray:
        return self.values > NO_VARIANCE * len(self.sums) * self.values.max(initial=0)

    def weights(self) -> np.ndarray:
        """One column per component: the unit vector over the square root of its eigenvalue, zeros without variance."""
        open_ = self.has_variance()
        return np.where(open_, self.vectors / np.sqrt(np.where(open_, self.values, 1)), 0.0)


def _entries(column: Column) -> Column:
    """Whole numbers floor(256 c) of a vector, null where it is null or holds null or non-finite entries."""
    fine = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(column.isNotNull() & fine, F.transform(column, lambda c: F.floor(c.cast("double") * STEPS)))


def quantised(vectors: DataFrame, column: str = "embedding", id_column: str = "vec_id") -> tuple[DataFrame, int]:
    """(id, x) of the rows whose vector is usable, all of one length, and that length.

    Vectors shorter than the longest are filled up with zeros. ``x`` has the narrowest whole-number type that holds all
    entries, which one pass over the column finds.
    """
    rows = vectors.select(F.col(id_column).alias("id"), _entries(F.col(column)).alias("x")).filter(F.col("x").isNotNull())
    length, least, most = rows.agg(F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    length, widest = length or 0, max(-(least or 0), most or 0)
    if length > MOST_DIMENSIONS:
        raise ValueError(f"{length} dimensions are more than {MOST_DIMENSIONS}")
    kind = next((k for k, top in (("smallint", 1 << 15), ("int", 1 << 31)) if widest < top), "bigint")
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(length) - F.size("x")))
    return rows.select("id", filled.cast(f"array<{kind}>").alias("x")), length


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)


def _exact(length: int, widest: int) -> type:
    """Whole numbers of 64 bits where sums over a batch cannot leave them, else Python's own."""
    return np.int64 if widest < 1 << 40 else object


def moments(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums by dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, object)
        for batch in batches:
            x = _matrix(batch, length)
            widest = int(np.abs(x.astype(object)).max()) if x.dtype == np.int64 and x.size else 1 << 31
            n, total = n + len(x), total + x.astype(_exact(length, widest)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict({
            "n": pa.array([n], pa.int64()),
            "sums": pa.array([[Decimal(int(t)) for t in total]], pa.list_(pa.decimal128(_DIGITS, 0))),
        })

    parts = staged(fit.select("x").mapInArrow(add, f"n long, sums array<decimal({_DIGITS},0)>"))
    n = parts.agg(F.sum("n")).first()[0] or 0
    sums = parts.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
    by = {r.i: int(r.s) for r in sums}
    return n, [by.get(i, 0) for i in range(length)]


def _added(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of equally long arrays by key, in the order of ``part``."""
    kinds = ", ".join(f"{k} int" for k in keys)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        out = {k: [group[k].iloc[0]] for k in keys}
        return pd.DataFrame(out | {"part": [group["part"].iloc[0]], "row": [np.sum(np.stack(group["row"].to_list()), axis=0)]})

    return rows.groupBy(*keys).applyInPandas(add, f"{kinds}, part int, row array<double>")


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor ``n``; rows are centred before they are multiplied.

    Each task adds up its products; rows of these matrices are summed by Spark, first over groups of tasks.
    """
    length = len(sums)
    mean = np.array([s / n for s in sums])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((length, length))
        for batch in batches:
            y = _matrix(batch, length).astype(np.float64) - mean
            total += y.T @ y
        part = TaskContext.get().partitionId()
        for i in range(length):
            yield pa.RecordBatch.from_pydict({
                "i": pa.array([i], pa.int32()), "part": pa.array([part], pa.int32()), "salt": pa.array([part % GROUPS], pa.int32()),
                "row": pa.array([total[i].tolist()], pa.list_(pa.float64())),
            })

    products = fit.select("x").mapInArrow(multiply, "i int, part int, salt int, row array<double>")
    out = np.zeros((length, length))
    for r in _added(_added(products, ["i", "salt"]), ["i"]).collect():
        out[r.i] = r.row
    out /= n
    return (out + out.T) / 2


def _projected(n: int, sums: list[int], weights: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    mean = np.array([s / n for s in sums])
    return lambda x: (x.astype(np.float64) - mean) @ weights


def identity_error(fit: DataFrame, n: int, sums: list[int], weights: np.ndarray) -> float:
    """Largest absolute entry of the covariance of whitened vectors minus the identity."""
    k, project = weights.shape[1], _projected(n, sums, weights)
    if not k:
        return 0.0

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = project(_matrix(batch, len(sums)))
            if not len(w):
                continue
            mean = w.mean(axis=0)
            spread = (w - mean).T @ (w - mean)
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([float(len(w))]),
                "mean": pa.array([mean.tolist()], pa.list_(pa.float64())),
                "spread": pa.array([spread.ravel().tolist()], pa.list_(pa.float64())),
            })

    parts = staged(fit.select("x").mapInArrow(measure, "n double, mean array<double>, spread array<double>"))
    means = parts.agg(*[(F.sum(F.col("n") * F.get("mean", F.lit(a))) / n).alias(f"m{a}") for a in range(k)]).first()
    apart = lambda a: F.get("mean", F.lit(a)) - means[a]
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    found = parts.agg(*[(F.sum(F.get("spread", F.lit(a * k + b)) + F.col("n") * apart(a) * apart(b)) / n).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[i] - (a == b)) for i, (a, b) in enumerate(pairs))


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, written to the shared folder: several passes read it."""
    return staged(rows.select("x").distinct(), compression="zstd")


def train(vectors: DataFrame, components: int = 4, column: str = "embedding", id_column: str = "vec_id") -> Whitening | None:
    """Fit on every distinct vector; None if there is no usable one.

    Three passes over the list of distinct vectors: exact sums, products of centred rows, and the check of the result.
    """
    ship(vectors.sparkSession)
    rows, length = quantised(vectors, column, id_column)
    fit = fit_list(rows)
    n, sums = moments(fit, length)
    if not n:
        return None
    matrix = covariance(fit, n, sums)
    values, found = eigenvectors(matrix)
    k = min(components, length)
    made = Whitening(n, sums, np.maximum(values[:k], 0), found[:, :k], float(np.trace(matrix)), 0.0)
    made.identity_error = identity_error(fit, n, sums, made.weights()[:, made.has_variance()])
    return made


def whiten(vectors: DataFrame, model: Whitening | None, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """(id, deviation, whitened) of every usable row of ``vectors``, in components of falling variance.

    Rows whose vector is null or holds null or non-finite entries are left out; vectors that are shorter than the
    longest count as filled up with zeros, empty ones too. ``deviation`` is the sum of squares of n x - S over the
    dimensions, exact, null above 38 digits. A component without variance (all vectors equal, or fewer independent ones
    than components) has 0 throughout. Repeated rows give repeated results, a null id stays; other columns are not read.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, deviation decimal({_DIGITS},0), whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    ship(vectors.sparkSession)
    rows, _ = quantised(vectors, column, id_column)
    n, sums, length = model.n, model.sums, len(model.sums)
    project, total = _projected(n, sums, model.weights()), np.array(sums, object)
    far = max([abs(s) for s in sums], default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, length)
            widest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
            small = (n * widest + far) ** 2 * max(length, 1) < 1 << 63
            apart = n * x.astype(np.int64) - total.astype(np.int64) if small else n * x.astype(object) - total
            squares = (apart * apart).sum(axis=1)
            exact = [Decimal(int(s)) if int(s) < 10**_DIGITS else None for s in squares]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(exact, pa.decimal128(_DIGITS, 0)), pa.array(project(x).tolist(), pa.list_(pa.float64()))],
                ["id", "deviation", "whitened"],
            )

    return rows.mapInArrow(run, schema)
