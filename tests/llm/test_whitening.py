"""Whitening against exact fractions and a decomposition in double precision."""

import math
from fractions import Fraction

import numpy as np
import pytest

from sensorpipe.llm import queries, whitening
from sensorpipe.llm.eigen import eigenvectors

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, id string, part string"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0, "own", "own", "own", "own") for i, v in vectors], schema)


def some(seed, n, d):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) * np.linspace(2, 0.5, d) + np.linspace(-3, 3, d)
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(base)]
    return rows + [(1000, rows[0][1]), (1001, rows[0][1]), (0, rows[0][1]), (None, rows[1][1])]


BAD = [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, [1.0, None, 2.0, 0.0, 0.0, 0.0])]


def by_hand(rows):
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x.items()}
    white = {i: [sum(float(Fraction(n * c - s, n)) * vectors[k, j] for k, (c, s) in enumerate(zip(v, sums))) / math.sqrt(values[j]) for j in range(4)] for i, v in x.items()}
    return n, deviation, white, values / values.sum()


def test_whitened(spark):
    rows = some(1, 150, 6)
    table = frame(spark, rows + BAD).repartition(4)
    model = whitening.train(table)
    n, deviation, white, explained = by_hand(rows)
    got = whitening.whiten(table, model).collect()
    assert len(got) == len(rows) and model.n == n == 150
    sign = None
    for r in got:
        assert int(r.deviation) == deviation[r.id]
        sign = np.sign(np.array(r.whitened) * np.array(white[r.id])) if sign is None else sign
        assert np.array(r.whitened) * sign == pytest.approx(white[r.id], abs=1e-11)
    assert model.explained == pytest.approx(explained[:4], rel=1e-12)
    assert model.identity_error < 1e-12


def test_query(spark, tmp_path):
    rows = some(2, 80, 6)
    frame(spark, rows + BAD).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 4 * len(rows) and {r.component for r in got} == {1, 2, 3, 4}
    assert {r.n for r in got} == {80} and len({r.identity_error for r in got}) == 1


def test_ranks_that_lack(spark):
    """Fewer dimensions than components, constant columns, one vector, none at all, other lengths, and huge entries."""
    two = frame(spark, [(i, [float(i), 1.0]) for i in range(5)])
    model = whitening.train(two)
    assert [r.whitened[1] for r in whitening.whiten(two, model).collect()] == [0.0] * 5 and model.identity_error < 1e-12
    one = frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    model = whitening.train(one)
    assert [(int(r.deviation), r.whitened) for r in whitening.whiten(one, model).collect()] == [(0, [0.0, 0.0])] * 2
    assert model.n == 1 and model.explained == [0.0, 0.0] and model.identity_error == 0.0
    for nothing in ([], BAD):
        table = frame(spark, nothing)
        assert whitening.train(table) is None and whitening.whiten(table, None).count() == 0
    ragged = frame(spark, [(1, []), (2, [1.0]), (3, [1.0, 0.0]), (4, [0.0, 2.0])])
    assert whitening.train(ragged).n == 3 and whitening.whiten(ragged, whitening.train(ragged)).count() == 4
    bare = frame(spark, [(1, []), (2, [])])
    assert whitening.train(bare).n == 1 and [(int(r.deviation), r.whitened) for r in whitening.whiten(bare, whitening.train(bare)).collect()] == [(0, [])] * 2
    huge = frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [1e15, 0.0])])
    assert whitening.whiten(huge, whitening.train(huge)).count() == 3


def test_exact_beyond_64_bits(spark):
    big = frame(spark, [(1, [float(2**40)]), (2, [0.0]), (3, [1.0])])
    got = {r.id: int(r.deviation) for r in whitening.whiten(big, whitening.train(big)).collect()}
    total = 2**48 + 256
    assert got == {1: (3 * 2**48 - total) ** 2, 2: total**2, 3: (768 - total) ** 2}


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(0.5, 2, 40), [3, 2 + 1e-7, 2 + 5e-8, 2, 1, 1e-3, 1e-9, 0], [1, 1 - 1e-10, 1 - 2e-10, 0.5, 0.5, 0.5, 1e-6], [1] * 5,
        [*(1 + 1e-8 * np.arange(15)), *(0.3 + 1e-12 * np.arange(15))], [1e-30, 1e-31, 0], [7],
    ],
)
def test_eigenvectors_of_clusters(values):
    rng = np.random.default_rng(3)
    values = np.sort(np.asarray(values, float))[::-1]
    basis = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = eigenvectors(matrix)
    scale = np.abs(matrix).max()
    exact = matrix.astype(np.longdouble)
    assert got == pytest.approx(values, abs=1e-14 * scale) and (np.diff(got) <= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 4e-15
    assert np.abs(exact @ vectors - vectors * got).max() < 3e-16 * scale * math.sqrt(len(values))


def test_eigenvectors_of_nothing():
    assert eigenvectors(np.zeros((0, 0)))[1].shape == (0, 0)
    assert (eigenvectors(np.zeros((3, 3)))[1] == np.eye(3)).all()
    with pytest.raises(ValueError):
        eigenvectors(np.full((2, 2), np.nan))


def test_single_precision_alone_would_not_do():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(30, 30))
    matrix = a @ a.T
    start = np.linalg.eigh(matrix.astype(np.float32))[1][:, ::-1]
    _, vectors = eigenvectors(matrix)
    best = np.linalg.eigh(matrix)[1][:, ::-1]
    off = lambda v: np.abs(np.abs((v * best).sum(axis=0)) - 1).max()
    assert np.abs(start.T @ matrix @ start - np.diag(np.diag(start.T @ matrix @ start))).max() > 1e-6
    assert np.abs(vectors.T @ matrix @ vectors - np.diag(np.diag(vectors.T @ matrix @ vectors))).max() < 1e-12 and off(vectors) < 1e-12
