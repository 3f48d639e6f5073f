"""Near vectors where lists are full or evidence is scarce, against brute force."""

from collections import Counter

import numpy as np
import pytest

from sensorpipe.llm import neighbours


def brute(x, threshold=0.98):
    """(vec_id, links, component) of vectors of one label."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], len(x)).min(axis=1))
        if (lower == root).all():
            return Counter(zip(range(len(x)), near.sum(axis=1).tolist(), root.tolist()))
        root = lower


def found(spark, x):
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    return Counter(tuple(r) for r in neighbours.near_vectors(frame).collect())


@pytest.mark.parametrize("block, cells", [(8, 2), (1024, 1 << 14)])
def test_clusters_whose_lists_are_full_are_linked(spark, monkeypatch, block, cells):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "MOST_CELLS", cells, raising=False)
    rng = np.random.default_rng(12)
    a, b = np.eye(16)[:2]
    centres = [a, 0.985 * a + np.sqrt(1 - 0.985**2) * b]
    tight = [c + 0.004 * rng.standard_normal(16) for c in centres for _ in range(25)]
    chain = [np.cos(t) * np.eye(16)[4] + np.sin(t) * np.eye(16)[5] for t in np.linspace(0, 1.2, 120)]
    x = np.array(tight + chain + list(rng.standard_normal((30, 16))))
    want = brute(x)
    assert len({root for i, _, root in want if i < 50}) == 1 and min(n for i, n, _ in want if i < 50) >= 40
    assert found(spark, x) == want


def test_few_links_in_many_vectors_are_not_passed_unseen(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TABLES", 1)
    monkeypatch.setattr(neighbours, "AHEAD", 1)
    monkeypatch.setattr(neighbours, "AUDITED", 4)
    monkeypatch.setattr(neighbours, "MORE_ROUNDS", 1)
    rng = np.random.default_rng(13)
    x = rng.standard_normal((1500, 48))
    x[-40:] = x[:40] + 0.15 * rng.standard_normal((40, 48))
    want = brute(x)
    assert sum(n for _, n, _ in want) >= 70
    assert found(spark, x) == want


def test_very_large_and_very_small_vectors(spark):
    rows = [[1e-200, 1e-200], [1.0, 0.1], [1e200, 1e200], [2e200, 2e200], [5e-324, 0.0], [1.0, 0.0], [1.7e308, -1.7e308]]
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(frame).collect()}
    assert got == {0: (2, 0), 2: (2, 0), 3: (2, 0), 1: (2, 1), 4: (2, 1), 5: (2, 1), 6: (0, 6)}
