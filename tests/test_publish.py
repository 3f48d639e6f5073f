"""Writes of a table survive a failure at any step, and numbers keep their digits."""

import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorpipe.sinks import publish, tables


def points(spark, *items, kind="double"):
    df = spark.createDataFrame([(f"2026-01-{d:02d} 00:00:00", v) for d, v in items], f"t string, value {kind}")
    return df.select(F.col("t").cast("timestamp_ntz").alias("ts"), "value")


def stored(spark, path):
    return sorted((r["ts"].day, r["value"]) for r in spark.read.parquet(path).collect())


class Failure(Exception):
    pass


def failing(monkeypatch, step):
    """Let the step-th change of files fail before it is made; returns how many were begun."""
    begun = [0]

    def wrap(name):
        real = getattr(publish._Table, name)

        def act(self, *args):
            if begun[0] == step:
                raise Failure
            begun[0] += 1
            return real(self, *args)

        monkeypatch.setattr(publish._Table, name, act)

    for name in ("delete", "move", "note"):
        wrap(name)
    return begun


OLD = [(1, 1.0), (2, 2.0), (3, 3.0)]


@pytest.mark.parametrize("options, new", [
    ({"policy": "replace", "start": "2026-01-02", "end": "2026-01-03"}, [(1, 1.0), (2, 20.0)]),
    ({"policy": "replace_all"}, [(2, 20.0)]),
])
def test_a_failure_at_any_step_loses_nothing(spark, tmp_path, monkeypatch, options, new):
    seen = set()
    tables.write_table(points(spark, *OLD), str(tmp_path / "old"))
    for step in range(100):
        path = shutil.copytree(tmp_path / "old", tmp_path / f"t{step}").as_posix()
        with monkeypatch.context() as patch:
            begun = failing(patch, step)
            try:
                tables.write_table(points(spark, (2, 20.0)), path, **options)
                done = True
            except Failure:
                done = False
        publish.recover(spark, path)
        found = stored(spark, path)
        assert found in (OLD, new), step
        seen.add(found == new)
        assert not [f for f in (tmp_path / f"t{step}").iterdir() if f.name.startswith(("_next", "_swap"))]
        if done:
            assert begun[0] > 4 and found == new
            break
    assert seen == {True, False}


def test_a_wider_type_is_swapped_in_or_not(spark, tmp_path, monkeypatch):
    for step in (3, 6, 9):
        path = str(tmp_path / f"w{step}")
        tables.write_table(points(spark, (1, 1), (2, 2), kind="long"), path)
        with monkeypatch.context() as patch:
            failing(patch, step)
            with pytest.raises(Failure):
                tables.write_table(points(spark, (3, 0.5)), path, policy="append")
        publish.recover(spark, path)
        assert stored(spark, path) == [(1, 1), (2, 2)]
        tables.write_table(points(spark, (3, 0.5)), path, policy="append")
        assert stored(spark, path) == [(1, 1.0), (2, 2.0), (3, 0.5)]


def test_digits_are_not_lost(spark, tmp_path):
    path = str(tmp_path / "d")
    odd = 2**53 + 1
    tables.write_table(points(spark, (1, odd), kind="long"), path)
    for policy in ("append", "replace"):
        with pytest.raises(ValueError, match="digits of value"):
            tables.write_table(points(spark, (2, 0.5)), path, policy=policy)
        assert stored(spark, path) == [(1, odd)]
    tables.write_table(points(spark, (2, 0.5)), path, policy="replace_all")
    for lost in (odd, 2**63 - 1):
        with pytest.raises(ValueError, match="digits of value"):
            tables.write_table(points(spark, (3, lost), kind="long"), path, policy="append")
    tables.write_table(points(spark, (3, 2**53), (4, None), kind="long"), path, policy="append")
    assert stored(spark, path)[:2] == [(2, 0.5), (3, 2.0**53)]
    assert tables.wider(T.LongType(), T.DecimalType(20, 4)) == T.DecimalType(23, 4)
    with pytest.raises(ValueError, match="no number type"):
        tables.wider(T.DecimalType(38, 0), T.DecimalType(10, 4))
