"""Rolling statistics and event segments against brute force, with and without hot series."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorpipe.operators.enrich import event_segments, rolling

START = datetime(2026, 1, 1)
SCHEMA = "device_id string, metric string, ts timestamp_ntz, value double, seq long"


def series(seed, n, span):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = None if rng.random() < 0.03 else START + timedelta(seconds=rng.randrange(span))
        rows.append((rng.choice(["d0", "d0", "d1", None]), "m", at, None if rng.random() < 0.1 else float(rng.randrange(100)), i))
    # Windows and blocks meet at whole multiples of the window; far away stands a row alone.
    return rows + [("d0", "m", START + timedelta(seconds=600 * k), float(k), n + k) for k in range(8)] + [("d1", "m", START + timedelta(days=900), 1.0, n + 8)]


def rolled(rows, seconds):
    out, by = [], {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for group in by.values():
        timed = sorted((r for r in group if r[2] is not None), key=lambda r: (r[2], r[4]))
        for r in group:
            if r[2] is None:
                out.append((r[4], None, None, None, None, None))
                continue
            inside = [x[3] for x in group if x[2] is not None and x[3] is not None and timedelta(0) <= r[2] - x[2] <= timedelta(seconds=seconds)]
            k = timed.index(r)
            passed = (r[2] - timed[k - 1][2]).total_seconds() if k else 0
            rate = (r[3] - timed[k - 1][3]) / passed if 0 < passed <= seconds and None not in (r[3], timed[k - 1][3]) else None
            out.append((r[4], len(inside), sum(inside) / len(inside) if inside else None, min(inside, default=None), max(inside, default=None), rate))
    return sorted(out)


@pytest.mark.parametrize("rows_per_task,slice_windows", [(4_000_000, 64), (4_000_000, 1), (40, 2)])
def test_rolling(spark, rows_per_task, slice_windows):
    rows = series(1, 400, 6000)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = rolling(frame, "10m", tie=["seq"], event_rate=0.5, slice_windows=slice_windows, rows_per_task=rows_per_task)
    assert got.columns == [*frame.columns, "count", "mean", "min", "max", "rate", "event"]
    found = sorted((r.seq, r["count"], r.mean, r.min, r.max, r.rate) for r in got.collect())
    want = rolled(rows, 600)
    assert [f[:2] + f[3:5] for f in found] == [w[:2] + w[3:5] for w in want]
    for k in (2, 5):
        assert [f[k] for f in found] == pytest.approx([w[k] for w in want])
    assert got.filter("event <> (abs(rate) > 0.5)").count() == 0


def test_rolling_without_tie_is_the_same_each_time(spark):
    rows = spark.createDataFrame([("d", "m", START + timedelta(seconds=i // 3), float(i), i) for i in range(60)], SCHEMA)
    runs = [sorted((r.seq, r.rate) for r in rolling(rows.repartition(n, "seq"), "10s").collect() if r.rate is not None) for n in (1, 5)]
    assert runs[0] == runs[1] and runs[0]


def test_rolling_of_many_rows_in_one_window_takes_linear_time(spark):
    def seconds(n):
        rows = spark.range(n).select(F.lit("d").alias("device_id"), F.lit("m").alias("metric"), F.expr("timestampadd(MILLISECOND, id, TIMESTAMP_NTZ '2026-01-01 00:00:00')").alias("ts"), (F.col("id") % 977).cast("double").alias("value"))
        begin = time.time()
        assert rolling(rows, "1h").agg(F.sum("count")).first()[0] == n * (n + 1) // 2
        return time.time() - begin

    seconds(1000)
    few, many = seconds(50_000), seconds(400_000)
    assert many < 8 * 2 * few + 5


def segmented(rows, start, end, least):
    out = []
    for device in {r[0] for r in rows}:
        event = None
        for r in sorted((r for r in rows if r[0] == device and r[2] is not None and r[3] is not None), key=lambda r: (r[2], r[4])):
            if event and r[3] < end:
                out.append((device, event, True))
                event = None
            elif event:
                event.append(r)
            elif r[3] >= start:
                event = [r]
        if event:
            out.append((device, event, False))
    found = [(d, e[0][2], e[-1][2], len(e), max(r[3] for r in e), sum(r[3] for r in e) / len(e), closed) for d, e, closed in out]
    return sorted((f for f in found if f[2] - f[1] >= least), key=str)


@pytest.mark.parametrize("rows_per_task", [4_000_000, 30])
@pytest.mark.parametrize("start,end,least", [(80, 30, None), (60, 60, "5m"), (100, 0, None), (0, 0, None)])
def test_event_segments(spark, rows_per_task, start, end, least):
    rows = series(2, 500, 20_000)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = event_segments(frame, start, end, min_length=least, tie=["seq"], rows_per_task=rows_per_task)
    found = sorted(((r.device_id, r.start, r.end, r.readings, r.peak, round(r.mean, 9), r.closed) for r in got.collect()), key=str)
    want = segmented(rows, start, end, timedelta(minutes=5) if least else timedelta(0))
    assert found == [(*w[:5], round(w[5], 9), w[6]) for w in want]


def test_events_that_cannot_be(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert event_segments(rows, 1).count() == 0
    with pytest.raises(ValueError):
        event_segments(rows, 1, 2)
    with pytest.raises(ValueError):
        event_segments(rows, 1, min_length="1mo")
    with pytest.raises(ValueError):
        rolling(rows, "1mo")
