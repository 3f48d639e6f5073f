"""Divergence of sources and benchmark decontamination against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import BASE, SCHEMA, document
from pyspark.sql import functions as F

from sensorpipe.llm import decontamination as clean
from sensorpipe.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit_by_hand(rows, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        whole = Counter()
        for other, s in groups:
            if other == lang:
                whole.update(counts[lang, s])

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 1) // (total + len(kept)) for t in kept}

        p, q = shares(counts[lang, source]), shares(whole)
        parts = {"pair": [], "term": [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, source][t] and p[t] > q[t]]}
        for other, s in groups:
            if other == lang and s != source:
                r = shares(counts[lang, s])
                parts["pair"].append((sum((p[t] - r[t]) ** 2 // r[t] for t in kept), s))
        for part, items in parts.items():
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def corpus(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n long, id long, term string, total long, p long, bits long, chunk long, part string"
    return spark.createDataFrame([(i, *r, -1, -2, "own", -3, -4, -5, -6, "own") for i, r in enumerate(rows)], schema)


def made(seed, n, sources, vocabulary):
    rng = random.Random(seed)
    rows = [(None, "en", "s0"), ("", None, None), ("12 3.4", "xx", "bare"), ("Ünïcode ünïcode ÜNÏCODE", None, "s0"), ("word " * 3000, "en", "s1")]
    for _ in range(n):
        words = [f"t{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in (int(vocabulary * rng.random() ** 3) for _ in range(rng.randrange(1, 120)))]
        source = "hot" if rng.random() < 0.3 else f"s{rng.randrange(sources)}"
        rows.append((" ".join(w.upper() if rng.random() < 0.2 else w for w in words), rng.choice(["en", "de", None]), source))
    return rows + rows[10:20]


@pytest.mark.parametrize("block", [1, 4, 32])
def test_audit(spark, monkeypatch, block):
    monkeypatch.setattr(divergence.pair_values, "__defaults__", (block,))
    rows = made(1, 220, 5, 1500)
    assert sorted(tuple(r) for r in divergence.audit(corpus(spark, rows).repartition(3)).collect()) == audit_by_hand(rows)


def test_audit_hands_on_and_slices(spark, monkeypatch):
    monkeypatch.setattr(divergence, "REMEMBERED", 50)
    monkeypatch.setattr(divergence, "SLICE", 7)
    rows = made(2, 40, 2, 200)
    got = Counter()
    for r in divergence._counted(iter(corpus(spark, rows).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")]).toArrow().to_batches())):
        for x in r.to_pylist():
            got[x["lang"], x["source"], x["term"]] += x["n"]
    want = Counter()
    for text, lang, source in rows:
        want[lang or "", source or "", None] += 0
        for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)):
            want[lang or "", source or "", t] += 1
    assert got == want


def test_audit_limits_and_nothing(spark, none):
    rows = made(3, 60, 3, 300)
    got = divergence.audit(corpus(spark, rows), top=5)
    assert sorted(tuple(r) for r in got.collect()) == audit_by_hand(rows, 5)
    assert divergence.audit(none).count() == 0
    alone = spark.createDataFrame([("a b", "en", "x")] * 2, "text string, lang string, source string")
    assert divergence.audit(alone).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    n, total, terms = 3 * 10**12 + 7, 9 * 10**15 + 1, 12345
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p"), divergence.divergence(F.lit(10**9 + 1), F.lit(1)).alias("f")).first()
    assert row.p == 1 + 10**9 * (n + 1) // (total + terms) and row.f == 10**18


def windows_by_hand(docs, items, size):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    known = defaultdict(set)
    for i, text in items:
        words = split(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            known[tuple(words[k : k + n])].add(i)
    out = []
    for d, text in docs:
        words = split(text)
        hit, found = set(), set()
        for n in {len(w) for w in known}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in known:
                    hit.update(range(k, k + n))
                    found |= known[tuple(words[k : k + n])] - {None}
        out.append((d, len(words), len(hit), tuple(sorted(found))))
    return Counter(out)


ITEMS = [
    (1, "The committee met on Monday, to discuss the NEW budget for the coming year"), (2, None), (3, ""), (4, "..."), (5, "one two"), (6, "word5x5 word6x6 word7x7"),
    (7, "the new budget for the coming year and agreed on most of the points that were raised"), (7, "the new budget for the coming year and agreed on most of the points"),
    (None, "agreed on most of the points that were raised today"), (8, "straße École"), (9, "x x x x x x x x x x x x"),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(*i, "own", -1, -2) for i in ITEMS], "item_id long, text string, hash string, window long, len long")


@pytest.fixture(scope="module")
def training(spark, docs):
    more = [(500, "x " * 40, "a"), (501, "a " * 5000 + BASE + " b" * 300, "a"), (501, "one two one two", "a"), (502, f"{BASE}. {BASE}", None)]
    return docs.unionByName(spark.createDataFrame([document(*m) for m in more], SCHEMA))


@pytest.mark.parametrize("size,block,most", [(10, 4096, 500_000), (10, 7, 500_000), (3, 16, 500_000), (10, 4096, 5)])
def test_contaminated(training, benchmark, size, block, most):
    rows = training.collect()
    got = clean.contaminated(training, benchmark, size, block=block, most=most)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) == windows_by_hand([(r.doc_id, r.text) for r in rows], ITEMS, size)
    assert got.filter("n_hit <> aggregate(spans, 0, (n, s) -> n + s.end - s.start)").count() == 0


def test_equal_hashes_are_told_apart(training, benchmark, monkeypatch):
    want = windows_by_hand([(r.doc_id, r.text) for r in training.collect()], ITEMS, 10)
    monkeypatch.setattr(clean.F, "xxhash64", lambda *columns: F.size(columns[0]).cast("long"))
    got = clean.contaminated(training.filter("length(text) < 10000 OR text IS NULL"), benchmark)
    assert not Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()) - want


def test_nothing_to_scan_or_to_find(training, benchmark, none, spark):
    assert clean.contaminated(none, benchmark).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    got = clean.contaminated(training, empty)
    assert got.count() == training.count() and got.filter("n_hit > 0 OR size(items) > 0").count() == 0


def test_spans_and_documents_are_removed(training, benchmark, none):
    found = {r.row: r for r in clean.contaminated(training.withColumn("row", F.col("doc_id")), benchmark, number="row").collect()}
    cut = clean.decontaminate(training, benchmark)
    assert cut.columns == training.columns and cut.count() == training.count()
    before, after = {r.doc_id: r.text for r in training.collect()}, {r.doc_id: r for r in cut.collect()}
    assert after[1].text == "" and after[3].text == "" and after[9].text == "" and after[4].text is None
    assert after[500].text == " " and after[7].text.startswith("word0x0 word1x1 word2x2 word3x3 word4x4 word8x8")
    assert after[12].text == " and later"
    assert all(r.text == before[d] for d, r in after.items() if d is not None and not found[d].n_hit)
    assert {r._row for r in after.values()} == {-3}
    left = clean.decontaminate(training, benchmark, remove="documents")
    assert left.columns == training.columns
    assert left.count() == clean.contaminated(training, benchmark).filter("n_hit = 0").count()
    assert clean.decontaminate(none, benchmark).count() == 0
    with pytest.raises(ValueError):
        clean.decontaminate(training, benchmark, remove="some")


def test_scan_runs_without_python(spark, training, benchmark):
    known, _ = clean.benchmark_windows(benchmark)
    plan = clean._scan(training.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "text", known, [2, 10], 64)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert "Exchange hash" not in plan and "Sort" not in plan and "Cartesian" not in plan
