"""Exact and near copies, repeated passages, mixing and shards, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sensorpipe.llm import exact, fingerprint, graph, mixing, shard, simhash, spread, substring
from sensorpipe.llm.fuse import BinaryFuse


def roots(pairs, nodes):
    above = {n: n for n in nodes}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_filter_holds_all_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 10, 1000, 50_000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        made = BinaryFuse.from_bytes(BinaryFuse.build(keys).to_bytes())
        assert made.contains(keys).all()
        assert made.contains(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.02 or n < 10


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_exact(docs, batches):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for r in docs.collect():
        groups[(r.text or "").translate(lower)].append(r.doc_id)
    got = exact.exact_duplicates(docs, batches=batches).collect()
    assert len(got) == sum(map(len, groups.values()))
    by = defaultdict(list)
    for r in got:
        by[bytes(r.digest)].append(r)
    for text, ids in groups.items():
        rows = by[hashlib.sha256(text.encode()).digest()]
        keep = max((i for i in ids if i is not None), default=None)
        assert Counter(r.doc_id for r in rows) == Counter(ids)
        assert {(r.keep_id, r.group_size) for r in rows} == {(keep, len(ids))}
        assert [r.doc_id for r in rows if r.kept] == [keep]


def test_the_filters_decide(docs, monkeypatch):
    """With filters that turn everything away no batch finds an earlier one, and copies stay in each."""
    right = Counter((r.doc_id, r.group_size) for r in exact.exact_duplicates(docs).collect())
    monkeypatch.setattr(exact.BinaryFuse, "contains", lambda self, keys: np.zeros(len(keys), bool))
    monkeypatch.setattr(exact, "screen", lambda incoming, filters: incoming.select("digest").limit(0))
    got = exact.exact_duplicates(docs).collect()
    assert len(got) == docs.count() and Counter((r.doc_id, r.group_size) for r in got) != right


def test_exact_of_nothing(none):
    assert exact.exact_duplicates(none).count() == 0


def test_screen_loses_none(spark):
    held = spark.range(5000).selectExpr("unhex(sha2(cast(id as string), 256)) AS digest")
    new = spark.range(4000, 12000).selectExpr("unhex(sha2(cast(id as string), 256)) AS digest")
    found = exact.screen(new, exact.build_filters(held))
    assert found.join(held, "digest", "left_semi").count() == 1000
    assert found.count() < 1000 + 200


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(500, 560)] + [(1000, 1000 + i) for i in range(300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = roots(pairs, {x for p in pairs for x in p})
    assert all(got.get(n, n) == r for n, r in want.items())
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_pairs(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(300)}
    for v in list(values)[:60]:
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            values.add(v)
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(30)} | {0, 1, (1 << 64) - 1}
    values = sorted(values)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 3]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.similar_pairs(frame).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert roots(found, values) == roots(pairs, values)
    return len(found), len(pairs)


def test_similar_pairs_connect_what_all_pairs_connect(spark):
    found, pairs = check_pairs(spark)
    assert found < pairs / 2


def test_trie_goes_deeper_where_nodes_are_full(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PAIR_WORK", 400)
    check_pairs(spark)


def test_near_duplicates(docs):
    rows = docs.collect()
    prints = [fingerprint.simhash(r.text) for r in rows]
    top = roots([(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3], range(len(rows)))
    want = defaultdict(list)
    for i, r in enumerate(rows):
        want[top[i]].append(r.doc_id)
    smallest = {t: min((d for d in ids if d is not None), default=None) for t, ids in want.items()}
    got = simhash.near_duplicates(docs)
    assert Counter((r.doc_id, r.component_id) for r in got.collect()) == Counter((r.doc_id, smallest[top[i]]) for i, r in enumerate(rows))
    assert got.filter("kept").count() == len(want)
    assert Counter(r.h for r in got.select(simhash.hexadecimal("fingerprint").alias("h")).collect()) == Counter(f"{p:016x}" for p in prints)


def test_fingerprint_by_bits():
    import xxhash

    text = "A b c D a b c"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(5)]
    assert fingerprint.simhash(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 5)
    assert fingerprint.simhash(None) == fingerprint.simhash(" ") == 0
    assert fingerprint.simhash("One two") == xxhash.xxh64_intdigest(b"one two", 42)


def test_near_duplicates_of_nothing(none):
    assert simhash.near_duplicates(none).count() == 0


def without_repeats(rows, size=20):
    order = sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0))
    seen, out = set(), []
    for i in order:
        words = (rows[i].text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                gone[k : k + size] = [True] * size
            seen.add(window)
        out.append((rows[i].doc_id, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return Counter(out)


@pytest.mark.parametrize("chunk", [20, 1 << 20])
def test_repeats(docs, monkeypatch, chunk):
    monkeypatch.setattr(substring, "CHUNK_WORDS", chunk)
    got = substring.remove_repeats(docs).collect()
    assert Counter(tuple(r) for r in got) == without_repeats(docs.collect())


def test_repeats_among_rows_without_id(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(None, passage + " end"), (7, "begin " + passage), (None, passage)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert Counter(tuple(r) for r in got) == Counter([(None, 31, 30, "end"), (7, 31, 0, "begin " + passage), (None, 30, 30, "")])


@pytest.mark.parametrize("size", [0, 10**5, 10**9, 10**12])
@pytest.mark.parametrize("n", [1, 2, 3, 100, 8191])
def test_sketch_shares_are_read_as_written(size, n):
    plan = substring.sized(size)
    cells = np.unique(np.random.default_rng(n).integers(0, 1 << plan.block_bits, n).astype(np.uint64))
    cells = np.unique(np.r_[cells, np.uint64((1 << plan.block_bits) - 1)])
    assert (substring._read_cells(substring._write_cells(cells + np.uint64(3 << plan.block_bits), plan), plan) == cells.astype(np.int64)).all()


def test_sketch_shares_stay_small_in_large_tables():
    """Bytes that a window sends to one row of the sketch, for full chunks and the cells that a table of this size has."""
    cost = {}
    for size in (5 * 10**8, 10**12):
        plan = substring.sized(size)
        n = max(1, plan.chunk_words >> plan.cell_bits - plan.block_bits)
        cells = np.unique(np.random.default_rng(2).integers(0, 1 << plan.block_bits, n).astype(np.uint64))
        cost[size] = len(substring._write_cells(cells, plan)) / n
    assert cost[5 * 10**8] < 1.9 and cost[10**12] < 3


def test_repeats_of_nothing(none):
    assert substring.remove_repeats(none).count() == 0


def test_window_hashes_tell_windows_apart():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], np.uint64)
    for size in (1, 2, 3, 5):
        got = substring.window_hashes(words, size)
        want = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        assert len(got) == len(want)
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(got)) for j in range(i))


def test_shares_fill_up_to_the_caps(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, "e": 700}
    rows = spark.createDataFrame([(f"0{k}", v) for k, v in sizes.items()], "key string, source_size long")
    got = {r.key[1:]: r.target for r in mixing.targets(rows).collect()}
    weight, total, full = dict(zip(sizes, (5, 2, 1, 5, 2))), sum(sizes.values()), set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(w for s, w in weight.items() if s not in full)
        more = {s for s in sizes if s in full or weight[s] * level > 3 * sizes[s]}
        if more == full:
            break
        full = more
    assert got == pytest.approx({s: 3 * sizes[s] if s in full else weight[s] * level for s in sizes})
    assert sum(got.values()) == pytest.approx(total)


def test_mix(docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= min(3, int(rate) + 1)
    again = Counter((r.doc_id, r.size, r.copies) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == Counter((r.doc_id, r.size, r.copies) for r in got)
    taken = Counter()
    for r in got:
        taken[r.doc_id, r.size] += r.copies
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns
    assert sum(taken.values()) == emitted.count()
    assert mixing.mix(none).count() == mixing.emit(none).count() == 0


def test_copies_are_drawn_with_the_fraction_as_chance(spark):
    share = spark.range(20_000).select((mixing.draw("id") < 0.3).cast("int").alias("hit")).agg({"hit": "avg"}).first()[0]
    assert share == pytest.approx(0.3, abs=0.015)


def test_hypergeometric_follows_its_law():
    rng = random.Random(4)
    got = Counter(shard.hypergeometric(12, 9, 21, rng) for _ in range(20_000))
    from math import comb

    for k in range(10):
        assert got[k] / 20_000 == pytest.approx(comb(9, k) * comb(21, 12 - k) / comb(30, 12), abs=0.012)
    big = [shard.hypergeometric(1_000_000, 10**9, 39 * 10**9, rng) for _ in range(200)]
    assert np.mean(big) == pytest.approx(25_000, rel=0.005)


def test_shards_are_exact_and_mixed(spark, docs, none):
    rows = spark.range(4003).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 as int)) AS text", "1 AS shard", "2 AS slot")
    got = shard.shuffle_into_shards(rows, 7).toPandas()
    assert sorted(got.groupby("shard").size()) == [571] * 1 + [572] * 6
    assert all(sorted(part.slot) == list(range(len(part))) for _, part in got.groupby("shard"))
    assert sorted(got.doc_id) == list(range(4003))
    assert abs(np.corrcoef(got.doc_id, got.shard)[0, 1]) < 0.06 and abs(np.corrcoef(got.doc_id, got.slot)[0, 1]) < 0.06
    same = shard.shuffle_into_shards(docs, 3).toPandas()
    assert len(same) == docs.count() and same.groupby("shard").size().max() - same.groupby("shard").size().min() <= 1
    assert shard.shuffle_into_shards(none).count() == 0


def test_shards_do_not_follow_the_splits(docs, monkeypatch):
    monkeypatch.setattr(shard, "COPIES", 3)
    repeated = docs.unionByName(docs.filter("doc_id = 9")).unionByName(docs.filter("doc_id = 9 OR doc_id IS NULL"))
    placed = [sorted(map(str, shard.shuffle_into_shards(repeated.repartition(n), 5).collect())) for n in (1, 7)]
    assert placed[0] == placed[1]
    values = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in repeated.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in shard.shuffle_into_shards(repeated, 5).collect()) == values
    assert max(values.values()) > 3


def test_without_keeps_all_columns(docs):
    gone = exact.exact_duplicates(docs).filter("not kept")
    left = spread.without(docs, gone)
    assert left.columns == docs.columns and left.count() == docs.count() - gone.count()
    assert {r._row for r in left.collect()} == {-3}
