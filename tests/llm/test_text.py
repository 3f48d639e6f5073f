"""Tokens, licenses, toxicity, quality, vectors and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SCHEMA, document
from sensorpipe.llm import bpe, licenses, neighbours, quality, toxicity
from sensorpipe.llm.license_rules import BASE, SHORT, gates, rules

PATH = public_tokenizers.path("word_bpe_49k.json")
MERGES = bpe.Merges(open(PATH, encoding="utf-8").read())
ENCODER = bpe.Encoder(MERGES)
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \t\n\x1c\x1f\x85 '’aAzZtTsSΣσİß1²é́<|>"), st.characters(exclude_categories=["Cs", "Cn"], max_codepoint=0x2FF)), max_size=60))
def test_encodes_as_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = ids_of(text)
    assert got == want
    half, state = len(got) // 2, bpe.Decoder(MERGES)
    assert state.feed(got[:half]) + state.feed(got[half:], True) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["ab", "thean", "abcdefghijklmnopqrstuvwxyz", "éèa"])
def test_long_words_in_bounded_memory(letters):
    rng = random.Random(7)
    word = "".join(rng.choice(letters) for _ in range(6000))
    assert ids_of(word) == LIBRARY.encode(word, add_special_tokens=False).ids
    most = 0

    def watched():
        nonlocal most
        for symbol in MERGES.symbols(word):
            yield symbol
            most = max(most, len(watch))

    watch, original = [], MERGES.merge
    MERGES.merge = lambda symbols: (watch.clear(), watch.extend(symbols), original(symbols))[-1]
    try:
        assert list(MERGES.stream(watched())) == ids_of(word)
    finally:
        del MERGES.merge
    assert most <= 2 * (MERGES.lookahead + MERGES.longest)


def test_text_in_slices(monkeypatch):
    text = " ".join(f"word{i}, <|endoftext|>" for i in range(300))
    whole = ids_of(text)
    monkeypatch.setattr(bpe, "SLICE", 7)
    assert ids_of(text) == whole == LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_word_and_every_token_takes_the_way_of_the_method(docs, monkeypatch):
    words, ids, stream, feed = Counter(), [], bpe.Merges.stream, bpe.Decoder.feed
    own = bpe.Encoder(MERGES)
    monkeypatch.setattr(bpe.Merges, "stream", lambda self, symbols: stream(self, (words.update(["symbol"]) or s for s in symbols)))
    monkeypatch.setattr(bpe.Decoder, "feed", lambda self, some, last=False: (ids.extend(some), feed(self, some, last))[1])
    text = "The budget, the plan and the coming year: 12.5 euro"
    n, *_ = bpe._round_trip(own, text, False)
    assert words["symbol"] == len("".join(dict.fromkeys(bpe.PATTERN.findall(text.lower()))).encode())
    assert ids == np.frombuffer(own.encode(text), "<u4").tolist() and n == len(ids)


def test_text_without_blanks_leaves_in_pieces():
    text = "ab,cd" * 200_000
    pieces = [len(p) // 4 for p in ENCODER.pieces(text)]
    assert max(pieces) <= bpe.PIECE and sum(pieces) == len(LIBRARY.encode(text, add_special_tokens=False).ids)
    word = "theandof" * 20_000
    pieces = list(ENCODER.pieces(word))
    assert max(map(len, pieces)) == 4 * bpe.PIECE and len(pieces) > 2
    assert np.frombuffer(b"".join(pieces), "<u4").tolist() == LIBRARY.encode(word, add_special_tokens=False).ids


def test_decodes_bytes_of_split_characters():
    state = bpe.Decoder(MERGES, library=False)
    ids = ids_of("naïve 😀 <|endoftext|> ok")
    assert "".join(state.feed([i]) for i in ids) + state.feed([], True) == "naïve 😀 <|endoftext|>ok "


def test_token_frames(docs, none):
    got = bpe.tokens(docs, PATH)
    assert {"n_tokens", "ids", "lang", "score"} <= set(got.columns)
    want = Counter()
    for r in docs.collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == want
    back = bpe.decode(bpe.encode(docs, PATH), PATH, library=False)
    assert back.filter("doc_id = 9").first().text == "one two "
    assert bpe.tokens(none, PATH).count() == bpe.decode(bpe.encode(none, PATH), PATH).count() == 0


def kept_detections(text):
    """All matches of all rules, whatever the gates say, without those inside another of a better or the same priority."""
    text = text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    found = [(m.start(), -m.end(), r.priority, i, r.label) for i, r in enumerate(rules()) for m in re.finditer(r.pattern, text, re.ASCII)]
    out = []
    for d in sorted(found):
        if not any(e[0] <= d[0] and e[1] <= d[1] and e[2] <= d[2] and e < d for e in found if e != d):
            out.append((d[0], -d[1], d[2], d[4]))
    return out


LICENSE_TEXTS = [
    None, "", "MIT License", "the mit  license\nand MIT-LICENSE.", "Licensed under the Apache License, Version 2.0 (the License)", "cc_by CC BY-SA 4.0 cc-by-nc-3.0 ccby éCC by",
    "SPDX-License-Identifier: GPL-2.0-or-later\nGNU General Public License version 3, or GNU Lesser General Public License v2.1", "https://creativecommons.org/licenses/by-nc/4.0/ Creative Commons Attribution-NonCommercial 4.0",
    "Redistribution and use in source and binary forms ... 3-clause BSD; all rights reserved. All rights reserved", "gpl gplv3 GPL-2 lgpl 2.1 agpl-3.0 MPL 2.0", "plain words without anything", "general public license gnu general public license " * 40,
]


def test_licenses(spark, none):
    frame = spark.createDataFrame([(i, t, 5) for i, t in enumerate(LICENSE_TEXTS)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in licenses.scan(frame).collect()}
    word, lower = re.compile(licenses.WORD), str.maketrans(licenses.UPPER, licenses.LOWER)
    summary = {r.doc_id: r for r in licenses.summary(licenses.scan(frame)).collect()}
    for i, text in enumerate(LICENSE_TEXTS):
        words = word.findall((text or "").translate(lower))
        at = {label: [k for k in range(len(words)) if words[k : k + len(p.split())] == p.split()] for label, p in BASE.items()}
        every = sorted(k for places in at.values() for k in places)
        s = summary[i]
        assert (s.n_words, s.n_base) == (len(words), len(every))
        assert (s.first_word, s.last_word) == ((every[0], every[-1]) if every else (None, None))
        base = sorted(label for label, places in at.items() if places)
        assert s.base_labels == ",".join(base)
        assert sorted((d.start, d.end, d.priority, d.label) for d in got[i].detections) == sorted(kept_detections(text or ""))
        assert s.labels == ",".join(sorted({*base, *(d[3] for d in kept_detections(text or ""))}))
        assert 0 <= s.score <= 1 and (s.score > 0) == bool(s.labels)
    assert licenses.summary(licenses.scan(none)).count() == 0


def test_license_gates_let_every_rule_through(spark):
    assert len(rules()) > 400
    for r in rules():
        assert any(g in r.keyword for g in gates()) or re.search(SHORT, f"{r.keyword} 2.0", re.ASCII) or r.keyword == "cc", r
    frame = spark.createDataFrame([(r.keyword.replace(" ", "\n * ") + (" by 2.0" if r.keyword == "cc" else " 2.0"),) for r in rules()], "text string")
    assert frame.filter(~licenses._candidate(frame["text"])).collect() == []


WRAPPED = {
    "GNU Lesser General Public\n License version 2.1": "lgpl,lgpl-2.1",
    "Mozilla Public\nLicense, v. 2.0": "mpl,mpl-2.0",
    "the BSD\nlicense": "bsd",
    "/*\n * Permission is hereby granted, free of\n * charge, to any\n * person obtaining a copy": "mit",
    " * Licensed under the Apache\n * License, Version\n * 2.0": "apache,apache-2.0",
    "it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of\n# the License": "gpl,gpl-2.0",
    "Neither the name of X nor the names of its\n   contributors may be used to endorse\nor promote products": "bsd-3-clause",
    "Altered source versions must be\nplainly marked as such": "zlib",
    "a simple reply, replaced by examples of a couple of words": "",
}


def test_wrapped_notices(spark):
    frame = spark.createDataFrame(list(enumerate(WRAPPED)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(frame).collect()}
    for i, (text, labels) in enumerate(WRAPPED.items()):
        found = {d.label for d in got[i].detections}
        assert set(filter(None, labels.split(","))) - found <= {labels.split(",")[0]} and bool(found) == bool(labels), (text, found)
        assert labels.split(",")[-1] in found | {""}
        assert sorted((d.start, d.end, d.priority, d.label) for d in got[i].detections) == sorted(kept_detections(text))


def test_license_of_a_very_long_text(spark):
    notice = "MIT License. Mozilla Public\nLicense 2.0 and words that say nothing at all; all rights reserved. "
    long = notice * 2_000 + "plain words " * 400_000
    frame = spark.createDataFrame([(1, long)], "doc_id long, text string")
    row = licenses.scan(frame).first()
    assert len(row.detections) == 6_000 and row.n_words == len(re.findall(licenses.ANY_WORD, long))
    assert sorted((d.start, d.end, d.priority, d.label) for d in row.detections if d.start < 3 * len(notice)) == sorted(kept_detections(notice * 3))


def labelled(spark, n=600):
    rng, plain = random.Random(5), [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [rng.choice(plain) for _ in range(40)]
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(["zorgface", "blimpet", "idiot"]))
        rows.append(document(i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    rows += [document(None, None), document(n, ""), document(n, "")]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*labels, (None, 1, None), (n + 5, 0, 1)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, none):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels, rounds=5)
    assert {"zorgface", "blimpet", "idiot"} <= model.lexicon.keys() and not any(w.startswith("w1") for w in model.lexicon)
    got = toxicity.score(docs, model)
    assert got.columns == [c for c in docs.columns if c not in ("text", "score")] + ["score"]
    held = {r.doc_id: r.score for r in got.filter(toxicity.remainder() == 0).collect()}
    assert len(held) > 80 and all(0 <= s <= 1 for s in held.values())
    assert np.mean([(s >= 0.5) == (i % 4 == 0) for i, s in held.items() if i is not None and i < 600]) > 0.95
    assert got.count() == docs.count()
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(docs, toxicity.train(none, labels)).agg({"score": "max"}).first()[0] == 0.0


def test_toxic_features():
    lexicon = {"fool": 2.0, "blim*": 3.0}
    shown = toxicity.features("You FOOL!! blimpets", lexicon)
    assert shown[2] == pytest.approx(2 / 3) and shown[5] == 3.0
    assert len(toxicity.features(None, lexicon)) == len(shown) == len(toxicity.features("x" * 100_000, lexicon))


def test_em_finds_who_is_right():
    rng = np.random.default_rng(6)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.9, 0.8, 0.6, 0.85])
    votes = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.3] = quality.SILENT
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = quality.expectation_maximisation(patterns, counts.astype(float))
    assert found.share == pytest.approx(0.7, abs=0.03)
    said = found.says[1, :, 2] / found.says[1, :, 1:].sum(axis=1)
    assert said == pytest.approx(right, abs=0.05)


def test_quality(spark, docs, none):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "river", "house", "green", "walked", "slowly", "morning", "because"]) + str(rng.randrange(40)) * (rng.random() < 0.1) for _ in range(80)) + "." for _ in range(150)]
    bad = ["SPAM!! " * 50, "a | b | c | " * 30, "### $$$ %%% " * 40]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(good + [f"{b}{i}" for i in range(20) for b in bad])], "doc_id long, text string")
    scored = {r.doc_id: r.score for r in quality.score(frame, quality.train(frame)).collect()}
    assert np.mean([scored[i] >= 0.5 for i in range(150)]) > 0.95
    assert np.mean([scored[i] < 0.5 for i in range(150, 210)]) > 0.95
    model = quality.train(docs)
    again = quality.score(docs, model).collect()
    assert len(again) == docs.count() and all(r.score == 0 for r in again if r.doc_id in (4, 5, 6))
    assert quality.score(none, quality.train(none)).count() == 0
    more = frame.withColumns({"key": F.lit(1), "votes": F.lit("x"), "index": F.lit(2.0), "score": F.lit(None)})
    alike = quality.train(more)
    assert (alike.weight == quality.train(frame).weight).all()
    twice = quality.score(more.union(more), alike).collect()
    assert len(twice) == 2 * len(scored) and all(r.score == scored[r.doc_id] for r in twice)


def vectors(spark):
    rng = np.random.default_rng(9)
    rows, centre = [], rng.standard_normal((3, 16))
    for i in range(260):
        v = centre[i % 3] + rng.standard_normal(16) * (0.05 if i < 90 else 3)
        rows.append((i, v.tolist(), i % 2, "x"))
    rows += [(300 + i, rows[i][1], rows[i][2], "x") for i in range(12)] + [(400, [2 * x for x in rows[0][1]], rows[0][2], "x")]
    rows += [(500, None, 1, "x"), (501, [0.0] * 16, 1, "x"), (502, [float("nan")] * 16, 1, "x"), (503, [None] * 16, 1, "x"), (504, [float("inf")] * 16, 1, "x")]
    rows += [(505, rows[0][1], None, "x"), (506, [], 1, "x"), (507, [1.0, 2.0], 1, "x"), (507, [1.0, 2.0], 1, "x"), (None, rows[0][1], rows[0][2], "x"), (None, None, None, "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kind string")


@pytest.mark.parametrize("block", [8, 1024])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    frame = vectors(spark)
    rows = frame.collect()
    usable = [r.label is not None and bool(r.embedding) and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding) for r in rows]
    linked = lambda a, b: a.label == b.label and len(a.embedding) == len(b.embedding) and np.dot(a.embedding, b.embedding) / np.linalg.norm(a.embedding) / np.linalg.norm(b.embedding) >= 0.98
    near = {i: {j for j in range(len(rows)) if j != i and usable[i] and usable[j] and linked(rows[i], rows[j])} for i in range(len(rows))}
    want = Counter()
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        want[r.vec_id, len(near[i]), min((rows[j].vec_id for j in seen if rows[j].vec_id is not None), default=None)] += 1
    assert Counter(tuple(r) for r in neighbours.near_vectors(frame).collect()) == want
    assert neighbours.near_vectors(frame.limit(0)).count() == 0


def test_pipeline(spark, docs, tmp_path, none):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mix_sources", "bpe"]
    extra, labels = labelled(spark, 200)
    docs.unionByName(extra.withColumn("doc_id", extra.doc_id + 1000)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("doc_id", labels.doc_id + 1000).write.parquet(f"{tmp_path}/labels.parquet")
    now, counts = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        counts.append(now.count())
        if i:
            assert now.columns == docs.columns
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
    assert counts[0] > counts[1] > counts[2] > counts[3]
    assert Counter(r.ids_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == Counter(r.ids_sha256 for r in now.collect())


def test_pipeline_of_nothing(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
