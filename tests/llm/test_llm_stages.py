"""Each pipeline stage against brute force on its own input, and the quality network against plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm_text import groups, leaks, reference  # noqa: F401

import corpus_pipeline
from prepmill.llm import quality, queries, toxicity

SMALL = "/root/testdata/sf0.001"


# --- pipeline --------------------------------------------------------------------------------------------


def kept_texts(texts, length=400):
    """The characters of which no byte lies in a repeated string of ``length`` bytes."""
    raws = [t.encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for text, raw in zip(texts, raws, strict=True):
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        left, at = [], 0
        for char in text:
            size = len(char.encode())
            if not gone[at : at + size].any():
                left.append(char)
            at += size
        out.append("".join(left))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """(name of the stage, rows before, rows after) as dictionaries of doc_id and text."""
    docs, out = queries.table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, docs, SMALL), "stage")
        rows = {r["doc_id"]: r for r in after.collect()}
        assert len(rows) == after.count()
        out[name] = {r["doc_id"]: r["text"] or "" for r in docs.collect()}, rows
        docs = after
    return out


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    docs, labels = queries.table(spark, SMALL, "documents"), queries.table(spark, SMALL, "labels")
    model = toxicity.fit(docs, labels, queries.fold("doc_id", 5) != 0)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert set(after) == {i for i in before if scores[i] < 0.5}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    assert np.mean([i not in after for i, v in toxic.items() if v == 1]) >= 0.8
    assert np.mean([i in after for i, v in toxic.items() if v == 0]) >= 0.97


def test_one_document_of_each_group_stays(stages):
    before, after = stages["n-gram Jaccard join"]
    assert set(after) == {least for _, _, least in groups(sorted(before.items()), 5, 80)}
    assert len(after) < len(before)


def test_repeated_strings_go(stages):
    before, after = stages["suffix-array dedup"]
    ids = sorted(before)
    expected = dict(zip(ids, kept_texts([before[i] for i in ids]), strict=True))
    assert {i: r["text"] or "" for i, r in after.items()} == expected


def test_contaminated_documents_go(spark, stages):
    before, after = stages["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SMALL, "benchmark").collect()]
    ids = sorted(before)
    found = leaks([before[i] for i in ids], items)
    assert set(after) == {i for i, row in zip(ids, found, strict=True) if not row[5]}


def test_the_rest_is_encoded(stages, reference):  # noqa: F811
    before, after = stages["byte-level BPE encoding and decoding"]
    assert set(after) == set(before)
    for i, row in after.items():
        assert list(row["ids"]) == reference.encode_ordinary(before[i]) and row["n_tokens"] == len(row["ids"])
        assert row["text_sha256"] == hashlib.sha256(before[i].encode()).hexdigest()


# --- quality network -------------------------------------------------------------------------------------


def network(seed=0):
    rng = np.random.default_rng(seed)
    return quality.Network(
        rng.normal(size=(256, quality.EMBEDDED)).astype(np.float32),
        rng.normal(size=(quality.WIDTH * quality.CHANNELS, quality.FILTERS)).astype(np.float32) * 0.2,
        rng.normal(size=quality.FILTERS).astype(np.float32) * 0.1,
        rng.normal(size=2 * quality.FILTERS),
        0.3,
    )


def plain_score(net, raw):
    """One text, byte by byte and filter by filter."""
    words = raw.split()
    rows, at = [], 0
    marks = [0] * len(raw)
    for k, word in enumerate(words):
        at = raw.index(word, at)
        if k and word == words[k - 1]:
            marks[at : at + len(word)] = [1] * len(word)
        at += len(word)
    for i, byte in enumerate(raw):
        row = [0.0] * quality.CHANNELS
        row[quality.CLASS[byte]] = 1.0
        row[quality.FIXED - 1] = float(marks[i])
        row[quality.FIXED :] = net.embedding[byte].tolist()
        rows.append(row)
    tops, start = [], 0
    while raw and (start == 0 or start + quality.WIDTH - quality.STRIDE < len(raw)):
        best = [0.0] * quality.FILTERS
        for position in range(quality.STEPS):
            first = start + position * quality.STRIDE
            seen = [rows[i] if i < len(raw) else [0.0] * quality.CHANNELS for i in range(first, first + quality.WIDTH)]
            active = np.array(seen).ravel() @ net.filters + net.offsets
            best = np.maximum(best, active)
        tops.append(best)
        start += quality.STRIDE * quality.STEPS
    pooled = np.concatenate([np.max(tops, 0), np.mean(tops, 0)]) if tops else np.zeros(2 * quality.FILTERS)
    return 1 / (1 + np.exp(-(pooled @ net.unit + net.bias)))


def test_network_equals_plain_loops():
    texts = [b"", b"a", b"go go stop", b"x" * 264, b"y" * 265, ("Été 12, no! no! " * 60).encode(), bytes(range(33, 127)) * 9]
    found = network().scores(texts)
    assert np.allclose(found, [plain_score(network(), t) for t in texts], atol=1e-4)


def test_embedding_slope_equals_differences():
    net, texts = network(1), [b"some words here", b"another text, longer " * 20]
    weight = np.random.default_rng(2).normal(size=quality.FILTERS)
    _, (codes, _, _, best, tops) = net.pooled(texts)
    slope = quality.embedding_slope(net, codes, best, weight * (tops > 0))
    for byte, axis in [(ord("e"), 0), (ord(" "), 2), (ord("t"), 3), (ord("Z"), 1)]:
        sides = []
        for step in (1e-3, -1e-3):
            moved = net.embedding.astype(np.float64)
            moved[byte, axis] += step
            other = quality.Network(moved, net.filters, net.offsets, net.unit, net.bias)
            sides.append((other.pooled(texts)[1][4].astype(np.float64) * weight).sum())
        assert slope[byte, axis] == pytest.approx((sides[0] - sides[1]) / 2e-3, rel=0.05, abs=0.05)


def test_junk_of_ordinary_letters_is_seen():
    """Words with their letters replaced by others have the same classes everywhere; only the bytes differ."""
    rng = random.Random(8)
    words = "the river runs under old stone bridges while people walk home with bread and some late evening news".split()
    prose = [" ".join(rng.choices(words, k=rng.randint(40, 120))) for _ in range(300)]
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if c != " " else c for c in t) for t in prose]
    texts = [t.encode() for pair in zip(prose, junk, strict=True) for t in pair]
    good = np.array([True, False] * 300)
    net = quality.train(texts[:400], good[:400])
    assert np.mean((net.scores(texts[400:]) >= 0.5) == good[400:]) >= 0.95
