"""Chat windows, WARC archives, classifiers, top-k search and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from prepmill.llm import chat, queries, quality, toxicity, voronoi, warc
from prepmill.llm.sql import SQL

FOLDER = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(SQL))
def test_equals_sql(spark, database, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), SQL[name], database) is None


# --- chat ------------------------------------------------------------------------------------------------

TOKENS = re.compile(chat.TOKEN)


def tokens(text):
    return len(TOKENS.findall(text)) + chat.OVERHEAD


def escaped(text):
    for plain, mark in chat.ESCAPES:
        text = text.replace(plain, mark)
    return text


def windows(turns, budget, history):
    """Windows of one conversation, turn by turn: (key, [(place, repeated, role, text)])."""
    lead = 1 if turns and turns[0][0] == "system" else 0
    given = tokens(turns[0][1]) if lead else 0
    stride, at, held, starts = max(1, budget - history - given), 0, {}, []
    for place, (role, text) in enumerate(turns, 1):
        if place <= lead:
            held.setdefault((0, 0), []).append((place, False, role, text))
            continue
        n = tokens(text)
        cell = at // stride
        key = (cell, int(at + n > (cell + 1) * stride))
        held.setdefault(key, []).append((place, False, role, text))
        starts.append((at, place, role, text, key))
        at += n
    for key, rows in held.items():
        begins = min((s[0] for s in starts if s[4] == key), default=0)
        rows += [(p, True, r, t) for a, p, r, t, _ in starts if a < begins <= a + history]
        if lead and key != (0, 0):
            rows.append((1, True, *turns[0]))
        rows.sort()
    return sorted(held.items())


def conversations():
    rng = random.Random(6)
    bits = ["a", "Bc", "</s>", "[INST]", "<|user|>", "\\l", "\\", "é🙂", " ", "\n", "|>", "x y z"]
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 12)):
            role = "system" if turn == 0 and conv % 3 else rng.choice(["user", "assistant", "assistant", "tool|", "<|>"])
            rows.append((conv, turn // 2 if conv % 5 == 0 else turn, role, "".join(rng.choices(bits, k=rng.randint(0, 30)))))
    rows += [(40, 0, "system", "alone"), (41, None, None, None), (41, 1, "assistant", None), (None, 0, "user", "who"), (None, 1, "assistant", "me")]
    rows += [(42, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(700)]
    return rows


@pytest.mark.parametrize(("budget", "history"), [(60, 20), (4096, 512), (30, 1)])
def test_windows_equal_a_walk_over_turns(spark, budget, history):
    rows = conversations()
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, stride string")
    written = chat.windows(frame.repartition(4), budget, history)
    found = {(r["conv_id"], r["stride"], r["alone"]): r for r in chat.read_back(written).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    expected = 0
    for conv, turns in by_conv.items():
        turns = [t[1:] for t in sorted(turns)]
        for key, own in windows(turns, budget, history):
            row = found[(conv, *key)]
            expected += 1
            text = "".join(f"<|{escaped(r)}|>{escaped(t)}</s>" for _, _, r, t in own)
            assert row["formatted"] == text
            assert [tuple(t) for t in row["turns"]] == [(r, t) for _, again, r, t in own if not again]
            assert row["targets"] == [t for _, again, r, t in own if r == "assistant" and not again]
            assert row["n_repeated"] == sum(again for _, again, _, _ in own)
            assert row["oversize"] == (row["n_tokens"] > budget)
    assert expected == len(found)
    report = {r["conv_id"]: r for r in chat.report(written).collect()}
    for conv, turns in by_conv.items():
        turns = [t[1:] for t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        row = report[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(learned)
        assert row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_runs_without_python_and_on_nothing(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report = chat.report(chat.windows(frame))
    assert report.count() == 0
    plan = report._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- WARC ------------------------------------------------------------------------------------------------


def test_archives_return_every_page(spark):
    long = "<p>" + "x" * 1200 + "é"
    rows = [(1, "http://a", long), (2, "http://b\r\nX: y", long), (9, None, long), (3, "u", None), (4, "u: v", ""), (5, "u", "short"), (6, "u", "short")]
    rows += [(None, "u", long), (7, "u", "x" * 1000), (8, "u", "x" * 1000), (8, "u", "x" * 1000), (10, "u", "y" * 999), (11, "u", "y" * 999)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    index = warc.write_archives(frame.repartition(3))
    found = sorted(map(tuple, warc.report(warc.read_records(index)).collect()), key=repr)
    revisits = {1: 9, 2: 9, 7: 8}
    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        expected.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if page in revisits else "response", revisits.get(page)))
    assert found == sorted(expected, key=repr)
    some = warc.read_records(index.filter("page_id in (2, 9)")).collect()
    assert {r["page_id"]: r["payload"] and bytes(r["payload"]).decode() for r in some} == {2: None, 9: long}
    assert warc.read_records(warc.write_archives(frame.limit(0))).count() == 0


def test_reading_tasks_follow_archive_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_RANGE", 1 << 12)
    monkeypatch.setattr(warc, "TASK_BYTES", 1 << 14)
    rng = random.Random(6)
    rows = [(i, "u", "".join(chr(rng.randint(33, 126)) for _ in range(rng.choice([0, 50, 900, 6000])))) for i in range(400)]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    assert index.select("archive").distinct().count() == 1
    total, longest = index.agg(F.sum("length"), F.max("length")).first()
    tasks = [sum(r["length"] for r in part) for part in warc.dealt(index).rdd.glom().collect()]
    assert len(tasks) == warc.reading_tasks(total, spark.sparkContext.defaultParallelism) >= total / warc.TASK_BYTES
    assert max(tasks) <= total / len(tasks) * 4 + longest
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_records(index).collect()} == {i: t for i, _, t in rows}
    assert [warc.reading_tasks(n, 8) for n in (0, 1, 3 * 2**12, 2**14 * 9)] == [1, 1, 3, 9]


# --- classifiers -----------------------------------------------------------------------------------------


def held_out(spark, name, label, folds, fold, threshold):
    documents, labels = queries.table(spark, "/root/testdata/sf0.1", "documents"), queries.table(spark, "/root/testdata/sf0.1", "labels")
    rows = queries.QUERIES[name](spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    rows = [r for r in rows if r["held_out"] and r[label] is not None]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % folds == fold for r in rows)
    assert all(r["predicted"] == int(r["score"] >= threshold) and 0 <= r["score"] <= 1 for r in rows)
    right = {v: np.mean([r["predicted"] == v for r in rows if r[label] == v]) for v in (0, 1)}
    assert documents.count() == queries.QUERIES[name](spark, "/root/testdata/sf0.1").count()
    return right


def test_toxicity_on_held_out_labels(spark):
    right = held_out(spark, "op5_toxicity", "toxic", 5, 0, 0.5)
    assert right[0] > 0.97 and right[1] > 0.85


def test_quality_on_held_out_labels(spark):
    right = held_out(spark, "op7_quality", "quality", 4, 2, 0.7)
    assert right[0] > 0.97 and right[1] > 0.97


def test_inserted_characters_do_not_hide_an_insult(spark):
    folder = "/root/testdata/sf0.1"
    model = toxicity.fit(queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels"), F.lit(True))
    clean = b"Thnd the that onanly, inthe and of erly the was. "
    score = lambda text: float(model.scores(model.decisions([text]))[0])
    assert score(clean) < 0.5 and score(b"") < 0.5 and score(clean * 400) < 0.5
    forms = ["moron", "MORON!", "mo-ron", "m.o.r.o.n", "mo*ron", "(moron)", "m o r o n", "m-o-r-o-n", "mo ron", "moro n", "m oron"]
    for form in forms:
        assert score(clean + form.encode() + b" and erly.") >= 0.5, form
        assert score(clean * 400 + form.encode() + b" and erly.") >= 0.5, form
    for form in ("morron", "mroon"):  # far above clean words, not always above one half, as the docstring says
        assert score(clean + form.encode() + b" and erly.") > 20 * score(clean), form
    for form in ("m*ron", "m0ron"):  # a letter replaced: not recognised, as the docstring says
        assert score(clean + form.encode() + b" and erly.") < 0.5, form


def test_few_labels_teach(spark):
    """A handful of toxic texts with one insult is enough, and rows that share an id count once."""
    rng = np.random.default_rng(3)
    words = ["stone", "river", "meadow", "cloud", "window", "garden", "lantern", "harbour", "winter", "pepper"]
    texts = [" ".join(rng.choice(words, 12)) for _ in range(40)]
    texts = [t + " scoundrel" if i % 8 == 0 else t for i, t in enumerate(texts)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 50 + [(1, texts[0])]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(documents, labels, F.lit(True))
    new = [b"river stone scoundrel", b"river scoun drel stone", b"window garden river stone"]
    assert (model.scores(model.decisions(new)) >= 0.5).tolist() == [True, True, False]


def test_subsequence_weights_equal_the_kernel():
    """The collapsed scan gives the kernel that a direct count over index triples gives."""

    def direct(a, b):
        def features(word):
            word, out = f"^{word}$", {}
            for i in range(len(word)):
                for k in range(i + 2, min(len(word), i + toxicity.REACH + 1)):
                    for j in range(i + 1, k):
                        key = word[i] + word[j] + word[k]
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
            return out

        x, y = features(a), features(b)
        return sum(v * y.get(k, 0) for k, v in x.items()) / np.sqrt(max(len(a) - 1, 1) * max(len(b) - 1, 1))

    words = ["idiot", "idoit", "clown", "clownish", "abc", "abcabcabc"]
    found = toxicity._Kernel([w.encode() for w in words[:3]]).of([w.encode() for w in words])
    expected = [[direct(a, b) for b in words[:3]] for a in words]
    assert np.allclose(found, expected, atol=1e-5)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_without_labels(spark, module):
    documents = spark.createDataFrame([(1, "a", 0.5), (1, "a", 0.5), (None, None, 0.1), (3, "", 0.2)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, toxic int, quality int")
    scored = module.score(documents, module.fit(documents, labels, F.lit(True)))
    assert scored.columns == ["doc_id", "score"] and scored.count() == 4
    assert module.score(documents.limit(0), module.fit(documents.limit(0), labels.limit(0), F.lit(True))).count() == 0


def test_chunks_cover_the_text():
    for size in (1, 11, 12, 13, 263, 264, 265, 266, 520, 5000):
        codes, repeated, counts = quality.chunked([bytes([97 + i % 26 for i in range(size)])])
        inputs = quality.windows(codes, repeated, np.zeros((256, quality.EMBEDDED)))
        seen = inputs.reshape(-1, quality.WIDTH, quality.CHANNELS)[:, :, 1].sum()
        assert counts[0] * quality.STRIDE * quality.STEPS + quality.WIDTH - quality.STRIDE >= size and seen >= size
    assert quality.chunked([b""])[2].tolist() == [0]


# --- top-k -----------------------------------------------------------------------------------------------


def best(rows, k):
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, w, strict=True)), j) for j, w in usable if j != i and len(w) == len(q))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "pivots"), [(4096, 64), (7, 4), (1, 1)])
def test_top_k_equals_all_scores(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(voronoi, "BLOCK", block)
    monkeypatch.setattr(voronoi, "SHARE", 2)
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=3) * 3)]) for i in range(0, 150)]
    rows += [(int(200 + i), [2.0, 2.0, 2.0]) for i in range(60)]
    rows += [(500, None), (550, [None, 1.0, 2.0]), (600, [float("nan"), 1.0, 2.0]), (650, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (700, []), (750, [float("inf"), 0.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    found = sorted(map(tuple, voronoi.top_k(frame, F.col("vec_id") % 50 == 0, pivots=pivots).collect()))
    assert found == best(rows, 5)


def test_cells_go_only_where_a_bound_reaches(spark, monkeypatch):
    """Three clusters far apart: each group of queries receives the cells of its own clusters alone, each of them once."""
    monkeypatch.setattr(voronoi, "SHARE", 4)
    rng = np.random.default_rng(3)
    corners = np.array([[90.0, 0, 0], [0, 90.0, 0], [0, 0, 90.0]])
    rows = [(i, [float(x) for x in corners[i % 3] + rng.normal(size=3) * 0.1]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    stored = {}
    keep = voronoi.materialize
    monkeypatch.setattr(voronoi, "materialize", lambda df, label: stored.setdefault(label, keep(df, label)))
    found = sorted(map(tuple, voronoi.top_k(frame, F.col("vec_id") % 50 == 0, pivots=12).collect()))
    assert found == best(rows, 5)
    cluster = {r["cell"]: r["vec_id"] % 3 for r in stored["cells"].select("cell", "vec_id").collect()}
    pairs = stored["routed"].select("home", "group", "part", "cell").distinct().collect()
    assert all(cluster[r["home"]] == cluster[r["cell"]] and r["home"] != r["cell"] for r in pairs)
    groups = {r["group"] for r in stored["floors"].select("group").collect()}
    copies = {(r["group"], r["part"], r["cell"]) for r in pairs}
    assert len(groups) >= 3 and len(copies) < len(groups) * len(cluster) / 2


def test_neighbouring_cells_share_a_group(monkeypatch):
    monkeypatch.setattr(voronoi, "SHARE", 10)
    points = [(0, 0), (1, 0), (0, 1), (50, 0), (51, 1), (0, 90)]
    known = voronoi.Pivots(points)
    group = voronoi.grouped(known, {0: 3, 1: 3, 2: 3, 3: 4, 4: 5, 5: 30, -4: 2})
    assert group[0] == group[1] == group[2] and group[3] == group[4] and len(set(group.values())) == 4
    assert set(group) == {0, 1, 2, 3, 4, 5, -4}


def test_top_k_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert voronoi.top_k(frame, F.col("vec_id") % 50 == 0).count() == 0


# --- pipeline --------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = queries.table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, before, FOLDER), "test")
        assert after.columns == columns
        left[name] = {r["doc_id"] for r in after.select("doc_id").collect()}
        before = after
    assert len(left["toxicity"]) > len(left["n-gram Jaccard join"]) > len(left["benchmark decontamination"]) > 0
    assert left["suffix-array dedup"] == left["n-gram Jaccard join"]
    last = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = last.collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(r["text_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in rows)


def test_pipeline_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (1, "", "en", "s", 0, 2), (2, "a b c", None, None, None, 3)],
        "doc_id long, text string, lang string, source string, n_chars long, spans int",
    )
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), "test")
    assert docs.count() == 4
