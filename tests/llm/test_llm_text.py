"""Decontamination, tokenisation, token counts, Jaccard join and suffix dedup against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from prepmill.llm import attribution, bpe, decontaminate, jaccard, suffixes, textbytes

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def documents(spark, texts, **more):
    rows = [(i, t, "n", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept string").repartition(3)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_word_hashes_do_not_depend_on_the_place():
    data, starts = textbytes.joined([b"one two", b"", b"two"])
    spans = textbytes.word_spans(data != 32)
    hashes = textbytes.span_hashes(data, *spans)
    assert starts.tolist() == [0, 8, 9]
    assert hashes[1] == hashes[2] != hashes[0]


# --- decontamination -------------------------------------------------------------------------------------


def leaks(texts, items, n=10):
    """What the contract asks of each document, the slow way."""
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).update([] if item is None else [str(item)])
    out = []
    for i, text in enumerate(texts):
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(words) - size + 1):
                own = windows.get(tuple(words[at : at + size]))
                if own is not None:
                    hit.update(range(at, at + size))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, bool(hit)))
    return out


@pytest.fixture(scope="module")
def leaky():
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(60)] + ["Été", "日本", "x9"]
    items = [(i, " ".join(rng.choices(pool, k=rng.randint(1, 30)))) for i in range(20)]
    items += [(20, None), (21, ""), (22, " -- "), (None, "only here now " * 4), (5, items[3][1]), (23, items[3][1])]
    texts = [None, "", "...", "w1"]
    for _ in range(80):
        words = rng.choices(pool, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            own = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(own) - 10))
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if rng.random() < 0.3 else w for w in own[a : a + rng.randint(8, 20)]]
        texts.append(rng.choice([" ", ", ", "\n"]).join(words))
    texts += [texts[10], "only here now " * 4]
    return texts, items


@pytest.mark.parametrize("most", [1_000_000, 40])
def test_leaks_equal_brute_force(spark, leaky, most):
    texts, items = leaky
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, words string")
    scanned = decontaminate.scan_documents(documents(spark, texts), benchmark, max_windows=most)
    found = sorted(map(tuple, decontaminate.report(scanned).collect()))
    assert found == leaks(texts, items)


def test_spans_and_documents_are_removed(spark, leaky):
    texts, items = leaky
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    scanned = decontaminate.scan_documents(documents(spark, texts), benchmark, carried=["doc_id", "text", "kept"])
    dirty = {r[0] for r in leaks(texts, items) if r[5]}
    assert {r["doc_id"] for r in decontaminate.without_documents(scanned).collect()} == set(range(len(texts))) - dirty
    cut = {r["doc_id"]: r["text"] for r in decontaminate.without_spans(scanned).collect()}
    assert all(cut[i] == texts[i] for i in range(len(texts)) if i not in dirty)
    hits = {r[0]: r[2] for r in leaks(texts, items)}
    for i in dirty:
        assert len(WORD.findall(cut[i])) == len(WORD.findall(texts[i])) - hits[i]


def test_empty_tables(spark, leaky):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    scanned = decontaminate.report(decontaminate.scan_documents(documents(spark, leaky[0]), benchmark))
    assert scanned.filter("contaminated").count() == 0 and scanned.count() == len(leaky[0])
    none = documents(spark, ["a"]).limit(0)
    assert decontaminate.scan_documents(none, benchmark).count() == 0
    assert bpe.encode(none, PATH).count() == 0
    assert attribution.token_counts(none, PATH).count() == 0
    assert jaccard.jaccard_components(none).count() == 0
    assert suffixes.cut_repeats(none).count() == 0


# --- tokenisation ----------------------------------------------------------------------------------------

PIECES = ["'", "s", "t", "re", "ve", "ll", "d", "m", "r", "e", "l", "v", " ", "  ", "\n", " \n", "\t", "\x85", "\x1c"]
PIECES += ["a", "Z", "é", "1", "23", "²", "!", "?", "…", " ", "日本", "🙂", "́", "'S", "''", "<|endoftext|>"]


def test_pieces_and_ids_equal_the_library(reference):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(20_000)]
    texts += ["ab" * 3000 + "x" * 500, "'", "  ", "'re", "'r", " 's"]
    ids, bounds = bpe.vocabulary(PATH).encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == reference.encode_ordinary(text), repr(text)


def test_scan_of_any_block_size_is_the_same():
    of_symbol, compose, _, _ = bpe._machine()
    ids = of_symbol[np.random.default_rng(2).integers(0, len(of_symbol), 1000)]
    expected, last = [], 0
    for i in ids:
        last = compose[last, i]
        expected.append(last)
    assert bpe._prefixes(ids, 128).tolist() == bpe._prefixes(ids, 7).tolist() == expected


def test_round_trip_and_offsets(spark, reference):
    texts = [None, "", " ", "Hello  world'll 日本\n\n x", "🙂" * 40, "Hello  world'll 日本\n\n x"]
    encoded = bpe.encode(documents(spark, texts), PATH)
    rows = {r["doc_id"]: r for r in encoded.collect()}
    for i, text in enumerate(texts):
        ids = reference.encode_ordinary(text or "")
        assert rows[i]["ids"] == ids
        assert rows[i]["ends"] == np.cumsum([len(reference.decode_single_token_bytes(t)) for t in ids]).tolist()
    decoded = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(encoded.select("doc_id", "ids"), PATH).collect()}
    assert decoded == {i: t or "" for i, t in enumerate(texts)}


@pytest.mark.parametrize("rule", attribution.RULES)
def test_token_counts_equal_a_walk_over_tokens(spark, reference, rule):
    texts = [None, "", "one line", "a\n\nb\n", "\n", " x \n y \n\n\n z", "日本\n語\n" * 5, "don't\nstop"]
    found = {r["doc_id"]: r for r in attribution.token_counts(documents(spark, texts), PATH, rule).collect()}
    for i, text in enumerate(texts):
        raw, at, crossing = (text or "").encode(), 0, 0
        starts = [0, *(k + 1 for k, b in enumerate(raw) if b == 10 and k + 1 < len(raw))]
        section = lambda byte: max(k for k, s in enumerate(starts) if s <= byte)  # noqa: B023, E731
        counts = [0] * len(starts)
        for token in reference.encode_ordinary(text or ""):
            size = len(reference.decode_single_token_bytes(token))
            held = [section(b) for b in range(at, at + size)]
            most = max(sorted(set(held)), key=held.count)
            counts[{"start": held[0], "end": held[-1], "most": most}[rule]] += 1
            crossing += len(set(held)) > 1
            at += size
        assert (found[i]["starts"], found[i]["tokens"], found[i]["crossing"]) == (starts, counts, crossing)
        assert found[i]["n_tokens"] == sum(counts)


def test_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError, match="rule"):
        attribution.token_counts(documents(spark, ["a"]), PATH, "middle")


# --- Jaccard join ----------------------------------------------------------------------------------------


def groups(rows, n=3, percent=90):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = {}
    for i, own in enumerate(sets):
        if rows[i][0] in ids:
            parent[root(i)] = root(ids[rows[i][0]])
        ids[rows[i][0]] = i
        for j in range(i):
            both = len(own & sets[j])
            if own and sets[j] and 100 * both >= percent * (len(own) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows)))


def near_copies(seed, sizes, edits):
    rng, rows = random.Random(seed), []
    for _ in range(25):
        base = [rng.choice("aa Bb cc dd ee".split()) + str(rng.randint(0, 20)) for _ in range(rng.choice(sizes))]
        for _ in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.choice(edits)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 5)}"
            rows.append((len(rows) * 7 % 5003, rng.choice([" ", "\n", "  "]).join(words)))
    return [*rows, (9000, None), (9001, ""), (9002, "  \n "), (9003, "one"), (9004, "ONE"), (9005, "one two")]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 100)])
def test_components_equal_all_pairs(spark, n, percent):
    rows = near_copies(n, [1, 2, 3, 8, 12, 15, 40, 150], [0, 0, 1, 1, 2, 3])
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id long").repartition(4)
    found = sorted(map(tuple, jaccard.jaccard_components(frame, n, percent).collect()))
    assert found == groups(rows, n, percent)


def test_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(12):
        rows.append((100 - k, " ".join(words)))
        words[5 * k] = f"new{k}"
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, jaccard.jaccard_components(frame).collect()))
    assert found == groups(rows) and len({r[2] for r in found}) == 1


def test_null_and_repeated_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (1, "e f g h"), (3, "e f g h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(frame).collect())
    assert found == {(1, 1): 3, (2, 1): 1, (3, 1): 1, (None, None): 1}
    kept = jaccard.one_per_group(frame)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 1]


def test_null_id_ahead_of_a_text_with_near_copies(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:59], "other"])
    rows = [(None, " ".join(words)), (5, " ".join(words)), (3, near), (None, near), (8, "far away from it all")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = Counter((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(frame).collect())
    assert found == {(5, 3): 1, (3, 3): 1, (8, 8): 1, (None, None): 2}
    assert sorted(r["doc_id"] or 0 for r in jaccard.one_per_group(frame).collect()) == [0, 0, 3, 8]


# --- suffix dedup ----------------------------------------------------------------------------------------


def test_cover_meets_every_shift():
    cover = suffixes.COVER
    assert {(a - b) % suffixes.PERIOD for a in cover for b in cover} == set(range(suffixes.PERIOD))


def repeats(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for k, raw in enumerate(raws):
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((k, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("part_rows", [4096, 5])
def test_repeats_equal_brute_force(spark, monkeypatch, part_rows):
    monkeypatch.setattr(suffixes, "PART_ROWS", part_rows)
    rng = random.Random(3)
    draw = lambda letters, a, b: "".join(rng.choices(letters, k=rng.randint(a, b)))
    base, texts = draw("abcdé ", 3000, 3000), [None, "", "q" * 399, "z" * 400, "w" * 401]
    for _ in range(40):
        kind = rng.random()
        if kind < 0.4:
            a = rng.randrange(2500)
            texts.append(draw("xyz é", 0, 600) + base[a : a + rng.randint(300, 900)] + draw("xyz", 0, 500))
        elif kind < 0.5:
            texts.append("q" * rng.randint(380, 900))
        elif kind < 0.6:
            texts.append(texts[-1])
        else:
            texts.append(draw("mnop é", 0, 2000))
    found = sorted(map(tuple, suffixes.report(suffixes.cut_repeats(documents(spark, texts))).collect()))
    assert found == repeats(texts)


def test_kept_text_is_whole_characters(spark):
    same = "é" * 250
    cut = suffixes.cut_repeats(documents(spark, ["x" + same + "end", "yy" + same]), as_text=True)
    assert sorted(r["kept"] for r in cut.collect()) == ["xend", "yy"]
    assert cut.columns == ["doc_id", "text", "n_words", "n_bytes", "n_removed", "n_spans", "kept"]
    assert cut.filter(F.col("n_spans") == 1).count() == 2
