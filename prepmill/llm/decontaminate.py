"""Benchmark decontamination: a broadcast hash set of benchmark windows, scanned over documents.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A window is
``n`` consecutive words of an item; an item of fewer words is one window. The hashes of all windows
are broadcast, a task scans the word windows of its texts against them, and every hash hit is
verified word for word.

The broadcast holds about ``max_windows`` windows at most; more are stored in the order of their hashes and taken in
stretches of about that many. Each stretch scans the documents in a pass of its own, whose result is stored before the
next begins and whose broadcast is then released, with the same result.

Defined cases: null text has no words; an item without words has no window; null item ids count as no
item but their windows still hit; repeated rows are each judged; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.llm.textbytes import LOWER, chunks, joined, listed, row_hashes, span_hashes, tidy, word_spans
from prepmill.sources.storage import materialize

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True
FILTER_BITS = 22

SPANS = "array<struct<first:long,last:long,start:long,end:long>>"
OUTPUTS = ("n_words", "spans", "items")


def ascii_lower(text: Column) -> Column:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def benchmark_windows(benchmark: DataFrame, n: int = 10) -> DataFrame:
    """One row per distinct window and item: item_id text, length, window (words joined by a space)."""
    words = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD_PATTERN), F.lit(0))
    listed = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words"))
    length = F.least(F.size("words"), F.lit(n))
    first = F.explode(F.sequence(F.lit(1), F.size("words") - length + 1))
    return (
        listed.filter(F.size("words") > 0)
        .select("item_id", "words", length.alias("length"), first.alias("first"))
        .select(
            "item_id", "length", F.array_join(F.slice("words", F.col("first"), F.col("length")), " ").alias("window")
        )
        .distinct()
    )


def _hash_of(windows: list[str]) -> np.ndarray:
    out = np.zeros(len(windows), dtype=np.uint64)
    for i, window in enumerate(windows):
        data = np.frombuffer(window.encode(), dtype=np.uint8)
        out[i] = row_hashes(span_hashes(data, *word_spans(IS_WORD[data])), window.count(" ") + 1)[0]
    return out


class WindowSet:
    """Window hashes of one block, with the texts and items for the verification."""

    def __init__(self, rows: list):
        by_window: dict[str, list[str]] = {}
        for row in rows:
            by_window.setdefault(row.window, []).extend([] if row.item_id is None else [row.item_id])
        self.windows = list(by_window)
        self.items = list(by_window.values())
        self.lengths = sorted({w.count(" ") + 1 for w in self.windows})
        self.hashes = _hash_of(self.windows)
        self.by_hash: dict[int, list[int]] = {}
        for i, h in enumerate(self.hashes.tolist()):
            self.by_hash.setdefault(h, []).append(i)


def _scanner(block) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: WindowSet = block.value
        maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        maybe[known.hashes >> np.uint64(64 - FILTER_BITS)] = True
        for batch in batches:
            rows = {name: batch.column(name).to_pylist() for name in OUTPUTS}
            for first, group in chunks(listed(batch.column("text"))):
                _scan_group(known, maybe, rows, first, group)
            fields = {f.name: f for f in batch.schema}
            columns = [
                pa.array(rows[n], fields[n].type) if n in rows else batch.column(n) for n in batch.schema.names
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return scan


def _scan_group(known: WindowSet, maybe: np.ndarray, rows: dict, first: int, group: list[bytes]) -> None:
    data, text_starts = joined(group)
    data = LOWER[data]
    starts, ends = word_spans(IS_WORD[data])
    bounds = np.append(np.searchsorted(starts, text_starts), len(starts))
    for i, n in enumerate(np.diff(bounds).tolist()):
        rows["n_words"][first + i] = n
    words = span_hashes(data, starts, ends)
    hits: dict[int, list[tuple[int, int]]] = {}
    met: dict[int, set[int]] = {}
    for length in known.lengths:
        rolled = row_hashes(words, length)
        for at in np.flatnonzero(maybe[rolled >> np.uint64(64 - FILTER_BITS)]).tolist():
            same = known.by_hash.get(int(rolled[at]))
            if not same:
                continue
            text = int(np.searchsorted(bounds, at, side="right")) - 1
            if at + length > bounds[text + 1]:
                continue
            own = b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(at, at + length)).decode()
            for i in same:
                if known.windows[i] == own:
                    hits.setdefault(text, []).append((at, at + length))
                    met.setdefault(text, set()).add(i)
    for text, found in hits.items():
        rows["items"][first + text] = sorted({*rows["items"][first + text], *(x for i in met[text] for x in known.items[i])})
        base, zero = int(bounds[text]), int(text_starts[text])
        old = [(s["first"], s["last"] + 1) for s in rows["spans"][first + text] or []]
        merged = _merged(old + [(a - base, b - base) for a, b in found])
        rows["spans"][first + text] = [
            {
                "first": a,
                "last": b - 1,
                "start": int(starts[base + a]) - zero,
                "end": int(ends[base + b - 1]) - zero,
            }
            for a, b in merged
        ]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def scan_documents(
    documents: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    max_windows: int = 1_000_000,
    carried: list[str] | None = None,
) -> DataFrame:
    """The columns ``carried`` (doc_id and text at least, and no others by default) of each document, with its number
    of words (``n_words``), the runs of hit words (``spans``: word numbers and UTF-8 byte offsets) and the ids of the
    items with occurring windows (``items``, sorted as texts). Columns so named are replaced."""
    spark = documents.sparkSession
    marked = benchmark_windows(benchmark, n).withColumn("mark", F.xxhash64("window"))
    windows = materialize(marked.repartitionByRange("mark").sortWithinPartitions("mark"), "windows")
    blocks = max(1, math.ceil(windows.count() / max_windows))
    kept = [c for c in carried or ["doc_id", "text"] if c not in OUTPUTS]
    scanned = documents.select(
        *(F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in kept),
        F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {SPANS})").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    cuts = [2**64 * block // blocks - 2**63 for block in range(blocks + 1)]
    for block, (low, high) in enumerate(itertools.pairwise(cuts)):
        rows = windows.filter(F.col("mark").between(low, high - 1)).drop("mark").collect()
        known = spark.sparkContext.broadcast(WindowSet(rows))
        scanned = scanned.mapInArrow(tidy(_scanner(known)), scanned.schema)
        if block + 1 < blocks:
            scanned = materialize(scanned, "scanned")
            known.destroy()
    return scanned


def without_spans(scanned: DataFrame) -> DataFrame:
    """``scanned`` with the hit spans cut out of ``text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    raw, parts, last = texts[i].encode(), [], 0
                    for span in spans:
                        parts.append(raw[last : span["start"]])
                        last = span["end"]
                    texts[i] = b"".join([*parts, raw[last:]]).decode()
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return scanned.mapInArrow(cut, scanned.schema)


def without_documents(scanned: DataFrame) -> DataFrame:
    """``scanned`` without the documents that hold any window."""
    return scanned.filter(F.size("spans") == 0)


def report(scanned: DataFrame) -> DataFrame:
    """The counts of each document and a digest of its items."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)
    return scanned.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
