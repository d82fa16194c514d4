"""Removal of long repeated byte strings by sampled suffixes of a difference cover.

Two occurrences i and j of a string of ``length`` bytes have a common offset d below the period of
the cover such that i+d and j+d are both sampled, so equal strings always share a sampled suffix with
an equal prefix of ``length - period + 1`` bytes. The rounds are those of the distributed difference-cover
suffix sort, with one replacement, stated plainly: **no order of suffixes is built**. Where the sort would place equal prefixes side
by side and compare neighbours, prefixes are hashed, hashes are grouped in buckets over the cluster, and those met twice are
kept. The question is only which prefixes of one fixed length are equal, for which their order is not needed, and the sort
does not fit the budget of the check: every position would have to carry its rank pair through at least one shuffle, 16 bytes
a byte of text, against 4 times the input in all; the grouping writes 0.5 bytes of names a byte.

1. Sampled suffixes (17 of 273) are named by hashes of their prefixes; names that occur once are settled. As the wanted depth is
   finite, there is no recursion.
2. The remaining suffixes, sampled or not, that may begin a repeated string are those up to 272 bytes before a repeated name.
3. Their ``length``-byte prefixes are grouped: an equal one marks all bytes of the string. Stretches between content-chosen anchors go
   first, as one string each: a stretch that occurs twice settles all windows in it. Only windows outside such stretches ask
   one by one, and one part for each repeated stretch tells its windows, so that those who ask learn of them.

The documents are stored once in parts of about ``PART_BYTES`` (``PART_ROWS`` rows at most), bucketed by part, so texts are never shuffled. A
part sends each name once (twice if it occurs in the part more than once), so a string that a third of all documents holds costs one or
two entries per part, and buckets of names are even whatever the text; their number follows the bytes of all texts, so that a bucket
holds some 2**24 names and the 32 bits that are kept of a name within a bucket add few candidates. Equality is that of 64-bit hashes:
of windows modulo 2**64, whose systematic collisions need 1,024 bytes and more, of stretches modulo a prime.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; repeated rows are
separate documents, so each loses what they share; a column named like an output is replaced by it, other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from prepmill.llm.buckets import bucketed
from prepmill.llm.textbytes import chunks, give_back, joined, listed, mixed, powers, prefix_sums, prime_hashes, tidy
from prepmill.sources.storage import materialize

PART_ROWS = 4096
PART_BYTES = 8 << 20
#: Bytes of text whose names share a bucket.
BUCKET_BYTES = 1 << 28
#: A perfect difference set, every shift modulo 273 is a difference of two members.
PERIOD = 273
COVER = [1, 2, 4, 8, 16, 32, 64, 91, 117, 128, 137, 182, 195, 205, 234, 239, 256]
#: Stretches between anchors are compared whole; about one position in so many is an anchor.
ANCHOR_EVERY = 64
ANCHOR_BYTES = 16
SENT = "__part long, bucket int, hashes binary, kind string"
OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept")


def _window_hashes(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    _, inverse = powers(len(sums))
    return mixed((sums[at + length] - sums[at]) * inverse[at])


def _places(group: list[bytes], starts: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a string of ``length`` bytes fits within its text."""
    sizes = np.array([len(x) for x in group], dtype=np.int64)
    counts = np.maximum(sizes - length + 1, 0)
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return first + np.arange(counts.sum())


def _sampled(group: list[bytes], starts: np.ndarray, length: int) -> np.ndarray:
    """Sampled positions with a whole prefix of ``length - PERIOD + 1`` bytes, of texts that are long enough."""
    depth = length - PERIOD + 1
    found = []
    for text, start in zip(group, starts.tolist(), strict=True):
        if len(text) >= length:
            rows = np.arange(0, len(text), PERIOD)[:, None] + np.array(COVER)
            flat = rows.ravel()
            found.append(start + flat[flat <= len(text) - depth])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _send(
    part: int, hashes: np.ndarray, buckets: int, width: type, kind: str = "asked"
) -> Iterator[tuple[int, int, bytes, str]]:
    """Each distinct hash once, or twice if it occurs more often, by bucket."""
    hashes = np.sort(hashes)
    first = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
    distinct, more = hashes[first], np.append(~first[1:], False)[: len(hashes)][first]
    bucket = (distinct % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    distinct, more, bucket = distinct[order], more[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.int32))
    values = (distinct >> np.uint64(64 - 8 * np.dtype(width).itemsize)).astype(width)
    for b in np.flatnonzero(np.diff(edges)).tolist():
        own = values[edges[b] : edges[b + 1]]
        twice = own[more[edges[b] : edges[b + 1]]]
        yield part, b, np.concatenate([own, twice]).tobytes(), kind


def _as_batch(rows: list[tuple[int, int, bytes, str]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.string())
    names = ["__part", "bucket", "hashes", "kind"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _send_names(length: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.asarray(batch.column(0))
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                names = []
                for _, group in chunks(listed(batch.column(1).slice(a, b - a))):
                    data, starts = joined(group)
                    at = _sampled(group, starts, length)
                    names.append(_window_hashes(prefix_sums(data), at, length - PERIOD + 1))
                rows = list(_send(int(parts[a]), np.concatenate(names), buckets, np.uint32))
                yield from _as_batch(rows).to_batches()

    return run


def _repeated(width: type, kind: str):
    """Of the hashes of a bucket, those that occur more than once, back to each part that asked for them, as ``kind``.
    Segments also go, as "owned", to one of the parts that have them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("__part")
        sent = [np.frombuffer(x, dtype=width) for x in table.column("hashes").to_pylist()]
        told = [x for x, k in zip(sent, table.column("kind").to_pylist(), strict=True) if k == "told"]
        every = np.sort(np.concatenate([*sent, *told]))
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        owned, rows = np.zeros(len(repeated), dtype=bool), []
        columns = (table.column(c).to_pylist() for c in ("__part", "bucket", "kind"))
        for part, bucket, asked, own in zip(*columns, sent, strict=True):
            if asked != "asked":
                continue
            own = np.unique(own)
            found = own[_member(own, repeated)]
            if len(found):
                rows.append((part, bucket, found.tobytes(), kind))
            if len(found) and kind == "segment":
                at = np.searchsorted(repeated, found)
                mine = found[~owned[at]]
                owned[at] = True
                if len(mine):
                    rows.append((part, bucket, mine.tobytes(), "owned"))
        return _as_batch(rows)

    return run


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


class _Known:
    """Hashes that a part got back, as bucket and value in one number, behind a bitmap."""

    def __init__(self, table: pa.Table, buckets: int, kind: type):
        self.buckets, self.shift = np.uint64(buckets), np.uint64(64 - 8 * np.dtype(kind).itemsize)
        got = [np.zeros(0, dtype=np.uint64)]
        for bucket, raw in zip(table.column("bucket").to_pylist(), table.column("hashes").to_pylist(), strict=True):
            values = np.frombuffer(raw, dtype=kind).astype(np.uint64)
            got.append(self._key(np.full(len(values), bucket, dtype=np.uint64), values))
        self.keys = np.unique(np.concatenate(got))
        bits = min(26, max(16, (16 * len(self.keys)).bit_length()))
        self.top = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, dtype=bool)
        self.maybe[self.keys >> self.top] = True

    def _key(self, bucket: np.ndarray, values: np.ndarray) -> np.ndarray:
        return mixed(values * self.buckets + bucket) if self.shift else mixed(values)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(hashes), dtype=bool)
        key = self._key(hashes % self.buckets if self.shift else hashes, hashes >> self.shift)
        found = self.maybe[key >> self.top]
        at = np.flatnonzero(found)
        found[at] = _member(key[at], self.keys)
        return found


class _Text:
    """A group of texts with what every round needs of them."""

    def __init__(self, group: list[bytes], length: int):
        self.data, self.starts = joined(group)
        self.sums, self.length = prefix_sums(self.data), length
        self.places = _places(group, self.starts, length)
        self.group = group

    def windows(self, places: np.ndarray) -> np.ndarray:
        return _window_hashes(self.sums, places, self.length)

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of each stretch between neighbouring anchors of a text. Anchors are chosen by the bytes
        that follow them, so equal stretches have equal anchors."""
        marks = _window_hashes(self.sums, self.places, ANCHOR_BYTES)
        anchors = self.places[marks & np.uint64(ANCHOR_EVERY - 1) == 0]
        text = np.searchsorted(self.starts, anchors, side="right")
        same = text[1:] == text[:-1]
        return anchors[:-1][same], anchors[1:][same]

    def segment_hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return prime_hashes(self.data, first, last + self.length)

    def candidates(self, names: _Known) -> np.ndarray:
        """For each position, how many windows up to it may begin a repeated string (a running count)."""
        depth = self.length - PERIOD + 1
        at = _sampled(self.group, self.starts, self.length)
        at = at[names.holds(_window_hashes(self.sums, at, depth))]
        near = np.bincount(np.maximum(at - PERIOD + 1, 0), minlength=len(self.data) + 2)
        near[at + 1] -= 1
        likely = np.zeros(len(self.data) + 1, dtype=np.int64)
        likely[self.places[np.cumsum(near)[self.places] > 0] + 1] = 1
        return np.cumsum(likely)

    def within(self, segments: _Known) -> np.ndarray:
        """For each position, whether a window that begins there lies in one of the stretches."""
        first, last = self.segments()
        found = segments.holds(self.segment_hashes(first, last))
        change = np.bincount(first[found], minlength=len(self.data) + 2)
        change -= np.bincount(last[found] + 1, minlength=len(self.data) + 2)
        return np.cumsum(change)[: len(self.data)] > 0


def _got(table: pa.Table, kind: str) -> pa.Table:
    return table.filter(pa.compute.equal(table.column("kind"), kind))


def _send_segments(length: int, buckets: int):
    def run(texts: pa.Table, got: pa.Table) -> pa.Table:
        if not texts.num_rows or not got.num_rows:
            return _as_batch([])
        names, hashes = _Known(_got(got, "name"), buckets, np.uint32), []
        for _, group in chunks(listed(texts.column("text"))):
            text = _Text(group, length)
            likely, (first, last) = text.candidates(names), text.segments()
            whole = likely[last + 1] - likely[first] == last - first + 1
            hashes.append(text.segment_hashes(first[whole], last[whole]))
        part = texts.column("__part")[0].as_py()
        return _as_batch(list(_send(part, np.concatenate(hashes), buckets, np.uint64)))

    return run


def _send_windows(length: int, buckets: int):
    def run(texts: pa.Table, got: pa.Table) -> pa.Table:
        if not texts.num_rows or not got.num_rows:
            return _as_batch([])
        names = _Known(_got(got, "name"), buckets, np.uint32)
        segments, owned = (_Known(_got(got, kind), buckets, np.uint64) for kind in ("segment", "owned"))
        asked, told = [], []
        for _, group in chunks(listed(texts.column("text"))):
            text = _Text(group, length)
            likely = np.diff(text.candidates(names)) > 0
            asked.append(text.windows(text.places[(likely & ~text.within(segments))[text.places]]))
            told.append(np.unique(text.windows(text.places[text.within(owned)[text.places]])))
        part = texts.column("__part")[0].as_py()
        rows = list(_send(part, np.concatenate(asked), buckets, np.uint64))
        return _as_batch(rows + list(_send(part, np.concatenate(told), buckets, np.uint64, "told")))

    return run


def _cut(length: int, buckets: int, text_at: int, as_text: bool):
    def run(rows: pa.Table, got: pa.Table) -> pa.Table:
        segments, windows = (_Known(_got(got, kind), buckets, np.uint64) for kind in ("segment", "window"))
        out: dict[str, list] = {name: [] for name in OUTPUTS}
        for _, group in chunks(listed(rows.column(text_at))):
            if len(segments.keys) or len(windows.keys):
                text = _Text(group, length)
                data, starts = text.data, text.starts
                settled = text.within(segments)[text.places]
                settled[~settled] = windows.holds(text.windows(text.places[~settled]))
                found = text.places[settled]
                covered = np.zeros(len(data) + 1, dtype=np.int32)
                covered[found] += 1
                covered[found + length] -= 1
                gone = np.cumsum(covered)[:-1] > 0
            else:
                data, starts = joined(group)
                gone = np.zeros(len(data), dtype=bool)
            for raw, start in zip(group, starts.tolist(), strict=True):
                own = gone[start : start + len(raw)]
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(own.sum()))
                out["n_spans"].append(int((np.diff(own.view(np.int8), prepend=0) == 1).sum()))
                kept = data[start : start + len(raw)][~own].tobytes()
                out["kept"].append(kept.decode(errors="ignore") if as_text else kept)
        columns = [rows.column(i) for i in range(1, rows.num_columns)]
        names = rows.column_names[1:]
        columns += [pa.array(out[n], pa.int64()) for n in OUTPUTS[:3]]
        columns += [pa.array(out["kept"], pa.string() if as_text else pa.binary())]
        return pa.table(columns, names=[*names, *OUTPUTS])

    return run


def _one(run):
    def tidied(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out

    return tidied


def _two(run):
    def tidied(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        give_back()
        return out

    return tidied


def cut_repeats(
    documents: DataFrame, length: int = 400, buckets: int | None = None, as_text: bool = False
) -> DataFrame:
    """``documents`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes of ``text`` that
    no string of ``length`` bytes covers that also starts anywhere else. ``as_text`` gives ``kept`` as text, without the
    bytes of a character that a cut has split."""
    if length < PERIOD:
        raise ValueError(f"length must be {PERIOD} or more")
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = documents.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    total = int(size["bytes"] or 0)
    buckets = buckets or max(4 * tasks, -(-total // BUCKET_BYTES))
    rows = min(PART_ROWS, max(1, PART_BYTES * size["n"] // max(total, 1)))
    key = "__part"
    while key in map(str.lower, documents.columns):
        key += "_"
    part = F.floor(F.monotonically_increasing_id() / rows).cast("long").alias(key)
    carried = documents.select(part, *(F.col(f"`{c}`") for c in documents.columns if c not in OUTPUTS))
    stored = bucketed(carried, "suffix-documents", key, tasks)
    texts = stored.select(F.col(key).alias("__part"), F.col("text").cast("string").alias("text"))

    def repeated(sent: DataFrame, kind: str, width: type) -> DataFrame:
        return materialize(sent.groupBy("bucket").applyInArrow(_one(_repeated(width, kind)), SENT), f"suffix-{kind}s")

    def beside(left: DataFrame, right: DataFrame, run, schema) -> DataFrame:
        return left.groupBy(left.columns[0]).cogroup(right.groupBy("__part")).applyInArrow(_two(run), schema)

    names = repeated(texts.mapInArrow(tidy(_send_names(length, buckets)), SENT), "name", np.uint32)
    segments = repeated(beside(texts, names, _send_segments(length, buckets), SENT), "segment", np.uint64)
    both = names.union(segments)
    windows = repeated(beside(texts, both, _send_windows(length, buckets), SENT), "window", np.uint64)

    schema = StructType(stored.schema.fields[1:])
    for name in OUTPUTS[:3]:
        schema.add(name, "long", nullable=False)
    schema.add("kept", "string" if as_text else "binary", nullable=False)
    cut = _cut(length, buckets, stored.columns.index("text"), as_text)
    return beside(stored, segments.union(windows), cut, schema)


def report(cut: DataFrame) -> DataFrame:
    """The counts of each document and a digest of what stays."""
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
