"""Importance resampling towards a target: documents are drawn in proportion to how much likelier their words are there.

A batch of texts is joined into one byte string with a separator no word can hold. One pass of a regular expression finds
all words, ``searchsorted`` over the texts' offsets gives each word its document, and runs of words that would cross
two documents are masked before ``bincount`` adds up their buckets. The checksum of a run is composed from those of its words:
a CRC is linear, so appending a word is a shift by its length, looked up per byte, and an exclusive or.

Two scans: the first counts the buckets of the corpus and of the target, of which ``buckets`` numbers each are collected;
the second weighs every document with the gains of its buckets. The draw sorts by range and adds the partitions' sizes,
so no task sees all scores, and equal scores are divided by id.

Words are runs of ASCII letters, digits and all other non-ASCII bytes, with A-Z lower-cased.

Defined cases: a null or empty text, or one without words, has no features and weight 0; it is not drawn unless
``least_words`` is 0. A row with a null id is weighed but not drawn, and has no score. Rows with one id share their noise, each
row counts and may be drawn; equal rows take neighbouring ranks. An empty target or corpus has counts of 0. Other columns
are ignored. Texts are read whole, in blocks of ``BLOCK`` words.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.llm.textbytes import chunks
from prepmill.sources.storage import materialize

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
BLOCK = 1 << 17
#: Words up to this length are appended by table, longer ones by checksum of their bytes.
TABLED = 48
WEIGHED = "weighed_id {kind}, n_words long, n_features long, weight long"


def _byte_steps() -> np.ndarray:
    """The checksum register after one zero byte, for each value of its lowest byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (step & np.uint32(1)))
    return step


def _shifts() -> np.ndarray:
    """[length, byte, value]: a register that holds only that byte, after ``length`` zero bytes."""
    step = _byte_steps()
    now = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [now]
    for _ in range(TABLED):
        now = step[now & np.uint32(255)] ^ (now >> np.uint32(8))
        out.append(now)
    return np.stack(out)


STEPS, SHIFTS = _byte_steps(), _shifts()


def with_space(crcs: np.ndarray) -> np.ndarray:
    """Checksums of the same strings with a space after each."""
    register = ~crcs
    return ~(STEPS[(register ^ np.uint32(32)) & np.uint32(255)] ^ (register >> np.uint32(8)))


def appended(crcs: np.ndarray, codes: np.ndarray, words: list[bytes], word_crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of strings, given by theirs, with the word of each code appended."""
    size = np.minimum(lengths[codes], TABLED)
    out = word_crcs[codes].copy()
    for k in range(4):
        out ^= SHIFTS[size, k, (crcs >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(lengths[codes] > TABLED).tolist():
        out[i] = zlib.crc32(words[codes[i]], int(crcs[i]))
    return out


def features(group: list[bytes], longest: int = 2) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, text number, checksum) of all runs of 1 to ``longest`` consecutive words, block by block."""
    data = SEPARATOR.join(group).lower()
    offsets = np.cumsum([0] + [len(x) + 1 for x in group[:-1]])
    found = ((m.start(), m.group()) for m in WORD.finditer(data))
    tail_rows, tail_words = np.zeros(0, dtype=np.int64), []
    while block := list(itertools.islice(found, BLOCK)):
        fresh = len(tail_words)
        rows = np.searchsorted(offsets, np.fromiter((s for s, _ in block), dtype=np.int64, count=len(block)), side="right") - 1
        rows, said = np.concatenate([tail_rows, rows]), tail_words + [w for _, w in block]
        number: dict[bytes, int] = {}
        codes = np.array([number.setdefault(w, len(number)) for w in said])
        words = list(number)
        word_crcs = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        lengths = np.array([len(w) for w in words])
        runs = word_crcs[codes]
        yield 1, rows[fresh:], runs[fresh:]
        for k in range(2, longest + 1):
            runs = appended(with_space(runs[:-1]), codes[k - 1 :], words, word_crcs, lengths)
            new = (rows[k - 1 :] == rows[: len(runs)]) & (np.arange(len(runs)) + k > fresh)
            yield k, rows[: len(runs)][new], runs[new]
        keep = min(longest - 1, len(said))
        tail_rows, tail_words = rows[len(rows) - keep :], said[len(said) - keep :]


def bucket_counts(texts: DataFrame, buckets: int = 10000, longest: int = 2) -> DataFrame:
    """(bucket, n): the features of all texts in each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, group in chunks(batch.column(0).to_pylist()):
                for _, _, crcs in features(group, longest):
                    total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = 10000, longest: int = 2, text_column: str = "text") -> np.ndarray:
    """A thousand times the logarithm of how much likelier each bucket is in the target than in the documents, add-one
    smoothed and rounded down."""
    of = lambda t: bucket_counts(t.select(F.col(text_column).cast("string")), buckets, longest)
    sides = of(documents).select("bucket", "n", F.lit(0).cast("long").alias("wanted"))
    sides = sides.union(of(target).select("bucket", F.lit(0).cast("long"), F.col("n")))
    counts = np.zeros((buckets, 2), dtype=np.int64)
    for row in sides.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("wanted").alias("wanted")).collect():
        counts[row["bucket"]] = row["n"], row["wanted"]
    all_held, all_wanted = (float(x + buckets) for x in counts.sum(0).tolist())
    ratio = lambda s, t: (t + 1.0) * all_held / ((s + 1.0) * all_wanted)
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in counts.tolist()], dtype=np.int64)


def weighed(documents: DataFrame, gain: np.ndarray, longest: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(weighed_id, n_words, n_features, weight): the mean gain of each document's features, rounded down."""
    held = documents.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for batch in batches:
            for first, group in chunks(batch.column(1).to_pylist()):
                n_words, n, total = (np.zeros(len(group), dtype=np.int64) for _ in range(3))
                for k, rows, crcs in features(group, longest):
                    count = np.bincount(rows, minlength=len(group))
                    n += count
                    n_words += count if k == 1 else 0
                    total += np.bincount(rows, gain[crcs % np.uint32(len(gain))], len(group)).astype(np.int64)
                columns = [batch.column(0).slice(first, len(group)), *map(pa.array, (n_words, n, total // np.maximum(n, 1)))]
                yield pa.RecordBatch.from_arrays(columns, names=["weighed_id", "n_words", "n_features", "weight"])

    chosen = documents.select(F.col(id_column).alias("weighed_id"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(run, WEIGHED.format(kind=chosen.schema[0].dataType.simpleString()))


def scored(weights: DataFrame, seed: int = 7) -> DataFrame:
    """``weights`` with ``score``: the weight plus Gumbel noise that only the seed and the id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("weighed_id").cast("string")), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    return weights.withColumn("score", F.col("weight") + noise)


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = 10000,
    longest: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document. Of those with ``least_words`` words or more, the
    ``percent`` with the highest scores are drawn and ranked from 1; equal scores go to the smaller id; the rank of the
    others is null."""
    gain = gains(documents, target, buckets, longest, text_column)
    stored = materialize(scored(weighed(documents, gain, longest, id_column, text_column), seed), "weighed")
    eligible = (F.col("n_words") >= least_words) & F.col("weighed_id").isNotNull()
    order = [F.desc("score"), F.asc("weighed_id"), F.asc("weight"), F.asc("n_features")]
    sorted_rows = stored.filter(eligible).repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows = materialize(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "by-score")
    part = F.shiftright("place", 33)
    sizes = sorted(sorted_rows.groupBy(part.alias("part")).count().collect())  # a row per partition
    before = [0, *itertools.accumulate(row["count"] for row in sizes)]
    shifts = [(row["part"], n) for row, n in zip(sizes, before, strict=False)]
    shifts = documents.sparkSession.createDataFrame(shifts, "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = sorted_rows.join(F.broadcast(shifts), part == F.col("part")).withColumn(
        "rank", F.when(rank <= before[-1] * percent // 100, rank)
    )
    columns = [F.col("weighed_id").alias(id_column), "n_words", "n_features", "weight", "score"]
    others = stored.filter(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").union(others)
