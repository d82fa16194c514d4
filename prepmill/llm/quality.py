"""Text quality by a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of ``CHUNK`` bytes that cover it from the first byte to the last. Each byte enters
as ``EMBEDDED`` learned numbers of its own, beside fixed channels (its class, and whether its word repeats the word before);
learned filters of ``WIDTH`` bytes slide over them with stride ``STRIDE``, and each filter keeps its largest activation in
every chunk. The largest and the mean of these over the chunks feed one logistic unit.

Embedding, filters and unit are trained together by gradient descent (Adam) through the maxima, on at most
``max_documents`` labelled texts per class of at most ``max_bytes`` bytes each; scoring covers every whole text. Labels
of rows that ``trainable`` excludes are never read.

Defined cases: a null text is empty; an empty text has no activation, so the unit's bias gives its score; null ids
or labels teach nothing; of the texts under one id the least teaches; without labels of both classes every score is 1; repeated rows are each scored; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.llm.textbytes import chunks, joined, span_hashes, word_spans
from prepmill.llm.toxicity import labelled_sample

WIDTH = 12
STRIDE = 4
STEPS = 64  # positions of a filter in a chunk
CHUNK = WIDTH + STRIDE * (STEPS - 1)
FILTERS = 16
BLOCK = 1 << 18

CLASS = np.zeros(256, dtype=np.int64)
CLASS[97:123] = 1
CLASS[65:91] = 2
CLASS[48:58] = 3
CLASS[[32, *range(9, 14)]] = 4
CLASS[[ord(c) for c in ".,;:"]] = 5
CLASS[[ord(c) for c in "!?"]] = 6
CLASS[[ord(c) for c in "#$%&*|<>=_~^"]] = 7
CLASS[128:192] = 8
CLASS[192:] = 9
FIXED = 11
EMBEDDED = 4
CHANNELS = FIXED + EMBEDDED
BEYOND = 256  # stands for bytes beyond the text


def repeated_words(data: np.ndarray) -> np.ndarray:
    """1 at each byte of a word that repeats the word before it, else 0."""
    mark = np.zeros(len(data) + 1, dtype=np.int32)
    first, last = word_spans(CLASS[data] != 4)
    if len(first):
        hashes = span_hashes(data, first, last)
        same = np.zeros(len(first), dtype=bool)
        same[1:] = hashes[1:] == hashes[:-1]
        mark[first[same]] += 1
        mark[last[same]] -= 1
    return np.cumsum(mark)[:-1]


def chunked(group: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of each chunk, marks of repeated words, number of chunks of each text).

    Chunks begin every STRIDE * STEPS bytes and overlap by WIDTH - STRIDE."""
    data, starts = joined(group)
    sizes = np.array([len(x) for x in group], dtype=np.int64)
    advance = STRIDE * STEPS
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - WIDTH + STRIDE) // advance)), 0)
    row = np.repeat(np.arange(len(group)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (within * advance)[:, None] + np.arange(CHUNK)
    inside = at < sizes[row][:, None]
    at = np.minimum(at + starts[row][:, None], len(data) - 1)
    return np.where(inside, data[at], np.int16(BEYOND)), repeated_words(data)[at] * inside, counts


def windows(codes: np.ndarray, repeated: np.ndarray, embedding: np.ndarray) -> np.ndarray:
    """The inputs of each filter position, STEPS to a chunk; what lies beyond the text is zero."""
    known = np.zeros((BEYOND + 1, CHANNELS), dtype=np.float32)
    known[np.arange(BEYOND), CLASS] = 1
    known[:BEYOND, FIXED:] = embedding
    values = known[codes]
    values[:, :, FIXED - 1] = repeated
    rolled = np.lib.stride_tricks.sliding_window_view(values, WIDTH, axis=1)[:, ::STRIDE]
    return rolled.transpose(0, 1, 3, 2).reshape(len(codes) * STEPS, WIDTH * CHANNELS)


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    unit: np.ndarray
    bias: float

    def pooled(self, group: list[bytes]) -> tuple[np.ndarray, tuple]:
        """(largest and mean activation of each text, what the gradient needs)."""
        codes, repeated, counts = chunked(group)
        inputs = windows(codes, repeated, self.embedding)
        active = (inputs @ self.filters + self.offsets).reshape(-1, STEPS, FILTERS)
        best = active.argmax(1)
        tops = np.maximum(np.take_along_axis(active, best[:, None], 1)[:, 0], 0)
        out = np.zeros((len(group), 2 * FILTERS), dtype=np.float32)
        held = np.flatnonzero(counts)
        if len(held):
            edges = (np.cumsum(counts) - counts)[held]
            out[held, :FILTERS] = np.maximum.reduceat(tops, edges)
            out[held, FILTERS:] = np.add.reduceat(tops, edges) / counts[held][:, None]
        return out, (codes, inputs, counts, best, tops)

    def scores(self, group: list[bytes]) -> np.ndarray:
        value = self.pooled(group)[0].astype(np.float64) @ self.unit + self.bias
        return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


ALWAYS = Network(
    np.zeros((BEYOND, EMBEDDED), dtype=np.float32),
    np.zeros((WIDTH * CHANNELS, FILTERS), dtype=np.float32),
    np.zeros(FILTERS, dtype=np.float32),
    np.zeros(2 * FILTERS),
    40.0,
)


def embedding_slope(net: Network, codes: np.ndarray, best: np.ndarray, per_chunk: np.ndarray) -> np.ndarray:
    """The gradient of the embedding: what reaches each byte under the best position of a filter."""
    chunk, at = np.nonzero(per_chunk)
    weights = net.filters.reshape(WIDTH, CHANNELS, FILTERS)[:, FIXED:].transpose(2, 0, 1)
    reaching = per_chunk[chunk, at][:, None, None] * weights[at]
    under = codes[chunk[:, None], (best[chunk, at] * STRIDE)[:, None] + np.arange(WIDTH)].ravel()
    sums = [np.bincount(under, reaching[:, :, i].ravel(), BEYOND + 1)[:BEYOND] for i in range(EMBEDDED)]
    return np.stack(sums, axis=1)


def train(texts: list[bytes], good: np.ndarray, epochs: int = 10, rate: float = 0.01) -> Network:
    """A network fitted to texts of both classes, which weigh alike."""
    rng = np.random.default_rng(11)
    net = Network(
        (rng.normal(size=(BEYOND, EMBEDDED)) * 0.3).astype(np.float32),
        (rng.normal(size=(WIDTH * CHANNELS, FILTERS)) / np.sqrt(WIDTH)).astype(np.float32),
        np.zeros(FILTERS, dtype=np.float32),
        rng.normal(size=2 * FILTERS) * 0.1,
        0.0,
    )
    weight = np.where(good, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
    moments = [[0.0, 0.0] for _ in range(5)]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), 48):
            rows = order[a : a + 48]
            out, (codes, inputs, counts, best, tops) = net.pooled([texts[i] for i in rows])
            p = 1 / (1 + np.exp(-np.clip(out @ net.unit + net.bias, -30, 30)))
            slope = weight[rows] * (p - good[rows]) / len(rows)
            back = slope[:, None] * net.unit
            text = np.repeat(np.arange(len(rows)), counts)
            per_chunk = back[text, FILTERS:] / counts[text][:, None]
            per_chunk += back[text, :FILTERS] * (tops == out[text, :FILTERS])
            per_chunk *= tops > 0
            at = np.arange(len(text))[:, None] * STEPS + best
            grad = np.stack([inputs[at[:, f]].T @ per_chunk[:, f] for f in range(FILTERS)], axis=1)
            step += 1
            rate_now = rate * (1 - epoch / epochs)
            grads = [embedding_slope(net, codes, best, per_chunk), grad, per_chunk.sum(0), out.T @ slope + 1e-4 * net.unit, slope.sum()]
            values = [net.embedding, net.filters, net.offsets, net.unit, net.bias]
            for i, g in enumerate(grads):
                moments[i][0] = 0.9 * moments[i][0] + 0.1 * g
                moments[i][1] = 0.99 * moments[i][1] + 0.01 * g * g
                first, second = moments[i][0] / (1 - 0.9**step), moments[i][1] / (1 - 0.99**step)
                values[i] = values[i] - rate_now * first / (np.sqrt(second) + 1e-8)
            net = Network(*(v.astype(np.float32) for v in values[:3]), values[3], float(values[4]))
    return net


def fit(
    documents: DataFrame, labels: DataFrame, trainable: Column, max_documents: int = 700, max_bytes: int = 20_000
) -> Network:
    """The network learned from the labels (doc_id, quality) of rows for which ``trainable`` holds."""
    sample = F.broadcast(labelled_sample(labels, "quality", trainable, max_documents))
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    texts = texts.filter(F.octet_length("text").between(1, max_bytes)).join(sample, "doc_id")
    rows = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    good = np.array([r["label"] == 1 for r in rows], dtype=bool)
    if not good.any() or good.all():
        return ALWAYS
    return train([r["text"].encode() for r in rows], good)


def score(documents: DataFrame, network: Network) -> DataFrame:
    """(doc_id, score) of every row."""
    broadcast = documents.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Network = broadcast.value
        for batch in batches:
            for first, group in chunks(batch.column(1).to_pylist(), BLOCK):
                column = pa.array(known.scores(group))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), column], names=["doc_id", "score"])

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, score double")
