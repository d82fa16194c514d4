"""Toxicity by a support vector machine with a subsequence string kernel and Nyström landmarks.

The kernel counts common subsequences of three symbols, each occurrence weighted by ``DECAY`` to the power
of the span it takes (up to ``REACH`` bytes); the beginning and the end of a word are symbols
too. So a word with characters inserted, left out or the other way round stays close to the plain one. Marks inside a word are gaps
that cost nothing, characters that stand singly are one word, and two neighbouring words whose ends and common length are those of a
witness (below) are also scored as one, so neither ``m.o.r``, ``m o r`` nor ``mo r`` hides what stands there. A document is scored by
its best unit.

Training is of the multiple-instance kind, since labels are given for whole texts: the words of clean texts are
clean, of those of a toxic text at least one is toxic. Witness words are the few, far commoner in toxic
texts, that together explain them, and those common in toxic texts and in no clean one; landmarks are drawn from witnesses and clean words, the kernel against them is whitened
(Nyström), and a linear machine with squared hinge loss is fitted, four times, each time with the
clean words it got most wrong added, to the examples and to the landmarks. Witnesses are also shown with a letter doubled, left out,
or changed round with its neighbour.
The result collapses into one weight per subsequence, so scoring is a scan over byte arrays.

The fit is bounded, scoring covers every whole text: at most ``max_documents`` labelled texts per class (of rows that share an id, the
least text), ``max_candidates`` words as candidates for witnesses (the commonest in toxic texts), ``max_words`` words of clean
texts (by hash), of which ``max_shown`` are examples besides the hard ones, and words of ``MOST_BYTES`` at most. Labels of rows that
``trainable`` excludes are never read.

Not always recognised: a short insult with a letter doubled or two changed round, which scores far above clean words but may stay
below one half. Not recognised: an insult with a letter replaced (by a mark, a digit or another letter) in the middle of a short word, one made
of three or more pieces of several letters, and one made of words that are each common in clean texts.

Defined cases: a null text is empty; a text without any word gets the score of a text with no evidence; null
ids or labels teach nothing, a text labelled both ways counts as toxic; without labels of both classes, or where no word is
commoner in toxic texts, every score is 0; repeated rows are each scored; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.llm.textbytes import LOWER, chunks, joined, listed, tidy, word_spans

DECAY = 0.85
REACH = 6
EMPTY = -4.0
#: Longest word that teaches.
MOST_BYTES = 64
#: Longest unit whose parts are looked for in neighbouring words.
MOST_LETTERS = 24

MARK = 93
#: ASCII characters that are no letter, digit or white space, as a class of Java's regular expressions.
MARKS = r"[\x00-\x08\x0E-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
SYMBOL = np.full(256, MARK, dtype=np.int32)
SYMBOL[[32, *range(9, 14)]] = 0
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:192] = np.arange(27, 91)
SYMBOL[192:] = 91
SYMBOL[48:58] = 92
START, END = 94, 95
SYMBOLS = 96
IS_LETTER = (SYMBOL > 0) & (SYMBOL < 92)


def spaced(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in lower case, without marks and without the spaces between characters that stand singly, with a space
    before and after each, and the start of each text."""
    data, text_starts = joined(group)
    data = LOWER[np.append(np.uint8(32), data)]
    kept = SYMBOL[data] != MARK
    data, text_starts = data[kept], (np.cumsum(kept) - kept)[text_starts + 1]
    white = SYMBOL[data] == 0
    single = np.zeros(len(data) + 2, dtype=bool)
    single[2:-2] = white[:-2] & ~white[1:-1] & white[2:]  # at i + 1: the byte at i stands singly
    between = white & single[:-2] & single[2:]
    between[text_starts - 1] = False
    kept = ~between
    return data[kept], (np.cumsum(kept) - kept)[text_starts]


def coded(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol and unit of each byte, start and end of each unit) of units that begin at ``starts``; a unit takes the
    space before it, which stands for its beginning, and ends with its last byte that is no white space."""
    codes, mark = SYMBOL[data], np.zeros(len(data), dtype=np.int32)
    solid = np.flatnonzero(codes > 0)
    ends = solid[np.append(np.searchsorted(solid, starts[1:]), len(solid)) - 1] + 1
    codes[starts - 1] = START
    mark[starts - 1] = 1
    return codes, np.cumsum(mark, dtype=np.int32) - 1, starts - 1, ends


def units(data: np.ndarray) -> np.ndarray:
    """Where units begin: words, of which single characters in a row are one."""
    return word_spans(SYMBOL[data] > 0)[0]


def subsequences(codes: np.ndarray, unit: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """(weight, number of the subsequence that begins at each position) for each pair of gaps; 0 where it would
    leave the unit or hold white space."""
    solid = codes > 0
    for last in range(2, REACH + 1):
        if len(codes) <= last:
            return
        inside = (unit[last:] == unit[:-last]) & solid[last:] & solid[:-last]
        ends = codes[:-last] * (SYMBOLS * SYMBOLS) + codes[last:]
        for middle in range(1, last):
            code = codes[middle : len(codes) - last + middle]
            number = ends + code * SYMBOLS
            number[~(inside & (code > 0))] = 0
            yield DECAY ** (last + 1), number


def endings(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """(weight, number of the subsequence that stops with the end of each unit) for each pair of gaps; 0 where it would
    begin before the unit."""
    for first in range(2, REACH + 1):
        inside = ends - first >= starts
        at = codes[np.maximum(ends - first, 0)] * (SYMBOLS * SYMBOLS) + END
        for middle in range(1, first):
            code = codes[ends - middle]
            yield DECAY ** (first + 1), np.where(inside & (code > 0), at + code * SYMBOLS, 0)


def _scale(codes_letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A length scale of each unit, by its letters."""
    return np.sqrt(np.maximum(np.add.reduceat(codes_letters.astype(np.float64), starts) - 1, 1))


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    #: By first and last symbol and number of bytes, whether a witness is like that.
    shapes: np.ndarray | None = None

    def decisions(self, group: list[bytes]) -> np.ndarray:
        """The best decision value over the units of each text, and over pairs of neighbours with the shape of a witness."""
        data, text_starts = spaced(group)
        best, (texts, pairs) = self._best(data, text_starts, units(data)), self._pairs(data, text_starts)
        for a in range(0, len(pairs), 4000):
            own, own_starts = spaced(pairs[a : a + 4000])
            np.maximum.at(best, texts[a : a + 4000], self._best(own, own_starts, units(own)))
        return best

    def _pairs(self, data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """(text, bytes) of neighbouring words that together have the ends and the length of a witness."""
        starts, ends = word_spans(SYMBOL[data] > 0)
        if self.shapes is None or len(starts) < 2:
            return np.zeros(0, dtype=np.int64), []
        text = np.searchsorted(text_starts, starts, side="right") - 1
        size = np.minimum((ends - starts)[:-1] + (ends - starts)[1:], MOST_LETTERS)
        alike = self.shapes[SYMBOL[data[starts[:-1]]], SYMBOL[data[ends[1:] - 1]], size]
        at = np.flatnonzero(alike & (text[1:] == text[:-1]))
        raw = data.tobytes()
        return text[at], [raw[starts[i] : ends[i]] + raw[starts[i + 1] : ends[i + 1]] for i in at.tolist()]

    def _best(self, data: np.ndarray, text_starts: np.ndarray, starts: np.ndarray) -> np.ndarray:
        best = np.full(len(text_starts), EMPTY)
        if len(starts):
            edges = np.append(np.searchsorted(starts, text_starts), len(starts))
            codes, unit, starts, ends = coded(data, starts)
            total = np.zeros(len(data) + 1, dtype=np.float32)
            for weight, number in subsequences(codes, unit):
                total[: len(number)] += np.float32(weight) * self.weights[number]
            value = np.add.reduceat(total[:-1].astype(np.float64), starts)
            for weight, number in endings(codes, starts, ends):
                value += weight * self.weights[number]
            value = value / _scale(IS_LETTER[data], starts) + self.bias
            held = np.flatnonzero(np.diff(edges) > 0)
            best[held] = np.maximum(np.maximum.reduceat(value, edges[held]), EMPTY)
        return best

    def scores(self, decisions: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decisions + self.shift, -30, 30)))


def shapes_of(witnesses: list[bytes]) -> np.ndarray:
    out = np.zeros((SYMBOLS, SYMBOLS, MOST_LETTERS + 1), dtype=bool)
    for word in witnesses:
        if MOST_LETTERS > len(word) > 3:
            out[SYMBOL[word[0]], SYMBOL[word[-1]], len(word)] = True
    return out


NEVER = Model(np.zeros(SYMBOLS**3, dtype=np.float32), 0.0, 0.0, -40.0)


class _Kernel:
    """Kernel values of words against the landmarks."""

    def __init__(self, landmarks: list[bytes]):
        data, starts = spaced(landmarks)
        codes, unit, starts, ends = coded(data, starts)
        rows = np.arange(len(starts))
        found = [(w, n[n > 0], unit[: len(n)][n > 0]) for w, n in subsequences(codes, unit)]
        found += [(w, n[n > 0], rows[n > 0]) for w, n in endings(codes, starts, ends)]
        numbers = np.unique(np.concatenate([n for _, n, _ in found]))
        self.numbers, self.column = numbers, np.full(SYMBOLS**3, -1, dtype=np.int32)
        self.column[numbers] = np.arange(len(numbers))
        self.features = np.zeros((len(numbers), len(landmarks)), dtype=np.float32)
        for weight, number, row in found:
            np.add.at(self.features, (self.column[number], row), np.float32(weight))
        self.features /= _scale(IS_LETTER[data], starts)

    def of(self, words: list[bytes]) -> np.ndarray:
        out = []
        for a in range(0, len(words), 4000):
            data, starts = spaced(words[a : a + 4000])
            codes, unit, starts, ends = coded(data, starts)
            total = np.zeros((len(starts), self.features.shape[1]), dtype=np.float32)
            for weight, number in subsequences(codes, unit):
                at = np.flatnonzero(self.column[number] >= 0)
                if len(at):
                    rows, first = np.unique(unit[at], return_index=True)
                    summed = np.add.reduceat(self.features[self.column[number[at]]], first, axis=0)
                    total[rows] += np.float32(weight) * summed
            for weight, number in endings(codes, starts, ends):
                rows = np.flatnonzero(self.column[number] >= 0)
                total[rows] += np.float32(weight) * self.features[self.column[number[rows]]]
            out.append(total / _scale(IS_LETTER[data], starts)[:, None])
        return np.concatenate(out)


def _squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine, by Newton steps over its support vectors."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w, active = np.zeros(x.shape[1]), np.ones(len(x), dtype=bool)
    for _ in range(30):
        own, c = x[active], cost[active]
        w = np.linalg.solve(ridge + (own * c[:, None]).T @ own, (own * c[:, None]).T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _fit_words(witnesses: list[bytes], clean: list[bytes], landmarks: int, most: int) -> Model:
    rng = np.random.default_rng(7)
    shown = list(witnesses)
    for word in witnesses:
        letters = word.decode()
        if 4 <= len(letters) <= 16:
            at = int(rng.integers(1, len(letters)))
            shown.append((letters[:at] + letters[at - 1] + letters[at:]).encode())  # a letter twice
            shown.append((letters[: at - 1] + letters[at - 1 : at + 1][::-1] + letters[at + 1 :]).encode())  # two the other way round
        if 5 <= len(letters) <= 16:
            at = int(rng.integers(1, len(letters) - 1))
            shown.append((letters[:at] + letters[at + 1 :]).encode())  # one left out, as a mark in its place is
    pick = lambda words, n: [words[i] for i in rng.permutation(len(words))[:n]]
    hard, worst = pick(clean, most), []
    for _ in range(4):
        others = list(dict.fromkeys([*worst[: landmarks // 4], *pick(clean, landmarks // 4)]))
        kernel = _Kernel(pick(witnesses, landmarks // 2) + others)
        own = kernel.features.T @ kernel.features
        values, vectors = np.linalg.eigh(own.astype(np.float64))
        whiten = vectors / np.sqrt(np.maximum(values, 1e-3 * values.max()))
        x = np.vstack([kernel.of(shown), kernel.of(hard)]) @ whiten
        y = np.append(np.ones(len(shown)), -np.ones(len(hard)))
        w = _squared_hinge(x, y, np.where(y > 0, 4000 / len(shown), 20000 / len(hard)))
        weights = np.zeros(SYMBOLS**3, dtype=np.float32)
        weights[kernel.numbers] = kernel.features @ (whiten @ w[:-1]).astype(np.float32)
        model = Model(weights, float(w[-1]), shapes=shapes_of(witnesses))
        order = np.argsort(-np.concatenate([model.decisions(g) for _, g in chunks(clean)]))[:2000]
        worst = [clean[i] for i in order]
        hard = list(dict.fromkeys([*hard, *worst]))
    return model


def _calibrated(model: Model, decisions: np.ndarray, toxic: np.ndarray) -> Model:
    """Slope and shift of the logistic curve over the decision values of whole texts."""
    x = np.stack([decisions, np.ones(len(decisions))], axis=1)
    weight = np.full(len(decisions), 1 / max(len(decisions), 1))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + 1e-4 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step / max(1.0, float(np.abs(step).max()) / 4)
    return Model(model.weights, model.bias, float(w[0]), float(w[1]), model.shapes)


def labelled_sample(labels: DataFrame, label: str, trainable: Column, most: int) -> DataFrame:
    """(doc_id, label) of at most ``most`` ids of each class, in the order of a hash of the id."""
    known = labels.filter(trainable & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).alias("label"))
    part = lambda v: known.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return part(0).union(part(1))


def _witnesses(likely: list[tuple[str, list[int]]], least: int) -> list[bytes]:
    """A small set of words that explains the toxic texts: again and again the word that is in most texts not yet
    explained, while it explains ``least`` or more."""
    ids = {doc_id: i for i, doc_id in enumerate(sorted({d for _, own in likely for d in own}))}
    holds = np.zeros((len(likely), len(ids)), dtype=bool)
    for row, (_, own) in zip(holds, likely, strict=True):
        row[[ids[d] for d in own]] = True
    left, chosen = np.ones(len(ids), dtype=bool), []
    gain = holds.sum(1) if len(likely) else np.zeros(1)
    while gain.max() >= least:
        best = int(gain.argmax())
        chosen.append(likely[best][0].encode())
        gain = gain - (holds & (holds[best] & left)).sum(1)
        left &= ~holds[best]
    return chosen


def fit(
    documents: DataFrame,
    labels: DataFrame,
    trainable: Column,
    max_documents: int = 2000,
    max_words: int = 150_000,
    landmarks: int = 240,
    max_candidates: int = 4000,
    max_shown: int = 8000,
) -> Model:
    """The model learned from the labels (doc_id, toxic) of rows for which ``trainable`` holds."""
    sample = F.broadcast(labelled_sample(labels, "toxic", trainable, max_documents))
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    texts = texts.join(sample, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    bare = F.regexp_replace(F.lower("text"), MARKS, "")
    words = F.array_distinct(F.split(bare, r"[\x20\x09-\x0D]+"))
    held = texts.select("doc_id", F.explode(words).alias("word"), "label").filter(F.octet_length("word").between(3, MOST_BYTES))
    toxic_ids = F.collect_set(F.when(F.col("label") == 1, F.col("doc_id")))
    counted = held.groupBy("word").agg(toxic_ids.alias("ids"), F.sum(1 - F.col("label")).alias("clean"))
    counted = counted.withColumn("toxic", F.size("ids")).persist()
    size = texts.agg(F.sum("label"), F.count("*")).first()
    n_toxic, n_clean = int(size[0] or 0), int(size[1] or 0) - int(size[0] or 0)
    odds = (F.col("toxic") + 0.5) * (n_clean + 1) / ((F.col("clean") + 0.5) * (n_toxic + 1))
    least = max(1, min(3, n_toxic // 10))  # few labels cannot show a word in many texts
    likely = counted.filter((F.col("toxic") >= min(2, least)) & (odds >= min(5, 1 + n_toxic)))
    likely = likely.orderBy(F.desc("toxic"), "clean", "word").limit(max_candidates)
    rows = likely.select("word", "ids", "toxic", "clean").collect()
    plain = [r["word"].encode() for r in rows if r["clean"] == 0 and r["toxic"] >= max(5, n_toxic / 50)]
    witnesses = list(dict.fromkeys([*plain, *_witnesses([(r["word"], r["ids"]) for r in rows], least)]))
    clean = counted.filter("clean > 0 and clean * 20 >= toxic").orderBy(F.xxhash64("word")).limit(max_words)
    clean = [r["word"].encode() for r in clean.select("word").collect()]
    counted.unpersist()
    if not witnesses or not clean:
        return NEVER
    model = _fit_words(witnesses, clean, landmarks, max_shown)
    broadcast = documents.sparkSession.sparkContext.broadcast(model)
    rows = texts.select("text", "label").mapInArrow(tidy(_decide(broadcast)), "label int, decision double").collect()
    return _calibrated(model, np.array([r["decision"] for r in rows]), np.array([r["label"] == 1 for r in rows]))


def _decide(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [broadcast.value.decisions(g) for _, g in chunks(listed(batch.column(0)))]
            column = pa.array(np.concatenate(values) if values else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), column], names=["label", "decision"])

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    broadcast = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = broadcast.value
        for batch in batches:
            for first, group in chunks(listed(batch.column(1))):
                column = pa.array(known.scores(known.decisions(group)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), column], names=["doc_id", "score"])

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(tidy(run), "doc_id long, score double")


def without_toxic(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents``, with all their columns, that score below ``threshold``."""
    broadcast = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = broadcast.value
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                values = [known.scores(known.decisions(g)) < threshold for _, g in chunks(listed(part.column(at)))]
                yield part.filter(pa.array(np.concatenate(values)))

    return documents.mapInArrow(tidy(run), documents.schema)
