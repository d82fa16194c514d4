"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

A text becomes an array of codepoints, each codepoint a symbol (its class, with the look-ahead the
pattern needs folded in), and each symbol a transition function over the nine states of the
pre-tokeniser. Composition of such functions is associative, so their prefix compositions are found
by a blocked scan over whole arrays: every function that can arise has a number, and composing is one
lookup in a table. State before a character and its symbol say whether a piece begins there. No
regular expression runs over the text.

The pieces between boundaries feed the merge of neighbouring byte pairs by rank; finished pieces are
kept in a bounded cache. Equal pieces of a chunk are merged once: they are found by hash and then compared byte by byte, and a
chunk in which a hash misleads is grouped by the bytes themselves. Token lengths give the byte offset of every token; decoding
gathers the bytes of all ids of a chunk from one table.

Defined cases: a null text is the empty text, which has no tokens; repeated rows are each encoded;
columns other than the id and the text are ignored. ``decode`` replaces a column named ``decoded``; null ids decode to
nothing, an id beyond the vocabulary is an error.
"""

from __future__ import annotations

import base64
import functools
import heapq
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.llm.textbytes import listed, span_hashes, tidy

CHUNK_CHARS = 1 << 19
CACHE_PIECES = 250_000
LONG_PIECE = 96

# Symbols. ONE and TWO are letters that end, or begin, a contraction after an apostrophe.
LETTER, ONE, TWO, NUMBER, OTHER, APOSTROPHE, SPACE, SPACE_LAST, WHITE, WHITE_LAST = range(10)
SYMBOLS = 10
# States, by what came before.
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_APOSTROPHE, AFTER_SPACE, AFTER_WHITE, HALF, CLOSED = range(9)
STATES = 9

# The characters that the pattern's \s matches.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _next_state(state: int, symbol: int) -> int:
    if symbol in (LETTER, ONE, TWO):
        if state == HALF or (state == AFTER_APOSTROPHE and symbol == ONE):
            return CLOSED
        return HALF if state == AFTER_APOSTROPHE and symbol == TWO else IN_LETTERS
    if symbol == NUMBER:
        return IN_NUMBERS
    if symbol == APOSTROPHE and state not in (IN_OTHER, AFTER_APOSTROPHE, AFTER_SPACE):
        return AFTER_APOSTROPHE
    if symbol in (OTHER, APOSTROPHE):
        return IN_OTHER
    return AFTER_SPACE if symbol in (SPACE, SPACE_LAST) else AFTER_WHITE


def _begins(state: int, symbol: int) -> bool:
    """Whether a piece begins before ``symbol``."""
    if symbol in (SPACE_LAST, WHITE_LAST):
        return True
    if symbol in (SPACE, WHITE):
        return state not in (AFTER_SPACE, AFTER_WHITE)
    if state == AFTER_SPACE:
        return False
    if symbol in (LETTER, ONE, TWO):
        return not (state in (IN_LETTERS, HALF) or (state == AFTER_APOSTROPHE and symbol != LETTER))
    if symbol == NUMBER:
        return state != IN_NUMBERS
    return state not in (IN_OTHER, AFTER_APOSTROPHE)


@functools.cache
def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each symbol's function, composition table, function values, begins table).

    Symbols of SYMBOLS and above begin a text: their functions forget the state.
    """
    functions: list[tuple[int, ...]] = [tuple(range(STATES))]
    number = {functions[0]: 0}

    def known(f: tuple[int, ...]) -> int:
        if f not in number:
            number[f] = len(functions)
            functions.append(f)
        return number[f]

    of_symbol = [known(tuple(_next_state(s, x) for s in range(STATES))) for x in range(SYMBOLS)]
    of_symbol += [known((_next_state(BEGIN, x),) * STATES) for x in range(SYMBOLS)]
    table: dict[tuple[int, int], int] = {}
    size = 0
    while size < len(functions):
        size = len(functions)
        for i in range(size):
            for j in range(size):
                if (i, j) not in table:
                    table[i, j] = known(tuple(functions[j][s] for s in functions[i]))
    compose = np.zeros((size, size), dtype=np.int32)
    for (i, j), k in table.items():
        compose[i, j] = k
    begins = np.array([[_begins(s, x % SYMBOLS) or x >= SYMBOLS for x in range(2 * SYMBOLS)] for s in range(STATES)])
    return np.array(of_symbol, dtype=np.int32), compose, np.array(functions, dtype=np.int32), begins


@functools.cache
def _base_symbols() -> np.ndarray:
    """The symbol of each codepoint, before the look-ahead."""
    table = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    category = unicodedata.category
    kinds = "".join(category(chr(c))[0] for c in range(sys.maxunicode + 1)).encode()
    kinds = np.frombuffer(kinds, dtype=np.uint8)
    table[kinds == ord("L")] = LETTER
    table[kinds == ord("N")] = NUMBER
    table[WHITE_SPACE] = WHITE
    table[ord(" ")] = SPACE
    table[ord("'")] = APOSTROPHE
    table[[ord(c) for c in "stmd"]] = ONE
    return table


def _prefixes(ids: np.ndarray, block: int = 128) -> np.ndarray:
    """Prefix compositions of transition functions, in blocks that advance side by side."""
    _, compose, _, _ = _machine()
    flat, width = compose.ravel(), compose.shape[1]
    n = len(ids)
    rows = -(-n // block)
    padded = np.zeros(rows * block, dtype=np.int32)
    padded[:n] = ids
    columns = np.ascontiguousarray(padded.reshape(rows, block).T)
    for k in range(1, block):
        np.take(flat, columns[k - 1] * width + columns[k], out=columns[k])
    if rows > 1:
        before = np.zeros(rows, dtype=np.int32)
        before[1:] = _prefixes(columns[-1], block)[:-1]
        columns = np.take(flat, before * width + columns)
    return columns.T.ravel()[:n]


def boundaries(codepoints: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions at which a piece begins; every text's first character is one of them."""
    of_symbol, _, functions, begins = _machine()
    n = len(codepoints)
    if not n:
        return np.zeros(0, dtype=np.int64)
    symbols = _base_symbols()[codepoints]
    first = np.zeros(n + 1, dtype=bool)
    first[text_starts[text_starts < n]] = True
    first[n] = True
    following = np.append(codepoints[1:], 0)
    inside = ~first[1:]
    pairs = (following == ord("e")) & ((codepoints == ord("r")) | (codepoints == ord("v")))
    pairs |= (following == ord("l")) & (codepoints == ord("l"))
    symbols[pairs & inside] = TWO
    white = (symbols == SPACE) | (symbols == WHITE)
    last = white & inside & ~np.append(white[1:], False)
    symbols[last] += 1
    symbols[first[:n]] += SYMBOLS
    after = functions[_prefixes(of_symbol[symbols]), BEGIN]
    before = np.append(BEGIN, after[:-1])
    return np.flatnonzero(begins[before, symbols])


def _grouped(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of each piece, first piece of each group) of the pieces between edges, grouped by their bytes."""
    starts, sizes = edges[:-1], np.diff(edges)
    _, sample, code = np.unique(span_hashes(data, starts, edges[1:]), return_index=True, return_inverse=True)
    like = sample[code]
    same = bool((sizes == sizes[like]).all())
    if same:
        moved = np.flatnonzero(like != np.arange(len(like)))
        own = np.repeat(starts[moved] - (np.cumsum(sizes[moved]) - sizes[moved]), sizes[moved]) + np.arange(sizes[moved].sum())
        same = bool((data[own] == data[own + np.repeat((starts[like] - starts)[moved], sizes[moved])]).all())
    if not same:
        raw, known = data.tobytes(), {}
        code = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), edges[1:].tolist(), strict=True)])
        _, sample = np.unique(code, return_index=True)
    return code, sample


class Vocabulary:
    """Ranks of byte strings, which are the token ids."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def piece(self, raw: bytes) -> bytes:
        """Token ids of one piece, four bytes each."""
        rank = self.ranks.get(raw)
        if rank is not None:
            ids = struct.pack("i", rank)
        elif len(raw) > LONG_PIECE:
            return np.array(self._merge_long(raw), dtype=np.int32).tobytes()
        else:
            merged = self._merge(raw)
            ids = struct.pack(f"{len(merged)}i", *merged)
        if len(self.young) >= CACHE_PIECES:
            self.old, self.young = self.young, {}
        self.young[raw] = ids
        return ids

    def forget(self) -> None:
        """Empty the cache, so that a worker that waits for other work holds no memory for this."""
        self.young, self.old = {}, {}

    def get(self, raw: bytes) -> bytes | None:
        """Token ids of one piece, if cached."""
        return self.young.get(raw) or self.old.get(raw)

    def _merge(self, raw: bytes) -> tuple[int, ...]:
        parts = [raw[i : i + 1] for i in range(len(raw))]
        get, none = self.ranks.get, len(self.tokens)
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at] = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def _merge_long(self, raw: bytes) -> tuple[int, ...]:
        """The same merges with a heap over a linked list: n log n for a piece of any length."""
        n = len(raw)
        end = list(range(1, n + 1))
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        alive = [True] * n
        rank = self.ranks.get
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n:
                r = rank(raw[i : end[j]])
                if r is not None:
                    heap.append((r, i, end[j])) if not ready else heapq.heappush(heap, (r, i, end[j]))

        ready = False
        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j] = False
            end[i], right[i] = end[j], right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[raw[i : end[i]]])
            i = right[i]
        return tuple(out)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more at the end)."""
        whole = "".join(texts)
        codepoints = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        raw = whole.encode()
        char_starts = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=char_starts[1:])
        begin = boundaries(codepoints, char_starts)
        if len(raw) == len(codepoints):
            cut = begin
        else:
            widths = np.ones(len(codepoints), dtype=np.int64)
            for limit in (0x80, 0x800, 0x10000):
                widths += codepoints >= limit
            cut = (np.cumsum(widths) - widths)[begin]
        data, edges = np.frombuffer(raw, dtype=np.uint8), np.append(cut, len(raw))
        code, sample = _grouped(data, edges)
        get, piece = self.get, self.piece
        pieces = [
            get(s) or piece(s) for s in (raw[a:b] for a, b in zip(edges[sample], edges[sample + 1], strict=True))
        ]
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        flat = np.frombuffer(b"".join(pieces), dtype=np.int32)
        counts = sizes[code]
        ends = np.append(0, np.cumsum(counts))
        shift = (np.cumsum(sizes) - sizes)[code] - ends[:-1]
        ids = flat[np.repeat(shift, counts) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(begin, char_starts)]


    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The bytes of each run of ids between bounds."""
        sizes = self.lengths[ids]
        ends = np.append(0, np.cumsum(sizes))
        data = self.flat[np.repeat(self.begins[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
        offsets = ends[bounds].astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file, read once per worker process."""
    return Vocabulary(path)


def text_groups(texts: Iterable, limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Neighbouring texts of about ``limit`` characters together; null as the empty text."""
    group, size = [], 0
    for text in texts:
        text = text or ""
        if group and size + len(text) > limit:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _encoder(path: str, id_column: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        try:
            for batch in batches:
                done = 0
                for group in text_groups(listed(batch.column(1))):
                    ids, bounds = known.encode(group)
                    ends = np.cumsum(known.lengths[ids])
                    base = np.append(0, ends)[bounds[:-1]]
                    ends = (ends - np.repeat(base, np.diff(bounds))).astype(np.int32)
                    offsets = pa.array(bounds.astype(np.int32))
                    columns = [
                        batch.column(0).slice(done, len(group)),
                        pa.ListArray.from_arrays(offsets, pa.array(ids)),
                        pa.ListArray.from_arrays(offsets, pa.array(ends)),
                    ]
                    if decoded:
                        columns.append(known.decode(ids, bounds))
                    yield pa.RecordBatch.from_arrays(columns, names=[id_column, "ids", "ends", "decoded"][: len(columns)])
                    done += len(group)
        finally:  # also when the reader of this task wants no more
            known.forget()

    return run


def encode(
    documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False
) -> DataFrame:
    """(id, ids array<int>, ends array<int>): the tokens of each whole text and the byte offset at which each token ends.
    ``decoded`` adds the bytes that the ids stand for, read back in the same pass."""
    chosen = documents.select(id_column, F.col(text_column).cast("string").alias("text"))
    kind = chosen.schema[0].dataType.simpleString()
    schema = f"`{id_column}` {kind}, ids array<int>, ends array<int>" + (", decoded binary" if decoded else "")
    return chosen.mapInArrow(tidy(_encoder(path, id_column, decoded)), schema)


def decode(encoded: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with the bytes of its ids as ``decoded`` in place of the id column."""
    kept = [c for c in encoded.columns if c not in (ids_column, "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                listed = part.column(len(kept))
                sizes = np.asarray(listed.value_lengths().fill_null(0))
                raw = known.decode(np.asarray(listed.flatten()), np.append(0, np.cumsum(sizes)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], raw], names=[*kept, "decoded"])

    fields = {f.name: f.dataType.simpleString() for f in encoded.schema}
    schema = "".join(f"`{c}` {fields[c]}, " for c in kept)
    ids = F.array_compact(F.col(f"`{ids_column}`")).alias("ids")
    numbered = encoded.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), ids)  # mapInArrow takes no dotted names
    return numbered.mapInArrow(tidy(run), f"{schema}decoded binary")
