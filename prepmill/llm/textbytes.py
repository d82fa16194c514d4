"""Byte-array helpers shared by the text operators: chunks of texts, words and rolling hashes.

All functions work on one Arrow batch inside a task. Texts are handled whole; a chunk is a group of
neighbouring rows of about ``CHUNK`` bytes (one row alone if it is longer), so memory follows the
longest text and not the batch. What a task has freed goes back to the system at its end: Spark keeps its Python
workers for later tasks, and a worker that waits would hold its largest size for good.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15 | 3)
_WORD_ROW = np.uint64(0xD1B54A32D192ED03)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Texts that are taken out of a batch at a time.
LISTED = 256


def listed(column: pa.Array | pa.ChunkedArray) -> Iterator:
    """The values of a column, of which only a few are Python objects at a time."""
    for at in range(0, len(column), LISTED):
        yield from column.slice(at, LISTED).to_pylist()


#: The C library's own call for giving free memory back, where it has one.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that is free within this process to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` over the batches of a task, with ``give_back`` when it has ended, also where its reader wants no more."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def chunks(texts: Iterable, limit: int = CHUNK, most: int = 4096) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) of each group of ``most`` rows at most; null is the empty text."""
    first, group, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode() if isinstance(text, str) else bytes(text)
        if group and (size + len(raw) > limit or len(group) == most):
            yield first, group
            first, group, size = i, [], 0
        group.append(raw)
        size += len(raw) + 1
    if group:
        yield first, group


def joined(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space after each as one byte array, and the start of each text."""
    data = np.frombuffer(b" ".join([*group, b""]), dtype=np.uint8)
    starts = np.zeros(len(group), dtype=np.int64)
    np.cumsum([len(x) + 1 for x in group[:-1]], out=starts[1:])
    return data, starts


def word_spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.flatnonzero(np.diff(is_word.view(np.int8), prepend=0, append=0))
    return edges[0::2], edges[1::2]


@functools.lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(CHUNK + 64)


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
        power = np.full(n, np.uint64(base))
        power[:1] = 1
        out.append(np.cumprod(power, dtype=np.uint64, out=power))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n. Those of one chunk are kept, those of a longer text are not."""
    power, inverse = _kept_powers() if n <= CHUNK + 64 else _new_powers(n)
    return power[:n], inverse[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """out[i] = sum of (byte + 1) * BASE**k over k < i, modulo 2**64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    power, _ = powers(len(data) + 1)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, the same wherever the span stands."""
    sums = prefix_sums(data)
    _, inverse = powers(len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


PRIME = np.uint64((1 << 61) - 1)
_PRIME_BASE = 0x1B873593CC9E2D51 % ((1 << 61) - 1)
_LOW = {bits: np.uint64((1 << bits) - 1) for bits in (29, 30, 31, 32)}


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of numbers below PRIME: products of halves, with 2**61 counted as 1."""
    low_a, high_a = a & _LOW[31], a >> np.uint64(31)
    low_b, high_b = b & _LOW[31], b >> np.uint64(31)
    middle = low_a * high_b + high_a * low_b
    total = np.uint64(2) * high_a * high_b + (middle >> np.uint64(30)) + ((middle & _LOW[30]) << np.uint64(31)) + low_a * low_b
    return _reduced(total)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


@functools.lru_cache(maxsize=1)
def _prime_powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """_PRIME_BASE**i and its inverse modulo PRIME for i < 2**bits."""
    out = []
    for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, int(PRIME))):
        power = np.ones(1, dtype=np.uint64)
        for k in range(bits):
            power = np.concatenate([power, times(power, np.full(1, pow(base, 1 << k, int(PRIME)), dtype=np.uint64))])
        out.append(power)
    return out[0], out[1]


def prime_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes`` modulo a prime: spans of any length that differ have different hashes but for chance, while modulo a power of
    two some long words and their complements always meet. For equality that is not looked at again."""
    bits = max(20, int(len(data)).bit_length())  # one table for all but very long texts
    power, inverse = _prime_powers(bits)
    value = data.astype(np.uint64) + np.uint64(1)
    high = value * (power[: len(data)] >> np.uint64(32))
    terms = (high >> np.uint64(29)) + ((high & _LOW[29]) << np.uint64(32)) + value * (power[: len(data)] & _LOW[32])
    sums = []
    for half in (terms & _LOW[32], terms >> np.uint64(32)):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(half, out=total[1:])
        sums.append(total[ends] - total[starts])
    low, high = sums
    total = _reduced((high >> np.uint64(29)) + ((high & _LOW[29]) << np.uint64(32)) + low)
    return mixed(times(total, inverse[starts]) + (ends - starts).astype(np.uint64) * BASE)


def row_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n neighbouring word hashes, in order."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        total = total * _WORD_ROW + words[k : k + len(total)]
    return mixed(total + np.uint64(n))
