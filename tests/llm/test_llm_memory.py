"""What a Python worker holds while it works and after it."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from prepmill.llm import suffixes, textbytes


def own_memory():
    """MB of this process, without mapped files."""
    status = Path("/proc/self/status").read_text().split()
    return int(status[status.index("RssAnon:") + 1]) / 1024


@pytest.mark.parametrize("whole", [True, False])
def test_a_task_gives_back_what_it_freed(whole):
    pins = []

    def run(batches):
        for batch in batches:
            np.ones(30 << 20, dtype=np.uint8)  # from now on the C library keeps arrays below this size
            used = []
            for _ in range(200):
                used.append(np.ones(1 << 20, dtype=np.uint8))
                pins.append(np.ones(2000, dtype=np.uint8))  # what stays lies between what goes
            yield batch

    before = own_memory()
    batches = textbytes.tidy(run)(iter([pa.RecordBatch.from_pydict({"n": [1]})] * 2))
    assert next(batches).num_rows == 1
    assert own_memory() > before + 150
    if whole:
        assert len(list(batches)) == 1
    else:
        batches.close()  # a reader that wants no more
    assert own_memory() < before + 60


def test_powers_of_a_long_text_are_not_kept():
    n = 5 * textbytes.CHUNK
    power, inverse = textbytes.powers(n)
    assert len(power) == len(inverse) == n
    assert (power * inverse == 1).all()
    assert int(power[2]) == int(textbytes.BASE) ** 2 % 2**64
    short, _ = textbytes.powers(100)
    assert (short == power[:100]).all()
    assert len(short.base) < 2 * textbytes.CHUNK


def test_listed_gives_every_value():
    values = ["a", None, "", *map(str, range(1000))]
    assert list(textbytes.listed(pa.array(values))) == values
    assert list(textbytes.listed(pa.chunked_array([values[:5], values[5:]]))) == values
    assert list(textbytes.listed(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_a_part_sends_a_hash_once_or_twice(n):
    rng = random.Random(n)
    hashes = [rng.choice([rng.getrandbits(64), 7, 2**63 + 5]) for _ in range(n)]
    found = Counter()
    for part, bucket, raw, kind in suffixes._send(3, np.array(hashes, dtype=np.uint64), 11, np.uint64):
        own = np.frombuffer(raw, dtype=np.uint64).tolist()
        assert (part, kind) == (3, "asked") and own and all(x % 11 == bucket for x in own)
        found.update(own)
    assert found == {x: min(k, 2) for x, k in Counter(hashes).items()}
