"""Token counts by section, attributed by offsets.

A document is encoded once, whole. Each token has a span of UTF-8 bytes; the spans are joined with the
spans of the document's sections (intervals that cover the text without overlap) by a search in the
sorted section starts. A token that crosses a section boundary goes by an explicit rule:

- ``start``: to the section that holds its first byte;
- ``end``: to the section that holds its last byte;
- ``most``: to the section that holds most of its bytes, the earlier one on a tie.

The default sections are lines, each with its line break; any function from a text to the starts of
its sections in bytes can be given instead.

Defined cases: a null or empty text has one empty section without tokens; repeated rows are each
counted; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.llm.bpe import text_groups, vocabulary

RULES = ("start", "end", "most")
SCHEMA = "doc_id long, n_tokens long, starts array<long>, tokens array<long>, crossing long"


def line_starts(raw: bytes) -> np.ndarray:
    """Byte offsets at which the lines of a text begin."""
    breaks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    return np.append(0, breaks[breaks < len(raw)])


def attribute(lengths: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """(tokens per section, number of tokens that cross a boundary) of one text."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.searchsorted(starts, begins, side="right") - 1
    last = np.searchsorted(starts, ends - 1, side="right") - 1
    if rule == "start":
        chosen = first
    elif rule == "end":
        chosen = last
    else:
        chosen = first.copy()
        for i in np.flatnonzero(first != last).tolist():
            edges = np.concatenate([[begins[i]], starts[first[i] + 1 : last[i] + 1], [ends[i]]])
            chosen[i] = first[i] + int(np.argmax(np.diff(edges)))
    return np.bincount(chosen, minlength=len(starts)), int((first != last).sum())


def token_counts(
    documents: DataFrame,
    path: str,
    rule: str = "most",
    sections: Callable[[bytes], np.ndarray] = line_starts,
) -> DataFrame:
    """Per document: doc_id, n_tokens, the byte offset of each section (``starts``), the tokens given to
    each (``tokens``) and how many tokens crossed a boundary (``crossing``)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        try:
            for batch in batches:
                done = 0
                for group in text_groups(batch.column(1).to_pylist()):
                    ids, bounds = known.encode(group)
                    rows: dict[str, list] = {"n_tokens": np.diff(bounds).tolist(), "starts": [], "tokens": [], "crossing": []}
                    for text, a, b in zip(group, bounds[:-1], bounds[1:], strict=True):
                        starts = sections(text.encode())
                        counts, crossing = attribute(known.lengths[ids[a:b]], starts, rule)
                        rows["starts"].append(starts)
                        rows["tokens"].append(counts)
                        rows["crossing"].append(crossing)
                    listed = pa.list_(pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(done, len(group)),
                            pa.array(rows["n_tokens"], pa.int64()),
                            pa.array(rows["starts"], listed),
                            pa.array(rows["tokens"], listed),
                            pa.array(rows["crossing"], pa.int64()),
                        ],
                        names=["doc_id", "n_tokens", "starts", "tokens", "crossing"],
                    )
                    done += len(group)
        finally:  # also when the reader of this task wants no more
            known.forget()

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, SCHEMA)
