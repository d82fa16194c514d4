"""N-gram Jaccard join by several global orders of the n-grams.

Under any one global order, two sets with Jaccard similarity of at least p/100 share an n-gram among
the first ``n - ceil(p*n/100) + 1`` of each. The join uses three orders: order 1 has rare n-grams first,
orders 2 and 3 follow hashes. A common n-gram of two order-1 prefixes proposes a pair, unless so many n-grams stand
before it in either set that the rest cannot reach the similarity (true pairs pass at their first common n-gram).
A pair goes on only if its prefixes also meet under order 2 and order 3. What is left is verified on the whole texts.

Rarity comes from counts over all documents in ``COUNTERS`` hashed counters, whose logarithms (one byte
each) are broadcast. Documents with the same set are one node from the start, so copies never pair up.

Proposing is linear first: every member of a prefix group is paired with the smallest member of its
size class. Once those links have made components, only groups that still hold several components
propose the pairs across them, which are the only ones that can still join anything. A group of more than
``PAIRED`` members is dealt out by a second n-gram first, one of the prefix under order 2, and what is still larger by a third one under
order 3, since only sets that share all three can be similar; what pairs up in the end has met under every order in one key. So no
link between two components is lost, and neither near copies nor dissimilar sets around one common n-gram make a square of pairs.

Defined cases: a text without words has an empty set and links with nothing; fewer than ``n`` words make
one n-gram of all; a row with a null id has no component (null) and links nothing; rows with the same
id are one document; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.llm.components import components
from prepmill.llm.textbytes import LOWER, chunks, joined, listed, mixed, prime_hashes, row_hashes, tidy, word_spans
from prepmill.sources.storage import materialize

COUNTERS = 1 << 20
SLICES = 64
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, *range(9, 14)]] = False
ORDER_SEEDS = [np.uint64(0), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)]
SETS = "doc_id long, n long, signature binary, p1 array<long>, p2 array<int>, p3 array<int>"
#: Ids are broadcast up to this number; beyond it they are joined by a shuffle.
MOST_IDS = 2_000_000
#: Members of a prefix group that are paired without a further n-gram. Dealing a member out costs a row for each n-gram of a prefix.
PAIRED = 4096
#: Tasks' counters are added up in so many groups first.
TASK_GROUPS = 1024


def shingle_sets(group: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct n-grams of each text, sorted by both."""
    data, text_starts = joined(group)
    data = LOWER[data]
    starts, ends = word_spans(IS_WORD[data])
    bounds = np.append(np.searchsorted(starts, text_starts), len(starts))
    words = prime_hashes(data, starts, ends)
    rows = np.repeat(np.arange(len(group)), np.diff(bounds))
    hashes = row_hashes(words, n)
    inside = rows[: len(hashes)] == rows[n - 1 :]
    rows_of, hashes = rows[: len(hashes)][inside], hashes[inside]
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < n))
    if len(short):
        whole = [row_hashes(words[bounds[i] : bounds[i + 1]], bounds[i + 1] - bounds[i])[0] for i in short]
        rows_of, hashes = np.append(rows_of, short), np.append(hashes, np.array(whole, dtype=np.uint64))
    order = np.lexsort((hashes, rows_of))
    rows_of, hashes = rows_of[order], hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows_of[1:] != rows_of[:-1])
    return rows_of[new], hashes[new]


def _count(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for _, group in chunks(listed(batch.column(0))):
                _, hashes = shingle_sets(group, n)
                total += np.bincount((hashes % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        width = COUNTERS // SLICES
        packed = [zlib.compress(total[i * width : (i + 1) * width].tobytes(), 1) for i in range(SLICES)]
        task = [TaskContext.get().partitionId() % TASK_GROUPS] * SLICES
        columns = [pa.array(range(SLICES), pa.int32()), pa.array(task, pa.int32()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["slice", "tasks", "counts"])

    return run


def _total(table: pa.Table) -> np.ndarray:
    return sum(np.frombuffer(zlib.decompress(x.as_py()), dtype=np.int64) for x in table.column("counts"))


def _add(table: pa.Table) -> pa.Table:
    packed = pa.array([zlib.compress(_total(table).tobytes(), 1)], pa.binary())
    return pa.table([table.column("slice")[:1], packed], names=["slice", "counts"])


def _levels(table: pa.Table) -> pa.Table:
    levels = np.minimum(np.floor(4 * np.log2(_total(table) + 1)), 255).astype(np.uint8)
    return pa.table([table.column("slice")[:1], pa.array([levels.tobytes()], pa.binary())], names=["slice", "counts"])


def rarity(texts: DataFrame, n: int) -> np.ndarray:
    """A level for each hashed counter of n-grams, higher for more documents. One byte each, so the result
    has ``COUNTERS`` bytes whatever the corpus."""
    schema = "slice int, counts binary"
    counted = texts.mapInArrow(tidy(_count(n)), "slice int, tasks int, counts binary")
    added = counted.groupBy("slice", "tasks").applyInArrow(_add, schema)
    parts = added.groupBy("slice").applyInArrow(_levels, schema).collect()
    levels = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint8)
    for part in parts:
        levels[part["slice"]] = np.frombuffer(part["counts"], dtype=np.uint8)
    return levels.ravel()


def _prefixes(n: int, percent: int, broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = broadcast.value
        seen: set[bytes] = set()
        for batch in batches:
            for first, group in chunks(listed(batch.column(1))):
                rows, hashes = shingle_sets(group, n)
                sizes = np.bincount(rows, minlength=len(group))
                ends = np.cumsum(sizes)
                sums = [np.append(np.uint64(0), np.cumsum(mixed(hashes + seed))) for seed in ORDER_SEEDS[1:]]
                marks = np.stack([s[ends] - s[ends - sizes] for s in sums], axis=1).astype(np.uint64)
                signatures = [m.tobytes() if k else None for m, k in zip(marks, sizes.tolist(), strict=True)]
                level = levels[hashes % np.uint64(COUNTERS)].astype(np.uint64)
                lengths = sizes - (percent * sizes + 99) // 100 + 1
                columns = []
                for k, seed in enumerate(ORDER_SEEDS):
                    own = mixed(hashes + seed) >> np.uint64(20 if k == 0 else 12)
                    key = (rows.astype(np.uint64) << np.uint64(52)) | own
                    if k == 0:
                        key |= level << np.uint64(44)
                    order = np.argsort(key, kind="stable")
                    columns.append(hashes[order])
                ids = batch.column(0).slice(first, len(group))
                fresh = []
                for s, named in zip(signatures, ids.is_valid().to_pylist(), strict=True):
                    # a row without an id joins no class, so it must not be the one that carries the prefixes
                    fresh.append(named and s is not None and s not in seen)
                    if fresh[-1]:
                        seen.add(s)
                if len(seen) > 500_000:
                    seen.clear()
                columns = [columns[0].view(np.int64), *(c.astype(np.uint32).view(np.int32) for c in columns[1:])]
                kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                cuts = [(e - k, e - k + m) for e, k, m in zip(ends.tolist(), sizes.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(sizes, pa.int64()),
                        pa.array(signatures, pa.binary()),
                        *(
                            pa.array([c[a:b] if f else None for (a, b), f in zip(cuts, fresh, strict=True)], kind)
                            for c, kind in zip(columns, kinds, strict=True)
                        ),
                    ],
                    names=["doc_id", "n", "signature", "p1", "p2", "p3"],
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in compressed form, which is a fraction of the size of their sets of hashes."""
    for batch in batches:
        for first, group in chunks(listed(batch.column(1))):
            packed = pa.array([zlib.compress(x, 6) for x in group], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(group)), packed], names=["node", "packed"])


def _linked(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sides = [part.column(2).to_pylist(), part.column(3).to_pylist()]
                distinct, sets = list(dict.fromkeys(sides[0] + sides[1])), {}
                for first, group in chunks([zlib.decompress(x) for x in distinct]):
                    rows, hashes = shingle_sets(group, n)
                    edges = np.searchsorted(rows, np.arange(len(group) + 1)).tolist()
                    for i in range(len(group)):
                        sets[distinct[first + i]] = hashes[edges[i] : edges[i + 1]]
                keep = []
                for x, y in zip(*sides, strict=True):
                    both = np.concatenate([sets[x], sets[y]])
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * same >= percent * (len(both) - same))
                yield part.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return run


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Of the proposed pairs (a, b), those that pass the size filter, the orders 2 and 3 and the check of the
    whole sets."""
    side = lambda x: classes.select(
        F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("p2").alias(f"p2_{x}"), F.col("p3").alias(f"p3_{x}")
    )
    near = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .filter(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
        .filter(F.arrays_overlap("p2_a", "p2_b") & F.arrays_overlap("p3_a", "p3_b"))
        .select("a", "b")
        .distinct()
    )
    near = materialize(near, "near")
    nodes = materialize(near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), "nodes")
    few = nodes.count() <= MOST_IDS
    wanted = texts.join(F.broadcast(nodes) if few else nodes, texts["doc_id"] == nodes["id"]).select("doc_id", "text")
    held = materialize(wanted.mapInArrow(tidy(_packed), "node long, packed binary"), "near-texts")
    left = near.join(held.select(F.col("node").alias("a"), F.col("packed").alias("x")), "a")
    whole = left.join(held.select(F.col("node").alias("b"), F.col("packed").alias("y")), "b")
    links = whole.select("a", "b", "x", "y").mapInArrow(tidy(_linked(n, percent)), "a long, b long")
    return materialize(links.distinct(), "verified")


def _open(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of groups that hold several components, with the number of ``members``."""
    groups = rows.groupBy(*keys).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")
    )
    return rows.join(groups.filter("low < high").select(*keys, "members"), keys)


def _across(labelled: DataFrame, classes: DataFrame, reach: Column) -> DataFrame:
    """Pairs (a, b) of different components that share a prefix n-gram of order 1 and, where many do, one of order 2
    and one of order 3 as well. ``labelled``: token, rep, n, rest, component; ``reach`` compares n and rest with n_a and rest_a."""

    def paired(rows: DataFrame, keys: list[str]) -> DataFrame:
        other = rows.select(
            *keys,
            F.col("rep").alias("a"),
            F.col("n").alias("n_a"),
            F.col("rest").alias("rest_a"),
            F.col("component").alias("other"),
        )
        near = rows.join(other, keys).filter("a < rep and component <> other").filter(reach)
        return near.select("a", F.col("rep").alias("b"))

    keys, rows = ["token"], _open(labelled, ["token"])
    pairs = []
    for prefix, key in (("p2", "second"), ("p3", "third")):
        rows = materialize(rows, "open")
        pairs.append(paired(rows.filter(F.col("members") <= PAIRED), keys))
        large = rows.filter(F.col("members") > PAIRED).drop("members")
        grams = classes.select(F.col("rep").alias("of"), F.col(prefix).alias("grams"))
        held = large.join(grams, large["rep"] == grams["of"]).select(*large.columns, F.explode("grams").alias(key))
        keys = [*keys, key]
        rows = _open(materialize(held, "held"), keys)
    return pairs[0].union(pairs[1]).union(paired(rows, keys)).distinct()


def jaccard_components(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest doc_id that links of Jaccard similarity
    percent/100 or more lead to, itself included."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels = spark.sparkContext.broadcast(rarity(texts.select("text"), n))
    sets = materialize(texts.mapInArrow(tidy(_prefixes(n, percent, levels)), SETS), "prefixes")

    named = sets.filter("doc_id is not null and signature is not null")
    classes = named.groupBy("signature").agg(
        F.min("doc_id").alias("rep"),
        F.max("n").alias("n"),
        *(F.first(p, ignorenulls=True).alias(p) for p in ("p1", "p2", "p3")),
    )
    classes = materialize(classes, "classes")

    tokens = classes.select(F.posexplode("p1").alias("at", "token"), "rep", "n")
    shared = tokens.groupBy("token").count().filter("count > 1").select("token")
    step = float(np.log(100 / percent)) if percent < 100 else 1.0
    size_class = F.floor(F.log("n") / step) if percent < 100 else F.col("n")
    tokens = tokens.select("token", "rep", "n", (F.col("n") - F.col("at")).alias("rest"))
    shared = materialize(tokens.join(shared, "token").withColumn("size", size_class.cast("long")), "shared")
    reach = F.lit(100 + percent) * F.least("rest", "rest_a") >= F.lit(percent) * (F.col("n") + F.col("n_a"))

    leaders = shared.groupBy("token", "size").agg(F.min(F.struct("rep", "n", "rest")).alias("lead"))
    leaders = leaders.select(
        "token", "size", F.col("lead.rep").alias("a"), F.col("lead.n").alias("n_a"), F.col("lead.rest").alias("rest_a")
    )
    first = shared.join(leaders, ["token", "size"]).filter("a < rep").filter(reach)
    first = materialize(first.select("a", F.col("rep").alias("b")).distinct(), "first")
    links = _verified(first, classes, texts, n, percent)
    joined_so_far = components(links)

    labelled = shared.join(joined_so_far, shared["rep"] == joined_so_far["node"], "left").select(
        "token", "rep", "n", "rest", F.coalesce("component", "rep").alias("component")
    )
    across = _across(materialize(labelled, "labelled"), classes, reach).join(first, ["a", "b"], "left_anti")
    more = _verified(across, classes, texts, n, percent)
    found = components(links.union(more))

    members = sets.select("doc_id", "signature", F.col("n").alias("n_shingles"))
    merged = classes.join(found, classes["rep"] == found["node"], "left").select(
        F.col("signature").alias("of"), F.coalesce("component", "rep").alias("label")
    )
    return members.join(merged, members["signature"] == merged["of"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("label", "doc_id")).alias("component_id"),
    )


def one_per_group(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """The document with the smallest id of each group, with all its columns; rows with a null id stay, and so do all rows of a
    kept id, since rows with one id are one document."""
    found = jaccard_components(documents, n, percent).filter("doc_id = component_id").select("doc_id").distinct()
    return documents.join(found, "doc_id", "left_semi").union(documents.filter("doc_id is null"))
