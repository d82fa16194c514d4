"""Near-duplicate vectors by cosine: spherical k-means cells, blocked products inside them, one vector kept of each group.

Equal vectors are one node from the start. Centres are fitted on a sample of at most ``sample`` nodes; every node goes to the cell
of its nearest centre, its home. Two vectors within the angle of ``cosine`` may lie on two sides of a border, so a node is also a
guest in each other cell whose border it is near: a node x with home a can have a link to a member of cell b only if
``x . (a - b) <= sin(angle) * |a - b|``. So all links of a node are between its home's members and guests, and none is lost; with
``margin`` below 1 fewer guests are sent and links across borders may be.

Members within half the angle of a cell's centre, its core, all link with one another. They are counted by their number, not compared, so
that a group of near copies that holds a third of all rows costs no square of its size. Everything else is compared in blocks of
``BLOCK`` by ``BLOCK`` nodes, each block a task of its own; a product over a quarter of the components, whose bound no link can miss, goes ahead. A block returns for each of its nodes the number of links and
the smallest node of its group within the block, no pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows with a null id, and
vectors of different lengths do not meet; such a row is its own component (null for a null id) and is kept. Equal vectors and positive
multiples have cosine 1. Rows with one id are vectors of their own, and a component's name is the smallest id in it. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.llm.components import components
from prepmill.sources.storage import materialize

BLOCK = 8192
#: Rows of a block that are multiplied at once.
STRIP = 512
SLACK = 1e-9
#: Cells of vectors of one length.
LENGTH_BITS = 20
# Kinds of members, in the order in which a cell's blocks are numbered.
HOME_REST, HOME_CORE, GUEST_CORE, GUEST_REST = range(4)


def usable(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(points: np.ndarray) -> np.ndarray:
    points = points / np.abs(points).max(axis=1, keepdims=True)  # neither very large nor very small numbers lose their length
    return points / np.sqrt((points**2).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return _unit(np.asarray(column.flatten()).astype(np.float64).reshape(len(column), length))


def spherical_means(points: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """``k`` centres, at most, of unit vectors: the first are spread points, then each is the direction of its members' sum."""
    centres = points[:: max(1, len(points) // k)][:k].copy()
    for _ in range(rounds):
        near = np.concatenate([(points[i : i + 8192] @ centres.T).argmax(axis=1) for i in range(0, len(points), 8192)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        lengths = np.sqrt((sums**2).sum(axis=1))
        moved = lengths > 1e-6
        centres[moved] = sums[moved] / lengths[moved, None]
    return centres


def _fit(sample: list, nodes: int, per_cell: int, most_cells: int) -> dict[int, np.ndarray]:
    """Centres by vector length, in proportion to the sample's rows of that length."""
    out = {}
    for length in {len(v) for v in sample}:
        points = _unit(np.array([v for v in sample if len(v) == length], dtype=np.float64))
        k = -(-nodes * len(points) // (len(sample) * per_cell))
        out[length] = spherical_means(points, max(1, min(k, most_cells, len(points))))
    return out


def _deal(broadcast, angle: float, margin: float):
    """Each node at home, and as a guest in the cells it is near."""
    reach = np.sin(angle) * margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres_of: dict[int, np.ndarray] = broadcast.value
        for batch in batches:
            lengths = np.asarray(pa.compute.list_value_length(batch.column(2)))
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                for a in range(0, len(rows), 2048):
                    part = batch.take(pa.array(rows[a : a + 2048]))
                    points = _matrix(part.column(2), length)
                    centres = centres_of.get(length, points[:0])
                    if not len(centres):  # no vector of this length was sampled: one cell without a core
                        at, to = np.arange(len(points)), np.zeros(len(points), dtype=np.int64)
                        home, core = np.ones(len(points), dtype=bool), np.zeros(len(points), dtype=bool)
                    else:
                        near = points @ centres.T
                        own = near.argmax(axis=1)
                        apart = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
                        over = near[np.arange(len(points)), own][:, None] - near
                        at, to = np.nonzero(over <= reach * apart[own] + SLACK)
                        home = to == own[at]
                        core = near[at, to] >= np.cos(angle / 2 - SLACK)
                    kind = np.where(home, np.where(core, HOME_CORE, HOME_REST), np.where(core, GUEST_CORE, GUEST_REST))
                    dealt = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((length << LENGTH_BITS) + to), pa.array(kind.astype(np.int32)), *dealt.columns],
                        names=["cell", "kind", "node", "size", "vector"],
                    )

    return run


def _roots(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node of the group that each row and column of a block belongs to by its links."""
    roots = left.copy(), right.copy()
    open_rows, open_columns = linked.any(axis=1), linked.any(axis=0)
    while open_rows.any():
        rows, columns = np.zeros(len(left), dtype=bool), np.zeros(len(right), dtype=bool)
        fresh = np.zeros(len(left), dtype=bool)
        fresh[open_rows.argmax()] = True
        while fresh.any():
            rows |= fresh
            open_rows &= ~fresh
            reached = linked[fresh].any(axis=0) & open_columns
            columns |= reached
            open_columns &= ~reached
            fresh = linked[:, reached].any(axis=1) & open_rows
        least = min(left[rows].min(), right[columns].min())
        roots[0][rows] = least
        roots[1][columns] = least
    return roots


def _bounded(points: np.ndarray) -> np.ndarray:
    """Rows whose inner product is that of two unit vectors or more: a turned vector's first quarter and the length of the rest
    (by Cauchy-Schwarz). The turn is random, the same for all vectors of one length."""
    length = points.shape[1]
    if length < 24:
        return points.astype(np.float32)
    turn, _ = np.linalg.qr(np.random.default_rng(length).normal(size=(length, length)))
    turned = points @ turn
    rest = np.sqrt((turned[:, length // 4 :] ** 2).sum(axis=1))
    return np.column_stack([turned[:, : length // 4], rest]).astype(np.float32)


def _linked(left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows have ``cosine`` or more with which: a cheap bound in single precision leaves few pairs to multiply whole."""
    linked = np.zeros((len(left), len(right)), dtype=bool)
    low_left, low_right = _bounded(left), _bounded(right)
    for a in range(0, len(left), STRIP):
        at, to = np.nonzero(low_left[a : a + STRIP] @ low_right.T >= np.float32(cosine - 1e-4))
        if 8 * len(at) > STRIP * len(right):
            linked[a : a + STRIP] = left[a : a + STRIP] @ right.T >= cosine
            continue
        for b in range(0, len(at), 1 << 16):
            x, y = at[b : b + (1 << 16)], to[b : b + (1 << 16)]
            near = np.einsum("ij,ij->i", left[a + x], right[y]) >= cosine
            linked[a + x[near], y[near]] = True
    return linked


def _compare(cosine: float):
    """The links of one block: of one set of nodes among themselves, or of two sets with each other."""

    def run(unit: pa.Table) -> pa.Table:
        unit = unit.sort_by("node")
        part = np.asarray(unit.column("part"))
        low, high = int(unit.column("low")[0].as_py()), int(unit.column("high")[0].as_py())
        length = int(unit.column("cell")[0].as_py()) >> LENGTH_BITS
        nodes, sizes, home = (np.asarray(unit.column(c)) for c in ("node", "size", "home"))
        points = _matrix(unit.column("vector").combine_chunks(), length)
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        linked = _linked(points[left], points[right], cosine)
        if low == high:
            np.fill_diagonal(linked, False)
        links, roots = np.zeros(len(nodes), dtype=np.int64), nodes.copy()
        if linked.any():
            for a in range(0, len(left), STRIP):
                at, to = np.nonzero(linked[a : a + STRIP])
                links[left[a : a + STRIP]] += np.bincount(at, sizes[right[to]], len(left[a : a + STRIP])).astype(np.int64)
                if low != high:
                    links[right] += np.bincount(to, sizes[left[a + at]], len(right)).astype(np.int64)
            roots_left, roots_right = _roots(linked, nodes[left], nodes[right])
            roots[right] = roots_right
            roots[left] = roots_left
        links[~home] = 0  # a guest's links are counted where it is at home
        told = (links > 0) | (roots != nodes)
        return pa.table([pa.array(x[told]) for x in (nodes, links, roots)], names=["node", "links", "root"])

    return run


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    per_cell: int = 16384,
    most_cells: int = 1024,
    sample: int = 65536,
    margin: float = 1.0,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: how many other vectors have ``cosine`` or more with it, the smallest id
    that such links lead to, and whether that is its own."""
    spark, angle = vectors.sparkSession, float(np.arccos(cosine))
    named = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    takes_part = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    rows = named.filter(takes_part)
    classes = rows.groupBy("vector").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("node"), "size", "least", "vector"), "classes")
    kind = classes.schema["vector"].dataType.simpleString()

    chosen = classes.orderBy(F.xxhash64("least", "node"), "node").limit(sample).select("vector").collect()
    centres = _fit([r["vector"] for r in chosen], classes.count(), per_cell, most_cells) if chosen else {}
    dealt = classes.select("node", "size", "vector").mapInArrow(
        _deal(spark.sparkContext.broadcast(centres), angle, margin), f"cell long, kind int, node long, size long, vector {kind}"
    )
    dealt = materialize(dealt, "cells")

    blocks = lambda k: F.ceil(F.sum((F.col("kind") == k).cast("long")) / BLOCK).cast("int")
    is_core = F.col("kind").isin(HOME_CORE, GUEST_CORE)
    cells = dealt.groupBy("cell").agg(
        *(blocks(k).alias(f"blocks{k}") for k in range(4)),
        F.sum(F.when(is_core, F.col("size"))).alias("core_size"),
        F.min(F.when(is_core, F.col("node"))).alias("core_root"),
    )
    cells = materialize(cells, "cell-sizes")  # a row per cell, of which there are most_cells for each vector length
    ends = [sum((F.col(f"blocks{j}") for j in range(k + 1)), F.lit(0)) for k in range(4)]
    begins = [F.lit(0), *ends[:-1]]
    kind_is = lambda choices: F.element_at(F.array(*choices), F.col("kind") + 1)
    in_blocks = dealt.join(F.broadcast(cells), "cell")

    # blocks of the home's rest meet all blocks, the core meets the rest only, guests meet no guests
    spread = F.pmod(F.xxhash64("node"), kind_is([F.col(f"blocks{k}") for k in range(4)]).cast("long")).cast("int")
    part = kind_is(begins) + spread
    span = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))
    rest, guests = span(begins[HOME_REST], ends[HOME_REST]), span(begins[GUEST_REST], ends[GUEST_REST])
    others = kind_is([span(F.lit(0), ends[3]), F.concat(rest, guests), rest, span(F.lit(0), ends[HOME_CORE])])
    units = in_blocks.select("cell", "kind", "node", "size", "vector", part.alias("part"), others.alias("others"))
    units = units.select("cell", "kind", "node", "size", "vector", "part", F.explode("others").alias("other"))
    units = units.select(
        "cell",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        F.col("kind").isin(HOME_REST, HOME_CORE).alias("home"),
        "node",
        "size",
        "vector",
    )
    found = units.groupBy("cell", "low", "high").applyInArrow(_compare(cosine), "node long, links long, root long")
    found = materialize(found, "blocks")

    core = in_blocks.filter(is_core).select(
        "node",
        F.when(F.col("kind") == HOME_CORE, F.col("core_size") - F.col("size")).otherwise(0).alias("links"),
        F.col("core_root").alias("root"),
    )
    linked = found.union(core)
    groups = components(linked.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named_groups = groups.withColumnRenamed("node", "of").join(classes.select("node", "least"), F.col("of") == F.col("node"))
    least = named_groups.groupBy("component").agg(F.min("least").alias("first")).withColumnRenamed("component", "c")
    labels = named_groups.join(least, F.col("component") == F.col("c")).select(F.col("of"), "first")
    result = classes.join(counted, "node", "left").join(labels, F.col("node") == F.col("of"), "left")
    result = result.select(
        F.col("vector").alias("v"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("first", "least").alias("component_id"),
    )
    joined = rows.join(result, F.col("vector") == F.col("v")).select("vec_id", "n_links", "component_id")
    alone = named.filter(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = joined.union(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
