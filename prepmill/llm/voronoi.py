"""Exact top-k by inner product as a Voronoi join.

Pivots are drawn from the data, about one per ``BLOCK`` rows between ``FEWEST`` and ``MOST`` (so that what is broadcast is
bounded), and every vector belongs to the cell of its nearest pivot. Cells are dealt out in blocks of about ``BLOCK``
vectors, so that a vector which a third of all rows hold fills many blocks and not one task. Neighbouring cells form a
group of about ``SHARE`` queries; a cell with more is a group whose queries are dealt out in parts.

A query is first solved in its own cell, which gives it a floor: the k-th best score so far. Cells are then summarised:
number of members, largest distance from the pivot, and for the queries of a cell the smallest floor. With
``q = p + a`` and ``v = c + b`` around their pivots, ``q.v <= p.c + |p||b| + |a||c| + |a||b|``, so a cell whose summary stays below
the floor of another's queries is of no use to any of them. For the pairs that remain each query is held against the cell
alone (``q.c + |q||b|``). A cell is copied to a group, once, only if one of its queries still needs it, and solved there;
each block returns k rows per query.

Scores are whole numbers: every component x counts as floor(256 * x).

Defined cases: a null vector, one with a null or non-finite component or one with a null id takes no part;
vectors of different lengths do not meet; rows with a query's id are its own; equal scores go to the
smaller id; repeated candidates are listed as often as they occur; different vectors under one id are all asked and their
hits ranked together; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepmill.sources.storage import materialize

BLOCK = 4096
SHARE = 2048
FEWEST, MOST = 64, 4096
HITS = "query_id long, vec_id long, score long"
SAFE = float(2**53)


def quantised(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector array<long>) of the rows that take part."""
    whole = F.col(vector_column).cast("array<double>")
    usable = F.col(id_column).isNotNull() & whole.isNotNull()
    usable &= F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(whole, lambda x: F.floor(x * 256).cast("long"))
    return vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), scaled.alias("vector")
    )


class Pivots:
    """Centres by number; vectors of a length without pivots share a cell around the origin."""

    def __init__(self, rows: list):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in {len(r) for r in rows}:
            own = [i for i, r in enumerate(rows) if len(r) == length]
            self.by_length[length] = np.array(own), np.array([rows[i] for i in own], dtype=np.float64).reshape(len(own), length)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        return self.by_length.get(length) or (np.array([-1 - length]), np.zeros((1, length)))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its centre) of points of one length."""
        numbers, centres = self.of(points.shape[1])
        apart = (centres**2).sum(1) - 2 * points @ centres.T
        at = apart.argmin(1)
        return numbers[at], np.sqrt(((points - centres[at]) ** 2).sum(1))


def grouped(pivots: Pivots, asked: dict[int, int]) -> dict[int, int]:
    """The group of each cell: cells are halved along their widest axis until ``SHARE`` queries or one cell are left."""
    out: dict[int, int] = {}
    pending = [*pivots.by_length.values(), *((np.array([c]), np.zeros((1, 0))) for c in asked if c < 0)]
    number = 0
    while pending:
        cells, centres = pending.pop()
        weight = np.array([asked.get(int(c), 0) for c in cells])
        if len(cells) == 1 or weight.sum() <= SHARE:
            out.update(dict.fromkeys(cells.tolist(), number))
            number += 1
            continue
        order = centres[:, np.ptp(centres, axis=0).argmax()].argsort(kind="stable")
        half = int(np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)) + 1
        half = min(max(half, 1), len(cells) - 1)
        pending += [(cells[side], centres[side]) for side in (order[:half], order[half:])]
    return out


def _by_length(column: pa.Array, chunk: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) of the vectors of each length."""
    lengths = np.asarray(pa.compute.list_value_length(column))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for a in range(0, len(rows), chunk):
            part = column.take(pa.array(rows[a : a + chunk]))
            yield rows[a : a + chunk], np.asarray(part.flatten()).reshape(len(part), int(length)).astype(np.float64)


def _assign(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = broadcast.value
        for batch in batches:
            cells, apart = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            for rows, points in _by_length(batch.column(1)):
                cells[rows], apart[rows] = pivots.nearest(points)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array(apart)], names=["vec_id", "vector", "cell", "apart"]
            )

    return run


def _raised(bound: np.ndarray) -> np.ndarray:
    """A bound with room for rounding."""
    return bound + 1 + np.abs(bound) * 1e-9


def _reached(broadcast, radii: dict[int, float]):
    """(home, part, cell) of every other cell that the bound of the queries of a cell reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = broadcast.value
        for batch in batches:
            home, part, length, apart, floor = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                numbers, centres = pivots.of(int(size))
                place = {int(c): i for i, c in enumerate(numbers)}
                own = centres[[place[int(c)] for c in home[rows]]]
                reach = np.array([radii.get(int(c), -np.inf) for c in numbers])
                held = np.flatnonzero(reach > -np.inf)
                far, around = centres[held], reach[held]
                bound = own @ far.T + np.sqrt((own**2).sum(1))[:, None] * around
                bound += apart[rows][:, None] * (np.sqrt((far**2).sum(1)) + around)
                useful = ~(_raised(bound) < floor[rows][:, None]) & (home[rows][:, None] != numbers[held])
                at, to = np.nonzero(useful)
                columns = [home[rows[at]], part[rows[at]], numbers[held[to]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["home", "part", "cell"])

    return run


def _needed(broadcast, radii: dict[int, float]):
    """The rows (query, its floor, a cell) whose cell the query's own bound reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = broadcast.value
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            floors, cells = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("floor", "cell"))
            for rows, points in _by_length(batch.column("query")):
                numbers, centres = pivots.of(points.shape[1])
                place = {int(c): i for i, c in enumerate(numbers)}
                centre = centres[[place[int(c)] for c in cells[rows]]]
                reach = np.array([radii[int(c)] for c in cells[rows]])
                bound = (points * centre).sum(1) + np.sqrt((points**2).sum(1)) * reach
                keep[rows] = ~(_raised(bound) < floors[rows])
            yield batch.filter(pa.array(keep)).drop_columns(["floor"])

    return run


def _solve(k: int):
    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        ids = np.asarray(data.column("vec_id"))
        query_ids = np.asarray(queries.column("query_id"))
        sides = [t.column(c).combine_chunks() for t, c in ((queries, "query"), (data, "vector"))]
        if queries.num_rows and data.num_rows:
            candidates = {p.shape[1]: (r, p) for r, p in _by_length(sides[1], data.num_rows)}
            for rows, points in _by_length(sides[0], 256):
                if points.shape[1] not in candidates:
                    continue
                members, matrix = candidates[points.shape[1]]
                own, largest = ids[members], np.abs(points).max(initial=0) * np.abs(matrix).max(initial=0)
                if largest * max(1, points.shape[1]) < SAFE:
                    scores = (points @ matrix.T).astype(np.int64)
                else:
                    scores = points.astype(np.int64) @ matrix.T.astype(np.int64)
                for row, score in zip(rows.tolist(), scores, strict=True):
                    other = np.flatnonzero(own != query_ids[row])
                    if len(other) > k:
                        kth = np.partition(score[other], len(other) - k)[len(other) - k]
                        other = other[score[other] >= kth]
                    best = other[np.lexsort((own[other], -score[other]))][:k]
                    out[0].append(np.full(len(best), query_ids[row]))
                    out[1].append(own[best])
                    out[2].append(score[best])
        columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    pivots: int | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row for which ``is_query`` (over the
    column ``vec_id``) holds. ``pivots`` follows the number of rows unless given."""
    spark = vectors.sparkSession
    usable = quantised(vectors, id_column, vector_column)
    if pivots is None:
        pivots = min(MOST, max(FEWEST, usable.count() // BLOCK))
    chosen = usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    known = Pivots(list(dict.fromkeys(tuple(r["vector"]) for r in chosen)))
    centres = spark.sparkContext.broadcast(known)
    celled = usable.mapInArrow(_assign(centres), "vec_id long, vector array<long>, cell long, apart double")
    celled = materialize(celled, "cells")

    # One row per pivot (and per length without pivots).
    summary = celled.groupBy("cell").agg(
        F.count("*").alias("size"), F.max("apart").alias("radius"), F.count_if(is_query).alias("asked")
    )
    summary = summary.collect()
    radii = {row["cell"]: row["radius"] * (1 + 1e-9) + 1e-6 for row in summary}
    group = grouped(known, {row["cell"]: row["asked"] for row in summary})
    dealt = [(r["cell"], group[r["cell"]], -(-r["size"] // BLOCK), -(-r["asked"] // SHARE)) for r in summary]
    dealt = F.broadcast(spark.createDataFrame(dealt, "cell long, group long, blocks long, parts long"))

    data = celled.join(dealt.select("cell", "blocks"), "cell").select(
        "cell", "vec_id", "vector", F.pmod(F.monotonically_increasing_id(), "blocks").alias("block")
    )
    key = ["group", "part", "cell", "block"]

    def solve(asked: DataFrame, copied: DataFrame) -> DataFrame:
        """The best hits of queries (group, part, cell, query) in the copies (group, part, cell) of the data."""
        blocks = asked.join(dealt.select("cell", "blocks"), "cell")
        blocks = blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        placed = blocks.select(*key, "query_id", "query").groupBy(*key)
        copies = copied.select(*(F.col(c).alias(f"of_{c}") for c in key), "vec_id", "vector").groupBy(*(f"of_{c}" for c in key))
        found = placed.cogroup(copies).applyInArrow(_solve(k), HITS)
        return _best(found, k)

    queries = celled.filter(is_query).dropDuplicates(["vec_id", "vector"]).join(dealt.select("cell", "group", "parts"), "cell")
    queries = queries.select(
        "group",
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        F.col("cell").alias("home"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), "parts").alias("part"),
        "apart",
    )
    parts = dealt.filter("parts > 0").select("cell", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    near = solve(queries.withColumn("cell", F.col("home")), data.join(F.broadcast(parts), "cell"))
    near = materialize(near.select("query_id", "vec_id", "score", "rank"), "own-cell")

    floors = near.filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("floor"))
    floored = queries.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    floored = materialize(floored, "floors")
    homes = floored.groupBy("home", "part", F.size("query").alias("length")).agg(
        F.max("apart").alias("apart"), F.min("floor").alias("floor")
    )
    reached = homes.mapInArrow(_reached(centres, radii), "home long, part long, cell long")
    routed = floored.join(reached, ["home", "part"]).select("home", "group", "part", "cell", "query_id", "query", "floor")
    routed = routed.mapInArrow(
        _needed(centres, radii), "home long, group long, part long, cell long, query_id long, query array<long>"
    )
    routed = materialize(routed, "routed")
    far = solve(routed, data.join(routed.select("group", "part", "cell").distinct(), "cell"))
    return _best(near.select("query_id", "vec_id", "score").union(far.select("query_id", "vec_id", "score")), k).select(
        "query_id", "rank", "vec_id", "score"
    )
