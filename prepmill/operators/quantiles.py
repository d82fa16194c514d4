"""Medians and quantiles of groups that may be far larger than one task can hold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepmill.sources.storage import materialize

#: Counted values of a group that are put into one array at the end; more are thinned first.
MOST_VALUES = 100_000
CUTS = 64
PIECES = 256  # above 2 * CUTS + 3, the pieces that CUTS + 1 values make


def group_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    accuracy: int = 10_000,
    exact: bool = False,
) -> DataFrame:
    """Median per group as (keys, ``median``): an element of the group, the lower of two middles.

    By default a sketch with a rank error of at most 1/``accuracy``; with ``exact`` the true
    element, at the price of a second pass.
    """
    if exact:
        found = exact_quantiles(df, keys, value, [0.5], accuracy=accuracy)
        return found.select(*[F.col(f"`{k}`") for k in keys], F.col("quantiles")[0].alias("median"))
    named = [F.col(f"`{k}`") for k in keys]
    return df.groupBy(*named).agg(F.percentile_approx(F.col(f"`{value}`"), 0.5, accuracy).alias("median"))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    interpolate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact quantiles per group as (keys, ``n``, ``quantiles``); null values are left out.

    With ``interpolate`` a quantile between two elements is their weighted mean, otherwise it is
    the first element whose rank reaches the probability.

    Two passes. The first makes one sketch of each group, which names a bracket around every
    probability, wide enough for the sketch's error; a group of no more rows than ``accuracy`` is
    one bracket. The second counts: rows between brackets by their number only, rows in a bracket by
    value, each row once however many quantiles are asked for. Counts are added up per task before
    they are shuffled. What is left of a group, about 8 / ``accuracy`` of its values per
    probability, is scanned in order for the ranks. Values of a group beyond ``MOST_VALUES`` are first
    thinned to those around the ranks, over the cluster.
    """
    named = [f"_key{i}" for i in range(len(keys))]
    present = df.filter(F.col(f"`{value}`").isNotNull()).select(
        *[F.col(f"`{k}`").alias(a) for k, a in zip(keys, named, strict=True)],
        F.col(f"`{value}`").alias("_value"),
    )
    parts = [_rank_parts(p, interpolate) for p in probabilities]
    ranks = [rank for low, high, _ in parts for rank in ((low, high) if interpolate else (low,))]
    picked = materialize(_picked(present, named, probabilities, ranks, accuracy), "picks")
    missed = reduce(or_, [F.col(f"_pick{i}").isNull() for i in range(len(ranks))])
    if picked.filter(missed).take(1):  # a sketch was further off than it may be: all values of such groups are counted
        again = _picked(_beside(present, picked.filter(missed).select(*named, F.lit(True).alias("_missed")), named).filter("_missed"),
                        named, probabilities, ranks, accuracy, whole=True)
        picked = picked.filter(~missed).unionByName(again)
    quantiles = []
    for i, (_, _, weight) in enumerate(parts):
        if interpolate:
            low, high = F.col(f"_pick{2 * i}"), F.col(f"_pick{2 * i + 1}")
            quantiles.append(low + (high - low) * weight)
        else:
            quantiles.append(F.col(f"_pick{i}"))
    return picked.select(
        *[F.col(a).alias(k) for k, a in zip(keys, named, strict=True)], "n", F.array(*quantiles).alias("quantiles")
    )


def _picked(
    present: DataFrame, keys: Sequence[str], probabilities: Sequence[float], ranks: list[Column], accuracy: int, whole: bool = False
) -> DataFrame:
    """(keys, n, _pick0, _pick1, ...): the element of every rank, null where it lies outside the brackets."""
    counted = _thinned(_counted(present, keys, probabilities, accuracy, whole), keys, ranks, accuracy)
    entries = counted.groupBy(*keys).agg(
        F.sum("rows").alias("n"), F.array_sort(F.collect_list(F.struct("piece", "_value", "rows"))).alias("entries")
    )
    entries = entries.filter("n > 0")  # without keys an empty table still has a row
    return entries.select(*keys, "n", *[_element(rank).alias(f"_pick{i}") for i, rank in enumerate(ranks)])


def _beside(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their group's row in ``table``."""
    others = [c for c in table.columns if c not in keys]
    if not keys:
        only = table.agg(F.first(F.struct(*others))).scalar()
        return rows.select("*", *[only[c].alias(c) for c in others])
    renamed = table.select(*[F.col(k).alias(f"{k}_of") for k in keys], *others)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys])
    return rows.join(renamed, same).drop(*[f"{k}_of" for k in keys])


def _counted(
    present: DataFrame, keys: Sequence[str], probabilities: Sequence[float], accuracy: int, whole: bool
) -> DataFrame:
    """(keys, piece, _value, rows): numbers of rows, by value inside brackets and under a null value between them; with
    ``whole`` a group is one bracket. Pieces follow the order of values: 2i is below bracket i, 2i + 1 inside it."""
    margin, wanted = 4 / accuracy, sorted(set(probabilities))
    shares = [min(max(p + side * margin, 0.0), 1.0) for p in wanted for side in (-1, 1)]
    sketch = F.percentile_approx("_value", shares, accuracy).alias("cuts")
    groups = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), sketch)
    groups = materialize(groups.filter("n > 0"), "sketches")
    small = F.lit(True) if whole else F.col("n") <= accuracy
    piece: Column = F.lit(2 * len(wanted))  # above the last bracket
    for i in reversed(range(len(wanted))):
        below = F.lit(False) if shares[2 * i] <= 0 else (F.col("_value") < F.col("cuts")[2 * i])
        within = F.lit(True) if shares[2 * i + 1] >= 1 else (F.col("_value") <= F.col("cuts")[2 * i + 1])
        piece = F.when(within, F.when(below, 2 * i).otherwise(2 * i + 1)).otherwise(piece)
    placed = _beside(present, groups, keys).withColumn("piece", F.when(small, 1).otherwise(piece).cast("long"))
    kept = F.when(F.col("piece") % 2 == 1, F.col("_value")).alias("_value")
    counts = placed.select(*keys, "piece", kept).groupBy(*keys, "piece", "_value").agg(F.count(F.lit(1)).alias("rows"))
    return materialize(counts, "counts")


def _thinned(counted: DataFrame, keys: Sequence[str], ranks: list[Column], accuracy: int) -> DataFrame:
    """``counted`` with at most ``MOST_VALUES`` entries a group: values far from all wanted ranks become numbers of rows.

    A round cuts every piece that holds many values at ``CUTS`` of them, adds up the rows of the pieces that this makes, and
    keeps values only where a wanted rank lies."""
    while True:
        lengths = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("entries"))
        if not lengths.filter(F.col("entries") > MOST_VALUES).take(1):
            return counted
        shares = [i / CUTS for i in range(CUTS + 1)]
        cuts = counted.filter("_value is not null").groupBy(*keys, "piece").agg(
            F.array_distinct(F.percentile_approx("_value", shares, accuracy)).alias("cuts")
        )
        cuts = materialize(cuts.withColumnRenamed("piece", "of"), "cuts")
        # a piece has one row in ``cuts``, so the join adds none
        match = [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys]
        renamed = cuts.select(*[F.col(k).alias(f"{k}_of") for k in keys], "of", "cuts")
        both = counted.join(renamed, reduce(and_, [F.col("piece") == F.col("of"), *match]), "left")
        sub = 2 * F.size(F.filter("cuts", lambda c: c < F.col("_value"))) + F.array_contains("cuts", F.col("_value")).cast("int")
        finer = F.col("piece") * PIECES + F.coalesce(F.when(F.col("_value").isNotNull(), sub), F.lit(0))
        finer = materialize(both.select(*keys, finer.alias("piece"), "_value", "rows"), "finer")
        totals = finer.groupBy(*keys, "piece").agg(F.sum("rows").alias("rows"))
        ordered = totals.groupBy(*keys).agg(
            F.sum("rows").alias("n"),
            F.array_sort(F.collect_list(F.struct("piece", F.lit(None).cast("long").alias("_value"), "rows"))).alias("entries"),
        )
        held = F.array_distinct(F.array(*[_element(rank, "piece") for rank in ranks]))
        held = materialize(ordered.select(*keys, held.alias("held")), "held")
        # pieces are numbered anew: 2i + 1 is the i-th that holds a rank, 2i all that lies below it
        below = F.size(F.filter("held", lambda h: h < F.col("piece")))
        near = F.array_contains("held", F.col("piece"))
        merged = _beside(finer, held, keys).select(
            *keys,
            (2 * below + near.cast("int")).cast("long").alias("piece"),
            F.when(near, F.col("_value")).alias("_value"),
            "rows",
        )
        counted = materialize(merged.groupBy(*keys, "piece", "_value").agg(F.sum("rows").alias("rows")), "counts")


def _element(rank: Column, field: str = "_value") -> Column:
    """The entry in which the row with this rank (from 0) lies, by running over the ordered entries of a group."""
    start = F.struct(rank.cast("long").alias("left"), F.element_at("entries", 1)[field].alias("at"))
    end = F.aggregate(
        "entries",
        start,
        lambda s, e: F.when(s["left"] < 0, s).otherwise(
            F.struct((s["left"] - e["rows"]).alias("left"), e[field].alias("at"))
        ),
    )
    return end["at"]


def _rank_parts(p: float, interpolate: bool) -> tuple[Column, Column, Column]:
    """Zero-based ranks of the lower and upper element, and the weight of the upper one."""
    n = F.col("n")
    if interpolate:
        position = F.lit(float(p)) * (n - 1)
        low = F.floor(position)
        return low.cast("long"), F.ceil(position).cast("long"), position - low
    rank = F.greatest(F.ceil(F.lit(float(p)) * n) - 1, F.lit(0)).cast("long")
    return rank, rank, F.lit(0.0)
