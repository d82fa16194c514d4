"""First look at a table and its analysis base table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.operators import cast_to_double, complete_rows, correlation, profile
from prepmill.sources import materialize


@dataclass(frozen=True)
class Exploration:
    """``profile`` and ``null_counts`` read one stored aggregate, the other tables are lazy."""

    profile: DataFrame
    null_counts: DataFrame
    frequency: DataFrame
    correlation: DataFrame
    base_table: DataFrame


def explore(
    df: DataFrame, label: str, driver: str, numbers: Sequence[str], others: Sequence[str]
) -> Exploration:
    """Profile, nulls, label frequency, label-driver correlation and the base table.

    One scan measures all columns; its result, a row per column, is stored, and the null counts
    are read from it. The frequency table is ordered by the label as stored, so a text label sorts
    as text. The base table holds ``numbers`` as doubles beside ``others``, without rows that miss
    a value.
    """
    named = lambda columns: df.select(*[F.col(f"`{c}`") for c in columns])
    measured = materialize(profile(df), "profile")
    nulls = [F.max(F.when(F.col("ordinal") == i, F.col("nulls"))).alias(c) for i, c in enumerate(df.columns)]
    return Exploration(
        profile=measured,
        null_counts=measured.agg(*nulls),
        frequency=df.groupBy(F.col(f"`{label}`")).count().orderBy(F.desc(f"`{label}`")),
        correlation=correlation(cast_to_double(named([label, driver]), [label, driver]), label, driver),
        base_table=complete_rows(cast_to_double(named([*numbers, *others]), numbers)),
    )
