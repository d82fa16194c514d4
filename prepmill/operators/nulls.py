"""Finding and filling nulls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepmill.operators.quantiles import group_median
from prepmill.sources.storage import materialize


def null_counts(df: DataFrame) -> DataFrame:
    """One row holding the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])


def rows_with_null(df: DataFrame) -> DataFrame:
    """Rows with a null in at least one column."""
    return df.filter(reduce(or_, [F.col(f"`{name}`").isNull() for name in df.columns]))


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null, or a NaN, in any of the columns: ``dropna`` that reaches the source.

    ``dropna`` counts values inside Spark after reading them. Separate conditions per column are
    handed to Parquet scans and databases. Fractional columns are left to ``dropna``, which tests
    for null and NaN while evaluating the column once.
    """
    names = df.columns if columns is None else list(columns)
    fractional = (T.DoubleType, T.FloatType)
    floats = [name for name in names if isinstance(df.schema[name].dataType, fractional)]
    others = [F.col(f"`{name}`").isNotNull() for name in names if name not in floats]
    kept = df.filter(reduce(and_, others)) if others else df
    return kept.dropna(subset=floats) if floats else kept


def impute_group_median(
    df: DataFrame,
    group: str,
    value: str,
    output: str,
    groups: Sequence | None = None,
    accuracy: int = 10_000,
    exact: bool = False,
) -> DataFrame:
    """Fill nulls of ``value`` with the median of the row's group.

    The median is taken over rows that hold no null in any column. ``groups`` limits the filling
    to the groups named; the others keep their nulls, as do rows without a group.

    The medians are stored once and then joined. They have one row per group, so Spark broadcasts
    them when the stored size is below its threshold; beyond it the join shuffles, and adaptive
    execution splits a hot group.
    """
    complete = complete_rows(df)
    if groups is not None:
        complete = complete.filter(F.col(f"`{group}`").isin(list(groups)))
    medians = materialize(
        group_median(complete, [group], value, accuracy, exact).select(
            F.col(f"`{group}`").alias("_group"), F.col("median").alias("_median")
        ),
        "medians",
    )
    joined = df.join(medians, df[f"`{group}`"] == medians["_group"], "left")
    return joined.withColumn(output, F.coalesce(F.col(f"`{value}`"), F.col("_median"))).drop(
        "_group", "_median"
    )
