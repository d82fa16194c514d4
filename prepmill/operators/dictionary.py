"""Indexes of columns with more distinct texts than a driver or a model should hold."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.operators.features import indexed
from prepmill.sources.storage import materialize

PLACE_BITS = 33


def ranked(df: DataFrame, *order, output: str = "rank") -> DataFrame:
    """``df`` with the number of each row in ``order``, from 0, as a stored table.

    Rows are sorted by range over the cluster; a row's number is its place in its partition plus the
    sizes of the partitions before it, of which the driver sees one number each. The order should
    tell all rows apart.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", PLACE_BITS)
    sizes = sorted(placed.groupBy(part.alias("_part")).count().collect())
    starts = itertools.accumulate((row["count"] for row in sizes), initial=0)
    before = [(row["_part"], start) for row, start in zip(sizes, starts, strict=False)]
    shifts = df.sparkSession.createDataFrame(before, "_part long, _before long")
    number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    both = placed.join(F.broadcast(shifts), part == F.col("_part"))  # a row per partition
    return both.withColumn(output, number).drop("_place", "_part", "_before")


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, frequency, index) of every distinct text: by falling frequency, equal ones in text order.

    The indexes are those of ``StringIndexer``, but no task and no model holds all texts. Nulls have none.
    """
    named = df.select(F.col(f"`{column}`").cast("string").alias("value")).filter("value is not null")
    counts = named.groupBy("value").agg(F.count(F.lit(1)).alias("frequency"))
    return ranked(counts, F.desc("frequency"), F.asc("value"), output="index")


def index_by_dictionary(df: DataFrame, column: str, words: DataFrame, invalid: str = "keep") -> DataFrame:
    """``df`` with the index of ``column`` as a double, looked up in a dictionary table by a join.

    Spark broadcasts the dictionary below its threshold; beyond it the join shuffles, and adaptive
    execution splits a frequent text. A text that the dictionary lacks, and null, get one extra
    index behind the last (``invalid="keep"``) or fail the job (``"error"``); the latter keeps null
    out as well.
    """
    if invalid not in ("keep", "error"):
        raise ValueError(f"invalid must be 'keep' or 'error', not {invalid!r}")
    lookup = words.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
    joined = df.join(lookup, F.col(f"`{column}`").cast("string") == F.col("_value"), "left")
    if invalid == "keep":
        extra = words.agg(F.count(F.lit(1))).scalar()
    else:
        message = F.concat(F.lit(f"no index in {column} for "), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("null")))
        extra = F.raise_error(message).cast("long")
    return joined.withColumn(indexed(column), F.coalesce("_index", extra).cast("double")).drop("_value", "_index")
