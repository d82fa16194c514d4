"""Grouped measures beyond a plain ``groupBy``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.functions import to_double


def average_and_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """Average and sum per group of a column that may be stored as text."""
    number = to_double(df.schema[value])
    return df.groupBy(F.col(f"`{key}`")).agg(F.avg(number).alias("average"), F.sum(number).alias("total"))


def letter_count(df: DataFrame, column: str) -> DataFrame:
    """How often every character occurs in a text column, most frequent first.

    Characters are counted inside the task that reads the text; only one count per distinct
    character and task is shuffled. Equal counts are ordered by character.
    """
    return (
        df.filter(F.col(f"`{column}`") != "")  # splitting empty text gives one empty letter
        .select(F.explode(F.split(F.col(f"`{column}`"), "")).alias("letter"))
        .groupBy("letter")
        .count()
        .orderBy(F.desc("count"), "letter")
    )
