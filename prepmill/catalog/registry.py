"""The register of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, table folder) under ``name`` with the SQL it must equal."""

    def register(run: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(run, sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
