"""Tables that the test data lacks, derived row by row from ``lineitem``.

The expressions are plain SQL that Spark and the checking database read alike, so both sides start
from the same derived rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prepmill.catalog.registry import table
from prepmill.operators import partitions_for, spread
from prepmill.plans.loans import NUMBERS
from prepmill.sources import materialize

# lineitem with nulls put in: three columns miss together on line 3, others alone.
WITH_NULLS = {
    "orderkey": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey END",
    "linenumber": "l_linenumber",
    "quantity": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END",
    "price": "CASE WHEN l_linenumber IN (3, 5) THEN NULL ELSE l_extendedprice END",
    "flag": "CASE WHEN l_linenumber IN (3, 7) THEN NULL ELSE l_returnflag END",
}

FLIGHTS = {
    "Cancelled": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 "
    "WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL ELSE 0 END",
    "CancellationCode": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' "
    "THEN CASE WHEN l_discount > 0.05 THEN 'A' ELSE 'B' END END",
    "TailNum": "CASE WHEN l_tax > 0.07 THEN NULL ELSE concat('N', l_suppkey) END",
    "UniqueCarrier": "concat('C', l_suppkey % 20)",
    "Origin": "concat('P', l_partkey % 60)",
    "Dest": "concat('P', l_orderkey % 60)",
    "DayofMonth": "l_linenumber * 4",
    "DayOfWeek": "l_linenumber",
    "DepTime": "CASE WHEN l_returnflag = 'A' AND l_linenumber = 5 THEN 'NA' "
    "ELSE concat('', (l_orderkey * 7 + l_partkey) % 2500) END",
    "TaxiOut": "concat('', CAST(round(l_tax * 100) AS INTEGER) + 5)",
    "TaxiIn": "concat('', CAST(round(l_discount * 100) AS INTEGER) + 2)",
    "DepDelay": "concat('', CAST(l_quantity AS INTEGER) - 10)",
    "ArrDelay": "CASE WHEN l_returnflag = 'N' AND l_linenumber = 6 THEN 'NA' "
    "ELSE concat('', CAST(l_quantity AS INTEGER) - 12 + CAST(round(l_tax * 200) AS INTEGER)) END",
    "CarrierDelay": "CASE WHEN l_linestatus = 'F' THEN 'NA' "
    "ELSE concat('', CAST(round(l_discount * 300) AS INTEGER)) END",
    "WeatherDelay": "concat('', CAST(round(l_tax * 50) AS INTEGER))",
    "Distance": "l_extendedprice",
}

_MEASURES = ("l_extendedprice", "l_quantity", "l_discount * 1000", "l_tax * 1000 + l_quantity")
LOANS = {
    "loan_status": "CASE WHEN l_returnflag = 'R' THEN 'Current' "
    "WHEN l_linestatus = 'O' AND (l_discount > 0.05 OR l_linenumber > 4) THEN 'Charged Off' ELSE 'Fully Paid' END",
    "grade": "substr('ABCDEFG', l_linenumber, 1)",
    "home_ownership": "CASE WHEN l_linestatus = 'O' THEN 'RENT' ELSE 'MORTGAGE' END",
    "purpose": "CASE l_suppkey % 9 WHEN 0 THEN 'wedding' WHEN 1 THEN 'car' WHEN 2 THEN 'house' "
    "ELSE 'debt_consolidation' END",
    "emp_length": "CASE l_partkey % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '10+ years' "
    "WHEN 2 THEN '< 1 year' ELSE '5 years' END",
    "term": "CASE WHEN l_tax > 0.04 THEN ' 36 months' ELSE ' 60 months' END",
    "verification_status": "CASE WHEN l_discount > 0.05 THEN 'Verified' ELSE 'Not Verified' END",
    "int_rate": "concat(CAST(round(l_discount * 100) AS INTEGER), '.5%')",
    **{
        name: f"concat('', CAST(floor({_MEASURES[i % len(_MEASURES)]}) AS INTEGER) + {i})"
        for i, name in enumerate(NUMBERS)
    },
    # one column misses values, one holds text that is no number
    "bc_util": "CASE WHEN l_linenumber = 4 AND l_linestatus = 'O' THEN NULL "
    "ELSE concat('', CAST(l_quantity AS INTEGER)) END",
    "dti": "CASE WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN 'unknown' "
    "ELSE concat('', CAST(l_quantity AS INTEGER)) END",
}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def derive(spark: SparkSession, folder: str, columns: dict[str, str]) -> DataFrame:
    """The derived table in Spark."""
    return _select(table(spark, folder, "lineitem"), columns)


def stored(spark: SparkSession, folder: str, columns: dict[str, str]) -> DataFrame:
    """The derived table written out, as the raw table of a job that reads it more than once."""
    lines = table(spark, folder, "lineitem")
    return materialize(_select(spread(lines, partitions_for(lines)), columns), "raw")


def _select(lines: DataFrame, columns: dict[str, str]) -> DataFrame:
    return lines.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def derived_sql(columns: dict[str, str]) -> str:
    """The derived table as a subquery of the checking SQL."""
    return f"(SELECT {select_list(columns)} FROM lineitem)"
