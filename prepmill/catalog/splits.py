"""Splitting and sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.operators import random_split, split_by_key, stratified_sample


def _labelled(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [df.withColumn("part", F.lit(name)) for name, df in parts.items()]
    )


@query("split_random", """
    SELECT count(*) AS rows, count(*) AS orders, true AS as_weighted FROM orders
""")
def split_random(spark, folder):
    """All rows, no order twice, and a test share within two hundredths of its weight."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    train, test = random_split(orders, [0.8, 0.2], seed=12, keys=["o_orderkey"])
    parts = _labelled({"train": train, "test": test})
    share = F.count_if(F.col("part") == "test") / F.count("*")
    return parts.agg(
        F.count("*").alias("rows"),
        F.count_distinct("o_orderkey").alias("orders"),
        F.abs(share - 0.2).between(0, 0.02).alias("as_weighted"),
    )


@query("split_random_covers", "SELECT o_orderkey, 1 AS parts FROM orders")
def split_random_covers(spark, folder):
    """Every row lies in exactly one part, whatever the split."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    train, test = random_split(orders, [0.6, 0.4], seed=13)
    both = _labelled({"train": train, "test": test})
    return both.groupBy("o_orderkey").agg(F.count("*").cast("int").alias("parts"))


@query("split_random_repeated", """
    SELECT l_returnflag, l_linestatus, count(*) AS rows, true AS as_weighted FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def split_random_repeated(spark, folder):
    """A table of a few rows, each repeated many times: of every one a fifth goes to the test part, within four times
    the deviation of as many draws."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")
    train, test = random_split(lines, [0.8, 0.2], seed=12)
    parts = _labelled({"train": train, "test": test}).groupBy("l_returnflag", "l_linestatus")
    share = F.count_if(F.col("part") == "test") / F.count("*")
    return parts.agg(
        F.count("*").alias("rows"), (F.abs(share - 0.2) <= 4 * F.sqrt(0.16 / F.count("*"))).alias("as_weighted")
    )


@query("split_by_key", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 100 < 80 THEN 'train' ELSE 'test' END AS part
    FROM orders
""")
def split_on_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    train, test = split_by_key(orders, "o_orderkey", 80)
    return _labelled({"train": train, "test": test})


@query("sample_stratified", """
    SELECT o_orderpriority,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE count(*) END AS whole,
           true AS as_asked
    FROM orders GROUP BY o_orderpriority
""")
def sample_stratified(spark, folder):
    """Two priorities thinned to two fifths, within a tenth of the stratum, three kept whole."""
    fractions = {
        "1-URGENT": 0.4,
        "2-HIGH": 0.4,
        "3-MEDIUM": 1.0,
        "4-NOT SPECIFIED": 1.0,
        "5-LOW": 1.0,
    }
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    sample = stratified_sample(orders, "o_orderpriority", fractions, seed=42, keys=["o_orderkey"])
    sizes = orders.groupBy("o_orderpriority").agg(F.count("*").alias("all"))
    kept = sample.groupBy("o_orderpriority").agg(
        F.count("*").alias("kept"), F.count_distinct("o_orderkey").alias("once")
    )
    thinned = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    near = F.abs(F.col("kept") / F.col("all") - F.when(thinned, 0.4).otherwise(1.0)) <= 0.1
    return kept.join(sizes, "o_orderpriority").select(
        "o_orderpriority",
        F.when(~thinned, F.col("kept")).alias("whole"),
        (near & (F.col("kept") == F.col("once"))).alias("as_asked"),
    )


@query("sample_stratified_whole", """
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '5-LOW')
""")
def sample_stratified_whole(spark, folder):
    """Fraction 1 keeps a whole stratum and strata not named are left out."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return stratified_sample(orders, "o_orderpriority", {"3-MEDIUM": 1.0, "5-LOW": 1.0}, seed=42)
