"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.operators import average_and_sum, correlation, group_median, letter_count


@query("agg_count", "SELECT count(*) AS rows FROM events")
def agg_count(spark, folder):
    return table(spark, folder, "events").agg(F.count("*").alias("rows"))


@query("agg_group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def agg_group_count(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").count()


@query("agg_group_count2", """
    SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem
    GROUP BY l_returnflag, l_linestatus
""")
def agg_group_count2(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").count()


@query("agg_group_count3_top", """
    SELECT o_orderstatus, o_orderpriority, o_custkey, count(*) AS count FROM orders
    GROUP BY o_orderstatus, o_orderpriority, o_custkey
    ORDER BY count DESC, o_orderstatus, o_orderpriority, o_custkey LIMIT 100
""")
def agg_group_count3_top(spark, folder):
    keys = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    counted = table(spark, folder, "orders").groupBy(*keys).count()
    return counted.orderBy(F.desc("count"), *keys).limit(100)


@query("agg_avg_sum", """
    SELECT l_returnflag, round(avg(l_extendedprice), 4) AS average,
           round(sum(l_extendedprice), 2) AS total
    FROM lineitem GROUP BY l_returnflag
""")
def agg_avg_sum(spark, folder):
    """The measure is stored as text."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").cast("string").alias("price")
    )
    return average_and_sum(lines, "l_returnflag", "price").select(
        "l_returnflag", F.round("average", 4).alias("average"), F.round("total", 2).alias("total")
    )


@query("agg_min_max", """
    SELECT min(l_extendedprice) AS smallest, max(l_extendedprice) AS largest,
           min(l_shipdate) AS first_date, max(l_shipdate) AS last_date
    FROM lineitem
""")
def agg_min_max(spark, folder):
    return table(spark, folder, "lineitem").agg(
        F.min("l_extendedprice").alias("smallest"),
        F.max("l_extendedprice").alias("largest"),
        F.min("l_shipdate").alias("first_date"),
        F.max("l_shipdate").alias("last_date"),
    )


@query("agg_median", """
    SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median FROM lineitem
    GROUP BY l_returnflag
""")
def agg_median(spark, folder):
    """The exact form, so that the result does not depend on the layout of the data."""
    return group_median(
        table(spark, folder, "lineitem"), ["l_returnflag"], "l_extendedprice", exact=True
    )


@query("agg_median_approx", "SELECT DISTINCT l_returnflag, true AS near FROM lineitem")
def agg_median_approx(spark, folder):
    """The sketch form: one pass; the rank of the result is within 1/10,000 of the group, rounded up to rows, of the middle."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    found = group_median(lines, ["l_returnflag"], "l_extendedprice")
    price, median = F.col("l_extendedprice"), F.col("median")
    ranks = lines.join(found, "l_returnflag").groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.count_if(price < median).alias("below"),
        F.count_if(price <= median).alias("upto"),
    )
    slack = F.col("n") / 10_000 + 1
    near = (F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)
    return ranks.select("l_returnflag", near.alias("near"))


@query("agg_corr", """
    SELECT count(*) AS rows, round(corr(l_quantity, l_extendedprice), 8) AS correlation
    FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
""")
def agg_corr(spark, folder):
    found = correlation(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return found.select("rows", F.round("correlation", 8).alias("correlation"))


@query("agg_distinct", "SELECT DISTINCT l_shipdate FROM lineitem")
def agg_distinct(spark, folder):
    return table(spark, folder, "lineitem").select("l_shipdate").distinct()


@query("agg_letter_count", """
    SELECT letter, count(*) AS count
    FROM (SELECT unnest(string_split(text, '')) AS letter FROM documents WHERE text <> '')
    GROUP BY letter ORDER BY count DESC, letter
""")
def agg_letter_count(spark, folder):
    return letter_count(table(spark, folder, "documents"), "text")
