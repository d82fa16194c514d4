"""Conditional values, text clean-up, binning and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.functions import (
    before_dash,
    decode_two_way,
    keep_or_replace,
    percent_to_double,
    time_of_day,
)
from prepmill.operators import min_max


@query("cond_replace", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END
           AS o_orderstatus
    FROM orders
""")
def cond_replace(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return orders.withColumn("o_orderstatus", keep_or_replace("o_orderstatus", "P", "pending"))


@query("cond_decode_label", """
    SELECT doc_id, CAST(toxic AS DOUBLE) AS prediction,
           CASE WHEN toxic = 0 THEN 'Fully Paid' ELSE 'Charged Off' END AS full_prediction
    FROM labels
""")
def cond_decode_label(spark, folder):
    predicted = table(spark, folder, "labels").select(
        "doc_id", F.col("toxic").cast("double").alias("prediction")
    )
    return predicted.withColumn(
        "full_prediction", decode_two_way("prediction", "Fully Paid", "Charged Off")
    )


_RATE = (
    "concat(CAST(round(l_discount * 100) AS INTEGER), '.5', "
    "CASE WHEN l_returnflag = 'R' THEN '%%' ELSE '%' END)"
)


@query("str_percent_to_double", f"""
    SELECT l_orderkey, l_linenumber, CAST(rtrim(rate, '%') AS DOUBLE) AS rate
    FROM (SELECT l_orderkey, l_linenumber, {_RATE} AS rate FROM lineitem)
""")
def str_percent_to_double(spark, folder):
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_RATE} AS rate"
    )
    return lines.withColumn("rate", percent_to_double("rate"))


@query("str_before_dash", """
    SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS priority FROM orders
""")
def str_before_dash(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", before_dash("o_orderpriority").alias("priority")
    )


@query("str_sentinel", """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'NotEmployed' ELSE p_type END AS p_type
    FROM part
""")
def str_sentinel(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_type")
    return part.withColumn("p_type", keep_or_replace("p_type", "PROMO", "NotEmployed"))


_CLOCK = (
    "CAST(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey % 2500 END AS DOUBLE)"
)


@query("bin_timeperiod", f"""
    SELECT o_orderkey, clock,
           CASE WHEN clock IS NULL THEN NULL
                WHEN clock > 0 AND clock < 600 THEN '00.01-05.59'
                WHEN clock BETWEEN 600 AND 1200 THEN '06.00-11.59'
                WHEN clock BETWEEN 1200 AND 1800 THEN '12.00-17.59'
                WHEN clock BETWEEN 1800 AND 2400 THEN '18.00-24.00'
                ELSE 'NA' END AS period
    FROM (SELECT o_orderkey, {_CLOCK} AS clock FROM orders)
""")
def bin_timeperiod(spark, folder):
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", f"{_CLOCK} AS clock")
    return orders.withColumn("period", time_of_day(F.col("clock")))


@query("norm_minmax", """
    SELECT l_orderkey, l_linenumber, l_quantity,
           (l_quantity - low) / nullif(high - low, 0) AS new_quantity
    FROM lineitem, (SELECT min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem)
""")
def norm_minmax(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return min_max(lines, {"l_quantity": "new_quantity"})


_SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("norm_minmax_multi", f"""
    SELECT l_orderkey, l_linenumber,
           {", ".join(f"({c} - {c}_low) / nullif({c}_high - {c}_low, 0) AS {c}" for c in _SCALED)},
           CAST(NULL AS DOUBLE) AS constant
    FROM lineitem, (SELECT {", ".join(f"min({c}) AS {c}_low, max({c}) AS {c}_high" for c in _SCALED)}
                    FROM lineitem)
""")
def norm_minmax_multi(spark, folder):
    """Several columns by one aggregate; a constant column becomes null."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", *_SCALED, F.lit(1.0).alias("constant")
    )
    return min_max(lines, [*_SCALED, "constant"])
