"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepmill.catalog.derived import WITH_NULLS, derive, derived_sql
from prepmill.catalog.registry import query, table

_LINE = ["l_orderkey", "l_linenumber", "l_quantity"]
_LINE_SQL = ", ".join(_LINE)


@query("filt_gt", f"SELECT {_LINE_SQL} FROM lineitem WHERE l_quantity > 45")
def filt_gt(spark, folder):
    return table(spark, folder, "lineitem").filter(F.col("l_quantity") > 45).select(*_LINE)


@query("filt_ge_sorted", """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal >= 5000
    ORDER BY c_acctbal DESC, c_mktsegment, c_custkey
""")
def filt_ge_sorted(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return customer.filter(customer["c_acctbal"] >= 5000).orderBy(
        F.col("c_acctbal").desc(), F.col("c_mktsegment").asc(), F.col("c_custkey").asc()
    )


@query("filt_and_ordinal", """
    SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 200000 AND o_orderstatus <> 'P'
""")
def filt_and_ordinal(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    first = F.col(orders.columns[0])
    return orders.filter(orders.o_totalprice > 200000).filter(first != "P")


@query("filt_between", f"SELECT {_LINE_SQL} FROM lineitem WHERE l_quantity BETWEEN 4 AND 5")
def filt_between(spark, folder):
    return table(spark, folder, "lineitem").filter(F.col("l_quantity").between(4, 5)).select(*_LINE)


@query("filt_or", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'O'
""")
def filt_or(spark, folder):
    status = F.col("o_orderstatus")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return orders.filter((status == "F") | (status == "O"))


@query("filt_ne", f"""
    SELECT orderkey, linenumber, flag FROM {derived_sql(WITH_NULLS)} WHERE flag <> 'R'
""")
def filt_ne(spark, folder):
    """Inequality drops rows where the column is null, too."""
    lines = derive(spark, folder, WITH_NULLS).select("orderkey", "linenumber", "flag")
    return lines.filter(F.col("flag") != "R")


@query("filt_eq", """
    SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def filt_eq(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return customer.filter(F.col("c_mktsegment") == "BUILDING")


@query("filt_col_col", """
    SELECT doc_id, quality, toxic, quality = toxic AS same FROM labels WHERE quality <> toxic
    UNION ALL
    SELECT doc_id, quality, toxic, quality = toxic AS same FROM labels WHERE quality = toxic
""")
def filt_col_col(spark, folder):
    """Column against column: the two filters together must return every row once."""
    labels = table(spark, folder, "labels").withColumn("same", F.col("quality") == F.col("toxic"))
    different = labels.filter(F.col("quality") != F.col("toxic"))
    equal = labels.filter(F.col("quality") == F.col("toxic"))
    return different.unionByName(equal)


@query("filt_having", """
    SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS largest FROM orders
    GROUP BY o_orderpriority HAVING o_orderpriority = '1-URGENT'
""")
def filt_having(spark, folder):
    """A filter on an aggregate's key column; Catalyst moves it into the scan."""
    grouped = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("largest"))
    )
    return grouped.filter(F.col("o_orderpriority") == "1-URGENT")
