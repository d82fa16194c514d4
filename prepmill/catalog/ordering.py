"""Sorts, limits and top-k. Every sort ends in a unique key, which also splits hot sort values."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table

_CUSTOMER = ["c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"]
_CUSTOMER_SQL = f"SELECT {', '.join(_CUSTOMER)} FROM customer"


@query("sort_multi_desc", f"{_CUSTOMER_SQL} ORDER BY c_nationkey DESC, c_mktsegment DESC, c_custkey DESC")
def sort_multi_desc(spark, folder):
    customer = table(spark, folder, "customer").select(*_CUSTOMER)
    return customer.orderBy("c_nationkey", "c_mktsegment", "c_custkey", ascending=False)


@query("sort_mixed", f"{_CUSTOMER_SQL} ORDER BY c_nationkey DESC, c_mktsegment, c_custkey")
def sort_mixed(spark, folder):
    customer = table(spark, folder, "customer").select(*_CUSTOMER)
    return customer.orderBy(F.col("c_nationkey").desc(), F.col("c_mktsegment").asc(), "c_custkey")


@query("sort_single", f"{_CUSTOMER_SQL} ORDER BY c_acctbal, c_custkey")
def sort_single(spark, folder):
    return table(spark, folder, "customer").select(*_CUSTOMER).orderBy(["c_acctbal", "c_custkey"])


@query("sort_text_desc", """
    SELECT text_quantity, count(*) AS count
    FROM (SELECT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS text_quantity FROM lineitem)
    GROUP BY text_quantity ORDER BY text_quantity DESC
""")
def sort_text_desc(spark, folder):
    """Numbers stored as text sort as text: '9' before '50'."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_quantity").cast("int").cast("string").alias("text_quantity")
    )
    return lines.groupBy("text_quantity").count().orderBy("text_quantity", ascending=False)


@query("limit_n", "SELECT least(3500, count(*)) AS rows FROM orders")
def limit_n(spark, folder):
    """Which rows a limit keeps is open; their number is not."""
    return table(spark, folder, "orders").limit(3500).agg(F.count("*").alias("rows"))


@query("limit_then_sort", """
    SELECT least(3500, count(*)) AS rows, least(3500, count(*)) AS orders, least(3500, count(*)) AS known
    FROM orders
""")
def limit_then_sort(spark, folder):
    """Any 3,500 rows, then sorted: not a top-k. Which rows is open; that they are different orders is not."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    cut = orders.limit(3500).orderBy("o_totalprice", "o_orderkey")
    found = cut.join(orders, ["o_orderkey", "o_totalprice"], "left_semi").agg(F.count("*").alias("known"))
    return cut.agg(F.count("*").alias("rows"), F.count_distinct("o_orderkey").alias("orders")).select(
        "rows", "orders", found.scalar().alias("known")
    )


@query("topk", """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def topk(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
