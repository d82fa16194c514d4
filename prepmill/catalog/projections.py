"""Projections, derived columns and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.operators import cast_to_double


@query("str_length", """
    SELECT doc_id, lang, length(lang) AS lang_length, length(text) AS text_length FROM documents
""")
def str_length(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        F.length("lang").cast("bigint").alias("lang_length"),
        F.length("text").cast("bigint").alias("text_length"),
    )


@query("proj_select", "SELECT p_partkey, p_brand, p_size FROM part")
def proj_select(spark, folder):
    return table(spark, folder, "part").select("p_partkey", "p_brand", "p_size")


@query("proj_alias", "SELECT p_type AS kind, p_size AS mid_size FROM part WHERE p_size BETWEEN 4 AND 5")
def proj_alias(spark, folder):
    part = table(spark, folder, "part")
    return part.filter(part.p_size.between(4, 5)).select(
        part.p_type.alias("kind"), part.p_size.alias("mid_size")
    )


@query("proj_drop", "SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part")
def proj_drop(spark, folder):
    return table(spark, folder, "part").drop("p_size")


@query("proj_replace", "SELECT p_partkey, p_size * 2 AS p_size FROM part")
def proj_replace(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    return part.withColumn("p_size", F.col("p_size") * 2)


@query("proj_derive", """
    SELECT p_partkey, p_size, p_size * 2 AS double_size, p_retailprice - p_size AS reduced,
           CAST(p_size AS DOUBLE) / 7 AS seventh
    FROM part
""")
def proj_derive(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return part.withColumns(
        {
            "double_size": F.col("p_size") * 2,
            "reduced": F.col("p_retailprice") - F.col("p_size"),
            "seventh": F.col("p_size") / 7,
        }
    ).drop("p_retailprice")


_DIRTY = {
    "p_partkey": "p_partkey",
    "size_text": "CASE WHEN p_type = 'PROMO' THEN 'NA' ELSE concat('', p_size) END",
    "price_text": "CASE WHEN p_size = 13 THEN 'n/a' ELSE concat('', p_size, '.25') END",
    "size_number": "p_size",
}


@query("prep_cast_double", f"""
    SELECT p_partkey, TRY_CAST(size_text AS DOUBLE) AS size_text,
           TRY_CAST(price_text AS DOUBLE) AS price_text, CAST(size_number AS DOUBLE) AS size_number
    FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in _DIRTY.items())} FROM part)
""")
def prep_cast_double(spark, folder):
    dirty = table(spark, folder, "part").selectExpr(*[f"{e} AS {n}" for n, e in _DIRTY.items()])
    return cast_to_double(dirty, ["size_text", "price_text", "size_number"])


@query("proj_same_twice", "SELECT o_orderkey AS number, o_orderkey AS again FROM orders")
def proj_same_twice(spark, folder):
    """A column selected twice keeps its name twice, until the columns are renamed."""
    return table(spark, folder, "orders").select("o_orderkey", "o_orderkey").toDF("number", "again")


@query("layout_repartition", "SELECT count(*) AS rows, CAST(7 AS BIGINT) AS parts FROM orders")
def layout_repartition(spark, folder):
    """Rows are dealt out evenly, none is lost."""
    dealt = table(spark, folder, "orders").repartition(7).select(F.spark_partition_id().alias("part"))
    return dealt.agg(F.count("*").alias("rows"), F.count_distinct("part").alias("parts"))


@query("layout_cache", "SELECT o_orderkey, o_totalprice FROM orders")
def layout_cache(spark, folder):
    """A table that was cached, read and released has the rows it had before."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice").persist()
    orders.count()
    return orders.unpersist()
