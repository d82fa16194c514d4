"""Feature building."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.operators import (
    FEATURES,
    assemble,
    dictionary,
    index_by_dictionary,
    one_hot,
    string_index,
    vector_columns,
    vector_width,
)
from prepmill.operators.features import encoded, indexed


def _ranks(source: str, column: str) -> str:
    return (
        f"SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS rank "
        f"FROM {source} GROUP BY {column}"
    )


@query("feat_string_index", f"""
    SELECT o_orderkey, orders.o_orderpriority, CAST(rank AS DOUBLE) AS priority_index
    FROM orders JOIN ({_ranks("orders", "o_orderpriority")}) ranks
         ON orders.o_orderpriority = ranks.o_orderpriority
""")
def feat_string_index(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    fitted = string_index(["o_orderpriority"]).fit(orders)
    return fitted.transform(orders).withColumnRenamed(indexed("o_orderpriority"), "priority_index")


@query("feat_string_index_strict", f"""
    SELECT o_orderkey, orders.o_orderpriority, CAST(rank AS DOUBLE) AS priority_index
    FROM orders JOIN ({_ranks("orders", "o_orderpriority")}) ranks
         ON orders.o_orderpriority = ranks.o_orderpriority
""")
def feat_string_index_strict(spark, folder):
    """The form that refuses unseen text, on data where every text was seen."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    fitted = string_index(["o_orderpriority"], invalid="error").fit(orders)
    return fitted.transform(orders).withColumnRenamed(indexed("o_orderpriority"), "priority_index")


@query("feat_string_index_unseen", f"""
    SELECT o_orderkey, orders.o_orderpriority,
           CAST(COALESCE(rank, (SELECT count(DISTINCT o_orderpriority) FROM orders
                                WHERE o_orderpriority <> '3-MEDIUM')) AS DOUBLE) AS priority_index
    FROM orders LEFT JOIN (
        {_ranks("(SELECT * FROM orders WHERE o_orderpriority <> '3-MEDIUM')", "o_orderpriority")}
    ) ranks ON orders.o_orderpriority = ranks.o_orderpriority
""")
def feat_string_index_unseen(spark, folder):
    """Text not seen in training gets one extra index behind the last label."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    seen = orders.filter(F.col("o_orderpriority") != "3-MEDIUM")
    fitted = string_index(["o_orderpriority"], invalid="keep").fit(seen)
    return fitted.transform(orders).withColumnRenamed(indexed("o_orderpriority"), "priority_index")


@query("feat_dictionary", f"""
    SELECT l_partkey AS value, count(*) AS frequency, rank AS index
    FROM (SELECT concat('P', l_partkey % 5000) AS l_partkey FROM lineitem) JOIN (
        {_ranks("(SELECT concat('P', l_partkey % 5000) AS l_partkey FROM lineitem)", "l_partkey")}
    ) USING (l_partkey) GROUP BY l_partkey, rank
""")
def feat_dictionary(spark, folder):
    """A dictionary table of a column with many distinct texts."""
    return dictionary(_parts(spark, folder), "l_partkey")


def _parts(spark, folder):
    part = F.concat(F.lit("P"), F.col("l_partkey") % 5000)
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", part.alias("l_partkey"))


@query("feat_dictionary_index", f"""
    WITH parts AS (SELECT l_orderkey, l_linenumber, concat('P', l_partkey % 5000) AS l_partkey FROM lineitem),
    early AS (SELECT * FROM parts WHERE l_linenumber < 3),
    ranks AS ({_ranks("early", "l_partkey")})
    SELECT l_orderkey, l_linenumber, parts.l_partkey,
           CAST(coalesce(rank, (SELECT count(*) FROM ranks)) AS DOUBLE) AS l_partkey_index
    FROM parts LEFT JOIN ranks ON parts.l_partkey = ranks.l_partkey
""")
def feat_dictionary_index(spark, folder):
    """Indexes by a dictionary of some of the lines; texts that it lacks share one index."""
    parts = _parts(spark, folder)
    return index_by_dictionary(parts, "l_partkey", dictionary(parts.filter("l_linenumber < 3"), "l_partkey"))


_SLOTS = 6  # five market segments and the slot for unseen text


@query("feat_one_hot", f"""
    SELECT c_custkey, {", ".join(
        f"CASE WHEN rank = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS slot_{i}"
        for i in range(_SLOTS))}
    FROM customer JOIN ({_ranks("customer", "c_mktsegment")}) ranks
         ON customer.c_mktsegment = ranks.c_mktsegment
""")
def feat_one_hot(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    stages = Pipeline(stages=[string_index(["c_mktsegment"]), one_hot(["c_mktsegment"])])
    vectors = stages.fit(customer).transform(customer)
    vectors = vectors.select("c_custkey", encoded("c_mktsegment"))
    slots = vector_width(vectors, encoded("c_mktsegment"))
    return vector_columns(vectors, encoded("c_mktsegment"), [f"slot_{i}" for i in range(slots)])


_INPUTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("feat_assemble", f"SELECT l_orderkey, l_linenumber, {', '.join(_INPUTS)} FROM lineitem")
def feat_assemble(spark, folder):
    """Columns into a vector and back."""
    lines = table(spark, folder, "lineitem")
    vectors = assemble(_INPUTS).transform(lines).select("l_orderkey", "l_linenumber", FEATURES)
    return vector_columns(vectors, FEATURES, _INPUTS)
