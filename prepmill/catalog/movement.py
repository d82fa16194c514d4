"""Files and databases: tables written out and read back.

The database is the one the session names in ``spark.prepmill.jdbc.url`` (with ``.user``,
``.password`` and ``.driver``). Without it a Derby database in the memory of this process is used,
which only works where the executors share that process, in local mode.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from prepmill.catalog.profiles import profile_sql
from prepmill.catalog.registry import query, table
from prepmill.operators import reconcile
from prepmill.plans import ingest, load_and_reconcile
from prepmill.sources import (
    JdbcTable,
    read_csv_inferred,
    read_csv_strict,
    read_parquet,
    read_table,
    scratch_path,
    write_csv,
    write_parquet,
    write_table,
)

_SETTING = "spark.prepmill.jdbc"
_CUSTOMER_TYPES = "c_name VARCHAR(64), c_mktsegment VARCHAR(32)"
_CUSTOMER = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}


def fresh_database_table(spark) -> JdbcTable:
    """A table that does not exist yet."""
    name = f"prepmill_{uuid.uuid4().hex[:12]}"
    url = spark.conf.get(f"{_SETTING}.url", None)
    if url:
        user, password, driver = (
            spark.conf.get(f"{_SETTING}.{part}", None) for part in ("user", "password", "driver")
        )
        return JdbcTable(url, name, user, password, driver)
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_SETTING}.url to a database that all executors reach")
    return JdbcTable(
        f"jdbc:derby:memory:{name};create=true",
        name,
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


@query("src_parquet_scan", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
""")
def src_parquet_scan(spark, folder):
    return read_parquet(spark, f"{folder}/order*.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@query("src_csv_infer", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def src_csv_infer(spark, folder):
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    write_csv(orders, path, header=True)
    # whether a key fits an int depends on the data
    return read_csv_inferred(spark, path).withColumn(
        "o_orderkey", F.col("o_orderkey").cast("bigint")
    )


@query("src_csv_dropmalformed", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment
    FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def src_csv_dropmalformed(spark, folder):
    """Customers written as text lines; those of one segment lack their last field."""
    path = scratch_path(spark, "customer-lines")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    line = F.concat_ws(",", "c_custkey", "c_name", segment)
    lines = table(spark, folder, "customer").select(line.alias(",".join(columns)))
    # a separator that never occurs keeps the commas of each line and of the header as they are
    lines.write.csv(path, header=True, sep="\u0001")
    return read_csv_strict(spark, path)


@query("src_jdbc_roundtrip", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def src_jdbc_roundtrip(spark, folder):
    stored = fresh_database_table(spark)
    write_table(table(spark, folder, "customer"), stored, _CUSTOMER_TYPES)
    return read_table(spark, stored, partition_column="c_custkey")


@query("src_jdbc_pushed_filter", """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 0
""")
def src_jdbc_pushed_filter(spark, folder):
    """The database, not Spark, leaves out the rows."""
    return src_jdbc_roundtrip(spark, folder).filter(F.col("c_acctbal") > 0)


@query("sink_parquet_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_parquet_roundtrip(spark, folder):
    """Written twice: the second write replaces the first."""
    path = scratch_path(spark, "supplier")
    supplier = table(spark, folder, "supplier")
    write_parquet(supplier, path)
    write_parquet(supplier, path)
    return read_parquet(spark, path)


@query("sink_csv_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sink_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "supplier-csv")
    supplier = table(spark, folder, "supplier")
    write_csv(supplier, path)
    write_csv(supplier, path)
    return spark.read.schema(supplier.schema).csv(path)


def _reconciled_sql() -> str:
    measures = ["data_type", "present", "nulls", "mean", "stddev", "min_number", "max_number",
                "min_text", "max_text"]
    sides = ", ".join(f"{m} AS source_{m}, {m} AS target_{m}" for m in measures)
    profiled = profile_sql("customer", _CUSTOMER)
    return f"SELECT ordinal, column_name, {sides}, true AS same_values, true AS same_rows, true AS matches FROM ({profiled})"


def _rounded(reconciled):
    means = [f"{side}_{m}" for side in ("source", "target") for m in ("mean", "stddev")]
    return reconciled.withColumns({c: F.round(c, 6) for c in means})


@query("etl_reconcile", _reconciled_sql())
def etl_reconcile(spark, folder):
    """Customers written to a database, read back and compared."""
    stored = fresh_database_table(spark)
    customer = table(spark, folder, "customer")
    write_table(customer, stored, _CUSTOMER_TYPES)
    loaded = read_table(spark, stored, partition_column="c_custkey")
    return _rounded(reconcile(customer, loaded))


@query("etl_reconcile_swapped", """
    SELECT column_name, count(*) AS present, column_name <> 'c_nationkey' AS same_values, false AS same_rows, false AS swapped_matches,
           column_name <> 'c_nationkey' AS changed_matches
    FROM (SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS column_name FROM customer)
    GROUP BY column_name
""")
def etl_reconcile_swapped(spark, folder):
    """Customers against a copy in which neighbours have swapped their balances: every column holds the same values,
    so only whole rows tell. Then against a copy with one nation changed, which is found in its column."""
    customer = table(spark, folder, "customer")
    neighbour = customer.select(F.col("c_custkey").bitwiseXOR(F.lit(1)).alias("key"), F.col("c_acctbal").alias("other"))
    both = customer.join(neighbour, customer["c_custkey"] == neighbour["key"], "left")
    swapped = both.withColumn("c_acctbal", F.coalesce("other", "c_acctbal")).select(customer.columns)
    one = customer.agg(F.min("c_custkey")).scalar()
    nation = F.when(F.col("c_custkey") == one, F.lit(-1).cast(customer.schema["c_nationkey"].dataType)).otherwise(F.col("c_nationkey"))
    changed = reconcile(customer, customer.withColumn("c_nationkey", nation)).select(
        F.col("column_name").alias("name"), "same_values", F.col("matches").alias("changed_matches")
    )
    found = reconcile(customer, swapped).select(
        "column_name", F.col("source_present").alias("present"), "same_rows", F.col("matches").alias("swapped_matches")
    )
    return found.join(changed, F.col("column_name") == F.col("name")).drop("name")


@query("job_load_and_reconcile", """
    SELECT column_name, present AS source_present, present AS target_present, true AS matches
    FROM (SELECT 'c_custkey' AS column_name, count(*) AS present FROM customer
          UNION ALL SELECT 'c_name', count(*) FROM customer
          UNION ALL SELECT 'c_nationkey', count(*) FROM customer
          UNION ALL SELECT 'c_acctbal', count(*) FROM customer
          UNION ALL SELECT 'c_mktsegment', count(*) FROM customer)
""")
def job_load_and_reconcile(spark, folder):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, folder, "customer"), path, header=True)
    compared = load_and_reconcile(
        spark, path, fresh_database_table(spark), "c_custkey", column_types=_CUSTOMER_TYPES
    )
    return compared.select("column_name", "source_present", "target_present", "matches")


@query("job_ingest", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def job_ingest(spark, folder):
    """Database table to Parquet."""
    stored = fresh_database_table(spark)
    write_table(table(spark, folder, "customer"), stored, _CUSTOMER_TYPES)
    return ingest(spark, stored, scratch_path(spark, "raw"), "c_custkey")
