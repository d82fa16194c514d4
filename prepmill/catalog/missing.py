"""Null handling, on lineitem with nulls put in."""

from __future__ import annotations

from prepmill.catalog.derived import WITH_NULLS, derive, derived_sql
from prepmill.catalog.registry import query
from prepmill.operators import impute_group_median, null_counts, rows_with_null

_LINES = derived_sql(WITH_NULLS)
_COLUMNS = list(WITH_NULLS)


@query("null_counts", f"""
    SELECT {", ".join(f"count(*) - count({c}) AS {c}" for c in _COLUMNS)} FROM {_LINES}
""")
def nulls_per_column(spark, folder):
    return null_counts(derive(spark, folder, WITH_NULLS))


@query("null_rows_any", f"""
    SELECT * FROM {_LINES} WHERE {" OR ".join(f"{c} IS NULL" for c in _COLUMNS)}
""")
def rows_with_any_null(spark, folder):
    return rows_with_null(derive(spark, folder, WITH_NULLS))


@query("null_drop_all", f"""
    SELECT quantity, price, flag FROM {_LINES}
    WHERE quantity IS NOT NULL OR price IS NOT NULL OR flag IS NOT NULL
""")
def drop_all_null(spark, folder):
    return derive(spark, folder, WITH_NULLS).select("quantity", "price", "flag").dropna(how="all")


@query("null_drop_subset", f"""
    SELECT * FROM {_LINES} WHERE price IS NOT NULL AND flag IS NOT NULL
""")
def drop_subset(spark, folder):
    return derive(spark, folder, WITH_NULLS).dropna(how="any", subset=["price", "flag"])


@query("null_drop_any", f"""
    SELECT * FROM {_LINES} WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _COLUMNS)}
""")
def drop_any(spark, folder):
    return derive(spark, folder, WITH_NULLS).dropna()


@query("null_fill_const", f"""
    SELECT * REPLACE (COALESCE(quantity, 9999) AS quantity) FROM {_LINES}
""")
def fill_one(spark, folder):
    return derive(spark, folder, WITH_NULLS).fillna(9999, ["quantity"])


@query("null_fill_map", f"""
    SELECT COALESCE(orderkey, 2) AS orderkey, linenumber, quantity, COALESCE(price, 3) AS price,
           COALESCE(flag, 'none') AS flag
    FROM {_LINES}
""")
def fill_by_column(spark, folder):
    return derive(spark, folder, WITH_NULLS).fillna({"orderkey": "2", "price": 3, "flag": "none"})


@query("null_impute_median", f"""
    WITH lines AS (SELECT orderkey, linenumber, flag, price, quantity FROM {_LINES}),
    medians AS (
        SELECT flag, quantile_disc(price, 0.5) AS median FROM lines
        WHERE orderkey IS NOT NULL AND flag IS NOT NULL AND price IS NOT NULL
              AND quantity IS NOT NULL
        GROUP BY flag
    )
    SELECT orderkey, linenumber, lines.flag, price, quantity, COALESCE(price, median) AS filled
    FROM lines LEFT JOIN medians ON lines.flag = medians.flag
""")
def impute_every_group(spark, folder):
    lines = derive(spark, folder, WITH_NULLS).select(
        "orderkey", "linenumber", "flag", "price", "quantity"
    )
    return impute_group_median(lines, "flag", "price", "filled", exact=True)


@query("null_impute_median_named", f"""
    WITH lines AS (SELECT orderkey, linenumber, flag, price, quantity FROM {_LINES}),
    medians AS (
        SELECT flag, quantile_disc(price, 0.5) AS median FROM lines
        WHERE orderkey IS NOT NULL AND flag = 'A' AND price IS NOT NULL AND quantity IS NOT NULL
        GROUP BY flag
    )
    SELECT orderkey, linenumber, lines.flag, price, quantity, COALESCE(price, median) AS filled
    FROM lines LEFT JOIN medians ON lines.flag = medians.flag
""")
def impute_one_group(spark, folder):
    """Only the named group is filled."""
    lines = derive(spark, folder, WITH_NULLS).select(
        "orderkey", "linenumber", "flag", "price", "quantity"
    )
    return impute_group_median(lines, "flag", "price", "filled", groups=["A"], exact=True)
