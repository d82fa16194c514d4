"""Scoring of predictions that SQL can make as well."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.operators import (
    accuracy,
    confusion,
    confusion_rates,
    regression_metrics,
    residuals,
)

_PRICES = "(SELECT l_orderkey, l_linenumber, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)"


def _prices(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 1500).alias("p"),
    )


def _judged(spark, folder):
    """Quality as the true class, absence of toxicity as its prediction."""
    return table(spark, folder, "labels").select(
        "doc_id", "quality", (1 - F.col("toxic")).alias("prediction")
    )


@query("eval_regression", f"""
    SELECT count(*) AS rows, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
           round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 8) AS r2
    FROM {_PRICES}, (SELECT avg(l_extendedprice) AS mean FROM lineitem)
""")
def eval_regression(spark, folder):
    scores = regression_metrics(_prices(spark, folder), "y", "p")
    return scores.withColumns({"rmse": F.round("rmse", 4), "r2": F.round("r2", 8)})


@query("eval_residuals", f"""
    SELECT l_orderkey, l_linenumber, y AS actual, p AS predicted, y - p AS residual
    FROM {_PRICES} ORDER BY actual, l_orderkey, l_linenumber, predicted
""")
def eval_residuals(spark, folder):
    rows = residuals(_prices(spark, folder), "y", "p", "l_orderkey", "l_linenumber")
    return rows.orderBy("actual", "l_orderkey", "l_linenumber", "predicted")


@query("eval_accuracy", """
    SELECT round(avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END) * 100, 6) AS accuracy
    FROM labels
""")
def eval_accuracy(spark, folder):
    return accuracy(_judged(spark, folder), "quality", "prediction").select(
        F.round("accuracy", 6).alias("accuracy")
    )


@query("eval_confusion", """
    SELECT quality, count(*) AS total, count(*) FILTER (WHERE quality = 1 - toxic) AS right,
           count(*) FILTER (WHERE quality <> 1 - toxic) AS wrong
    FROM labels GROUP BY quality
""")
def eval_confusion(spark, folder):
    return confusion(_judged(spark, folder), "quality", "prediction")


@query("eval_confusion_rates", """
    WITH counts AS (
        SELECT count(*) FILTER (WHERE quality = 1) AS actual_positive,
               count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS true_positive,
               count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS false_negative,
               count(*) FILTER (WHERE quality = 0) AS actual_negative,
               count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS true_negative,
               count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS false_positive
        FROM labels
    )
    SELECT *,
           round(CAST(true_positive AS DOUBLE) / nullif(actual_positive, 0) * 100, 6)
               AS true_positive_rate,
           round(CAST(false_negative AS DOUBLE) / nullif(actual_positive, 0) * 100, 6)
               AS false_negative_rate,
           round(CAST(true_negative AS DOUBLE) / nullif(actual_negative, 0) * 100, 6)
               AS true_negative_rate,
           round(CAST(false_positive AS DOUBLE) / nullif(actual_negative, 0) * 100, 6)
               AS false_positive_rate,
           round(CAST(true_positive + true_negative AS DOUBLE)
                 / nullif(actual_positive + actual_negative, 0) * 100, 6) AS accuracy
    FROM counts
""")
def eval_confusion_rates(spark, folder):
    rates = confusion_rates(_judged(spark, folder), "quality", "prediction", 1)
    return rates.withColumns(
        {c: F.round(c, 6) for c in rates.columns if c.endswith("_rate") or c == "accuracy"}
    )
