"""Models on lineitem: price from quantity, and whether a price is high."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from prepmill.catalog.registry import query, table
from prepmill.operators import (
    FEATURES,
    assemble,
    chain,
    confusion_rates,
    decision_tree,
    decode_prediction,
    feature_pipeline,
    label_texts,
    linear_regression,
    load_model,
    partitions_for,
    perceptron,
    random_forest,
    save_model,
    scaled,
    split_by_key,
    spread,
)
from prepmill.operators.features import indexed
from prepmill.sources import materialize, scratch_path

_NUMBERS = ["l_quantity", "l_discount", "l_tax"]
_TEXTS = ["l_returnflag", "l_linestatus"]


@query("ml_linear_regression", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
    FROM lineitem
""")
def ml_linear_regression(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    vectors = assemble(["l_quantity"]).transform(lines)
    model = linear_regression("l_extendedprice").fit(vectors)
    found = spark.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double"
    )
    return found.select(*[F.round(name, 4).alias(name) for name in found.columns])


def _priced(spark, folder):
    price = F.when(F.col("l_extendedprice") > 50000, "high").otherwise("low")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", *_TEXTS, *_NUMBERS, price.alias("price")
    )
    return materialize(spread(lines, partitions_for(lines)), "priced")


def _classify(spark, folder, build, labelled, scale):
    """Fit on four fifths of the orders and score the rest; one row of counts and rates."""
    lines = labelled(spark, folder)
    partitions = partitions_for(lines)
    train, test = split_by_key(lines, "l_orderkey", 80)
    features = feature_pipeline(_NUMBERS, encode=_TEXTS, label="price").fit(train)
    if scale:
        features = scaled(features, train)
    vectors = features.transform(spread(train, partitions)).select(FEATURES, indexed("price"))
    vectors.persist(StorageLevel.DISK_ONLY)  # the trainer keeps a form of its own in memory
    model = build(vectors).fit(vectors)
    vectors.unpersist()
    high = float(label_texts(features, "price").index("high"))
    scored = chain(features, model).transform(spread(test, partitions))
    return confusion_rates(scored, indexed("price"), "prediction", high)


def _ruled(spark, folder):
    """Lines with a label that is a rule over features with few values, so that a tree can learn all of it."""
    rule = (F.col("l_discount") > 0.05) & (F.col("l_returnflag") != "R")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", *_TEXTS, *_NUMBERS, F.when(rule, "high").otherwise("low").alias("price")
    )


_RULED = """
    SELECT count(CASE WHEN l_discount > 0.05 AND l_returnflag <> 'R' THEN 1 END) AS actual_high,
           count(CASE WHEN NOT (l_discount > 0.05 AND l_returnflag <> 'R') THEN 1 END) AS actual_low,
           true AS learned
    FROM lineitem WHERE NOT l_orderkey % 100 < 80
"""


def _learned(spark, folder, build, least, scale=False):
    """Actual numbers of the held-out lines, and whether ``least`` percent of them are predicted right."""
    rates = _classify(spark, folder, build, _ruled, scale)
    right = F.col("true_positive") + F.col("true_negative")
    actual = F.col("actual_positive") + F.col("actual_negative")
    return rates.select(
        F.col("actual_positive").alias("actual_high"),
        F.col("actual_negative").alias("actual_low"),
        (100 * right >= least * actual).alias("learned"),
    )


@query("ml_decision_tree", _RULED)
def ml_decision_tree(spark, folder):
    return _learned(spark, folder, lambda train: decision_tree(indexed("price")), 99.9)


@query("ml_random_forest", _RULED)
def ml_random_forest(spark, folder):
    return _learned(spark, folder, lambda train: random_forest(indexed("price")), 99.9)


@query("ml_mlp", _RULED)
def ml_mlp(spark, folder):
    return _learned(spark, folder, lambda train: perceptron(indexed("price"), train), 95, scale=True)


@query("ml_model_save_load", """
    SELECT CASE WHEN l_extendedprice > 50000 THEN 'high' ELSE 'low' END AS price,
           count(*) AS rows, count(*) AS same
    FROM lineitem GROUP BY 1
""")
def ml_model_save_load(spark, folder):
    """A saved and reloaded model predicts what the fitted one does, for every row."""
    priced = _priced(spark, folder)
    features = feature_pipeline(_NUMBERS, encode=_TEXTS, label="price").fit(priced)
    # a scan puts many files in one partition, and the trainer holds a partition's rows in a form ten times as large
    dealt = spread(priced, partitions_for(priced))
    tree = decision_tree(indexed("price")).fit(features.transform(dealt))
    model = chain(features, tree)
    path = scratch_path(spark, "model")
    save_model(model, path)
    labels = label_texts(model, "price")
    fitted = decode_prediction(model.transform(priced), labels, "fitted")
    kept = fitted.select("l_orderkey", *_TEXTS, *_NUMBERS, "price", "fitted")
    both = decode_prediction(load_model(path).transform(kept), labels, "loaded")
    return both.groupBy("price").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("fitted").eqNullSafe(F.col("loaded"))).alias("same"),
    )
