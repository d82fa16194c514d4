"""Plans that must hold at a thousand times the data."""

from __future__ import annotations

import re

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from prepmill import operators
from prepmill.catalog import ENTRIES, jobs, models
from prepmill.operators import group_median, impute_group_median

FOLDER = "/root/testdata/sf0.001"
TRAINING = {"ml_decision_tree", "ml_random_forest", "ml_mlp", "job_compare_classifiers",
            "job_train_delay", "job_ingest_and_train", "ml_model_save_load"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in ENTRIES if n not in TRAINING])
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, name):
    text = plan(ENTRIES[name].run(spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in text


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filt_gt", "GreaterThan(l_quantity,45.0)"),
        ("filt_and_ordinal", "Not(EqualTo(o_orderstatus,P))"),
        ("filt_between", "LessThanOrEqual(l_quantity,5.0)"),
        ("filt_having", "EqualTo(o_orderpriority,1-URGENT)"),
        ("src_jdbc_pushed_filter", "GreaterThan(c_acctbal,0.0)"),
    ],
)
def test_filters_are_pushed_down(spark, name, pushed):
    assert pushed in plan(ENTRIES[name].run(spark, FOLDER))


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("agg_group_count2", ["l_returnflag", "l_linestatus"]),
        ("agg_corr", ["l_quantity", "l_extendedprice"]),
        ("norm_minmax", ["l_orderkey", "l_linenumber", "l_quantity"]),
        ("agg_letter_count", ["text"]),
        ("agg_avg_sum", ["l_returnflag", "l_extendedprice"]),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(ENTRIES[name].run(spark, FOLDER)))
    scans = [{part.split(":")[0] for part in schema.split(",")} for schema in schemas]
    assert set(columns) in scans and all(scan <= set(columns) for scan in scans)


def test_top_k_needs_no_full_sort(spark):
    for name in ("topk", "agg_group_count3_top"):
        assert "TakeOrderedAndProject" in plan(ENTRIES[name].run(spark, FOLDER))


def test_counts_are_combined_before_the_shuffle(spark):
    for name in ("agg_group_count", "agg_letter_count", "eval_confusion", "agg_median_approx"):
        assert "partial_" in plan(ENTRIES[name].run(spark, FOLDER))


@pytest.mark.parametrize("limit", [None, "-1"])
def test_medians_are_broadcast_only_below_the_threshold(spark, limit):
    """Beyond the threshold the join shuffles, with the same result."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.col("l_returnflag").alias("flag"),
        F.expr("CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END").alias("quantity"),
    )
    before = spark.conf.get(key)
    try:
        if limit is not None:
            spark.conf.set(key, limit)
        filled = impute_group_median(lines, "flag", "quantity", "filled", exact=True)
        text = plan(filled)
        assert ("BroadcastHashJoin" in text) == (limit is None)
        assert ("SortMergeJoin" in text) == (limit is not None)
        medians = dict(group_median(lines.dropna(), ["flag"], "quantity", exact=True).collect())
        rows = filled.collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == lines.count()
    assert all(r.filled == (medians[r.flag] if r.quantity is None else r.quantity) for r in rows)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A folder with line items of the test's own."""
    n, folder = F.col("id"), str(tmp_path_factory.mktemp("lines"))
    spark.range(4000).select(
        F.floor(n / 4).alias("l_orderkey"),
        (n * 7 % 200).alias("l_partkey"),
        (n * 11 % 90).alias("l_suppkey"),
        (n % 7 + 1).cast("int").alias("l_linenumber"),
        (n * 13 % 50 + 1).cast("double").alias("l_quantity"),
        (n * 7919 % 100000 + 900).cast("double").alias("l_extendedprice"),
        (n * 3 % 11 / 100).alias("l_discount"),
        (n * 5 % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (n * 17 % 3 + 1).cast("int")).alias("l_returnflag"),
        F.when(n * 19 % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_training_partitions_follow_the_size(spark):
    """More than the cores of a small cluster for a table of 40 MB, in proportion beyond."""
    assert [operators.partitions_for(spark.range(n)) for n in (1000, 5_000_000, 50_000_000)] == [8, 20, 191]


def test_a_saved_tree_is_trained_on_dealt_rows(spark, lines, monkeypatch):
    """Not on the partitions of a scan, which packs files up to its own bound."""
    seen = []

    class Tree(DecisionTreeClassifier):
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return super().fit(rows)

    monkeypatch.setattr(models, "decision_tree", lambda label: Tree(labelCol=label, seed=1))
    monkeypatch.setattr(models, "partitions_for", lambda rows: 37)
    found = models.ml_model_save_load(spark, lines).collect()
    assert seen == [37] and sum(r["rows"] for r in found) == 4000 and all(r["rows"] == r["same"] for r in found)


def test_training_vectors_leave_the_memory_to_the_trainer(spark, lines, monkeypatch):
    """Features are fitted and rows split before the shuffle, and the vectors are kept on disk."""
    seen, fitted = [], []

    def build(label, train):
        seen.append((train.storageLevel.useMemory, train.storageLevel.useDisk, train.rdd.getNumPartitions()))
        return operators.decision_tree(label)

    def scaled(features, train):
        fitted.append(plan(train))
        return operators.scaled(features, train)

    monkeypatch.setattr(models, "perceptron", build)
    monkeypatch.setattr(models, "scaled", scaled)
    monkeypatch.setattr(models, "partitions_for", lambda rows: 23)
    row = models.ml_mlp(spark, lines).first()
    assert seen == [(False, True, 23)] and "Exchange" not in fitted[0]
    assert row["actual_high"] + row["actual_low"] == 800  # orders 80 to 99 of every hundred


def test_loans_are_prepared_once(spark, lines, monkeypatch):
    seen = []

    def compare(prepared):
        seen.append(plan(prepared))
        counts = ["actual_positive", "actual_negative", "true_positive", "true_negative", "false_positive", "false_negative"]
        return prepared.agg(F.lit("decision_tree").alias("model"), *[F.count(F.lit(1)).alias(c) for c in counts])

    monkeypatch.setattr(jobs, "compare_classifiers", compare)
    row = jobs.job_compare_classifiers(spark, lines).first()
    assert "cast(" not in seen[0] and "/prepared-" in seen[0] and 0 < row["complete"] < 4000
