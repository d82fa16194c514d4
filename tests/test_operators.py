"""Operators on small tables with known results, and against brute force."""

from __future__ import annotations

import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from prepmill.operators import quantiles, split
from prepmill.operators import (
    accuracy,
    average_and_sum,
    box_plot,
    cast_to_double,
    complete_rows,
    confusion,
    confusion_rates,
    correlation,
    dictionary,
    exact_quantiles,
    group_median,
    impute_group_median,
    index_by_dictionary,
    letter_count,
    min_max,
    null_counts,
    partitions_for,
    profile,
    random_split,
    ranked,
    reconcile,
    regression_metrics,
    residuals,
    rows_with_null,
    split_by_key,
    stored_random_split,
    stratified_sample,
    string_index,
)
from prepmill.sources import materialize


def pairs(df):
    return [tuple(row) for row in df.collect()]


# --- sorting, filtering and projecting ---------------------------------------------------------


def test_counts_and_filters(trees):
    assert trees.count() == 6
    assert sorted(pairs(trees.groupBy("height").count())) == [(12, 1), (18, 1), (30, 3), (40, 1)]
    kept = trees.filter(trees.height > 20).filter(F.col(trees.columns[0]) != "oak")
    assert [r[0] for r in kept.collect()] == ["pine", "elm", "larch"]
    between = trees.filter(F.col("height").between(18, 30))
    assert [r[0] for r in between.collect()] == ["oak", "birch", "elm", "larch"]


def test_sorts(trees):
    both = trees.orderBy("height", "tree", ascending=False)
    assert pairs(both) == [("pine", 40), ("oak", 30), ("larch", 30), ("elm", 30), ("birch", 18), ("yew", 12)]
    mixed = trees.filter("height >= 18").orderBy(F.desc("height"), F.asc("tree"))
    assert pairs(mixed) == [("pine", 40), ("elm", 30), ("larch", 30), ("oak", 30), ("birch", 18)]


def test_a_column_may_be_selected_twice(trees):
    assert trees.select("height", "tree", "height").columns == ["height", "tree", "height"]


def test_registered_sorts_are_in_order(spark):
    from prepmill.catalog import ENTRIES

    folder = "/root/testdata/sf0.001"
    rows = pairs(ENTRIES["sort_mixed"].run(spark, folder))
    assert rows == sorted(rows, key=lambda r: (-r[2], r[1], r[0]))
    rows = pairs(ENTRIES["sort_multi_desc"].run(spark, folder))
    assert rows == sorted(rows, key=lambda r: (r[2], r[1], r[0]), reverse=True)
    texts = [r[0] for r in pairs(ENTRIES["sort_text_desc"].run(spark, folder))]
    assert texts == sorted(texts, reverse=True) and texts.index("9") < texts.index("50")
    rows = pairs(ENTRIES["limit_then_sort"].run(spark, folder))
    assert rows == sorted(rows, key=lambda r: (r[1], r[0]))


# --- nulls --------------------------------------------------------------------------------------


def test_null_counts_and_rows(readings):
    assert pairs(null_counts(readings)) == [(1, 2, 2)]
    assert rows_with_null(readings).count() == 3
    assert readings.dropna(how="all").count() == 9
    assert readings.dropna(how="any", subset=["sensor", "day"]).count() == 8
    assert complete_rows(readings).count() == readings.dropna().count() == 7
    assert complete_rows(readings, ["sensor", "day"]).count() == 8


def test_complete_rows_drop_nan_as_dropna_does(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (4.0, None)], "x double, k int")
    assert pairs(complete_rows(df)) == pairs(df.dropna()) == [(1.0, 1)]


def test_fill(readings):
    one = readings.fillna(9999, ["level"])
    assert [r.level for r in one.collect()].count(9999) == 2
    assert pairs(null_counts(one)) == [(1, 2, 0)]
    every = readings.fillna({"sensor": "unknown", "day": "2", "level": 3})
    assert pairs(null_counts(every)) == [(0, 0, 0)]
    assert dict(every.dtypes)["day"] == "bigint"
    assert ("unknown", 2, 3) in pairs(every)


@pytest.mark.parametrize("exact", [False, True])
def test_group_median_of_complete_rows(readings, exact):
    medians = group_median(readings.dropna(), ["sensor"], "level", exact=exact)
    assert sorted(pairs(medians)) == [("north", 21), ("south", 70)]


@pytest.mark.parametrize("exact", [False, True])
def test_impute_one_group(readings, exact):
    filled = impute_group_median(readings, "sensor", "level", "filled", groups=["north"], exact=exact)
    assert filled.columns == ["sensor", "day", "level", "filled"]
    rows = pairs(filled)
    assert len(rows) == 10
    assert ("north", 3, None, 21) in rows and (None, None, None, None) in rows


# --- exact quantiles ------------------------------------------------------------------------------


def disc(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered)) - 1, 0)]


def cont(values, p):
    ordered = sorted(values)
    at = p * (len(ordered) - 1)
    low = math.floor(at)
    high = math.ceil(at)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 99, 101, 5000])
@pytest.mark.parametrize("accuracy_", [100, 10_000])
def test_quantiles_against_sorting(spark, n, accuracy_):
    """A low accuracy makes the brackets narrow next to the group, so the gaps are exercised."""
    chance = random.Random(n)
    values = [float(chance.choice([7, chance.randint(0, 50), chance.randint(0, 10**6)])) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(df, [], "x", ps, accuracy=accuracy_).first()
    assert (found.n, found.quantiles) == (n, [disc(values, p) for p in ps])
    between = exact_quantiles(df, [], "x", ps, interpolate=True, accuracy=accuracy_).first()
    assert between.quantiles == pytest.approx([cont(values, p) for p in ps])


def test_quantiles_of_brackets_with_many_values(spark, monkeypatch):
    """Brackets with more values than one array takes are thinned, round by round."""
    monkeypatch.setattr(quantiles, "MOST_VALUES", 40)
    monkeypatch.setattr(quantiles, "CUTS", 4)
    chance = random.Random(9)
    rows = [(i % 3, float(chance.choice([5, chance.randint(0, 900), chance.random()]))) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, x double").repartition(4)
    for ps, accuracy_ in (([0.5], 10_000), ([0.1, 0.11, 0.9], 10_000), ([0.0, 0.5, 1.0], 50)):
        found = exact_quantiles(df, ["k"], "x", ps, accuracy=accuracy_).collect()
        assert {r.k: r.quantiles for r in found} == {k: [disc([x for j, x in rows if j == k], p) for p in ps] for k in range(3)}


def test_a_sketch_that_misses_costs_a_pass_only(spark, monkeypatch):
    """Brackets beside the wanted ranks, as of a sketch far beyond its error."""
    true_sketch = F.percentile_approx
    wrong = lambda column, shares, accuracy: true_sketch(column, [min(1.0, s + 0.2) for s in shares], accuracy)
    monkeypatch.setattr(quantiles.F, "percentile_approx", wrong)
    values = list(range(3000))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = exact_quantiles(df, [], "x", [0.25, 0.5], accuracy=1000).first()
    assert found.quantiles == [disc(values, 0.25), disc(values, 0.5)]


def test_quantiles_with_a_hot_group_and_null_keys(spark):
    chance = random.Random(5)
    rows = []
    for i in range(9000):
        key = "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i % 40}")
        value = None if i % 11 == 0 else (chance.gauss(0, 100) if i % 2 else 1.0)
        rows.append((key, value))
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    groups: dict = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    found = exact_quantiles(df, ["k"], "x", [0.1, 0.5], accuracy=200)
    assert {r.k: (r.n, r.quantiles) for r in found.collect()} == {
        key: (len(v), [disc(v, 0.1), disc(v, 0.5)]) for key, v in groups.items()
    }


def test_approximate_median_keeps_its_error_bound(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    ordered = sorted(r.x for r in df.collect())
    found = group_median(df, [], "x", accuracy=1000).first().median
    assert abs(ordered.index(found) / len(ordered) - 0.5) <= 1 / 1000


# --- normalisation --------------------------------------------------------------------------------


def test_min_max_of_heights(trees):
    scaled = min_max(trees, {"height": "scaled"})
    assert [r.scaled for r in scaled.collect()] == [18 / 28, 6 / 28, 1.0, 0.0, 18 / 28, 18 / 28]


def test_columns_with_points_in_their_names(spark):
    df = spark.createDataFrame([("x", 1.0, 2.0), ("x", 3.0, 4.0)], "k string, a double, b double")
    df = df.withColumnsRenamed({"k": "k.k", "a": "a.a", "b": "b.b"})
    assert [r[3] for r in min_max(df, {"a.a": "c.c"}).collect()] == [0.0, 1.0]
    assert box_plot(df, "a.a").first().median == 2.0
    assert pairs(average_and_sum(df, "k.k", "a.a")) == [("x", 2.0, 4.0)]
    assert pairs(letter_count(df, "k.k")) == [("x", 2)]
    assert pairs(group_median(df, ["k.k"], "b.b")) == [("x", 2.0)]
    assert pairs(group_median(df, ["k.k"], "b.b", exact=True)) == [("x", 2.0)]
    assert correlation(df, "a.a", "b.b").first().correlation == pytest.approx(1.0)


def test_min_max_edges(spark):
    df = spark.createDataFrame([(1.0, 5, None), (3.0, 5, 2.0), (None, 5, 4.0)], "a double, b int, c double")
    assert pairs(min_max(df, ["a", "b", "c"])) == [(0.0, None, None), (1.0, None, 0.0), (None, None, 1.0)]


def test_min_max_with_ranges_of_another_table(spark):
    df = spark.createDataFrame([(0.0,), (4.0,)], "a double")
    wide = spark.createDataFrame([(0.0,), (8.0,)], "a double")
    assert pairs(min_max(df, ["a"], ranges_from=wide)) == [(0.0,), (0.5,)]


def test_min_max_plan_has_no_join_and_no_window(trees):
    plan = min_max(trees, ["height"])._jdf.queryExecution().toString()
    assert "Join" not in plan and "Window" not in plan


# --- profiles ---------------------------------------------------------------------------------------


def test_profile_of_readings(readings):
    rows = {r.column_name: r for r in profile(readings).collect()}
    assert [rows[c].present for c in readings.columns] == [9, 8, 8]
    assert rows["sensor"].mean is None and rows["sensor"].stddev is None
    assert (rows["sensor"].min_text, rows["sensor"].max_text) == ("north", "south")
    assert (rows["day"].mean, rows["level"].mean) == (3.25, 154.5)
    assert rows["day"].stddev == pytest.approx(statistics.stdev([1, 2, 3, 9, 1, 1, 4, 5]))
    assert rows["level"].stddev == pytest.approx(statistics.stdev([20, 25, 21, 70, 70, 64, 900, 66]))


def test_profile_agrees_with_describe_on_text_numbers(spark):
    df = spark.createDataFrame([("1",), ("zz",), ("4",), (None,)], "x string")
    ours = profile(df).first()
    theirs = {r.summary: r.x for r in df.describe().collect()}
    assert (str(ours.present), str(ours.mean)) == (theirs["count"], theirs["mean"])
    assert str(ours.stddev) == theirs["stddev"]
    assert (ours.min_text, ours.max_text) == (theirs["min"], theirs["max"])


def test_box_plot(spark):
    values = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 50.0, -40.0]
    box = box_plot(spark.createDataFrame([(v,) for v in [*values, None]], "x double"), "x").first()
    q1, q3 = cont(values, 0.25), cont(values, 0.75)
    assert (box.q1, box.median, box.q3) == (q1, cont(values, 0.5), q3)
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (box.whisker_low, box.whisker_high) == (min(inside), max(inside))
    assert (box.outliers, box.present) == (2, 10)


def test_correlation_uses_complete_rows(spark):
    rows = [(1.0, 2.0), (2.0, 3.5), (3.0, 7.0), (None, 100.0), (50.0, None)]
    found = correlation(spark.createDataFrame(rows, "a double, b double"), "a", "b").first()
    assert found.rows == 3
    assert found.correlation == pytest.approx(statistics.correlation([1, 2, 3], [2, 3.5, 7]))


def test_reconcile_finds_every_difference(readings):
    assert all(r.matches for r in reconcile(readings, readings.orderBy("level")).collect())
    changed = readings.fillna(0, ["level"])
    flags = {r.column_name: r.matches for r in reconcile(readings, changed).collect()}
    assert flags == {"sensor": True, "day": True, "level": False}
    doubled = readings.union(readings)
    assert not any(r.matches for r in reconcile(readings, doubled).collect())
    missing = {r.column_name: r.matches for r in reconcile(readings, readings.drop("sensor")).collect()}
    assert missing["sensor"] is False


def flags(a, b):
    return [(r.same_values, r.same_rows, r.matches) for r in reconcile(a, b).orderBy("ordinal").collect()]


def test_reconcile_finds_values_swapped_between_rows(spark):
    source = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (3, None)], "k int, t string")
    assert flags(source, source.repartition(3)) == [(True, True, True)] * 2
    swapped = spark.createDataFrame([(2, "x"), (1, "y"), (3, None), (3, None)], source.schema)
    assert flags(source, swapped) == [(True, False, False)] * 2
    inside = spark.createDataFrame([(1, "x"), (1, "y"), (3, None), (4, None)], "k int, t string")
    other = spark.createDataFrame([(1, "x"), (2, "y"), (2, None), (4, None)], "k int, t string")
    assert flags(inside, other) == [(False, False, False), (True, False, True)]  # the difference is in k alone
    nulls = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert flags(nulls, spark.createDataFrame([(1, 1), (None, None)], "a int, b int")) == [(True, False, False)] * 2
    assert flags(source.limit(0), source.limit(0)) == [(True, True, True)] * 2


# --- aggregates -------------------------------------------------------------------------------------


def test_letters(spark):
    df = spark.createDataFrame([("Hello World",), (None,), ("",)], "t string")
    found = pairs(letter_count(df, "t"))
    assert found[:2] == [("l", 3), ("o", 2)]
    assert Counter(dict(found)) == Counter("Hello World")


def test_letters_outside_the_basic_plane(spark):
    text = "añ😀 😀ç"
    df = spark.createDataFrame([(text,)], "t string")
    assert Counter(dict(pairs(letter_count(df, "t")))) == Counter(text)


def test_average_and_sum_of_text(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "3"), ("a", "x"), ("b", None)], "k string, v string")
    assert sorted(pairs(average_and_sum(df, "k", "v"))) == [("a", 2.0, 4.0), ("b", None, None)]


def test_cast_to_double_keeps_other_columns(spark):
    df = spark.createDataFrame([("1", "NA", "z")], "a string, b string, c string")
    assert pairs(cast_to_double(df, ["a", "b"])) == [(1.0, None, "z")]


# --- dictionaries -----------------------------------------------------------------------------------


def test_a_dictionary_indexes_like_the_indexer(spark):
    texts = [random.Random(2).choice(["a", "b", "B", "é", "", "zz", "hot", "hot", "hot"]) for _ in range(400)]
    texts += [f"t{i}" for i in range(300)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, index int").repartition(5)
    words = dictionary(df, "t")
    fitted = string_index(["t"]).fit(df)
    assert [r["value"] for r in words.orderBy("index").collect()] == list(fitted.labelsArray[0])
    more = df.union(spark.createDataFrame([("new", 1), (None, 2)], df.schema))
    expected = {(r.t, r.t_index) for r in fitted.transform(more).collect()}
    found = index_by_dictionary(more, "t", words)
    assert {(r.t, r.t_index) for r in found.collect()} == expected and found.count() == 702
    assert found.columns == ["t", "index", "t_index"]
    assert index_by_dictionary(df, "t", words, "error").count() == 700
    for bad in ("new", None):
        with pytest.raises(Exception, match="no index in t"):
            index_by_dictionary(spark.createDataFrame([(bad, 1)], df.schema), "t", words, "error").collect()
    with pytest.raises(ValueError, match="invalid"):
        index_by_dictionary(df, "t", words, "skip")
    assert dictionary(df.limit(0), "t").count() == 0


def test_ranks_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
        numbered = ranked(df, F.desc("k"))
        assert all(r["rank"] == 4999 - r.k for r in numbered.collect())
        assert ranked(df.limit(0), "k").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_partitions_follow_the_stored_size(spark):
    small, large = (materialize(spark.range(n).select(F.rand(1).alias("x")), "sized") for n in (1000, 400_000))
    assert partitions_for(small) == 8 == partitions_for(large)
    assert partitions_for(small, 100_000) == 8 and 25 < partitions_for(large, 100_000) < 40


# --- splits -----------------------------------------------------------------------------------------


def test_random_split_covers_and_repeats(spark):
    df = spark.range(5000)
    train, test = random_split(df, [0.8, 0.2], seed=12)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not a & b and len(a | b) == 5000 and 3800 < len(a) < 4200
    assert a == {r.id for r in random_split(df, [0.8, 0.2], seed=12)[0].collect()}


def test_stored_split_covers_and_stays(spark):
    df = spark.range(0, 6000, numPartitions=5)
    parts = stored_random_split(df, [3, 1, 1], seed=4, label="split")
    first = [{r.id for r in part.collect()} for part in parts]
    again = [{r.id for r in part.repartition(3).collect()} for part in parts]
    assert first == again and set.union(*first) == set(range(6000))
    assert sum(map(len, first)) == 6000 and 3400 < len(first[0]) < 3800
    assert parts[0].columns == ["id"]
    assert "Sort" not in parts[0]._jdf.queryExecution().executedPlan().toString()


def test_equal_rows_are_drawn_apart(spark, monkeypatch):
    monkeypatch.setattr(split, "COPIES", 700)
    df = spark.range(9000).select(F.when(F.col("id") < 8000, "hot").alias("t"), F.lit(1.5).alias("x"))
    first = random_split(df, [0.8, 0.2], seed=12)
    counts = [dict(pairs(part.groupBy("t").count())) for part in first]
    assert {t: counts[0][t] + counts[1][t] for t in ("hot", None)} == {"hot": 8000, None: 1000}
    assert abs(counts[1]["hot"] - 1600) < 4 * math.sqrt(8000 * 0.16) and abs(counts[1][None] - 200) < 4 * math.sqrt(160)
    again = random_split(df.repartition(7).orderBy("t"), [0.8, 0.2], seed=12)
    assert [dict(pairs(part.groupBy("t").count())) for part in again] == counts
    together = random_split(df, [0.5, 0.5], seed=1, keys=["t"])
    assert sorted(len(pairs(part.distinct())) for part in together) in ([0, 2], [1, 1])
    assert random_split(df.limit(0), [1, 1], seed=1)[0].count() == 0
    sample = stratified_sample(df, "t", {"hot": 0.25}, seed=3)
    assert abs(sample.count() - 2000) < 4 * math.sqrt(8000 * 0.1875) and sample.columns == ["t", "x"]


@pytest.mark.parametrize("key", ["id", "text"])
def test_split_by_key_does_not_depend_on_partitions(spark, key):
    df = spark.range(-50, 3000).select("id", F.concat(F.lit("k"), "id").alias("text"))
    first = [{r.id for r in part.collect()} for part in split_by_key(df, key, 80)]
    again = [{r.id for r in part.collect()} for part in split_by_key(df.repartition(7), key, 80)]
    assert first == again and not first[0] & first[1] and len(first[0] | first[1]) == 3050
    assert 0.75 < len(first[0]) / 3050 < 0.85


def test_split_by_key_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    train, test = split_by_key(df, "k", 100)
    assert (pairs(train), pairs(test)) == ([("a",)], [(None,)])


def test_stratified_sample(spark):
    df = spark.range(20_000).select((F.col("id") % 4).cast("string").alias("g"), "id")
    counts = dict(pairs(stratified_sample(df, "g", {"0": 0.4, "1": 1.0, "2": 0.0}, 42).groupBy("g").count()))
    assert counts["1"] == 5000 and 1800 < counts["0"] < 2200 and set(counts) == {"0", "1"}


# --- scores -----------------------------------------------------------------------------------------


def test_regression_scores_agree_with_the_evaluator(spark):
    df = spark.range(1000).select(
        (F.col("id") * 1.5 + F.sin("id") * 40).alias("y"), (F.col("id") * 1.4 + 3).alias("p")
    )
    ours = regression_metrics(df, "y", "p").first()
    for name in ("rmse", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert ours[name] == pytest.approx(theirs, rel=1e-10)
    assert residuals(df, "y", "p").columns == ["actual", "predicted", "residual"]


def test_classification_scores(spark):
    rows = [(0.0, 0.0)] * 50 + [(0.0, 1.0)] * 7 + [(1.0, 1.0)] * 30 + [(1.0, 0.0)] * 13
    df = spark.createDataFrame(rows, "y double, p double")
    assert sorted(pairs(confusion(df, "y", "p"))) == [(0.0, 57, 50, 7), (1.0, 43, 30, 13)]
    rates = confusion_rates(df, "y", "p", 1.0).first()
    assert (rates.true_positive, rates.false_negative) == (30, 13)
    assert (rates.true_negative, rates.false_positive) == (50, 7)
    assert rates.true_positive_rate == pytest.approx(100 * 30 / 43)
    assert rates.false_positive_rate == pytest.approx(100 * 7 / 57)
    evaluator = MulticlassClassificationEvaluator(
        labelCol="y", predictionCol="p", metricName="accuracy"
    )
    share = accuracy(df, "y", "p").first().accuracy
    assert share == pytest.approx(evaluator.evaluate(df) * 100) == pytest.approx(rates.accuracy)


def test_rates_per_group(spark):
    rows = [("m", 1.0, 1.0), ("m", 0.0, 1.0), ("k", 1.0, 0.0), ("k", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "model string, y double, p double")
    rates = {r.model: r for r in confusion_rates(df, "y", "p", 1.0, by=["model"]).collect()}
    assert rates["m"].true_positive_rate == 100.0 and rates["m"].true_negative_rate == 0.0
    assert rates["k"].true_positive_rate == 0.0 and rates["k"].accuracy == 50.0


def test_rates_of_a_class_without_members(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "y double, p double")
    rates = confusion_rates(df, "y", "p", 1.0).first()
    assert rates.true_positive_rate is None and rates.true_negative_rate == 100.0
