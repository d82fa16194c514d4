"""Whole jobs, sources and sinks on small made tables."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from prepmill.operators import chain, decode_prediction, feature_pipeline, group_median, label_texts, load_model
from prepmill.operators.features import FEATURES, indexed, vector_width
from prepmill.operators.models import decision_tree, perceptron, spread
from prepmill.plans import (
    compare_classifiers,
    explore,
    ingest,
    ingest_and_train,
    load_and_reconcile,
    prepare_flights,
    prepare_loans,
    train_delay,
)
from prepmill.plans.flights import score_delay
from prepmill.plans.loans import NUMBERS, TEXTS
from prepmill.sources import (
    JdbcTable,
    jdbc,
    materialize,
    read_csv_inferred,
    read_csv_strict,
    read_parquet,
    read_table,
    scratch_path,
    working_storage,
    write_csv,
    write_parquet,
    write_table,
)


def pairs(df):
    return [tuple(row) for row in df.collect()]


@pytest.fixture
def database():
    """A database in the memory of this process."""
    name = f"t{uuid.uuid4().hex[:12]}"
    return JdbcTable(
        f"jdbc:derby:memory:{name};create=true",
        name,
        password="secret",
        user="someone",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


# --- files ------------------------------------------------------------------------------------------


def test_malformed_rows_are_dropped_for_every_query(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    df = read_csv_strict(spark, str(path))
    assert pairs(df) == [("1", "2", "3"), ("10", "11", "12")]
    assert df.count() == 2 and df.select("a").count() == 2
    assert {t for _, t in df.dtypes} == {"string"}


def test_csv_types_are_inferred(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("n,x,t\n1,0.5,NA\n2,1.5,7\n")
    assert read_csv_inferred(spark, str(path)).dtypes == [("n", "int"), ("x", "double"), ("t", "string")]


def test_writes_replace(spark, trees, tmp_path):
    path = str(tmp_path / "p")
    write_parquet(trees, path)
    write_parquet(trees.limit(2), path)
    assert read_parquet(spark, path).count() == 2
    path = str(tmp_path / "c")
    write_csv(trees, path)
    write_csv(trees, path)
    back = spark.read.schema(trees.schema).csv(path)
    assert sorted(pairs(back)) == sorted(pairs(trees))


def files_below(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(system.listStatus(path)) if system.exists(path) else 0


def test_working_storage_goes_with_its_owner(spark, trees, loans):
    with working_storage(spark) as folder:
        rows = compare_classifiers(prepare_loans(loans)).collect()
        with working_storage(spark) as inner:
            assert inner != folder and group_median(trees, ["tree"], "height", exact=True).count() == 6
            assert files_below(spark, inner) > 0
        assert files_below(spark, inner) == 0
        assert files_below(spark, folder) > 0 and len(rows) == 3
    assert files_below(spark, folder) == 0
    with pytest.raises(RuntimeError), working_storage(spark) as folder:
        materialize(trees, "trees")
        raise RuntimeError
    assert files_below(spark, folder) == 0


def test_working_storage_lies_in_the_checkpoint_folder(spark, trees):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    stored = materialize(trees, "trees")
    assert sorted(pairs(stored)) == sorted(pairs(trees))
    assert all(root in f for f in stored.inputFiles())


# --- databases ----------------------------------------------------------------------------------------


def test_password_is_not_shown(database):
    assert "secret" not in repr(database)


def test_database_round_trip_in_parts(spark, database):
    df = spark.range(1000).select(F.col("id"), (F.col("id") / 4).alias("x"), F.lit("a").alias("t"))
    write_table(df, database, "t VARCHAR(8)")
    write_table(df, database, "t VARCHAR(8)")
    whole = read_table(spark, database, one_task=True)
    parts = read_table(spark, database, partition_column="id", num_partitions=4)
    assert sorted(pairs(whole)) == sorted(pairs(parts)) == sorted(pairs(df))
    assert parts.rdd.getNumPartitions() == 4 and whole.rdd.getNumPartitions() == 1
    chosen = read_table(spark, database, predicates=['"id" < 10', '"id" >= 10'])
    assert chosen.count() == 1000 and chosen.rdd.getNumPartitions() == 2
    plan = parts.filter("x > 3")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,3.0)" in plan


def test_a_read_says_how_it_is_split(spark, database):
    with pytest.raises(ValueError, match="partition column"):
        read_table(spark, database)


def test_empty_database_table(spark, database):
    df = spark.range(0)
    write_table(df, database)
    assert read_table(spark, database, partition_column="id").count() == 0


def test_reads_follow_the_number_of_rows(spark, database):
    write_table(spark.range(1000).select("id", (F.col("id") / 8).alias("x")), database)
    for key in ("id", "x"):
        parts = read_table(spark, database, key, rows_per_task=300)
        assert parts.rdd.getNumPartitions() == 4 and parts.count() == 1000
    assert read_table(spark, database, "id").rdd.getNumPartitions() == 1


def test_hot_ranges_of_keys_are_split(spark, database):
    """Nine tenths of the keys lie in a hundredth of their range, some rows have no key, and one key has many rows."""
    near = "CASE WHEN id % 10 < 9 THEN id % 1000 ELSE id * 10 + 90000 END"
    keys = spark.range(10_000).selectExpr(f"CASE WHEN id % 100 = 3 THEN NULL WHEN id % 50 = 1 THEN 777 ELSE {near} END AS k", "id")
    for kind in ("bigint", "double", "decimal(20,2)"):
        df = keys.withColumn("k", F.col("k").cast(kind))
        write_table(df, database)
        parts = read_table(spark, database, "k", rows_per_task=500)
        assert sorted(pairs(parts), key=repr) == sorted(pairs(df), key=repr)
        sizes = [r.n for r in parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 15 and max(sizes) <= 1000
    strides = read_table(spark, database, "k", 20, bounds=(0, 200_000))
    assert max(r.n for r in strides.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) > 8000


def test_dates_make_equal_strides(spark, database):
    df = spark.range(300).selectExpr("date_add(DATE'2020-01-01', CAST(id AS INT)) AS d", "id")
    write_table(df, database)
    parts = read_table(spark, database, "d", rows_per_task=100)
    assert sorted(pairs(parts)) == sorted(pairs(df)) and parts.rdd.getNumPartitions() == 3


def test_rows_of_a_repeated_task_are_written_once(spark, database):
    """A task that failed after its rows were committed writes them again; equal rows of the table itself stay."""
    df = spark.range(0, 400, 1, 4).selectExpr("id % 100 AS k", "concat('t', id % 7) AS t")
    types = {"createTableColumnTypes": "t VARCHAR(8)"}
    stored = materialize(df, "outgoing")
    staging, fresh = (jdbc.replace(database, table=f"{database.table}_{x}") for x in ("rows", "new"))
    jdbc._stage(stored, staging, types)
    again = stored.filter((F.spark_partition_id() == 1) | (F.spark_partition_id() == 2))
    jdbc._stage(again, staging, types, "append")
    assert read_table(spark, staging, one_task=True).count() > 400
    jdbc._save(stored.limit(0), fresh, types)
    jdbc._publish(spark, df.columns, staging, fresh, database)
    assert sorted(pairs(read_table(spark, database, one_task=True))) == sorted(pairs(df))
    for gone in (staging, fresh):
        with pytest.raises(Exception, match="(?i)does not exist"):
            read_table(spark, gone, one_task=True)


def test_a_failed_write_leaves_the_old_table(spark, database):
    write_table(spark.range(5), database)
    with pytest.raises(Exception, match="(?i)divi"):
        write_table(spark.range(5).selectExpr("id", "1 / (id - 3) AS x"), database)
    assert read_table(spark, database, one_task=True).count() == 5


def test_a_key_without_values_splits_nothing(spark, database):
    write_table(spark.range(3).select("id", F.lit(None).cast("int").alias("k")), database)
    with pytest.raises(ValueError, match="null in every row"):
        read_table(spark, database, "k")
    with pytest.raises(ValueError, match="num_partitions"):
        read_table(spark, database, "id", bounds=(0, 2))


def test_ingest(spark, database, tmp_path):
    write_table(spark.range(100), database)
    stored = ingest(spark, database, str(tmp_path / "raw"), "id", 3)
    assert sorted(pairs(stored)) == [(i,) for i in range(100)]


def test_load_and_reconcile(spark, database, tmp_path):
    write_csv(spark.range(500).selectExpr("id", "id / 7 AS x", "concat('t', id) AS t"), str(tmp_path / "c"), header=True)
    compared = load_and_reconcile(spark, str(tmp_path / "c"), database, "id", 2, "t VARCHAR(16)")
    assert [r.matches for r in compared.collect()] == [True, True, True]


# --- flights ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def flights(spark):
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN 1 WHEN id % 501 = 1 THEN NULL ELSE 0 END AS Cancelled",
        "concat('C', id % 3) AS UniqueCarrier",
        "concat('P', id % 11) AS Origin",
        "concat('P', id % 13) AS Dest",
        "CASE WHEN id % 97 = 0 THEN 'NA' ELSE concat('', id % 2500) END AS DepTime",
        "concat('', id % 17) AS TaxiOut",
        "concat('', id % 5) AS TaxiIn",
        "concat('', id % 60 - 5) AS DepDelay",
        "CAST(id % 7 + 1 AS INT) AS DayOfWeek",
        "CAST(100 + id AS INT) AS Distance",
        "CASE WHEN id % 89 = 0 THEN 'NA' ELSE concat('', 2 * (id % 60) + id % 17) END AS ArrDelay",
    )
    return materialize(rows, "flights")


def test_prepared_flights(flights):
    prepared = prepare_flights(flights).cache()
    kept = flights.filter("Cancelled <> 1 AND DepTime <> 'NA' AND ArrDelay <> 'NA'").count()
    assert prepared.count() == kept == prepared.dropna().count()
    low, high = prepared.agg(F.min("Distance"), F.max("Distance")).first()
    assert 0 <= low < high <= 1
    assert {r[0] for r in prepared.select("DepTime").distinct().collect()} == {
        "00.01-05.59", "06.00-11.59", "12.00-17.59", "18.00-24.00", "NA"}
    assert prepared.agg(F.max("ArrDelay")).first()[0] > 1
    assert prepare_flights(flights, scale_label=True).agg(F.max("ArrDelay")).first()[0] <= 1


def test_filters_reach_the_scan(flights):
    plan = prepare_flights(flights)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(Cancelled)" in plan and "Not(EqualTo(Cancelled,1))" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_delay_model_learns_and_is_saved(spark, flights, tmp_path):
    model, scored = train_delay(flights, str(tmp_path / "model"))
    score = score_delay(scored).first()
    assert score.r2 > 0.99 and score.rmse < 3 and 400 < score.rows < 700
    again = load_model(str(tmp_path / "model")).transform(scored.drop(
        *[c for c in scored.columns if c.endswith(("_index", "_vector"))], FEATURES, "prediction"))
    assert sorted(r[0] for r in again.select("prediction").collect()) == pytest.approx(
        sorted(r[0] for r in scored.select("prediction").collect()))


def test_ingest_and_train(spark, flights, database, tmp_path):
    write_table(flights, database)
    _, scored = ingest_and_train(
        spark, database, str(tmp_path / "raw"), str(tmp_path / "model"), "Distance", 3)
    assert score_delay(scored).first().r2 > 0.99


def test_exploration(flights):
    found = explore(flights, "ArrDelay", "DepDelay", ["ArrDelay", "DepDelay"], ["UniqueCarrier"])
    for table in (found.profile, found.null_counts):  # both read what one scan has measured
        assert table.inputFiles() == found.profile.inputFiles() and not set(table.inputFiles()) & set(flights.inputFiles())
    assert found.base_table.count() == flights.filter("ArrDelay <> 'NA'").count()
    order = [r.ArrDelay for r in found.frequency.collect()]
    assert order == sorted(order, reverse=True) and order[0] == "NA"
    assert found.correlation.first().correlation > 0.9
    assert found.null_counts.first().Cancelled == flights.filter("Cancelled IS NULL").count()
    assert found.profile.count() == len(flights.columns)


# --- loans --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def loans(spark):
    numbers = {name: f"concat('', id * {i + 3} % 100)" for i, name in enumerate(NUMBERS)}
    numbers["total_pymnt"] = "concat('', id % 50)"
    numbers["dti"] = "CASE WHEN id % 400 = 3 THEN 'unknown' ELSE '5' END"
    numbers["bc_util"] = "CASE WHEN id % 50 = 7 THEN NULL ELSE '5' END"
    texts = {
        "loan_status": "CASE WHEN id % 7 = 0 THEN 'Current' WHEN id % 50 < 20 THEN 'Charged Off' "
        "ELSE 'Fully Paid' END",
        "purpose": "CASE WHEN id % 8 = 0 THEN 'wedding' ELSE 'car' END",
        "emp_length": "CASE WHEN id % 3 = 0 THEN 'n/a' ELSE '5 years' END",
        "grade": "substr('ABCDEFG', id % 7 + 1, 1)",
        "home_ownership": "'RENT'",
        "term": "' 36 months'",
        "verification_status": "'Verified'",
        "int_rate": "concat(id % 20, '.5%')",
    }
    columns = [f"{e} AS {n}" for n, e in {**texts, **numbers, "extra": "'unused'"}.items()]
    return materialize(spark.range(4000).selectExpr(*columns), "loans")


def test_prepared_loans(loans):
    prepared = prepare_loans(loans).cache()
    kept = "loan_status <> 'Current' AND purpose <> 'wedding' AND bc_util IS NOT NULL"
    assert prepared.count() == loans.filter(kept).count()
    assert sorted(prepared.columns) == sorted([*TEXTS, "int_rate", *NUMBERS])
    assert prepared.filter("dti IS NULL").count() == loans.filter(kept + " AND dti = 'unknown'").count()
    assert {r[0] for r in prepared.select("emp_length").distinct().collect()} == {"NotEmployed", "5 years"}
    assert prepared.agg(F.min("annual_inc"), F.max("annual_inc")).first() == (0.0, 1.0)
    assert prepared.agg(F.max("loan_amnt")).first()[0] > 1
    assert prepare_loans(loans, partitions=6).rdd.getNumPartitions() == 6


def test_classifiers_compared(loans):
    rows = {r.model: r for r in compare_classifiers(prepare_loans(loans)).collect()}
    assert set(rows) == {"decision_tree", "random_forest", "perceptron"}
    for row in rows.values():
        assert row.true_positive + row.false_negative == row.actual_positive > 0
        assert row.true_negative + row.false_positive == row.actual_negative > 0
    assert rows["decision_tree"].accuracy > 95
    assert len({(r.actual_positive, r.actual_negative) for r in rows.values()}) == 1


# --- features and models --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame(
        [(c, float(i), "yes" if c == "a" else "no") for i, c in enumerate("cbacbc" * 20)],
        "t string, x double, y string",
    )


def test_features_have_a_slot_for_unseen_text(spark, letters):
    fitted = feature_pipeline(["x"], encode=["t"], index_only=["t"][:0], label="y").fit(letters)
    vectors = fitted.transform(letters)
    assert vector_width(vectors) == 3 + 1 + 1
    unseen = spark.createDataFrame([("z", 1.0, "no"), (None, 1.0, "no")], letters.schema)
    assert [r[0].toArray().tolist() for r in fitted.transform(unseen).select(FEATURES).collect()] == [
        [0, 0, 0, 1, 1], [0, 0, 0, 1, 1]]


def test_unseen_text_can_be_an_error(spark, letters):
    fitted = feature_pipeline(["x"], encode=["t"], invalid="error").fit(letters)
    unseen = spark.createDataFrame([("z", 1.0, "no")], letters.schema)
    with pytest.raises(Exception) as error:
        fitted.transform(unseen).collect()
    assert isinstance(error.value, PySparkException) or "label" in str(error.value)


def test_labels_come_back_as_text(letters):
    features = feature_pipeline([], encode=["t"], label="y").fit(letters)
    vectors = spread(features.transform(letters), 8)
    model = chain(features, decision_tree(indexed("y")).fit(vectors))
    scored = decode_prediction(model.transform(letters), label_texts(model, "y"))
    assert scored.filter("predicted_label <> y").count() == 0
    network = perceptron(indexed("y"), vectors)
    assert network.getLayers() == [vector_width(vectors), 20, 10, 2]
