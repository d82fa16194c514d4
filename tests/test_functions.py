"""Column expressions against their definition in plain Python."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prepmill.functions import (
    Bin,
    before_dash,
    bin_by,
    decode_two_way,
    keep_or_replace,
    percent_to_double,
    strip_trailing_percent,
    text_to_double,
    time_of_day,
    words_to_double,
)

ONE_SESSION = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
SPECIAL = ["NA", "n/a", "", " ", "7", " 7 ", "-2.5", "+1e3", ".5", "1.", "NaN", "Infinity",
           "-Infinity", "inf", "nope", "N", "10+ years", "1-URGENT", "1,5", "--1", None]


def column(spark, values, data_type="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {data_type}")


def values(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def expected_period(x):
    if x is None:
        return None
    for low, high, label in (
        (0, 600, "00.01-05.59"),
        (600, 1200, "06.00-11.59"),
        (1200, 1800, "12.00-17.59"),
        (1800, 2400, "18.00-24.00"),
    ):
        strict = low == 0
        if (low < x < high) if strict else (low <= x <= high):
            return label
    return "NA"


def test_time_of_day_at_the_edges(spark):
    edges = [None, 0.0, 1.0, 599.0, 599.5, 600.0, 1199.0, 1200.0, 1201.0, 1800.0, 1801.0, 2400.0,
             2401.0, -5.0, float("nan")]
    found = values(column(spark, edges, "double"), time_of_day(F.col("x")))
    assert found == [None, "NA", "00.01-05.59", "00.01-05.59", "00.01-05.59", "06.00-11.59",
                     "06.00-11.59", "06.00-11.59", "12.00-17.59", "12.00-17.59", "18.00-24.00",
                     "18.00-24.00", "NA", "NA", "NA"]


@ONE_SESSION
@given(st.lists(st.one_of(st.none(), st.floats(-100, 3000)), min_size=1, max_size=200))
def test_time_of_day_everywhere(spark, numbers):
    found = values(column(spark, numbers, "double"), time_of_day(F.col("x")))
    assert found == [expected_period(x) for x in numbers]


def test_bins_match_in_order(spark):
    bins = [Bin("low", 0, 10), Bin("high", 10, 20, open_high=True)]
    found = values(column(spark, [0, 10, 19, 20, None], "int"), bin_by(F.col("x"), bins, "none"))
    assert found == ["low", "low", "high", "none", None]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_both_casts_agree_with_the_plain_tolerant_cast(spark):
    df = column(spark, SPECIAL)
    plain = values(df, F.col("x").try_cast("double"))
    assert all(map(same, values(df, text_to_double(F.col("x"))), plain))
    assert all(map(same, values(df, words_to_double(F.col("x"))), plain))
    assert plain[SPECIAL.index("NA")] is None and plain[SPECIAL.index(" 7 ")] == 7.0


@ONE_SESSION
@given(st.lists(st.text(alphabet="0123456789+-.eEnaNifIty /:", max_size=9), min_size=1, max_size=200))
def test_casts_agree_on_any_text(spark, texts):
    df = column(spark, texts)
    plain = values(df, F.col("x").try_cast("double"))
    assert all(map(same, values(df, text_to_double(F.col("x"))), plain))
    assert all(map(same, values(df, words_to_double(F.col("x"))), plain))


@ONE_SESSION
@given(st.lists(st.text(alphabet="13.5%-x ", max_size=8), min_size=1, max_size=200))
def test_text_clean_up_like_python(spark, texts):
    df = column(spark, texts)
    assert values(df, strip_trailing_percent("x")) == [t.rstrip("%") for t in texts]
    assert values(df, before_dash("x")) == [t.split("-")[0] for t in texts]


def test_percent(spark):
    df = column(spark, ["13.5%", "13.5%%", "7", "%", None, "x%"])
    assert values(df, percent_to_double("x")) == [13.5, 13.5, 7.0, None, None, None]


def test_replacement_keeps_everything_else(spark):
    df = column(spark, ["n/a", "5 years", None])
    assert values(df, keep_or_replace("x", "n/a", "NotEmployed")) == ["NotEmployed", "5 years", None]


def test_one_tree_becomes_another(trees):
    found = values(trees, keep_or_replace("tree", "yew", "ash"))
    assert found == ["oak", "birch", "pine", "ash", "elm", "larch"]


def test_two_way_decoding(spark):
    df = column(spark, [0.0, 1.0, 2.0], "double")
    assert values(df, decode_two_way("x", "paid", "lost")) == ["paid", "lost", "lost"]
