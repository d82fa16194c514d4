"""Table operators: each takes a DataFrame and returns one, built from native Spark expressions."""

from prepmill.operators.aggregate import average_and_sum, letter_count
from prepmill.operators.dictionary import dictionary, index_by_dictionary, ranked
from prepmill.operators.evaluate import (
    accuracy,
    confusion,
    confusion_rates,
    regression_metrics,
    residuals,
)
from prepmill.operators.features import (
    FEATURES,
    assemble,
    feature_pipeline,
    one_hot,
    string_index,
    vector_columns,
    vector_width,
)
from prepmill.operators.models import (
    chain,
    decision_tree,
    decode_prediction,
    label_texts,
    linear_regression,
    load_model,
    partitions_for,
    perceptron,
    random_forest,
    save_model,
    scaled,
    spread,
)
from prepmill.operators.nulls import (
    complete_rows,
    impute_group_median,
    null_counts,
    rows_with_null,
)
from prepmill.operators.prepare import cast_to_double, min_max
from prepmill.operators.profile import box_plot, correlation, profile, reconcile
from prepmill.operators.quantiles import exact_quantiles, group_median
from prepmill.operators.split import (
    random_split,
    split_by_key,
    stored_random_split,
    stratified_sample,
)

__all__ = [
    "FEATURES",
    "accuracy",
    "assemble",
    "average_and_sum",
    "box_plot",
    "cast_to_double",
    "chain",
    "complete_rows",
    "confusion",
    "confusion_rates",
    "correlation",
    "decision_tree",
    "decode_prediction",
    "dictionary",
    "exact_quantiles",
    "feature_pipeline",
    "group_median",
    "impute_group_median",
    "index_by_dictionary",
    "label_texts",
    "letter_count",
    "linear_regression",
    "load_model",
    "min_max",
    "null_counts",
    "one_hot",
    "partitions_for",
    "perceptron",
    "profile",
    "random_forest",
    "random_split",
    "ranked",
    "reconcile",
    "regression_metrics",
    "residuals",
    "rows_with_null",
    "save_model",
    "scaled",
    "split_by_key",
    "spread",
    "stored_random_split",
    "stratified_sample",
    "string_index",
    "vector_columns",
    "vector_width",
]
