"""Loan outcome: preparation and three classifiers compared on the same split."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepmill.functions import keep_or_replace, percent_to_double, to_double
from prepmill.operators import (
    FEATURES,
    complete_rows,
    confusion_rates,
    decision_tree,
    feature_pipeline,
    label_texts,
    min_max,
    partitions_for,
    perceptron,
    random_forest,
    scaled,
    spread,
    stored_random_split,
)
from prepmill.operators.features import indexed

# Columns and values of the loan table.
LABEL = "loan_status"
PAID, CHARGED_OFF = "Fully Paid", "Charged Off"
EXCLUDED_PURPOSE = "wedding"
NO_EMPLOYMENT, NO_EMPLOYMENT_TEXT = "n/a", "NotEmployed"
TEXTS = [
    "emp_length",
    "grade",
    "home_ownership",
    "loan_status",
    "purpose",
    "term",
    "verification_status",
]
RATE = "int_rate"
NUMBERS = [
    "annual_inc",
    "bc_util",
    "chargeoff_within_12_mths",
    "collections_12_mths_ex_med",
    "delinq_2yrs",
    "dti",
    "il_util",
    "inq_fi",
    "inq_last_12m",
    "inq_last_6mths",
    "installment",
    "last_pymnt_amnt",
    "loan_amnt",
    "mort_acc",
    "num_actv_bc_tl",
    "num_actv_rev_tl",
    "num_il_tl",
    "num_tl_90g_dpd_24m",
    "open_rv_24m",
    "out_prncp",
    "out_prncp_inv",
    "pub_rec",
    "pub_rec_bankruptcies",
    "revol_bal",
    "tot_cur_bal",
    "total_acc",
    "total_bal_ex_mort",
    "total_bal_il",
    "total_pymnt",
    "total_pymnt_inv",
    "total_rev_hi_lim",
]
SCALED = [
    "annual_inc",
    "revol_bal",
    "tot_cur_bal",
    "total_bal_ex_mort",
    "total_bal_il",
    "total_rev_hi_lim",
]
FEATURE_NUMBERS = ["annual_inc", "installment", "loan_amnt", "total_pymnt"]
FEATURE_TEXTS = ["grade", "home_ownership", "emp_length", "purpose", "verification_status"]



def prepare_loans(loans: DataFrame, partitions: int | None = None) -> DataFrame:
    """Closed loans with every selected column present, cleaned, cast and scaled.

    Text that is no number becomes null here and stays in the table. ``partitions`` spreads the
    rows evenly before the clean-up; by default the layout of the scan is kept.
    """
    closed = loans.filter(F.col(LABEL).isin(PAID, CHARGED_OFF))
    present = complete_rows(closed.select(*TEXTS, RATE, *NUMBERS))
    kept = present.filter(F.col("purpose") != EXCLUDED_PURPOSE)
    if partitions is not None:
        kept = kept.repartition(partitions)
    clean = kept.withColumns(
        {
            "emp_length": keep_or_replace("emp_length", NO_EMPLOYMENT, NO_EMPLOYMENT_TEXT),
            RATE: percent_to_double(RATE),
            **{name: to_double(kept.schema[name]) for name in NUMBERS},
        }
    )
    return min_max(clean, SCALED)


def compare_classifiers(
    prepared: DataFrame,
    weights: tuple[float, float] = (0.6, 0.4),
    seed: int = 13,  # fixed value, as are the weights
    invalid: str = "keep",
    partitions: int | None = None,
    scale: bool = True,
) -> DataFrame:
    """One row per classifier (tree, forest, perceptron) with its counts, rates and accuracy.

    Only the columns the models use are stored, next to a flag for rows without any null; rows
    with nulls elsewhere may train but are not scored. Features are fitted once and shared by the
    three models, which score the held-out rows side by side, in one scan and one aggregate.
    Training runs on ``partitions`` partitions, by default as many as the stored size asks for. With
    ``scale`` every feature is divided by its largest size in training, for the perceptron; trees
    split alike either way.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in prepared.columns])
    used = prepared.select(
        LABEL, *FEATURE_TEXTS, *FEATURE_NUMBERS, complete.alias("complete")
    )
    train, test = stored_random_split(used, weights, seed, "loans")
    train = complete_rows(train)
    pipeline = feature_pipeline(
        FEATURE_NUMBERS, encode=FEATURE_TEXTS, label=LABEL, invalid=invalid
    )
    features = pipeline.fit(train)
    if scale:
        features = scaled(features, train)
    charged_off = float(label_texts(features, LABEL).index(CHARGED_OFF))
    trained = features.transform(train).select(FEATURES, indexed(LABEL))
    vectors = spread(trained, partitions or partitions_for(train))
    vectors.persist(StorageLevel.DISK_ONLY)  # each trainer keeps a form of its own in memory
    label = indexed(LABEL)
    models = {
        "decision_tree": decision_tree(label).fit(vectors),
        "random_forest": random_forest(label).fit(vectors),
        "perceptron": perceptron(label, vectors).fit(vectors),
    }
    vectors.unpersist()
    scored = features.transform(test.filter("complete")).select(FEATURES, label)
    for name, model in models.items():
        # only the predicted class is needed, under a name of its own
        model.setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("")
        scored = model.transform(scored)
    predictions = F.array(
        *[F.struct(F.lit(name).alias("model"), F.col(name).alias("prediction")) for name in models]
    )
    by_model = scored.select(label, F.inline(predictions))
    return confusion_rates(by_model, label, "prediction", charged_off, by=["model"])
