"""Fitting the classifiers on the feature columns."""

from pyspark.sql import DataFrame, functions as F

from tickloom.models.boosting import TREES, BoostedTrees, boost
from tickloom.models.logistic import LOGISTIC, LogisticModel, any_missing, newton_fit
from tickloom.schemas import FEATURES, IMPORTANCE


def check_features(df: DataFrame, features: list[str]) -> None:
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing features: {absent}")


def available_columns(columns: list[str], *tables: DataFrame) -> list[str]:
    """The wanted columns all tables have, plus ``label`` when they all have it."""
    shared = [c for c in columns if all(c in t.columns for t in tables)]
    if not shared:
        raise ValueError(f"none of {columns} is present in every table")
    if "label" not in shared and all("label" in t.columns for t in tables):
        shared.append("label")
    return shared


def class_counts(df: DataFrame, label: str = "label", complete: list[str] | tuple = ()) -> tuple[int, int]:
    """Negatives and positives; the ``complete`` columns must have a value in every row."""
    count = [F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1), F.count_if(any_missing(list(complete)))]
    negatives, positives, lacking = df.agg(*count).first()
    if not negatives or not positives:
        raise ValueError(f"both classes are needed: {negatives} negatives, {positives} positives")
    if lacking:
        raise ValueError(f"a feature is missing in {lacking} rows")
    return negatives, positives


def fit_logistic(df: DataFrame, features: list[str] = FEATURES, label: str = "label", max_iter: int = 1000) -> LogisticModel:
    """Balanced class weights, L2 penalty of strength 1 against the sum of the losses, unscaled
    features."""
    check_features(df, features)
    negatives, positives = class_counts(df, label, features)
    n = negatives + positives
    weight = F.when(F.col(label) == 1, n / (2.0 * positives)).otherwise(n / (2.0 * negatives))
    return newton_fit(df, features, label, weight, 1.0, max_iter)


def fit_trees(
    df: DataFrame, features: list[str] = FEATURES, label: str = "label",
    depth: int = 5, rounds: int = 100, rate: float = 0.1,
) -> BoostedTrees:
    """Boosted trees; positives weigh as much in total as negatives."""
    check_features(df, features)
    negatives, positives = class_counts(df, label)
    return boost(df, features, label, negatives / positives, depth, rounds, rate)


def score(model: LogisticModel | BoostedTrees, df: DataFrame) -> DataFrame:
    """All input columns plus ``predicted_label`` and ``spike_probability``, in one pass."""
    check_features(df, model.features)
    return model.transform(df)


def importance(model: LogisticModel | BoostedTrees, name: str, spark) -> DataFrame:
    """(model, feature, value): coefficients by size, or shares of the split gains, largest first."""
    rows = [(name, feature, float(value)) for feature, value in model.importance()]
    return spark.createDataFrame(rows, IMPORTANCE).orderBy(F.abs("value").desc(), "feature")
