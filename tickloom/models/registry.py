"""Saving, loading and applying fitted models of any kind."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.models.boosting import TREES, BoostedTrees
from tickloom.models.classifiers import check_features, score
from tickloom.models.logistic import LOGISTIC, LogisticModel
from tickloom.models.zscore import MODEL_TYPE, ZScoreModel
from tickloom.schemas import FEATURES

AUTO = "auto"


def save_model(model, path: str, spark: SparkSession, model_type: str | None = None) -> None:
    """Write the model and a one-row table naming its kind and holding its settings."""
    if isinstance(model, ZScoreModel):
        model._fitted
        model.params(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
        return
    if model_type not in (LOGISTIC, TREES):
        raise ValueError(f"unknown model type {model_type!r}")
    model.save(path, spark)


def load_model(path: str, spark: SparkSession, model_type: str = AUTO):
    """(model, model type). ``model_type`` other than auto must match what was saved."""
    try:
        params = spark.read.parquet(f"{path}/params").first()
    except Exception as error:
        raise ValueError(f"no model at {path}") from error
    kind = params["model_type"]
    if model_type not in (AUTO, kind):
        raise ValueError(f"{path} holds {kind}, not {model_type}")
    if kind == MODEL_TYPE:
        return ZScoreModel(params["feature"], params["threshold"], params["mean"], params["std"]), kind
    if kind == LOGISTIC:
        return LogisticModel.load(params), kind
    if kind == TREES:
        return BoostedTrees.load(path, params, spark), kind
    raise ValueError(f"unknown model type {kind!r}")


def predict(model, df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Add ``predicted_label`` and ``spike_probability`` with any model."""
    check_features(df, features)
    if isinstance(model, ZScoreModel):
        return model.transform(df)
    return score(model, df)


def prediction_counts(predictions: DataFrame) -> DataFrame:
    """One row: rows, predicted spikes and their percentage."""
    n, spikes = F.count(F.lit(1)), F.count_if(F.col("predicted_label") == 1)
    return predictions.agg(
        n.alias("n_rows"),
        spikes.alias("predicted_spikes"),
        (spikes * 100.0 / F.nullif(n, F.lit(0))).alias("spike_pct"),
    )
