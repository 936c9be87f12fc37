"""Label, split, fit and evaluate the three models."""

from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.models.classifiers import LOGISTIC, TREES, fit_logistic, fit_trees, importance
from tickloom.models.registry import predict, save_model
from tickloom.models.zscore import MODEL_TYPE, fit_zscore
from tickloom.operators.evaluate import evaluate, metrics_long
from tickloom.operators.labels import TRAIN_SHARES, TRAINING_THRESHOLD, label_next_row, prepare_training_rows, split_by_position
from tickloom.schemas import FEATURES, IMPORTANCE
from tickloom.session import stored
from tickloom.sources.sinks import write_importance, write_metrics, write_table


@dataclass
class Trained:
    models: dict
    metrics: DataFrame
    importance: DataFrame
    rows: DataFrame
    paths: dict = field(default_factory=dict)


def training_rows(
    features: DataFrame, threshold: float = TRAINING_THRESHOLD, shares: dict[str, float] = TRAIN_SHARES
) -> DataFrame:
    """Labelled, complete rows with their split; stored, as every fit scans them again.

    Time and pair stay in the table; models only see the feature columns.
    """
    labelled = label_next_row(features, threshold)
    complete = prepare_training_rows(labelled, drop=["raw_price", "window_size", "window_duration"])
    return stored(split_by_position(stored(complete, "labelled"), shares), "training")


def fit_all(rows: DataFrame, kinds: list[str] = [MODEL_TYPE, LOGISTIC, TREES], rounds: int = 100) -> dict:
    train = rows.where(F.col("split") == "train")
    fitters = {
        MODEL_TYPE: fit_zscore,
        LOGISTIC: fit_logistic,
        TREES: lambda df: fit_trees(df, rounds=rounds),
    }
    return {kind: fitters[kind](train) for kind in kinds}


def predictions(models: dict, rows: DataFrame) -> DataFrame:
    """(model, split, label, predicted_label, spike_probability) for every model and row."""
    parts = None
    for name, model in models.items():
        part = predict(model, rows).select(
            F.lit(name).alias("model"), "split", "label", "predicted_label", "spike_probability"
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def train(
    spark: SparkSession,
    features: DataFrame,
    folder: str | None = None,
    threshold: float = TRAINING_THRESHOLD,
    kinds: list[str] = [MODEL_TYPE, LOGISTIC, TREES],
    rounds: int = 100,
) -> Trained:
    """Fit on the training split, evaluate on all three; with a folder, save everything."""
    rows = training_rows(features, threshold)
    models = fit_all(rows, kinds, rounds)
    metrics = stored(metrics_long(evaluate(stored(predictions(models, rows), "predictions"))), "metrics")
    weights = spark.createDataFrame([], IMPORTANCE)
    for name, model in models.items():
        if name != MODEL_TYPE:
            weights = weights.unionByName(importance(model, name, spark))
    result = Trained(models, metrics, weights, rows)
    if folder:
        for name, model in models.items():
            result.paths[name] = f"{folder}/{name}"
            save_model(model, result.paths[name], spark, name)
        write_metrics(metrics, folder)
        write_importance(weights, folder)
        for split in ("train", "test"):
            write_table(rows.where(F.col("split") == split).drop("split"), f"{folder}/{split}_data")
        log_run(metrics, run_params(models, threshold), f"{folder}/runs")
    return result


def run_params(models: dict, threshold: float) -> dict[str, dict[str, str]]:
    """What each model was fitted with, as text, read from the model itself."""
    common = {"threshold_tau": repr(threshold), "features": ",".join(FEATURES), "n_features": str(len(FEATURES))}
    params = {}
    for name, model in models.items():
        if name in (LOGISTIC, TREES):
            own = model.logged()
        else:
            own = {
                "threshold": repr(model.threshold), "feature_name": model.feature,
                "mean": repr(model.mean), "std": repr(model.std),
            }
        params[name] = {**common, "model_type": name, **own}
    return params


def log_run(metrics: DataFrame, params: dict[str, dict[str, str]], path: str, run_id: str | None = None) -> str:
    """Append parameters and metrics of one run to the runs table."""
    spark = metrics.sparkSession
    run_id = run_id or uuid4().hex
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(m, "param", None, k, v, None) for m, kv in params.items() for k, v in kv.items()]
    given = spark.createDataFrame(
        rows, "model string, kind string, split string, name string, text string, value double"
    )
    measured = metrics.select(
        "model", F.lit("metric").alias("kind"), "split", F.col("metric").alias("name"),
        F.lit(None).cast("string").alias("text"), "value",
    )
    stamped = given.unionByName(measured).select(
        F.lit(run_id).alias("run_id"), F.lit(started).alias("logged_at"), "*"
    )
    stamped.coalesce(1).write.mode("append").parquet(path)
    return run_id
