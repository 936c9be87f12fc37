"""Drift and quality reports on two tables, as one long table per report."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.models.classifiers import available_columns
from tickloom.operators.drift import CURRENT, REFERENCE, both_sides, dataset_drift, densities, drift_by_column
from tickloom.operators.evaluate import compare_models, verdict
from tickloom.operators.labels import split_early_late
from tickloom.operators.quality import column_summary, dataset_summary, missing_kinds, missing_overview, uniques
from tickloom.schemas import FEATURES
from tickloom.session import stored
from tickloom.sources.raw import read_metrics
from tickloom.sources.sinks import write_table

DRIFT, QUALITY = "drift", "quality"


def _rows(df: DataFrame, section: str, metrics: dict, side: Column | None = None, column: Column | None = None) -> DataFrame:
    """One output row per metric; a metric is a number or a (number, text) pair."""
    text = lambda x: F.lit(None).cast("string") if x is None else x
    items = []
    for name, given in metrics.items():
        value, words = given if isinstance(given, tuple) else (given, None)
        items.append(
            F.struct(
                F.lit(name).alias("metric"),
                value.cast("double").alias("value"),
                text(words).alias("text"),
            )
        )
    return df.select(
        F.lit(section).alias("section"),
        text(side).alias("side"),
        text(column).alias("column_name"),
        F.inline(F.array(*items)),
    )


def drift_report(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """(section, side, column_name, metric, value, text): tests, verdict, densities."""
    by_column = stored(drift_by_column(reference, current, columns), "drift")
    name, col = F.col("column_name"), F.col
    tests = {"score": (col("score"), col("test")), "threshold": col("threshold"), "drift": col("drift").cast("int")}
    whole = {m: col(m) for m in ("n_columns", "n_drifted", "share")}
    whole["dataset_drift"] = col("dataset_drift").cast("int")
    bars = densities(reference, current, columns)
    shape = {"bin_start": (col("bin_start"), col("bin").cast("string")), "density": (col("density"), col("bin").cast("string"))}
    return _union(
        [
            _rows(by_column, "drift_by_column", tests, None, name),
            _rows(dataset_drift(by_column), "dataset_drift", whole),
            _rows(bars, "density", shape, col("side"), name),
        ]
    )


def quality_report(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """The same layout: dataset summary, column summaries, uniques and missing values."""
    sides = both_sides(reference, current, columns)
    facts = stored(uniques(sides), "uniques")
    side, name, col = F.col("side"), F.col("column_name"), F.col
    summary = column_summary(sides, facts)
    words = ["column_type", "most_common"]
    stats = {c: col(c) for c in summary.columns if c not in ("side", "column_name", *words)}
    stats |= {w: (F.lit(None), col(w)) for w in words}
    found = {"n_unique": col("n_unique"), "n_missing": col("n_missing")}
    plain = lambda df, section, metric, column=None: df.select(
        F.lit(section).alias("section"), "side",
        (F.lit(None).cast("string") if column is None else column).alias("column_name"),
        col(metric).alias("metric"), col("value").cast("double").alias("value"),
        F.lit(None).cast("string").alias("text"),
    )
    return _union(
        [
            plain(dataset_summary(sides, facts), "dataset_summary", "metric"),
            _rows(facts, "uniques_and_nans_by_column", found, side, name),
            _rows(summary, "column_summary", stats, side, name).where("value is not null or text is not null"),
            plain(missing_kinds(sides).withColumnRenamed("n", "value"), "missing_by_kind", "kind", name),
            plain(missing_overview(sides), "missing_values", "metric"),
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def combined_report(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    return drift_report(reference, current, columns).unionByName(quality_report(reference, current, columns))


def early_late_report(features: DataFrame, ratio: float = 0.5, columns: list[str] = FEATURES) -> DataFrame:
    """The first part of the table in time against the rest, on the features present."""
    wanted = [c for c in available_columns(columns, features) if c in columns]
    kept = dict.fromkeys(["ts_us", "seq", *wanted])
    # The split is a comparison with one row, which is cheaper than storing it.
    split = split_early_late(stored(features.select(*kept), "features"), ratio)
    side = lambda name: split.where(F.col("split") == name)
    return combined_report(side(REFERENCE), side(CURRENT), wanted)


def train_test_report(train: DataFrame, test: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Training against test rows, on shared features and the label if both have it."""
    return combined_report(train, test, available_columns(columns, train, test))


def model_report(spark: SparkSession, folder: str, baseline: str, challenger: str) -> tuple[DataFrame, DataFrame]:
    """(comparison, verdict) from saved metrics."""
    metrics, absent = read_metrics(spark, folder, [baseline, challenger])
    if absent:
        raise ValueError(f"no metrics for {absent} under {folder}")
    return compare_models(metrics), verdict(metrics, baseline, challenger)


def save_report(report: DataFrame, path: str) -> None:
    write_table(stored(report, "report").coalesce(1), path)
