"""Score a stored table and check that it was done in time."""

import time

from pyspark.sql import DataFrame, SparkSession

from tickloom.models.registry import AUTO, load_model, predict, prediction_counts
from tickloom.schemas import DEFAULT_WINDOW_SECONDS
from tickloom.session import fresh_path
from tickloom.sources.sinks import write_table

# Fixed value: scoring may take this many windows.
WINDOWS_ALLOWED = 2


def latency_check(spark: SparkSession, seconds: float, window_seconds: float = DEFAULT_WINDOW_SECONDS) -> DataFrame:
    allowed = WINDOWS_ALLOWED * window_seconds
    row = (float(seconds), float(window_seconds), float(allowed), "PASS" if seconds < allowed else "FAIL")
    return spark.createDataFrame(
        [row], "seconds double, window_seconds double, allowed_seconds double, status string"
    )


def score_table(
    spark: SparkSession, model_path: str, data_path: str, output_path: str | None = None, model_type: str = AUTO
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(predictions, spike counts, latency). The time covers reading, scoring and writing."""
    model, _ = load_model(model_path, spark, model_type)
    output = output_path or fresh_path(spark, "predictions")
    start = time.monotonic()
    write_table(predict(model, spark.read.parquet(data_path)), output)
    seconds = time.monotonic() - start
    scored = spark.read.parquet(output)
    return scored, prediction_counts(scored), latency_check(spark, seconds)
