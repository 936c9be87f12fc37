"""Rules that call for a new training run, looked at while scored rows stream in.

Every micro-batch is summed up into a few small rows: how many positives, negatives and called spikes each
range of scores holds, and a sketch of each feature. They are kept as one folder per batch, which
appears at once and is never written twice, so a repeated batch counts once. The rules read only these: the
curve from the ranges of scores, the spike rate from the counts, drift from merged sketches against the
reference's. With scores cut into ``bins`` ranges PR-AUC is that of scores rounded down to a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.drift import DISTANCE_LIMIT, DRIFT_SHARE, SMALLEST_SCALE
from tickloom.operators.evaluate import curve_areas, retrain_triggers, score_curve
from tickloom.operators.sketches import K, merge_range, range_drift, sketch_rows
from tickloom.session import stored
from tickloom.sources.delivery import deliver_stream, renamed_table

BINS = 1000
FOREVER = 10**12  # seconds of one bucket of sketches, where time does not matter


def score_histogram(rows: DataFrame, bins: int = BINS, label: str = "label", predicted: str = "predicted_label", score: str = "spike_probability") -> DataFrame:
    """(bin, pos, neg, called): labelled rows by ranges of their score."""
    bin_ = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return rows.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(bin_.alias("bin")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(predicted) == 1).alias("called")
    )


def feature_sketches(rows: DataFrame, features: list[str], k: int = K) -> DataFrame:
    return sketch_rows(rows.withColumn("_now", F.lit(0).cast("long")), features, FOREVER, "_now", k)


def reference_figures(reference: DataFrame, features: list[str], k: int = K) -> DataFrame:
    """Sketch and standard deviation of each feature of the rows a model was trained on; store it with the model."""
    merged = merge_range(feature_sketches(reference, features, k), k=k)
    scales = reference.agg(*[F.stddev_pop(F.when(F.abs(F.col(f).cast("double")) < float("inf"), F.col(f).cast("double"))).alias(f) for f in features])
    return merged.join(scales.unpivot([], features, "column_name", "scale"), "column_name")


def triggers(histogram: DataFrame, sketches: DataFrame, reference: DataFrame, bins: int = BINS, k: int = K) -> DataFrame:
    """The rules over summed-up rows: rule, value, threshold and whether it fires."""
    total = histogram.groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "called")])
    held = stored(total.withColumn("spike_probability", F.col("bin") / F.lit(float(bins))), "scores")
    areas = curve_areas(score_curve(held, counts={"pos": F.col("pos"), "neg": F.col("neg")}))
    metrics = areas.select(F.lit("live").alias("model"), F.lit("test").alias("split"), F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value"))
    rows = F.sum("pos") + F.sum("neg")
    spikes = held.agg((F.sum("called") * 100.0 / F.nullif(rows, F.lit(0))).alias("spike_pct"))
    gaps = range_drift(reference, merge_range(sketches, k=k), k=k).join(reference.select("column_name", "scale"), "column_name")
    share = F.avg((F.col("area") / F.greatest("scale", F.lit(SMALLEST_SCALE)) >= DISTANCE_LIMIT).cast("double"))
    drift = gaps.agg((share >= DRIFT_SHARE).alias("dataset_drift"))
    return retrain_triggers(metrics, spikes, drift, "live")


def current_triggers(spark: SparkSession, folder: str, reference: DataFrame, bins: int = BINS, k: int = K) -> DataFrame:
    """The rules over all batches so far."""
    return triggers(spark.read.parquet(f"{folder}/scores"), spark.read.parquet(f"{folder}/sketches"), reference, bins, k)


def watch_stream(
    scored: DataFrame, reference: DataFrame, features: list[str], folder: str, checkpoint: str, once: bool = False, bins: int = BINS, k: int = K,
) -> StreamingQuery:
    """Sum up each micro-batch of scored, labelled rows and write the rules as they then stand to
    ``<folder>/triggers``, one folder per batch."""
    scores, sketches, fired = (renamed_table(f"{folder}/{name}") for name in ("scores", "sketches", "triggers"))
    spark = scored.sparkSession
    targets = {
        "scores": lambda rows, batch: scores(score_histogram(rows, bins), batch),
        "sketches": lambda rows, batch: sketches(feature_sketches(rows, features, k), batch),
        "triggers": lambda rows, batch: fired(current_triggers(spark, folder, reference, bins, k), batch),
    }
    return deliver_stream(scored, targets, f"{folder}/_ledger", checkpoint, once)
