"""Classifier metrics from tables of labels, predictions and scores."""

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.ordering import running_totals
from tickloom.schemas import METRIC

# Metric names, in reporting order.
METRICS = [
    "accuracy", "f1_score", "precision", "recall", "pr_auc", "roc_auc",
    "true_negatives", "false_positives", "false_negatives", "true_positives",
]
COMPARED = ["pr_auc", "f1_score", "precision", "recall"]
TARGET_PR_AUC = 0.60


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, or 0.0 where bottom is zero."""
    return F.when(bottom == 0, 0.0).otherwise(top / F.nullif(bottom.cast("double"), F.lit(0.0)))


def confusion(
    df: DataFrame, keys: list[str] | tuple = (), label: str = "label", predicted: str = "predicted_label"
) -> DataFrame:
    """Counts of true/false negatives/positives per group, from one aggregation."""
    y, p = F.col(label), F.col(predicted)
    return df.groupBy(*keys).agg(
        F.count_if((y == 0) & (p == 0)).alias("true_negatives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((y == 1) & (p == 1)).alias("true_positives"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts. Where labels and
    predictions together hold one class only, the counts themselves become NULL."""
    tn, fp, fn, tp = (
        F.col(c) for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")
    )
    n = tn + fp + fn + tp
    both = (tn < n) & (tp < n)
    keys = [c for c in counts.columns if c not in METRICS]
    return counts.select(
        *keys,
        ratio(tp + tn, n).alias("accuracy"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        *[F.when(both, F.col(c)).alias(c) for c in METRICS[6:]],
    )


def score_curve(
    df: DataFrame,
    keys: list[str] | tuple = (),
    label: str = "label",
    score: str = "spike_probability",
    small_group: int | None = None,
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per distinct score, from the highest down: precision, recall and the
    false-positive rate when every row scoring at least that much is called a spike.

    ``counts`` says how many positives (``pos``) and negatives (``neg``) a row stands for, where
    rows have been counted before."""
    counts = counts or {"pos": (F.col(label) == 1).cast("long"), "neg": (F.col(label) == 0).cast("long")}
    slim = df.select(*keys, (-F.col(score)).alias("_down"), *[c.alias(n) for n, c in counts.items()])
    totals = running_totals(slim, "_down", {n: F.col(n) for n in counts}, keys, small_group)
    called = F.col("cum_pos") + F.col("cum_neg")
    called_before = called - F.col("pos") - F.col("neg")
    tp_before = F.col("cum_pos") - F.col("pos")
    no_pos = F.col("total_pos") == 0
    return totals.select(
        *keys,
        (-F.col("_down")).alias("threshold"),
        "pos",
        "neg",
        F.col("cum_pos").alias("true_positives"),
        F.col("cum_neg").alias("false_positives"),
        "total_pos",
        "total_neg",
        (F.col("cum_pos") / called).alias("precision"),
        F.when(no_pos, 1.0).otherwise(ratio(F.col("cum_pos"), F.col("total_pos"))).alias("recall"),
        ratio(F.col("cum_neg"), F.col("total_neg")).alias("false_positive_rate"),
        F.when(called_before == 0, 1.0)
        .otherwise(tp_before / F.nullif(called_before, F.lit(0)))
        .alias("precision_before"),
        tp_before.alias("true_positives_before"),
    )


def curve_areas(curve: DataFrame, keys: list[str] | tuple = ()) -> DataFrame:
    """Average precision, ROC-AUC and the trapezoid area under the precision-recall curve.

    Average precision is the step sum over distinct scores. Both AUCs are 0.0 where they
    are undefined for lack of a class.
    """
    # Products of two counts pass 64 bits on a few billion rows.
    pos, neg = F.col("total_pos"), F.col("total_neg").cast("double")
    step = ratio(F.col("pos"), pos)
    met = F.col("true_positives") + F.col("true_positives_before")
    roc = ratio(F.col("neg").cast("double") * met / 2.0, pos * neg)
    return curve.groupBy(*keys).agg(
        F.sum(step * F.col("precision")).alias("pr_auc"),
        F.sum(roc).alias("roc_auc"),
        F.sum(step * (F.col("precision") + F.col("precision_before")) / 2.0).alias("pr_curve_area"),
    )


def evaluate(
    df: DataFrame,
    keys: list[str] | tuple = ("model", "split"),
    label: str = "label",
    predicted: str = "predicted_label",
    score: str = "spike_probability",
    small_group: int | None = None,
) -> DataFrame:
    """All metrics, one row per group. ``df`` is scanned more than once; pass a stored one."""
    keys = list(keys)
    counts = rates(confusion(df, keys, label, predicted))
    areas = curve_areas(score_curve(df, keys, label, score, small_group), keys)
    return counts.join(areas, keys, "left").select(*keys, *METRICS)


def metrics_long(wide: DataFrame, keys: list[str] | tuple = ("model", "split")) -> DataFrame:
    """(model, split, metric, value), leaving out metrics that are not defined."""
    as_double = wide.select(*keys, *[F.col(m).cast("double").alias(m) for m in METRICS])
    long = as_double.unpivot(list(keys), METRICS, "metric", "value")
    return long.where("value is not null").select(*METRIC.fieldNames())


def compare_models(metrics: DataFrame, split: str = "test") -> DataFrame:
    """One row per model with the compared metrics on one split."""
    return (
        metrics.where((F.col("split") == split) & F.col("metric").isin(COMPARED))
        .groupBy("model")
        .pivot("metric", COMPARED)
        .agg(F.first("value"))
    )


def verdict(
    metrics: DataFrame, baseline: str, challenger: str, split: str = "test", target: float = TARGET_PR_AUC
) -> DataFrame:
    """One row: improvement in PR-AUC, the better model and whether each meets the target.

    A metric that is missing counts as 0.
    """
    of = lambda m: F.coalesce(
        F.max(F.when((F.col("model") == m) & (F.col("metric") == "pr_auc"), F.col("value"))), F.lit(0.0)
    )
    both = metrics.where(F.col("split") == split).agg(
        of(baseline).alias("baseline_pr_auc"), of(challenger).alias("challenger_pr_auc")
    )
    b, c = F.col("baseline_pr_auc"), F.col("challenger_pr_auc")
    return both.select(
        b,
        c,
        ((c - b) * 100.0 / F.nullif(b, F.lit(0.0))).alias("improvement_pct"),
        F.when(c > b, challenger).otherwise(baseline).alias("better_model"),
        (b >= target).alias("baseline_meets_target"),
        (c >= target).alias("challenger_meets_target"),
    )


# Limits that call for a new training run.
LOWEST_PR_AUC = 0.50
HIGHEST_SPIKE_PCT = 5.0


def retrain_triggers(metrics: DataFrame, spikes: DataFrame, drift: DataFrame, model: str, split: str = "test") -> DataFrame:
    """One row per rule: the value looked at, the limit and whether the rule fires.

    ``metrics`` is a long metric table, ``spikes`` has ``spike_pct``, ``drift`` has
    ``dataset_drift``; the last two hold one row.
    """
    chosen = (F.col("model") == model) & (F.col("split") == split) & (F.col("metric") == "pr_auc")
    pr_auc = F.col("value")
    rule = lambda df, name, value, limit, fired: df.select(
        F.lit(name).alias("rule"), value.cast("double").alias("value"),
        F.lit(limit).alias("threshold"), fired.alias("fired"),
    )
    low = rule(metrics.where(chosen), "pr_auc_low", pr_auc, LOWEST_PR_AUC, pr_auc < LOWEST_PR_AUC)
    pct = F.col("spike_pct")
    high = rule(spikes, "spike_rate_high", pct, HIGHEST_SPIKE_PCT, pct > HIGHEST_SPIKE_PCT)
    drifted = F.col("dataset_drift")
    moved = rule(drift, "drift", drifted.cast("int"), 1.0, drifted)
    return low.unionByName(high).unionByName(moved)
