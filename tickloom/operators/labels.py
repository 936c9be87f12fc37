"""Volatility labels and splits by time."""

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.ordering import keys_at_ranks, with_next
from tickloom.operators.trailing import forward_volatility
from tickloom.schemas import DEFAULT_WINDOW_SECONDS, FEATURES, METADATA

# The threshold the early analysis used and the one models are trained with.
FIRST_THRESHOLD = 0.000015
TRAINING_THRESHOLD = 0.000028


def at_least(value: Column, threshold: float) -> Column:
    """1 where value >= threshold; 0 otherwise, also for missing and NaN values."""
    return F.coalesce(((value >= threshold) & ~F.isnan(value)).cast("int"), F.lit(0))


def label_next_row(
    features: DataFrame,
    threshold: float = FIRST_THRESHOLD,
    column: str = "midprice_return_std",
    keys: list[str] | tuple = ("pair",),
) -> DataFrame:
    """``label`` = 1 when the next row's volatility reaches the threshold.

    The last row per key has no next row; it is kept with label 0.
    """
    ahead = with_next(features, column, "_next", keys)
    return ahead.withColumn("label", at_least(F.col("_next"), threshold)).drop("_next")


def label_same_row(features: DataFrame, threshold: float = FIRST_THRESHOLD) -> DataFrame:
    return features.withColumn("label", at_least(F.col("midprice_return_std"), threshold))


def label_horizon(
    ticks: DataFrame, threshold: float, horizon_seconds: float = DEFAULT_WINDOW_SECONDS
) -> DataFrame:
    """Label from the returns strictly after each tick; NULL when nothing follows in time."""
    ahead = forward_volatility(ticks, horizon_seconds)
    std = F.col("forward_return_std")
    return ahead.withColumn("label", F.when(std.isNotNull(), (std >= threshold).cast("int")))


def label_counts(labelled: DataFrame, label: str = "label") -> DataFrame:
    """One row: rows, spikes, normals and the percentage of spikes."""
    n = F.count(F.lit(1))
    spikes = F.count_if(F.col(label) == 1)
    return labelled.agg(
        n.alias("n_rows"),
        spikes.alias("spikes"),
        (n - spikes).alias("normals"),
        (spikes * 100.0 / F.nullif(n, F.lit(0))).alias("spike_pct"),
    )


def missing(column: str) -> Column:
    value = F.col(column)
    return value.isNull() | F.isnan(value.cast("double"))


def prepare_training_rows(
    labelled: DataFrame, features: list[str] = FEATURES, drop: list[str] = METADATA
) -> DataFrame:
    """Drop bookkeeping columns if present and rows missing a feature or the label."""
    keep = labelled.drop(*drop)
    complete = F.lit(True)
    for column in [*features, "label"]:
        complete = complete & ~missing(column)
    return keep.where(complete)


def missing_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column and how many rows remain without them."""
    anywhere = F.lit(False)
    for column in columns:
        anywhere = anywhere | missing(column)
    counts = df.agg(
        *[F.count_if(missing(c)).alias(c) for c in columns],
        F.count_if(~anywhere).alias("_rows_kept"),
    )
    return counts.unpivot(["_rows_kept"], columns, "column_name", "n_missing").select(
        "column_name", "n_missing", F.col("_rows_kept").alias("rows_kept")
    )


def split_by_position(
    df: DataFrame,
    shares: dict[str, float],
    time_us: str = "ts_us",
    order: str = "seq",
    small_group: int | None = None,
) -> DataFrame:
    """Add ``split``: consecutive runs of rows in time order, sized by ``shares``.

    All but the last split hold ``int(rows * share)`` rows; the last takes the rest. Only
    the rows at the boundaries are looked up, so the table is neither sorted nor moved.
    Pass a stored table: it is scanned a few times, two columns wide.
    """
    names = list(shares)
    n = df.count()
    ends, end = [], 0
    for name in names[:-1]:
        end += int(n * shares[name])
        ends.append(end)
    last_rows = keys_at_ranks(df, time_us, order, [e - 1 for e in ends if e > 0], small_group)
    split = F.lit(names[-1])
    for name, end in reversed(list(zip(names, ends))):
        if end == 0:
            continue
        at, seq = last_rows[end - 1]
        upto = (F.col(time_us) < at) | ((F.col(time_us) == at) & (F.col(order) <= seq))
        split = F.when(upto, name).otherwise(split)
    return df.withColumn("split", split)


# Shares of the training split and of the early-against-late split.
TRAIN_SHARES = {"train": 0.7, "validation": 0.15, "test": 0.15}


def split_train_validation_test(df: DataFrame, shares: dict[str, float] = TRAIN_SHARES) -> DataFrame:
    return split_by_position(df, shares)


def split_early_late(df: DataFrame, ratio: float = 0.5) -> DataFrame:
    return split_by_position(df, {"reference": ratio, "current": 1.0 - ratio})


def split_counts(split_df: DataFrame, label: str = "label") -> DataFrame:
    n, spikes = F.count(F.lit(1)), F.count_if(F.col(label) == 1)
    return split_df.groupBy("split").agg(
        n.alias("n_rows"), spikes.alias("spikes"), (spikes * 100.0 / n).alias("spike_pct")
    )
