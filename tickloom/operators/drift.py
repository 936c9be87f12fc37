"""Has a column moved? Comparison of a reference and a current table."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from tickloom.functions.statistics import EXACT_ROWS, ks_p_value
from tickloom.operators.ordering import number_or_null, running_totals, unpivot
from tickloom.operators.profile import bin_index
from tickloom.session import ship_code

REFERENCE, CURRENT = "reference", "current"
# Test names, their thresholds and when each test applies.
KS, WASSERSTEIN, JENSEN_SHANNON = "K-S p_value", "Wasserstein distance (normed)", "Jensen-Shannon distance"
NO_VALUES = "no values"
P_VALUE_LIMIT = 0.05
DISTANCE_LIMIT = 0.1
SMALL_REFERENCE = 1000
FEW_VALUES = 5
SMALLEST_SCALE = 0.001
DRIFT_SHARE = 0.5
DENSITY_BINS = 10


def both_sides(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """The chosen columns of both tables with a ``side`` column."""
    pick = lambda df, side: df.select(F.lit(side).alias("side"), *columns)
    return pick(reference, REFERENCE).unionByName(pick(current, CURRENT))


def finite_long(sides: DataFrame, columns: list[str]) -> DataFrame:
    """(side, column_name, value) without missing and infinite values."""
    numbers = sides.select("side", *[number_or_null(c) for c in columns])
    return unpivot(numbers, columns, "value", ["side"]).where(F.abs("value") < float("inf"))


def distances(sides: DataFrame, columns: list[str], small_group: int | None = None) -> DataFrame:
    """Per column: rows per side, distinct values, largest gap between the distribution
    functions, area between them, and Jensen-Shannon distance of the value shares.

    All come from one table of distinct values with running counts.
    """
    of = lambda side: (F.col("side") == side).cast("long")
    totals = running_totals(
        finite_long(sides, columns), "value", {"ref": of(REFERENCE), "cur": of(CURRENT)},
        ["column_name"], small_group,
    )
    share = lambda top, side: F.col(top) / F.nullif(F.col(f"total_{side}"), F.lit(0))
    gap = F.abs(share("cum_ref", "ref") - share("cum_cur", "cur"))
    p, q = share("ref", "ref"), share("cur", "cur")
    term = lambda a: F.when(a > 0, a * F.ln(a / ((p + q) / 2.0))).otherwise(0.0)
    return totals.groupBy("column_name").agg(
        F.first("total_ref").alias("n_reference"),
        F.first("total_cur").alias("n_current"),
        F.count(F.lit(1)).alias("n_values"),
        F.max(gap).alias("ks"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("area"),
        F.sqrt(F.greatest(F.sum((term(p) + term(q)) / 2.0), F.lit(0.0))).alias("jensen_shannon"),
    )


def _ks_p(exact_rows: int):
    @F.pandas_udf(DoubleType())
    def p_values(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for d, n, m in parts:
            p = [ks_p_value(*row, exact_rows) if row[0] == row[0] else None for row in zip(d, n, m)]
            yield pd.Series(p, dtype="float64")

    return p_values


def drift_by_column(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str],
    small_reference: int = SMALL_REFERENCE,
    few_values: int = FEW_VALUES,
    small_group: int | None = None,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """(column_name, test, threshold, score, drift), one row for each of ``columns``.

    A small reference is tested with Kolmogorov-Smirnov (p-values are exact up to
    ``exact_rows`` rows on either side); otherwise columns with few values by Jensen-Shannon
    distance and the rest by Wasserstein distance over the reference's standard deviation.
    A column without finite values on one side has no score: its test is ``NO_VALUES`` and it
    has drifted if only one side lacks them.
    """
    ship_code(reference.sparkSession)
    sides = both_sides(reference, current, columns)
    found = distances(sides, columns, small_group)
    finite = finite_long(sides, columns).where(F.col("side") == REFERENCE)
    scales = finite.groupBy("column_name").agg(F.stddev_pop("value").alias("scale"))
    asked = reference.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    rows = asked.join(found, "column_name", "left").join(scales, "column_name", "left")
    rows = rows.fillna(0, ["n_reference", "n_current", "n_values"])
    empty = (F.col("n_reference") == 0) | (F.col("n_current") == 0)
    small = F.col("n_reference") <= small_reference
    test = F.when(small, KS).when(F.col("n_values") <= few_values, JENSEN_SHANNON).otherwise(WASSERSTEIN)
    normed = F.col("area") / F.greatest(F.col("scale"), F.lit(SMALLEST_SCALE))
    other = F.when(F.col("n_values") <= few_values, F.col("jensen_shannon")).otherwise(normed)
    p_value = _ks_p(exact_rows)(F.when(small & ~empty, F.col("ks")), "n_reference", "n_current")
    score = F.when(~empty, F.when(small, F.col("_p")).otherwise(other))
    rows = rows.withColumn("_p", p_value).withColumn("score", score)
    limit = F.when(F.col("test") == KS, P_VALUE_LIMIT).when(F.col("test") != NO_VALUES, DISTANCE_LIMIT)
    one_side = F.col("n_reference") != F.col("n_current")
    drift = (
        F.when(F.col("test") == NO_VALUES, one_side)
        .when(F.col("test") == KS, F.col("score") < P_VALUE_LIMIT)
        .otherwise(F.col("score") >= DISTANCE_LIMIT)
    )
    return rows.withColumn("test", F.when(empty, NO_VALUES).otherwise(test)).select(
        "column_name", "test", limit.alias("threshold"), "score", drift.alias("drift")
    )


def dataset_drift(by_column: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """One row: columns, drifted columns, their share and whether the dataset drifted."""
    n, drifted = F.count(F.lit(1)), F.count_if(F.col("drift"))
    part = drifted / F.nullif(n, F.lit(0))
    return by_column.agg(
        n.alias("n_columns"),
        drifted.alias("n_drifted"),
        part.alias("share"),
        F.coalesce(part >= share, F.lit(False)).alias("dataset_drift"),
    )


def densities(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = DENSITY_BINS) -> DataFrame:
    """Density histogram per column and side over that side's own range."""
    spark = reference.sparkSession
    long = finite_long(both_sides(reference, current, columns), columns)
    ranges = long.groupBy("side", "column_name").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("total")
    )
    half = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    held = ranges.select(
        F.col("side").alias("s"), F.col("column_name").alias("c"),
        (F.col("lo") - half).alias("low"), (F.col("hi") + half).alias("high"), "total",
    )
    # Two rows per column: the number of columns bounds what is broadcast.
    limits = spark.createDataFrame(held.collect(), held.schema)
    index = bin_index(F.col("value"), F.col("low"), F.col("high"), bins)
    counted = (
        long.join(F.broadcast(limits), (F.col("side") == F.col("s")) & (F.col("column_name") == F.col("c")))
        .groupBy("side", "column_name", index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    empty = limits.select(
        F.col("s").alias("side"), F.col("c").alias("column_name"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.lit(0).cast("long").alias("n"),
    )
    whole = counted.unionByName(empty).groupBy("side", "column_name", "bin").agg(F.sum("n").alias("n"))
    width = (F.col("high") - F.col("low")) / bins
    return whole.join(
        F.broadcast(limits), (F.col("side") == F.col("s")) & (F.col("column_name") == F.col("c"))
    ).select(
        "side",
        "column_name",
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        (F.col("n") / (F.col("total") * width)).alias("density"),
    )
