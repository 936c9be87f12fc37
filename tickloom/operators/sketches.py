"""Percentiles, distinct counts and drift between any two ranges of time, without reading the rows again.

Rows are summed up once per bucket of time into mergeable sketches: KLL for the order of values, HyperLogLog
for how many are different, and exact counts and ends. New rows only add rows to the table of sketches; a range of
time is the union of its buckets. A rank read from a sketch is off by at most ``rank_error(k)``
with a probability of 99 per cent, and exact while a range holds no more than ``k`` values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.ordering import number_or_null
from tickloom.operators.trailing import floor_div
from tickloom.session import stored

K = 1000
UNIQUE_BITS = 12  # of the HyperLogLog table; its standard error is 1.6 per cent
POINTS = 100
SKETCH_COLUMNS = ["bucket_us", "column_name", "n", "lowest", "highest", "quantiles", "uniques"]


def rank_error(k: int = K) -> float:
    """Largest error of a rank, as a share of the rows, at 99 per cent confidence."""
    return 2.296 / k**0.9021


def sketch_rows(rows: DataFrame, columns: list[str], bucket_seconds: float, time_us: str = "ts_us", k: int = K) -> DataFrame:
    """One row per bucket of time and column, over the finite values. One pass; only sketches are shuffled."""
    width = int(round(bucket_seconds * 1_000_000))
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.col(c)).alias(c)
    numbers = rows.where(F.col(time_us).isNotNull()).select(
        F.expr(f"{floor_div(time_us, width)} * {width}L").alias("bucket_us"), *[number_or_null(c) for c in columns]
    )
    summed = lambda c: F.struct(
        F.count(c).alias("n"), F.min(c).alias("lowest"), F.max(c).alias("highest"),
        F.kll_sketch_agg_double(c, F.lit(k)).alias("quantiles"), F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c) + 0.0)), F.lit(UNIQUE_BITS)).alias("uniques"),
    ).alias(c)
    by_bucket = numbers.select("bucket_us", *[finite(c) for c in columns]).groupBy("bucket_us").agg(*[summed(c) for c in columns])
    long = by_bucket.unpivot(["bucket_us"], columns, "column_name", "s")
    return long.select("bucket_us", "column_name", "s.*").where("n > 0").select(*SKETCH_COLUMNS)


def merge_range(sketches: DataFrame, begin_us: int | None = None, end_us: int | None = None, k: int = K) -> DataFrame:
    """One row per column over the buckets that begin in [begin, end)."""
    inside = F.lit(True)
    if begin_us is not None:
        inside &= F.col("bucket_us") >= begin_us
    if end_us is not None:
        inside &= F.col("bucket_us") < end_us
    return sketches.where(inside).groupBy("column_name").agg(
        F.sum("n").alias("n"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
        F.kll_merge_agg_double("quantiles", F.lit(k)).alias("quantiles"), F.hll_union_agg("uniques").alias("uniques"),
    )


def _at(sketch: str, fractions: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(f)) for f in fractions]))


def range_percentiles(merged: DataFrame, fractions: list[float]) -> DataFrame:
    """(column_name, n, fraction, value): the least value with at least that share of rows up to it."""
    wanted = F.array(*[F.lit(float(f)) for f in fractions])
    rows = merged.select("column_name", "n", F.explode(F.arrays_zip(wanted.alias("fraction"), _at("quantiles", fractions).alias("value"))).alias("z"))
    return rows.select("column_name", "n", "z.fraction", "z.value")


def range_uniques(merged: DataFrame) -> DataFrame:
    return merged.select("column_name", "n", F.hll_sketch_estimate("uniques").alias("n_unique"))


def range_drift(reference: DataFrame, current: DataFrame, points: int = POINTS, k: int = K) -> DataFrame:
    """Per column of two merged ranges: the largest gap ``ks`` and the ``area`` between the shares of rows up to
    each value, taken at ``points`` quantiles of either side, and ``error``, by how much ``ks`` can
    be off what all values would give."""
    shares = [i / points for i in range(points + 1)]
    side = lambda df, name: df.select(
        "column_name", F.col("n").alias(f"n_{name}"), F.col("quantiles").alias(name), _at("quantiles", shares).alias(f"marks_{name}")
    )
    both = side(reference, "reference").join(side(current, "current"), "column_name")
    both = stored(both.withColumn("marks", F.array_sort(F.array_union("marks_reference", "marks_current"))), "ranges")
    # Spark looks ranks up at constants only: at most 2 * points + 2 numbers for each column.
    marks = {r["column_name"]: r["marks"] for r in both.select("column_name", "marks").collect()}
    found = None
    for column, values in marks.items():
        at = F.array(*[F.lit(v) for v in values])
        gaps = F.zip_with(F.kll_sketch_get_rank_double("reference", at), F.kll_sketch_get_rank_double("current", at), lambda a, b: F.abs(a - b))
        part = both.where(F.col("column_name") == column).withColumn("gaps", gaps)
        found = part if found is None else found.unionByName(part)
    found = both.withColumn("gaps", F.array().cast("array<double>")) if found is None else found
    steps = F.zip_with(F.slice("gaps", 1, F.size("gaps") - 1), F.zip_with(F.slice("marks", 2, F.size("marks")), F.slice("marks", 1, F.size("marks") - 1), lambda b, a: b - a), lambda g, d: g * d)
    area = F.aggregate(steps, F.lit(0.0), lambda total, step: total + step)
    error = F.lit(2 * rank_error(k) + 1 / points)
    return found.select("column_name", "n_reference", "n_current", F.array_max("gaps").alias("ks"), area.alias("area"), error.alias("error"))
