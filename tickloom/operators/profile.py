"""Exploratory statistics of a feature table."""

import json
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.labels import missing
from tickloom.operators.ordering import number_or_null, percentiles, running_totals, unpivot, with_next

QUARTILES = [0.25, 0.5, 0.75]
# Tail percentiles looked at when the threshold is chosen.
TAIL_PERCENTILES = [50.0, 75.0, 90.0, 95.0, 99.0, 99.5, 99.9]
SWEEP_PERCENTILES = [95.0, 99.0, 99.5]


def percent_name(fraction: float) -> str:
    return "p" + f"{fraction * 100:.10g}".replace(".", "_")


def numeric_columns(df: DataFrame) -> list[str]:
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return [n for n, t in df.dtypes if t in numbers or t.startswith("decimal")]


def describe(
    df: DataFrame, columns: list[str], fractions: list[float] = QUARTILES, small_group: int | None = None
) -> DataFrame:
    """One row per column: count, mean, sample std, min, exact percentiles, max."""
    wide = df.select(*[number_or_null(c) for c in columns])
    parts = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    row = wide.agg(
        *[F.struct(*[f(c).alias(n) for n, f in parts.items()]).alias(c) for c in columns]
    )
    moments = unpivot(row, columns, "m").select("column_name", "m.*")
    points = percentiles(df, columns, fractions, small_group)
    pivoted = points.groupBy("column_name").agg(
        *[F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(percent_name(f)) for f in fractions]
    )
    names = [percent_name(f) for f in fractions]
    return moments.join(pivoted, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *names, "max"
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    types = dict(df.dtypes)
    test = lambda c: missing(c) if types[c] in ("double", "float") else F.col(c).isNull()
    row = df.agg(*[F.count_if(test(c)).alias(c) for c in columns])
    return unpivot(row, columns, "n_missing")


def zero_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows equal to zero; a missing value is not zero."""
    row = df.agg(
        *[(F.count_if(F.col(c) == 0) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias(c) for c in columns]
    )
    return unpivot(row, columns, "zero_share")


def tail_percentiles(
    df: DataFrame, column: str, points: list[float] = TAIL_PERCENTILES, small_group: int | None = None
) -> DataFrame:
    result = percentiles(df, [column], [p / 100 for p in points], small_group)
    return result.select(F.round(F.col("fraction") * 100, 6).alias("percentile"), "value")


def bin_index(value: Column, low: float | Column, high: float | Column, bins: int) -> Column:
    """Equal-width bin from 0; the last bin is closed on both sides."""
    width = (high - low) / bins
    guess = F.least(F.floor((value - low) / width).cast("int"), F.lit(bins - 1))
    lower = lambda i: low + i * width
    return (
        F.when(value < lower(guess), guess - 1)
        .when((guess < bins - 1) & (value >= lower(guess + 1)), guess + 1)
        .otherwise(guess)
    )


def value_range(df: DataFrame, column: str) -> tuple[float, float] | None:
    """Lowest and highest finite value, widened by a half each way when they are equal."""
    finite = df.select(number_or_null(column)).where(F.abs(column) < float("inf"))
    low, high = finite.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    return (low - 0.5, high + 0.5) if low == high else (low, high)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts per equal-width bin, empty bins included."""
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"), F.lit(0).cast("long").alias("n"))
    limits = value_range(df, column)
    low, high = limits or (0.0, 1.0)
    finite = df.select(number_or_null(column)).where(F.abs(column) < float("inf"))
    counted = finite.groupBy(bin_index(F.col(column), low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    width = (high - low) / bins
    return (
        counted.unionByName(edges)
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_end"),
            "n",
        )
    )


def ecdf(df: DataFrame, column: str, small_group: int | None = None) -> DataFrame:
    """Distinct values with the percentage of rows at or below each."""
    rows = df.select(number_or_null(column))
    totals = running_totals(rows, column, {"n": F.lit(1)}, small_group=small_group)
    return totals.select(
        F.col(column).alias("value"), (F.col("cum_n") * 100.0 / F.col("total_n")).alias("percentile")
    )


def threshold_sweep(df: DataFrame, column: str, thresholds: dict[str, float]) -> DataFrame:
    """How many rows reach each threshold, in one scan."""
    names = list(thresholds)
    n = F.count(F.lit(1))
    row = df.agg(
        n.alias("_n"), *[F.count_if(~missing(column) & (F.col(column) >= F.lit(t).cast("double"))).alias(k) for k, t in thresholds.items()]
    )
    long = row.unpivot(["_n"], names, "threshold_name", "n_reaching")
    value = F.create_map(*[x for k, t in thresholds.items() for x in (F.lit(k), F.lit(t).cast("double"))])
    return long.select(
        "threshold_name",
        value[F.col("threshold_name")].alias("threshold"),
        "n_reaching",
        (F.col("n_reaching") * 100.0 / F.nullif(F.col("_n"), F.lit(0))).alias("pct_reaching"),
    )


def percentile_sweep(
    df: DataFrame, column: str, points: list[float] = SWEEP_PERCENTILES, small_group: int | None = None
) -> DataFrame:
    """The sweep with percentiles of the column itself as thresholds."""
    rows = percentiles(df, [column], [p / 100 for p in points], small_group).collect()
    # A column without values has no percentiles; its thresholds are missing and nothing reaches them.
    found = {r["fraction"]: r["value"] for r in rows}
    thresholds = {percent_name(p / 100): found.get(p / 100) for p in points}
    return threshold_sweep(df, column, thresholds)


def choose_threshold(
    df: DataFrame, column: str = "midprice_return_std", percentile: float = 95.0, small_group: int | None = None
) -> DataFrame:
    """One row: the chosen percentile, its value as threshold, and what it labels."""
    found = percentiles(df, [column], [percentile / 100], small_group).first()
    value = found["value"] if found else None
    swept = threshold_sweep(df, column, {"chosen": value})
    return swept.select(F.lit(percentile).alias("percentile"), "threshold", "n_reaching", "pct_reaching")


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Each value with its count and its share of the non-missing rows."""
    known = df.where(F.col(column).isNotNull())
    n = known.count()
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.lit(n))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, both ways round, in one scan.

    Each row is laid out once per pair and the pairs are added up before they are shuffled, so
    three aggregates serve any number of columns. NULL where a column is constant or the two are never
    there together."""
    spark = df.sparkSession
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    asked = spark.createDataFrame([(columns[i], columns[j], i, j) for i, j in pairs], "a string, b string, i int, j int")
    both = F.from_json(F.lit(json.dumps([{"i": i, "j": j} for i, j in pairs])), "array<struct<i:int,j:int>>")
    values = df.select(F.array(*[number_or_null(c) for c in columns]).alias("v"))
    laid = values.select(F.explode(both).alias("p"), "v")
    laid = laid.select("p.i", "p.j", F.get("v", "p.i").alias("x"), F.get("v", "p.j").alias("y")).where("x is not null and y is not null")
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    found = laid.groupBy("i", "j").agg((F.covar_pop("x", "y") / F.nullif(spread, F.lit(0.0))).alias("correlation"))
    named = asked.join(found, ["i", "j"], "left")
    ways = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return named.select(F.explode(ways).alias("p"), "correlation").select(
        F.col("p.a").alias("column_a"), F.col("p.b").alias("column_b"), "correlation"
    )


def arrival_gaps(df: DataFrame, keys: list[str] | tuple = ("pair",)) -> DataFrame:
    """Seconds from each row to the next one of its key; NULL for the last row."""
    ahead = with_next(df, "ts_us", "_next_us", keys)
    gap = (F.col("_next_us") - F.col("ts_us")) / F.lit(1e6)
    return ahead.withColumn("gap_seconds", gap).drop("_next_us")


def first_rows(df: DataFrame, n: int, order: list[str] = ["ts_us", "seq"]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def time_series(df: DataFrame, column: str = "midprice_return_std") -> DataFrame:
    """(ts, column) in time order, ready to plot."""
    return df.select("ts", column).orderBy("ts")


def columns_and_shape(df: DataFrame) -> DataFrame:
    """One row per column: its place, name and type, and how many rows and columns the table has."""
    listed = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("type")) for i, (c, t) in enumerate(df.dtypes, 1)])
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.explode(listed).alias("c"), "n_rows").select("c.*", "n_rows", F.lit(len(df.columns)).alias("n_columns"))
