"""Data quality of the two sides of a comparison, as long tables keyed by ``side``."""

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.operators.ordering import unpivot
from tickloom.operators.profile import describe, numeric_columns
from tickloom.session import stored

# Share of one value, or of equal rows, that counts as almost constant or
# almost duplicated; and how few values make a numeric column categorical.
ALMOST = 0.95
FEW_VALUES = 5
SHORT_NUMBERS = ("tinyint", "smallint", "int", "float", "double")  # whose order is that of their doubles
MISSING_KINDS = ["empty", "-Infinity", "Infinity", "null"]


def columns_of(sides: DataFrame) -> list[str]:
    return [c for c in sides.columns if c != "side"]


def is_missing(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def value_counts(sides: DataFrame, columns: list[str]) -> DataFrame:
    """(side, column_name, value as text, n) of the values present.

    Each column is read and counted by itself, in its own type; only different values are turned
    into text. Pass a stored table."""
    numbers = set(numeric_columns(sides))
    counts = None
    for c in columns:
        present = sides.where(~is_missing(sides, c)).select("side", F.col(c).alias("_v"))
        per_value = present.groupBy("side", "_v").agg(F.count(F.lit(1)).alias("n"))
        text = (F.col("_v") + F.lit(0) if c in numbers else F.col("_v")).cast("string")
        part = per_value.select("side", F.lit(c).alias("column_name"), text.alias("value"), "n")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def _commonest_number(sides: DataFrame, column: str) -> DataFrame:
    """Per side: distinct values, the greatest count and its least value. Values are first grouped by how
    often they occur, so that no sort is needed and only the one reported is turned into text."""
    present = sides.where(~is_missing(sides, column)).select("side", F.col(column).alias("_v"))
    per_value = present.groupBy("side", "_v").agg(F.count(F.lit(1)).alias("n"))
    per_count = per_value.groupBy("side", "n").agg(F.count(F.lit(1)).alias("_values"), F.min("_v").alias("_v"))
    found = per_count.groupBy("side").agg(
        F.sum("_values").alias("n_unique"), F.max("n").alias("top_n"), F.min_by("_v", -F.col("n")).alias("_v")
    )
    text = (F.col("_v") + F.lit(0)).cast("string")
    return found.select("side", F.lit(column).alias("column_name"), "n_unique", "top_n", text.alias("top_value"))


def uniques(sides: DataFrame) -> DataFrame:
    """Per side and column: rows, missing, distinct values and the most common value;
    among equally common values the smallest."""
    columns = columns_of(sides)
    types = dict(sides.dtypes)
    parts = [_commonest_number(sides, c) for c in columns if types[c] in SHORT_NUMBERS]
    if other := [c for c in columns if types[c] not in SHORT_NUMBERS]:
        counts = value_counts(sides, other)
        number = F.col("value").try_cast("double")
        top = F.min_by("value", F.struct(-F.col("n"), number, F.col("value")))
        parts.append(counts.groupBy("side", "column_name").agg(
            F.count(F.lit(1)).alias("n_unique"), F.max("n").alias("top_n"), top.alias("top_value")
        ))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    n = F.count(F.lit(1))
    wide = sides.groupBy("side").agg(
        n.alias("n_rows"), *[F.count_if(is_missing(sides, c)).alias(c) for c in columns]
    )
    missing = wide.unpivot(["side", "n_rows"], columns, "column_name", "n_missing")
    return missing.join(found, ["side", "column_name"], "left").select(
        "side", "column_name", "n_rows", "n_missing",
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "top_n", "top_value",
    )


def duplicated_rows(sides: DataFrame) -> DataFrame:
    columns = columns_of(sides)
    copies = sides.groupBy("side", *columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.groupBy("side").agg(F.sum(F.col("n") - 1).alias("value"))


def dataset_summary(sides: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """(side, metric, value): size, column kinds, missing, constant and duplicated parts.

    ``facts`` is the result of :func:`uniques` where it is already at hand.
    """
    columns = columns_of(sides)
    types = dict(sides.dtypes)
    numbers = set(numeric_columns(sides))
    times = {c for c in columns if types[c].startswith(("timestamp", "date"))}
    pairs = list(combinations(columns, 2))
    n = F.count(F.lit(1))
    all_missing = F.lit(True)
    for c in columns:
        all_missing = all_missing & is_missing(sides, c)
    same = {
        f"_{i}": F.count_if(F.col(a).eqNullSafe(F.col(b)))
        for i, (a, b) in enumerate(pairs)
        if (types[a] == types[b]) or (a in numbers and b in numbers)
    }
    wide = sides.groupBy("side").agg(
        n.alias("n_rows"),
        F.count_if(all_missing).alias("empty_rows"),
        *[c.alias(name) for name, c in same.items()],
    )

    def repeats(enough: Column) -> Column:
        total = F.lit(0)
        for column in columns[1:]:
            hit = F.lit(False)
            for i, (_, later) in enumerate(pairs):
                if later == column and f"_{i}" in same:
                    hit = hit | (F.col(f"_{i}") >= enough)
            total = total + hit.cast("int")
        return total

    fixed = {
        "number_of_columns": F.lit(len(columns)),
        "number_of_rows": F.col("n_rows"),
        "number_of_numeric_columns": F.lit(len(numbers & set(columns))),
        "number_of_datetime_columns": F.lit(len(times)),
        "number_of_categorical_columns": F.lit(len(set(columns) - numbers - times)),
        "number_of_empty_rows": F.col("empty_rows"),
        "number_of_duplicated_columns": repeats(F.col("n_rows")),
        "number_of_almost_duplicated_columns": repeats(F.col("n_rows") * ALMOST),
    }
    first = _long(wide, fixed)
    per_column = (facts or uniques(sides)).groupBy("side").agg(
        F.sum("n_missing").alias("missing"),
        F.count_if(F.col("n_missing") == F.col("n_rows")).alias("empty"),
        F.count_if(F.col("n_unique") == 1).alias("constant"),
        F.count_if(F.col("top_n") >= F.col("n_rows") * ALMOST).alias("almost"),
    )
    second = _long(
        per_column,
        {
            "number_of_missing_values": F.col("missing"),
            "number_of_empty_columns": F.col("empty"),
            "number_of_constant_columns": F.col("constant"),
            "number_of_almost_constant_columns": F.col("almost"),
        },
    )
    third = _long(duplicated_rows(sides), {"number_of_duplicated_rows": F.col("value")})
    return first.unionByName(second).unionByName(third)


def _long(wide: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    row = wide.select("side", *[c.cast("long").alias(name) for name, c in metrics.items()])
    return row.unpivot(["side"], list(metrics), "metric", "value")


def missing_kinds(sides: DataFrame) -> DataFrame:
    """(side, column_name, kind, n): empty text, infinities and nulls."""
    columns = columns_of(sides)
    types = dict(sides.dtypes)

    def tests(c: str) -> Column:
        value, never = F.col(c), F.lit(False)
        floating = types[c] in ("double", "float")
        found = [
            value == "" if types[c] == "string" else never,
            value == float("-inf") if floating else never,
            value == float("inf") if floating else never,
            is_missing(sides, c),
        ]
        return F.array(*[F.count_if(t) for t in found])

    wide = sides.groupBy("side").agg(*[tests(c).alias(c) for c in columns])
    long = unpivot(wide, columns, "counts", ["side"])
    names = F.array(*[F.lit(k) for k in MISSING_KINDS])
    return long.select(
        "side", "column_name", F.explode(F.arrays_zip(names.alias("kind"), F.col("counts").alias("n"))).alias("z")
    ).select("side", "column_name", "z.kind", "z.n")


def missing_overview(sides: DataFrame) -> DataFrame:
    """(side, metric, value): values, rows and columns with anything missing."""
    columns = columns_of(sides)
    types = dict(sides.dtypes)

    def gone(c: str) -> Column:
        bad = is_missing(sides, c)
        if types[c] == "string":
            bad = bad | (F.col(c) == "")
        if types[c] in ("double", "float"):
            bad = bad | (F.abs(c) == float("inf"))
        return F.coalesce(bad, F.lit(False))

    anywhere, per_row = F.lit(False), F.lit(0)
    for c in columns:
        anywhere, per_row = anywhere | gone(c), per_row + gone(c).cast("int")
    n = F.count(F.lit(1))
    touched = F.lit(0)
    for c in columns:
        touched = touched + F.max(gone(c).cast("int"))
    values, rows = F.sum(per_row), F.count_if(anywhere)
    share = lambda top, bottom: top / F.nullif(bottom.cast("double"), F.lit(0.0))
    wide = sides.groupBy("side").agg(
        values.cast("double").alias("number_of_missing_values"),
        share(values, n * len(columns)).alias("share_of_missing_values"),
        rows.cast("double").alias("number_of_rows_with_missing_values"),
        share(rows, n).alias("share_of_rows_with_missing_values"),
        touched.cast("double").alias("number_of_columns_with_missing_values"),
        (touched / len(columns)).alias("share_of_columns_with_missing_values"),
    )
    return wide.unpivot(["side"], [c for c in wide.columns if c != "side"], "metric", "value")


def column_summary(
    sides: DataFrame, facts: DataFrame | None = None, small_group: int | None = None
) -> DataFrame:
    """One row per side and column; numbers rounded to 2 places as in the report.

    Numeric columns with few values are reported as categories, without moments.
    """
    columns = columns_of(sides)
    numbers = [c for c in columns if c in numeric_columns(sides)]
    facts = facts or stored(uniques(sides), "uniques")  # looked at twice
    few = facts.groupBy("column_name").agg(F.max("n_unique").alias("_most"))
    moments = None
    for side in ("reference", "current"):
        part = sides.where(F.col("side") == side)
        row = describe(part, numbers, small_group=small_group).withColumn("side", F.lit(side))
        moments = row if moments is None else moments.unionByName(row)
    floating = [c for c in numbers if dict(sides.dtypes)[c] in ("double", "float")]
    infinite = sides.groupBy("side").agg(
        *[
            (F.count_if(F.abs(c) == float("inf")) if c in floating else F.lit(0).cast("long")).alias(c)
            for c in columns
        ]
    )
    infinite = unpivot(infinite, columns, "infinite_count", ["side"])
    on = ["side", "column_name"]
    rows = facts.join(moments, on, "left").join(infinite, on).join(few, "column_name")
    named = F.col("column_name").isin(numbers)
    rows = rows.withColumn("_number", named & (F.col("_most") > FEW_VALUES))
    is_number = F.col("_number")
    pct = lambda top: F.round(F.col(top) * 100.0 / F.nullif(F.col("n_rows"), F.lit(0)), 2)
    stat = lambda c: F.when(is_number, F.round(c, 2)).alias(c)
    top = F.when(is_number, F.round(F.col("top_value").try_cast("double"), 5).cast("string")).otherwise(F.col("top_value"))
    return rows.select(
        "side",
        "column_name",
        F.when(is_number, "num").otherwise("cat").alias("column_type"),
        F.col("n_rows").alias("number_of_rows"),
        (F.col("n_rows") - F.col("n_missing")).alias("count"),
        F.col("n_missing").alias("missing"),
        pct("n_missing").alias("missing_percentage"),
        *[stat(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")],
        F.col("n_unique").alias("unique"),
        pct("n_unique").alias("unique_percentage"),
        F.when(is_number, F.col("infinite_count")).alias("infinite_count"),
        F.when(is_number, pct("infinite_count")).alias("infinite_percentage"),
        top.alias("most_common"),
        pct("top_n").alias("most_common_percentage"),
    )
