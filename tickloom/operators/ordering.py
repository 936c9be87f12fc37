"""Ranks, running totals and neighbours over a global order, without a global sort.

A window without partitions would put the whole table into one task. Here the value
range is cut at approximate quantiles, so each bucket holds a similar share of rows; the
bucket of a row depends on its value alone, which makes retries and repeated scans agree.
Repeated values are summed before they are shuffled, so a value held by a third of all
rows is one row per task by then. Only cut points and bucket sums, a bounded number per
group, ever reach the driver.
"""

import json
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tickloom.session import stored

# Below this many rows per group one task handles the group and no cut points are needed.
SMALL_GROUP = 1_000_000
# Rows a bucket should hold; the number of buckets follows from it.
BUCKET_ROWS = 2_000_000
# Cut points of one group at a time, whatever its size.
MOST_CUTS = 1024


def bucket_count(df: DataFrame, rows: int = 0, bucket_rows: int = BUCKET_ROWS) -> int:
    """Enough buckets for all tasks, and for no bucket to hold much over ``bucket_rows``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_CUTS, max(2, partitions, ceil(rows / bucket_rows)))


def cut_points(value: str, buckets: int) -> Column:
    # As JSON, so that one literal holds them however many there are.
    fractions = F.from_json(F.lit(json.dumps([i / buckets for i in range(1, buckets)])), "array<double>")
    return F.array_sort(
        F.array_distinct(F.approx_percentile(value, fractions, max(1000, 20 * buckets)))
    )


def bucket_of(marks: Column, value: Column, buckets: int) -> Column:
    """How many cut points lie below ``value``: a binary search over the sorted array."""
    steps, step = [], 1
    while step <= buckets:
        steps.insert(0, step)
        step *= 2
    jump = lambda at, step: F.when(
        (at + step <= F.size(marks)) & (F.get(marks, at + step - 1) < value), at + step
    ).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), jump)


def running_totals(
    df: DataFrame,
    value: str,
    sums: dict[str, Column],
    keys: list[str] | tuple = (),
    small_group: int | None = None,
    buckets: int | None = None,
    bucket_rows: int | None = None,
) -> DataFrame:
    """One row per (keys, value), ascending in value, with each sum and its running total.

    ``sums`` maps names to row-level columns. Adds ``cum_<name>`` (own row included),
    ``total_<name>`` (over the group) and ``next_value``. NULL values are left out.

    A group of more than ``small_group`` rows is cut into at most ``MOST_CUTS`` ranges of values, and a
    range that still has more than ``bucket_rows`` different values is cut again, so what is known
    about a group's order at any time has a fixed size.
    """
    names = list(sums)
    small_group = SMALL_GROUP if small_group is None else small_group
    rows = df.where(F.col(value).isNotNull()).select(*keys, value, *[c.alias(n) for n, c in sums.items()])
    whole = [] if keys else ["_all"]  # without keys all rows are one group
    if whole:
        rows = rows.withColumn("_all", F.lit(0))
    groups = [*keys, *whole]
    largest = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("n")).first()["n"] or 0
    per_value = rows.groupBy(*groups, value).agg(*[F.sum(n).alias(n) for n in names])
    if largest <= small_group:
        found = _in_order(per_value, value, names, groups)
    else:
        found = _by_ranges(stored(per_value, "values"), value, names, groups, small_group, buckets, bucket_rows or BUCKET_ROWS)
    return found.drop(*whole)


def _in_order(per_value: DataFrame, value: str, names: list[str], keys: list[str]) -> DataFrame:
    """Running totals of groups that one task each can take."""
    order = W.partitionBy(*keys).orderBy(value)
    run = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_value.select(
        *keys,
        value,
        *names,
        *[F.sum(n).over(run).alias(f"cum_{n}") for n in names],
        *[F.sum(n).over(W.partitionBy(*keys)).alias(f"total_{n}") for n in names],
        F.lead(value).over(order).alias("next_value"),
    )


def _by_ranges(
    per_value: DataFrame, value: str, names: list[str], keys: list[str], limit: int, cuts: int | None, bucket_rows: int
) -> DataFrame:
    """Running totals of stored values: inside ranges of them, plus what lies in the ranges before."""
    sizes = per_value.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.agg(F.max("_n").alias("n")).first()["n"] or 0
    if largest <= limit:
        return _in_order(per_value, value, names, keys)

    def beside(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
        """``left`` with the other columns of ``right``, where the keys agree, null being a key like any other."""
        renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in right.columns if c not in on])
        joined = left.join(renamed, on=[left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in on], how=how)
        return joined if how == "left_semi" else joined.drop(*[f"_r_{k}" for k in on])

    cuts = min(MOST_CUTS, cuts or bucket_count(per_value, largest, bucket_rows))
    bucket = f"_bucket{len(keys)}"
    large = beside(per_value, sizes.where(F.col("_n") > limit).drop("_n"), keys, "left_semi")
    marks = large.groupBy(*keys).agg(cut_points(value, cuts).alias("_marks"))
    placed = beside(per_value, marks, keys, "left")
    # Groups that are small enough have no marks and are one range.
    placed = placed.withColumn(bucket, F.coalesce(bucket_of(F.col("_marks"), F.col(value), cuts), F.lit(0))).drop("_marks")
    placed = stored(placed, "ranges")

    over = W.partitionBy(*keys).orderBy(bucket)
    by_bucket = placed.groupBy(*keys, bucket).agg(*[F.sum(n).alias(n) for n in names], F.min(value).alias("_low"))
    offsets = by_bucket.select(
        *keys,
        bucket,
        *[F.coalesce(F.sum(n).over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"_before_{n}") for n in names],
        *[F.sum(n).over(W.partitionBy(*keys)).alias(f"_total_{n}") for n in names],
        F.lead("_low").over(over).alias("_next_low"),
    )
    local = _by_ranges(placed, value, names, [*keys, bucket], max(limit, bucket_rows), None, bucket_rows)
    return beside(local, offsets, [*keys, bucket], "inner").select(
        *keys,
        value,
        *names,
        *[(F.col(f"_before_{n}") + F.col(f"cum_{n}")).alias(f"cum_{n}") for n in names],
        *[F.col(f"_total_{n}").alias(f"total_{n}") for n in names],
        F.coalesce("next_value", "_next_low").alias("next_value"),
    )


def value_at_ranks(
    df: DataFrame, value: str, ranks: list[int], small_group: int | None = None, buckets: int | None = None
) -> dict[int, tuple]:
    """Exact values at 0-based ranks of the ascending order, as {rank: (value, rows below)}.

    Narrows the range around each rank by counting buckets until few rows are left.
    Every pass is one aggregation with a bounded result; nothing is sorted or shuffled
    but the rows of the last, small range.
    """
    small_group = SMALL_GROUP if small_group is None else small_group
    buckets = buckets or bucket_count(df)
    column, n = F.col(value), F.count(F.lit(1)).alias("n")
    ends = [F.min(value).alias("lo"), F.max(value).alias("hi")]

    def search(part: DataFrame, wanted: list[int], below: int) -> dict[int, tuple]:
        stats = part.agg(n, *ends, cut_points(value, buckets).alias("marks")).first()
        if wanted[-1] - below >= stats["n"]:
            raise ValueError(f"rank {wanted[-1]} is beyond the last row")
        if stats["lo"] == stats["hi"]:
            return {rank: (stats["lo"], below) for rank in wanted}
        if stats["n"] <= small_group:
            counts = part.groupBy(value).agg(n)
            upto = F.sum("n").over(W.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow))
            first = F.col("upto") - F.col("n")
            hits = counts.withColumn("upto", upto).where(
                F.exists(
                    F.array(*[F.lit(rank - below) for rank in wanted]),
                    lambda rank: (rank >= first) & (rank < F.col("upto")),
                )
            ).collect()
            return {
                rank: (hit[value], below + hit["upto"] - hit["n"])
                for rank in wanted
                for hit in hits
                if hit["upto"] - hit["n"] <= rank - below < hit["upto"]
            }
        # A cut below the highest value leaves rows on both sides, so the range shrinks.
        inner = [m for m in stats["marks"] if stats["lo"] <= m < stats["hi"]] or [stats["lo"]]
        marks = F.array(*[F.lit(m) for m in inner])
        counted = part.groupBy(bucket_of(marks, column, buckets).alias("bucket")).agg(n, *ends)
        found = {}
        for bucket in counted.orderBy("bucket").collect():
            inside = [rank for rank in wanted if below <= rank < below + bucket["n"]]
            if inside and bucket["lo"] == bucket["hi"]:
                found |= {rank: (bucket["lo"], below) for rank in inside}
            elif inside:
                narrow = part.where(column.between(F.lit(bucket["lo"]), F.lit(bucket["hi"])))
                found |= search(narrow, inside, below)
            below += bucket["n"]
        return found

    wanted = sorted(set(ranks))
    return search(df.where(column.isNotNull()).select(value), wanted, 0) if wanted else {}


def keys_at_ranks(
    df: DataFrame, major: str, minor: str, ranks: list[int], small_group: int | None = None
) -> dict[int, tuple]:
    """Exact ``(major, minor)`` at 0-based ranks of the order by both columns."""
    if not ranks:
        return {}
    places = {}
    for rank, (value, below) in value_at_ranks(df, major, ranks, small_group).items():
        ties = df.where(F.col(major) == F.lit(value))
        inner = value_at_ranks(ties, minor, [rank - below], small_group)
        places[rank] = (value, inner[rank - below][0])
    return places


def percentiles(
    df: DataFrame,
    columns: list[str],
    fractions: list[float],
    small_group: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation: (column_name, fraction, value).

    Small tables use the built-in aggregate, which holds every distinct value in one
    buffer. Of larger ones approximate quantiles just below and above a wanted rank are found first, then the
    rows below and between them are counted, and only those between are looked at.
    """
    spark = df.sparkSession
    small_group = SMALL_GROUP if small_group is None else small_group
    wide = df.select(*[number_or_null(c) for c in columns])
    sizes = wide.agg(*[F.count(c).alias(c) for c in columns]).first()
    if max(sizes) <= small_group:
        wanted = F.array(*[F.lit(f) for f in fractions])
        aggregated = wide.agg(*[F.percentile(c, wanted).alias(c) for c in columns])
        return unpivot(aggregated, columns, "values").select(
            "column_name", F.explode(F.arrays_zip(wanted.alias("fraction"), "values")).alias("z")
        ).select("column_name", F.col("z.fraction"), F.col("z.values").alias("value"))

    plan = []
    for column in columns:
        n = sizes[column]
        for fraction in fractions if n else []:
            position = fraction * (n - 1)
            plan.append((column, float(fraction), floor(position), ceil(position), position - floor(position)))
    found = _values_around(wide, plan, buckets or bucket_count(df, max(sizes)))
    ends = [(c, f, *found[c, low, high], part) for c, f, low, high, part in plan]
    return spark.createDataFrame(ends, "column_name string, fraction double, lo double, hi double, part double").select(
        "column_name", "fraction", _between(F.col("lo"), F.col("hi"), F.col("part")).alias("value")
    )


def _values_around(wide: DataFrame, plan: list[tuple], buckets: int) -> dict[tuple, tuple[float, float]]:
    """{(column, low, high): values at these ranks} for each (column, fraction, low, high, ...) of ``plan``."""
    spark = wide.sparkSession
    reach = 0.5 / buckets
    around = {}
    for column, fraction, *_ in plan:
        around.setdefault(column, []).extend([max(0.0, fraction - reach), min(1.0, fraction + reach)])
    if not around:
        return {}
    accuracy = max(1000, 20 * buckets)
    marks = wide.agg(*[F.approx_percentile(c, F.array(*[F.lit(f) for f in sorted(set(fs))]), accuracy).alias(c) for c, fs in around.items()]).first()
    marks = {c: dict(zip(sorted(set(fs)), marks[c])) for c, fs in around.items()}

    ranges = []  # (column, low, high, least value, greatest value); None where it is open
    for column, fraction, low, high, *_ in plan:
        begin, end = max(0.0, fraction - reach), min(1.0, fraction + reach)
        ranges.append((column, low, high, marks[column][begin] if begin > 0 else None, marks[column][end] if end < 1 else None))
    none, sums = F.lit(0).cast("long"), []
    for i, (column, _, _, least, greatest) in enumerate(ranges):
        value, all_rows = F.col(column), F.count(column)
        sums += [
            (none if least is None else F.count_if(value < F.lit(least))).alias(f"below{i}"),
            (none if least is None else F.count_if(value <= F.lit(least))).alias(f"from{i}"),
            (all_rows if greatest is None else F.count_if(value < F.lit(greatest))).alias(f"to{i}"),
            (all_rows if greatest is None else F.count_if(value <= F.lit(greatest))).alias(f"upto{i}"),
        ]
    counted = wide.agg(*sums).first()

    # A value that many rows hold is often an end of its range; only what lies between the ends is grouped.
    found, ends, inside, ranks = {}, {}, {}, []
    for i, (column, low, high, least, greatest) in enumerate(ranges):
        below, first, last, upto = (counted[f"{name}{i}"] for name in ("below", "from", "to", "upto"))
        if low < below or high >= upto:  # the quantiles were further off than they should be
            exact = value_at_ranks(wide, column, sorted({low, high}))
            found[column, low, high] = exact[low][0], exact[high][0]
            continue
        for rank in sorted({low, high}):
            if rank < first:
                ends[i, rank] = least
            elif rank >= last:
                ends[i, rank] = greatest
            else:
                value = F.col(column)
                within = value.isNotNull()
                within &= F.lit(True) if least is None else value > F.lit(least)
                within &= F.lit(True) if greatest is None else value < F.lit(greatest)
                inside[f"r{i}"] = F.when(within, value).alias(f"r{i}")
                ranks.append((f"r{i}", rank, rank - first))
    if inside:
        rows = wide.select(*inside.values()).where(F.coalesce(*inside).isNotNull())
        counts = unpivot(rows, list(inside), "value").where("value is not null").groupBy("column_name", "value").count()
        run = W.partitionBy("column_name").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
        rank_df = spark.createDataFrame(ranks, "c string, rank long, inner long")
        picked = (
            counts.withColumn("upto", F.sum("count").over(run))
            .join(F.broadcast(rank_df), F.col("column_name") == F.col("c"))
            .where((F.col("inner") < F.col("upto")) & (F.col("inner") >= F.col("upto") - F.col("count")))
        )
        ends |= {(int(r["c"][1:]), r["rank"]): r["value"] for r in picked.select("c", "rank", "value").collect()}
    for i, (column, low, high, _, _) in enumerate(ranges):
        if (column, low, high) not in found:
            found[column, low, high] = ends[i, low], ends[i, high]
    return found


def _between(low: Column, high: Column, part: Column) -> Column:
    """Interpolation that an infinite end does not spoil where it has no weight."""
    return F.when((low == high) | (part == 0), low).otherwise((1 - part) * low + part * high)


def number_or_null(column: str) -> Column:
    """The column as double, with NaN read as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value).alias(column)


def unpivot(df: DataFrame, columns: list[str], value: str, ids: list[str] | tuple = ()) -> DataFrame:
    return df.unpivot(list(ids), list(columns), "column_name", value)


def with_next(
    df: DataFrame,
    value: str,
    out: str,
    keys: list[str] | tuple = ("pair",),
    time_us: str = "ts_us",
    order: str = "seq",
    block_us: int = 3_600_000_000,
) -> DataFrame:
    """Add the value of the next row per key in the order of time and ``order``.

    Rows are grouped by key and block of time, so a busy key spreads over many tasks; the
    last row of a block takes the first value of the next block that has rows, from a
    table with one row per block. ``df`` is scanned twice and shuffled once: keys stand in as
    text and a null mark, so that the window and the join deal rows out alike.
    """
    block = F.expr(f"({time_us} - pmod({time_us}, {block_us}L)) div {block_us}L")
    stand_in = {}
    for i, key in enumerate(keys):
        stand_in |= {f"_k{i}": F.coalesce(F.col(key).cast("string"), F.lit("")), f"_n{i}": F.col(key).isNull()}
    rows = df.withColumns({**stand_in, "_block": block})
    place = [*stand_in, "_block"]
    firsts = rows.groupBy(*place).agg(F.min_by(F.struct(value), F.struct(time_us, order)).alias("_first"))
    chain = W.partitionBy(*stand_in).orderBy("_block")
    edges = firsts.select(*place, F.lead("_first").over(chain).alias("_edge"))
    inside = W.partitionBy(*place).orderBy(time_us, order)
    rows = rows.withColumn("_inside", F.lead(F.struct(value)).over(inside))
    return rows.join(edges, place, "left").select(*df.columns, F.coalesce("_inside", "_edge")[value].alias(out))
