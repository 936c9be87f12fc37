"""The row that follows each row in the order of a key, without putting all rows in one order.

The key's range is cut into many buckets by approximate quantiles. Within a bucket a window gives
the next row. The first row of each bucket is also sent to the bucket before it, whose last
row it follows; which rows these are is known from one grouped maximum before anything is moved.
So rows are shuffled once, and only one row per bucket twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window, functions as F

ROWS_PER_BUCKET = 4096
LEAST = -(2**63)


def _numbers(values: list[int]):
    """A constant array; as JSON it is folded into one literal however long it is."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def with_following(rows: DataFrame, key: str, tie: str, columns: list[str]) -> DataFrame:
    """``rows`` with the ``columns`` of the next row in descending order of ``key`` (then of
    ``tie``), each named ``next_<column>``. After the last row comes the first; a null key is
    last; a single row follows itself. ``key`` and ``tie`` are bigint."""
    spark = rows.sparkSession
    rows = rows.withColumn("__key", F.coalesce(key, F.lit(LEAST)))
    keys = rows.select("__key")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(8 * partitions, keys.count() // ROWS_PER_BUCKET)
    shares = F.from_json(F.lit(json.dumps([i / buckets for i in range(1, buckets)])), "array<double>")
    cuts = keys.agg(F.percentile_approx("__key", shares, F.lit(20 * buckets)).alias("cuts")).first().cuts
    cuts = sorted(set(cuts or []))

    # Number of cuts below the key, by halving.
    steps = F.from_json(F.lit(json.dumps([1 << j for j in range(len(cuts).bit_length(), -1, -1)])), "array<int>")
    at = lambda low, step: F.get(_numbers(cuts), low + step - 1)
    bucket = F.aggregate(
        steps, F.lit(0), lambda low, step: F.when((low + step <= len(cuts)) & (at(low, step) < F.col("__key")), low + step).otherwise(low)
    )
    firsts = {r.b: r.top for r in keys.groupBy(bucket.alias("b")).agg(F.max("__key").alias("top")).collect()}
    filled = sorted(firsts)
    before = dict(zip(filled, filled[1:] + filled[:1]))
    tops = _numbers([firsts.get(b, LEAST) for b in range(len(cuts) + 1)])
    goes_to = F.get(_numbers([before.get(b, 0) for b in range(len(cuts) + 1)]), F.col("__bucket")).cast("int")

    rows = rows.withColumn("__bucket", bucket)
    twice = F.when(
        F.col("__key") == F.get(tops, F.col("__bucket")),
        F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("again")), F.struct(goes_to.alias("b"), F.lit(True).alias("again"))),
    ).otherwise(F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("again"))))
    dealt = rows.withColumn("__to", F.explode(twice))
    order = Window.partitionBy("__to.b").orderBy("__to.again", F.desc("__key"), F.desc(tie))
    found = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return found.where(~F.col("__to.again")).drop("__key", "__bucket", "__to")
