"""A filter of fixed size for one side of a join whose other side is far smaller.

The keys of the small side set bits in a table of ``BITS`` bits, kept as rows (word, bits), so it has at
most ``BITS / 64`` rows whatever the data and may be broadcast. Rows of the large side whose bit is not
set have no partner and need not be shuffled. With more keys than bits it lets everything pass;
results never depend on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 24


def _place(hashed: Column) -> Column:
    return F.pmod(F.xxhash64(hashed), F.lit(BITS))


def bit_table(keys: DataFrame, hashed: str) -> DataFrame:
    place = keys.select(_place(F.col(hashed)).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    return place.select((F.col("place") / 64).cast("int").alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))


def marked(rows: DataFrame, hashed: str, table: DataFrame, name: str = "maybe") -> DataFrame:
    """``rows`` and whether each may have a partner."""
    place = _place(F.col(hashed))
    rows = rows.withColumn("__place", place)
    joined = rows.join(F.broadcast(table), (F.col("__place") / 64).cast("int") == F.col("__word"), "left")
    hit = F.expr("coalesce((shiftrightunsigned(__bits, cast(__place % 64 as int)) & 1L) = 1L, false)")
    return joined.withColumn(name, hit).drop("__place", "__word", "__bits")
