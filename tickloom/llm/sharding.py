"""Sharding by extendible hashing: shards are buckets of a hash-prefix directory.

A row's address is the hash of its key, followed, for keys that share a hash, by the hash of a row
number. The directory begins with ``START_BITS`` bits. Only buckets above the byte limit are
split, on their next bit, until every bucket fits. A bucket is known by its depth (number of
bits) and its prefix, which together are its shard id; shards that had no need to split keep
theirs when others do.

Each round adds up bytes per bucket, for the rows of buckets that are still too large only, over
``STEP_BITS`` further bits at once, and splits as far as needed. Sums are grouped before they are
shuffled, so a bucket with a third of all rows costs no task more than another. The directory
stays a table; rows find their bucket by a join for each round.

Defined results: a null or empty text has no bytes but still counts ``ROW_BYTES`` for its row. A null key is a
key like any other. Repeated rows and ids are told apart by their row numbers. A single row above
the limit is a shard of its own and is marked ``oversized``. An empty table has no shards. Other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.tables import stored

MAX_BYTES = 32 << 20
ROW_BYTES = 16
START_BITS = 4
STEP_BITS = 8
KEY_BITS = 64  # bits of the address that come from the key; as many more from the row number


def _prefix(depth: int):
    """First ``depth`` bits of the address, as a pair of numbers."""
    part = lambda column, bits: F.lit(0).cast("bigint") if bits <= 0 else F.shiftrightunsigned(column, 64 - bits) if bits < 64 else F.col(column)
    return part("a1", min(depth, KEY_BITS)), part("a2", depth - KEY_BITS)


def shards(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, row (its number), bytes, depth, prefix (bits as text), oversized."""
    rows = docs.select(docs[key].alias("doc_id"), (F.coalesce(F.octet_length(docs[text].cast("string")), F.lit(0)) + ROW_BYTES).cast("bigint").alias("bytes"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumns({"a1": F.xxhash64("doc_id"), "a2": F.xxhash64("row", F.lit("row"))})
    rows = stored(rows, "addresses")
    open_rows, settled, depth = rows, None, START_BITS
    while True:
        last = depth >= KEY_BITS + 64
        found = _split(open_rows, depth, max_bytes, last)
        found = stored(found, "buckets")
        done = found.where("final").drop("final", "p1", "p2")
        settled = done if settled is None else settled.unionByName(done)
        open_rows = found.where("not final").select("doc_id", "bytes", "row", "a1", "a2")
        if last or open_rows.isEmpty():
            break
        depth = min(depth + STEP_BITS, KEY_BITS + 64)
    return settled.select("doc_id", "row", "bytes", "depth", "prefix", "oversized")


def _split(rows: DataFrame, depth: int, max_bytes: int, last: bool) -> DataFrame:
    """Rows with the shallowest bucket from ``depth`` to ``depth + STEP_BITS - 1`` bits that fits; not final
    where none does."""
    deepest = depth if last else min(depth + STEP_BITS - 1, KEY_BITS + 64)
    p1, p2 = _prefix(deepest)
    sums = stored(rows.select(p1.alias("p1"), p2.alias("p2"), "bytes").groupBy("p1", "p2").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")), "sums")
    # Bytes of every ancestor of a deepest bucket; the shallowest one that fits is the shard.
    chosen = sums.select("p1", "p2")
    fits = []
    for bits in range(depth, deepest + 1):
        up1, up2 = (F.shiftrightunsigned("p1", max(min(deepest, KEY_BITS) - min(bits, KEY_BITS), 0)), F.shiftrightunsigned("p2", max(deepest - max(bits, KEY_BITS), 0)) if deepest > KEY_BITS else F.col("p2"))
        if bits <= KEY_BITS:
            up2 = F.lit(0).cast("bigint")
        level = sums.select(up1.alias("u1"), up2.alias("u2"), "bytes", "n").groupBy("u1", "u2").agg(F.sum("bytes").alias("b"), F.sum("n").alias("c"))
        level = level.select("u1", "u2", ((F.col("b") <= max_bytes) | (F.col("c") == 1)).alias(f"fits{bits}"), (F.col("b") > max_bytes).alias(f"over{bits}"))
        chosen = chosen.withColumns({"u1": up1, "u2": up2}).join(level, ["u1", "u2"]).drop("u1", "u2")
        fits.append(bits)
    at, over = F.lit(None).cast("int"), F.lit(False)
    for bits in reversed(fits):
        at = F.when(F.col(f"fits{bits}"), F.lit(bits)).otherwise(at)
        over = F.when(F.col(f"fits{bits}"), F.col(f"over{bits}")).otherwise(over)
    if last:
        at, over = F.coalesce(at, F.lit(deepest)), over | ~F.col(f"fits{deepest}")
    chosen = chosen.select("p1", "p2", at.alias("depth"), over.alias("oversized"))
    placed = rows.withColumns({"p1": p1, "p2": p2}).join(chosen, ["p1", "p2"])
    bits = F.concat(F.lpad(F.bin("a1"), 64, "0"), F.lpad(F.bin("a2"), 64, "0"))
    return placed.withColumns({"final": F.col("depth").isNotNull(), "prefix": F.substring(bits, F.lit(1), F.coalesce("depth", F.lit(0)))})


def write_shards(docs: DataFrame, placed: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` with their shard as a partitioned Parquet table, one task per shard. Rows that share a
    key are dealt to the places of that key with as many bytes, one each."""
    bytes_ = (F.coalesce(F.octet_length(docs[text].cast("string")), F.lit(0)) + ROW_BYTES).cast("bigint")
    names = ["__key", "__bytes"]
    number = lambda order: F.row_number().over(Window.partitionBy(*names).orderBy(order))
    rows = docs.withColumns({"__key": docs[key], "__bytes": bytes_}).withColumn("__n", number(F.xxhash64(text)))
    where = placed.select(F.col("doc_id").alias("__key"), F.col("bytes").alias("__bytes"), "row", F.col("prefix").alias("shard"))
    where = where.withColumn("__n", number(F.col("row"))).select(*[F.col(c).alias(f"{c}_") for c in (*names, "__n")], "shard")
    same = rows["__key"].eqNullSafe(where["__key_"]) & (rows["__bytes"] == where["__bytes_"]) & (rows["__n"] == where["__n_"])
    found = rows.join(where, same).select(*[docs[c] for c in docs.columns], "shard")
    found.repartition("shard").write.partitionBy("shard").parquet(path)
