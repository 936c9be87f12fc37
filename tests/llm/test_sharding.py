import os

import pytest
from pyspark.sql import functions as F

from tickloom.llm.sharding import ROW_BYTES, shards, write_shards


def check(rows, limit):
    found = shards(rows, max_bytes=limit).collect()
    assert len(found) == rows.count()
    assert sum(r.bytes for r in found) == sum(len((r.text or "").encode()) + ROW_BYTES for r in rows.collect())
    members = {}
    for r in found:
        members.setdefault(r.prefix, []).append(r)
        assert len(r.prefix) == r.depth
    for prefix, group in members.items():
        fits = sum(r.bytes for r in group) <= limit
        assert fits or (len(group) == 1 and group[0].oversized)
        assert fits != group[0].oversized
        assert not any(other != prefix and other.startswith(prefix) for other in members)
    # Only buckets that were too large have been split.
    total = {}
    for r in found:
        for depth in range(r.depth + 1):
            total[r.prefix[:depth]] = total.get(r.prefix[:depth], 0) + r.bytes
    for prefix in members:
        if len(prefix) > 4:
            assert total[prefix[:-1]] > limit
    return members


@pytest.mark.parametrize("limit", [4_000, 60_000, 1 << 30])
def test_every_shard_fits(documents, limit):
    check(documents, limit)


def test_one_key_with_most_rows(spark):
    rows = spark.range(600).select(F.lit(7).cast("bigint").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"))
    more = spark.createDataFrame([(None, "y" * 5000), (None, None), (3, ""), (3, "é")], "doc_id bigint, text string")
    assert len(check(rows.unionByName(more), 2000)) > 40


def test_a_shard_is_the_same_when_others_split(spark, documents):
    one = {r.doc_id: r.prefix for r in shards(documents, max_bytes=60_000).collect()}
    big = spark.createDataFrame([(10**9, "z" * 59_000)], "doc_id bigint, text string")
    two = {r.doc_id: r.prefix for r in shards(documents.select("doc_id", "text").unionByName(big), max_bytes=60_000).collect()}
    home = two[10**9]
    assert all(two[d] == p for d, p in one.items() if not home.startswith(p) and not p.startswith(home[:4]))


def test_odd_rows_and_files(odd, none, documents, tmp_path):
    check(odd, 3000)
    assert shards(none).count() == 0
    placed = shards(documents, max_bytes=60_000)
    write_shards(documents, placed, str(tmp_path / "out"))
    back = documents.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == documents.count()
    assert len([d for d in os.listdir(tmp_path / "out") if d.startswith("shard=")]) == placed.select("prefix").distinct().count()


def test_repeated_keys_are_written_once_each(spark, tmp_path):
    rows = [(1, "x" * 900)] * 3 + [(1, "y" * 100), (None, "z" * 900), (None, "z" * 900), (2, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    placed = shards(docs, max_bytes=1000)
    write_shards(docs, placed, str(tmp_path / "out"))
    back = spark.read.option("basePath", str(tmp_path / "out")).schema("doc_id bigint, text string, shard string").parquet(str(tmp_path / "out"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in back.collect()))) == sorted(map(str, rows))
    sizes = {}
    for r in back.collect():
        sizes[r.shard] = sizes.get(r.shard, 0) + len(r.text or "") + ROW_BYTES
    assert max(sizes.values()) <= 1000
