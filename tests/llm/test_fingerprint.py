import hashlib

from pyspark.sql import functions as F

from tickloom.llm import neighbours
from tickloom.llm.fingerprint import (
    as_text, containment, distinct_shingles, edited_neighbours, fingerprints, merge, merged_by, resemblance, with_fingerprint,
)
from tickloom.llm.neighbours import with_following


def shingles(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts(documents):
    found = edited_neighbours(documents).select("doc_id", "n_chars", F.sha2("edited", 256).alias("digest"), "near_edited", "near_next")
    rows = sorted(documents.collect(), key=lambda r: -r.doc_id)
    want = {}
    for row, following in zip(rows, rows[1:] + rows[:1]):
        half = len(row.text) // 2
        edited = row.text[: len(row.text) - half] + following.text[:half]
        want[row.doc_id] = (len(row.text), hashlib.sha256(edited.encode()).hexdigest()), row.text, edited, following.text
    for r in found.collect():
        exact, text, edited, following = want.pop(r.doc_id)
        assert (r.n_chars, r.digest) == exact
        assert abs(r.near_edited - likeness(shingles(text), shingles(edited))) < 0.2
        assert abs(r.near_next - likeness(shingles(text), shingles(following))) < 0.2
    assert not want


def test_following_whatever_the_buckets(spark, monkeypatch):
    keys = [5, 3, 3, None, 10**15, -(10**15), 7, 8, 9, None] + list(range(100, 160))
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, tie bigint")
    order = sorted(rows.collect(), key=lambda r: (r.k is None, -(r.k or 0), -r.tie))
    want = {a.tie: b.tie for a, b in zip(order, order[1:] + order[:1])}
    for size in (1, 10, 4096):
        monkeypatch.setattr(neighbours, "ROWS_PER_BUCKET", size)
        found = with_following(rows.withColumn("v", F.col("tie")), "k", "tie", ["v"])
        assert {r.tie: r.next_v for r in found.collect()} == want
    one = with_following(rows.limit(1).withColumn("v", F.col("tie")), "k", "tie", ["v"]).collect()
    assert [(r.tie, r.next_v) for r in one] == [(0, 0)]


def test_estimates_are_exact_below_k_and_close_above(spark):
    sets = [(i, " ".join(f"w{j}" for j in range(i * 400, i * 400 + n))) for i, n in enumerate((3, 5, 40, 3000))]
    near = [(9, " ".join(f"w{j}" for j in range(1200, 3300)))]
    rows = with_fingerprint(spark.createDataFrame(sets + near, "i int, text string"), "text", "f").select("i", "f", distinct_shingles("f").alias("n")).collect()
    count = {r.i: r.n for r in rows}
    assert (count[0], count[1], count[2]) == (1, 1, 36)
    assert abs(count[3] / 2996 - 1) < 0.35
    a, b = ({r.i: r.f for r in rows}[i] for i in (3, 9))
    pair = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>")
    got = pair.select(resemblance("a", "b").alias("r"), containment("b", "a").alias("c"), resemblance("a", "a").alias("same")).first()
    truth = likeness(shingles(sets[3][1]), shingles(near[0][1]))
    assert abs(got.r - truth) < 0.15 and got.c > 0.75 and got.same == 1


def test_parts_merge_into_the_whole(spark):
    parts = [("a", " ".join(f"w{j}" for j in range(i * 50, i * 50 + 90))) for i in range(12)] + [("b", "one two"), ("b", None)]
    rows = with_fingerprint(spark.createDataFrame(parts, "g string, text string").fillna(""), "text", "fingerprint")
    merged = {r.g: r.fingerprint for r in merged_by(rows, ["g"]).collect()}
    for group in "ab":
        hashes = {h for r in rows.where(F.col("g") == group).collect() for h in r.fingerprint}
        assert merged[group] == sorted(hashes)[:128]
    two = rows.where("g = 'a'").limit(2).collect()
    pair = spark.createDataFrame([(two[0].fingerprint, two[1].fingerprint)], "a array<bigint>, b array<bigint>")
    assert pair.select(merge("a", "b").alias("m")).first().m == sorted({*two[0].fingerprint, *two[1].fingerprint})[:128]


def test_odd_rows(odd, none):
    found = fingerprints(odd).select("doc_id", "text", as_text("fingerprint").alias("f")).collect()
    assert len(found) == odd.count()
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text, r.f) == r.f
    assert by_text[""] == by_text[" \t\n\r "] == "" and len(by_text["one"]) == 16
    edited = edited_neighbours(odd).collect()
    assert len(edited) == odd.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in edited)
    assert edited_neighbours(none).count() == 0
