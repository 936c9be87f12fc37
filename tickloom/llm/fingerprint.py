"""Document fingerprints: bottom-k sketches of hashed word shingles.

A text's shingles are its runs of five words (lower-cased, split at spaces and control spaces); a
text with fewer words has its whole word sequence as its only shingle. The fingerprint is
the ``k`` smallest distinct 64-bit shingle hashes in ascending order. Fingerprints of parts merge
into the fingerprint of the whole: the ``k`` smallest of all. Estimates:

* resemblance: among the k smallest hashes of both together, the share that is in both;
* containment of a in b: resemblance times the distinct count of both together over that of a;
* distinct shingles: (k - 1) over the k-th smallest hash as a fraction of the range; exact below k.

Everything is SQL functions; hashes stay in arrays, and arrays that later expressions read
often are columns of their own, so that they are made once.

Defined results: a null or empty text, or one without words, has the empty fingerprint. Two empty
fingerprints resemble each other fully (1), an empty and another one not at all (0). Equal texts
have equal fingerprints. Repeated rows each get theirs. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.neighbours import with_following
from tickloom.llm.tables import text_rows

WORDS = 5
K = 128
SPACES = r"[\x09-\x0D\x20]+"


def with_fingerprint(rows: DataFrame, text: str, name: str, words: int = WORDS, k: int = K) -> DataFrame:
    """``rows`` and the fingerprint of the column ``text`` as array<bigint> ``name``."""
    hashes, shingles = f"__{name}_words", f"__{name}_shingles"
    parts = F.filter(F.split(F.lower(F.col(text)), SPACES), lambda w: w != "")
    rows = rows.withColumn(hashes, F.transform(parts, lambda w: F.xxhash64(w)))
    shifted = [F.slice(F.col(hashes), i + 1, F.greatest(F.size(hashes) - (words - 1), F.lit(0))) for i in range(words)]
    joined = F.transform(F.arrays_zip(*[s.alias(f"w{i}") for i, s in enumerate(shifted)]), lambda z: F.xxhash64(z))
    whole = F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(hashes)))
    rows = rows.withColumn(shingles, F.when(F.size(hashes) >= words, joined).otherwise(whole))
    rows = rows.withColumn(name, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k))
    return rows.drop(hashes, shingles)


def merge(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Fingerprint of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of both."""
    both = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    all_of = F.least(F.size(F.array_union(a, b)), F.lit(k))
    return F.when(all_of == 0, F.lit(1.0)).otherwise(both / all_of)


def distinct_shingles(a: str | Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact where there are fewer than k."""
    a = F.col(a) if isinstance(a, str) else a
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: str | Column, b: str | Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    own = distinct_shingles(a, k)
    found = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k) / own
    return F.when(own == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), found))


def merged_by(rows: DataFrame, by: list[str], fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """Fingerprint of each group of rows. Every task first reduces each group to its k least hashes,
    so a group with a third of all rows is no more than k rows from each task."""
    hashes = rows.select(*by, F.explode(fingerprint).alias("__hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("__hash"))
    least = hashes.withColumn("__rank", rank).where(F.col("__rank") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("__hash")).alias(fingerprint))


def as_text(fingerprint: str | Column) -> Column:
    """Sixteen hexadecimal digits per hash."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, text_hash and fingerprint of every row of ``docs``."""
    return with_fingerprint(text_rows(docs, key, text), "text", "fingerprint")


def edited_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``fingerprints`` with the fingerprint of each text's edited form, in which the last half
    gives way to the beginning of the document that follows in descending order of the (integer)
    key, and with the likeness of the text to its edited form and to that document."""
    rows = fingerprints(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = with_following(rows, "doc_id", "text_hash", ["text", "fingerprint"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half))
    )
    rows = rows.drop("text", "next_text")
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    return rows.withColumns(
        {
            "near_edited": resemblance("fingerprint", "edited_fingerprint"),
            "near_next": resemblance("fingerprint", "next_fingerprint"),
        }
    )
