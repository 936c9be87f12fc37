import re

from tickloom.llm import decontaminate
from tickloom.llm.decontaminate import contamination, drop_contaminated

from plain import ascii_lower


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def expected(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for length in {len(k) for k in windows}:
            for i in range(len(w) - length + 1):
                if names := windows.get(tuple(w[i : i + length])):
                    hit |= set(range(i, i + length))
                    found |= names
        out.append((doc, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def rows(found):
    return sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect()], key=str)


def pairs(df, key):
    return [(r[key], r.text) for r in df.select(key, "text").collect()]


def test_equals_brute_force(documents, benchmark):
    assert rows(contamination(documents, benchmark)) == expected(pairs(documents, "doc_id"), pairs(benchmark, "item_id"))


ITEMS = [
    (1, "only three words"),
    (2, "Only THREE words!"),
    (3, " ".join(f"t{i}" for i in range(30))),
    (4, None),
    (5, "..."),
    (6, " ".join(["same"] * 15)),
    (7, "x1"),
]
DOCS = [
    (1, "here are only three words. and only three-words again"),
    (2, " ".join(f"t{i}" for i in range(12))),
    (3, "a " * 300 + " ".join(f"t{i}" for i in range(13))),
    (4, "b " * 10 + " ".join(f"t{i}" for i in range(5, 25)) + " t26 c"),
    (5, " ".join(["same"] * 40)),
    (6, "x1"),
    (7, None),
    (7, None),
    (None, "x1 x2"),
    (8, "é only three words é"),
]


def test_windows_at_the_edges(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rows(contamination(docs, items)) == expected(DOCS, ITEMS)


def test_bit_table_of_fixed_size(spark, monkeypatch):
    """A large benchmark is filtered by a table of bits instead of exact numbers."""
    monkeypatch.setattr(decontaminate, "EXACT_TOKENS", 3)
    docs, items = spark.createDataFrame(DOCS, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rows(contamination(docs, items)) == expected(DOCS, ITEMS)


def test_odd_rows(odd, none, benchmark):
    found = contamination(odd, benchmark).collect()
    assert len(found) == odd.count() and not any(r.contaminated for r in found)
    assert contamination(none, benchmark).count() == 0
    assert contamination(odd, benchmark.limit(0)).where("n_hit = 0").count() == odd.count()
    kept = drop_contaminated(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count()
