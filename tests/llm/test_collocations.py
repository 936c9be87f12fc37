import re
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import collocations as module
from tickloom.llm.collocations import collocations, phrase_counts, three_way_quicksort

from plain import ascii_lower

DOCS = "lang string, text string"


def expected_counts(docs):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, totals


def expected(docs, least, top):
    counts, totals = expected_counts(docs)
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    best = {}
    for (lang, w), a in found.items():
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        inside = [b for (other, v), b in found.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if all(100 * b < 80 * a for b in inside):
            best.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang, rows in best.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def drawn(seed, n=150):
    rng = np.random.default_rng(seed)
    words = ["The", "of", "a", "ß", "New", "york", "x\x00y", "co-op", "é"]
    docs = []
    for _ in range(n):
        some = [words[i] for i in rng.choice(len(words), rng.integers(0, 40), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])]
        text = "".join(w + str(rng.choice([" ", "  ", "\t", ". ", "\n", " , ", ";"], p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])) for w in some)
        docs.append((rng.choice(["en", "de"]), text + "New York Stock Exchange " * int(rng.integers(0, 3))))
    return [(str(lang), text) for lang, text in docs]


@pytest.mark.parametrize("hot", [module.HOT, 20])
def test_equals_all_windows(spark, monkeypatch, hot):
    """Also where many pairs are routed by all their words."""
    monkeypatch.setattr(module, "HOT", hot)
    docs = drawn(3) + [(None, "one two three four five " * 20), ("und", "one two")]
    table = spark.createDataFrame(docs, DOCS)
    got = sorted(tuple(r) for r in collocations(table, least=10, top=12).collect())
    assert got == expected(docs, 10, 12)
    counts, totals = phrase_counts(table, least=10)
    want, words = expected_counts(docs)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.n for r in counts.collect()} == {k: n for k, n in want.items() if n >= 10}
    assert {r.lang: r.n for r in totals.collect()} == words


def test_full_bit_tables_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module, "MOST_BITS", 64)
    docs = drawn(4, 60)
    got = sorted(tuple(r) for r in collocations(spark.createDataFrame(docs, DOCS), least=10, top=50).collect())
    assert got == expected(docs, 10, 50)


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 4, (400, 4))
    rows[rng.random(400) < 0.3, 3] = -1
    weights = rng.integers(1, 5, 400)
    want = Counter()
    for row, weight in zip(rows.tolist(), weights.tolist()):
        for depth in range(4 if row[3] >= 0 else 3):
            want[tuple(row[: depth + 1])] += weight
    for least in (1, 12):
        got = {tuple(rows[at, : depth + 1].tolist()): n for at, depth, n in three_way_quicksort(rows, weights, np.full(4, least))}
        assert got == {k: n for k, n in want.items() if n >= least}


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 2**43
    table = [("en", "a", 3 * big), ("en", "b", 2 * big), ("en", "a b", 2 * big - 1)]
    counts = spark.createDataFrame(table, "lang string, phrase string, n bigint")
    totals = spark.createDataFrame([("en", 2**62)], "lang string, n bigint")
    monkeypatch.setattr(module, "phrase_counts", lambda *_: (counts, totals))
    (row,) = collocations(counts).collect()
    assert row.score == 2_000_000 * (2 * big - 1) // (5 * big)


def test_odd_rows(spark, odd, none):
    got = sorted(tuple(r) for r in collocations(odd).collect())
    docs = [(r.lang, r.text) for r in odd.collect()]
    assert got == expected(docs, 30, 2000) and any(r[2] == "word word word word" for r in got)
    assert collocations(none).count() == 0
    assert collocations(odd.where("text = ''")).count() == 0
