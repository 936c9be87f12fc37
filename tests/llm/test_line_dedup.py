import collections
import random
import re

from tickloom import session
from tickloom.llm import line_dedup
from tickloom.llm.line_dedup import drop_repeated_lines, repeated_lines
from tickloom.llm.prefilter import bit_table, marked


def shingles(line):
    return frozenset(line[m.start() : m.start() + 10] for m in re.finditer(r"\S+\s*", line))


def expected(docs):
    """{doc_id: numbers of the lines to drop} by comparing all pairs of distinct lines."""
    places = collections.defaultdict(list)
    for doc, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            if line := line.lower().strip(" \t\r"):
                places[line].append((doc, i))
    lines = list(places)
    sets, parent = [shingles(line) for line in lines], list(range(len(lines)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if min(len(a), len(sets[j])) >= 3 and both >= 0.8 * (len(a) + len(sets[j]) - both) - 1e-9:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = collections.defaultdict(list)
    for i, line in enumerate(lines):
        groups[root(i)] += places[line]
    drop = collections.defaultdict(list)
    for group in groups.values():
        for doc, i in sorted(group)[1:]:
            drop[doc].append(i)
    return {doc: sorted(found) for doc, found in drop.items()}


def corpus(seed=2, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    stock = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 6, 20, 40, 60]))] for _ in range(70)]
    docs = []
    for doc in range(n):
        lines = []
        for _ in range(rng.randint(1, 9)):
            line = list(rng.choice(stock))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(rng.choice([" ".join(line), " ".join(line).upper(), "  " + " ".join(line) + " \r", ""]))
        docs.append((doc, "\n".join(lines)))
    return docs


def found(spark, docs):
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    return {r.doc_id: r.lines for r in repeated_lines(rows).collect()}


def agreement(got, want):
    lines = lambda x: {(d, i) for d, found_ in x.items() for i in found_}
    got, want = lines(got), lines(want)
    return len(got & want) / max(len(got | want), 1)


def test_equals_all_pairs(spark):
    docs = corpus()
    assert agreement(found(spark, docs), expected(docs)) >= 0.98  # banding may miss one pair in 200 at the threshold


def test_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    docs = corpus(4, 80)
    assert agreement(found(spark, docs), expected(docs)) >= 0.95


def test_documents(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = expected(docs)
    assert agreement(found(spark, docs), want) >= 0.99


def test_texts(spark):
    long = " ".join(f"word{i}" for i in range(40))
    docs = [
        (1, f"first\n\n{long}\nlast\n"),
        (2, f"other\r\n{long} more\r\n\r\nfirst"),
        (3, "FIRST\nlast"),
        (4, "alone\nalone"),
        (5, ""),
        (6, None),
    ]
    rows = spark.createDataFrame([(d, t, -1) for d, t in docs], "doc_id bigint, text string, n_chars int")
    kept = {r.doc_id: (r.text, r.n_chars) for r in drop_repeated_lines(rows).collect()}
    assert kept == {1: (docs[0][1], -1), 2: ("other\r\n\r", 8), 4: ("alone", 5), 5: ("", -1), 6: (None, -1)}
    all_rows = drop_repeated_lines(rows, drop_empty=False).where("doc_id = 3").collect()
    assert [(r.text, r.n_chars) for r in all_rows] == [("", 0)]


def test_odd_rows(odd, none):
    kept = drop_repeated_lines(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "None", "6", "7", "8", "9", "9"])
    assert drop_repeated_lines(none).count() == 0


def test_prefilter_lets_all_partners_through(spark):
    rows, keys = spark.range(5000).selectExpr("id as h"), spark.range(0, 5000, 7).selectExpr("id as h")
    table = bit_table(keys, "h")
    passed = {r.h for r in marked(rows, "h", table).where("maybe").collect()}
    assert set(range(0, 5000, 7)) <= passed and len(passed) < 900


def whole(line):
    """Shingles at words and at every place of longer words, or everywhere in a line that has few."""
    found = set()
    for m in re.finditer(r"\S+", line):
        found |= {line[m.start() + i : m.start() + i + 10] for i in range(max(len(m.group()) - 9, 1))}
    if len(found) < 3:
        found = {line[i : i + 10] for i in range(len(line) - 9)}
    return frozenset(found)


def test_characters_past_the_tenth_of_a_word(spark, monkeypatch):
    monkeypatch.setitem(globals(), "shingles", whole)
    rng = random.Random(6)
    han = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(120))
    docs = [
        (1, "GET /api/v1/users/1001 HTTP/1.1"),
        (2, "GET /api/v1/users/2002 HTTP/1.1"),
        (3, han),
        (4, han[:50] + "x" + han[50:]),
        (5, f"{han[:20]}{han[90:]} {han[5:40]}"),
        (6, "abcdefghij klmnopqrst"),
        (7, "abcdefghij klmnopqrsu"),
        (8, "abcdefghij klmnxxxxxx"),
    ]
    assert expected(docs) == {4: [0], 7: [0]}
    assert found(spark, docs) == {4: [0], 7: [0]}


def test_unspaced_lines_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setitem(globals(), "shingles", whole)
    rng = random.Random(8)
    stock = ["".join(chr(rng.randrange(0x3041, 0x3097)) for _ in range(rng.choice([30, 90, 200]))) for _ in range(40)]
    docs = []
    for doc in range(120):
        line = list(rng.choice(stock))
        for _ in range(rng.choice([0, 1, 1, 2])):
            line.insert(rng.randrange(len(line)), "-")
        docs.append((doc, "".join(line)))
    assert agreement(found(spark, docs), expected(docs)) >= 0.97


def test_bucket_of_many_components(spark, monkeypatch):
    """Templated lines: most meet in buckets of the template's shingles alone, of far more components than rounds,
    and each has its partner there."""
    monkeypatch.setattr(line_dedup, "RUN", 1)
    monkeypatch.setattr(line_dedup, "BANDS", 2)
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    template, docs = [word() for _ in range(32)], []
    for i in range(40):
        own = [word() for _ in range(7)]
        docs += [(2 * i, " ".join(template + own[:6])), (2 * i + 1, " ".join(template + own[1:]))]
    assert len(expected(docs)) == 40
    assert found(spark, docs) == expected(docs)


def test_lines_are_trimmed_of_blanks_only(spark):
    """Only lines that begin or end with a blank are trimmed character by character; others are as they were."""
    from pyspark.sql import functions as F

    lines = ["", " ", " \t\r", "a", " a", "A\r", "\ta b \r", "\x0ba", "a ", " a  ", " a ", "\x0b"]
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id bigint, text string")
    got = {r.doc_id: r.line for r in line_dedup._lines(rows, "doc_id", "text").collect()}
    assert got == {i: kept for i, line in enumerate(lines) if (kept := line.lower().strip(" \t\r"))}
    cases = line_dedup._lines(rows, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert cases.count("CASE WHEN") == 2 and cases.count("trim(") == 2
    line = F.col("line")
    whole = rows.select(line_dedup._trimmed(F.col("text"), F.col("text")).alias("line")).where(line != "").count()
    assert whole == len(got)


def test_buckets_that_form_again_need_no_filter(spark):
    """The lines of large buckets give the same pairs with and without the filter, which costs two tables a round."""
    rows = [(b, 10 * b + i) for b, n in ((1, 1), (2, 2), (3, 12), (4, 13), (5, 9)) for i in range(n)]
    buckets = spark.createDataFrame(rows, "bucket bigint, h1 bigint")
    got = [[sorted(map(tuple, part.collect())) for part in line_dedup._candidates(buckets, sparse)] for sparse in (True, False)]
    assert got[0] == got[1]
    pairs, stars, large = got[0]
    assert len(pairs) == 1 + 66 + 36 and stars == [(4, 40, 40 + i) for i in range(1, 13)] and len(large) == 13


def test_components_are_looked_for_once(spark, monkeypatch):
    """After the links of the buckets, only those between components are looked at again, with new labels or without."""
    monkeypatch.setattr(line_dedup, "RUN", 1)
    monkeypatch.setattr(line_dedup, "BANDS", 2)
    monkeypatch.setattr(line_dedup, "SMALL", 2)
    looked, components = [], line_dedup.connected_components
    monkeypatch.setattr(line_dedup, "connected_components", lambda edges: looked.append(edges.count()) or components(edges))
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    template, docs = [word() for _ in range(32)], []
    for i in range(20):
        own = [word() for _ in range(7)]
        docs += [(3 * i, " ".join(template + own[:6])), (3 * i + 1, " ".join(template + own[1:])), (3 * i + 2, " ".join(template + own[1:6]))]
    for few, calls in ((1000, 2), (-1, 3)):
        looked.clear()
        monkeypatch.setattr(line_dedup, "FEW", few)
        assert found(spark, docs) == expected(docs)
        assert len(looked) == calls


def test_prefixes(spark):
    rng = random.Random(3)
    sets = {h1: sorted(rng.sample(range(60), rng.randint(3, 12))) for h1 in range(1, 25)}
    near = spark.createDataFrame([(h1, h1 + 100, s) for h1, s in sets.items()], "h1 bigint, id bigint, shingles array<bigint>")
    counts = collections.Counter(t for s in sets.values() for t in s)
    want = set()
    for h1, s in sets.items():
        order = sorted(s, key=lambda t: (counts[t], t))[: len(s) - -(-4 * len(s) // 5) + 1]
        want |= {(t, h1, len(s), at) for at, t in enumerate(order) if counts[t] > 1}
    assert set(map(tuple, line_dedup._prefixes(near.select("h1"), near).collect())) == want


def test_tables_on_the_way_are_removed(spark, tmp_path, monkeypatch):
    """Only what the result is read from is left in the shared folder."""
    monkeypatch.setattr(session, "work_dir", lambda _: str(tmp_path))
    rows = spark.createDataFrame(corpus(4, 40), "doc_id bigint, text string")
    left = drop_repeated_lines(rows)
    assert [path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()] == ["dropped"]
    before = {r.doc_id: r.text for r in left.collect()}
    assert before and before == {r.doc_id: r.text for r in drop_repeated_lines(rows).collect()}


def test_texts_of_candidates_are_shuffled_once(spark, monkeypatch):
    """Of a candidate's copies only the one in its first document is kept with its text, and the texts are grouped as
    they were dealt for the join; a pair is intersected once."""
    tables, plans = {}, {}

    def stored(df, name):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        tables.setdefault(name, []).append(session.stored(df, name))
        return tables[name][-1]

    monkeypatch.setattr(line_dedup, "stored", stored)
    monkeypatch.setattr(line_dedup, "discard", lambda table: None)
    long = " ".join(f"word{i}" for i in range(40))
    docs = [(i, f"{long}\n{long}\nown line {i}" if i < 30 else f"{long} more") for i in range(31)]
    assert found(spark, docs) == expected(docs)
    texts = tables["places"][0].where("line is not null").select("doc_id", "line_no")
    assert sorted(map(tuple, texts.collect())) == [(0, 0), (0, 1), (30, 0)]
    near = tables["shingles"][0]
    assert near.count() == near.select("h1", "h2").distinct().count() == 2
    assert plans["links"].count("array_intersect") == 1


def test_blank_documents_go_and_odd_blanks_stay(spark):
    texts = ["same line", "same line", "same line\n\t\r ", "same line\n\x0b", "same line\n\u00a0", "same line\nx"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {r.doc_id: r.text for r in drop_repeated_lines(rows).collect()}
    assert kept == {0: "same line", 3: "\x0b", 4: "\u00a0", 5: "x"}


def test_tables_of_a_step_go_when_it_is_over(spark, tmp_path, monkeypatch):
    """The lines with their bands and the buckets' first tables are gone before the pairs are confirmed."""
    monkeypatch.setattr(session, "work_dir", lambda _: str(tmp_path))
    there, stored = {}, line_dedup.stored

    def seen(df, name):
        there.setdefault(name, {path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()})
        return stored(df, name)

    monkeypatch.setattr(line_dedup, "stored", seen)
    drop_repeated_lines(spark.createDataFrame(corpus(4, 40), "doc_id bigint, text string"))
    assert "lines" in there["places"] and not there["shingles"] & {"lines", "shared", "some"}
