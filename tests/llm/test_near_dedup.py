import random
import re

from pyspark.sql import functions as F

from tickloom.llm import near_dedup
from tickloom import session
from tickloom.llm.components import _settled, connected_components
from tickloom.llm.near_dedup import keep_one_of_each, near_duplicates

from plain import ascii_lower


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1)))


def expected(rows, size, similarity):
    sets = {d: shingles(t, size) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both) and both:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def families(seed=3, families=25, copies=14):
    """Chains of edited copies, some on either side of the threshold, and exact copies."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    for _ in range(families):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(2, 80))]
        for _ in range(copies):
            rows.append(" ".join(words))
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    return list(enumerate(rows))


def check(spark, rows, words, similarity):
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=words, similarity=similarity).collect()
    component, size = expected(rows, words, similarity)
    assert {r.doc_id: r.component_id for r in found} == component
    assert {r.doc_id: r.n_shingles for r in found} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_components_equal_all_pairs(spark):
    check(spark, families(), 3, 85)


def test_large_cohesive_nodes(spark, monkeypatch):
    """Nodes that branching cannot make small are compared in blocks."""
    monkeypatch.setattr(near_dedup, "NODE_LIMIT", 6)
    check(spark, families(5, 6, 40), 3, 85)


def test_documents_equal_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    check(spark, rows, 3, 85)


def test_odd_rows(spark, odd, none):
    found = near_duplicates(odd).collect()
    assert len(found) == odd.count()
    one = [r for r in found if r.doc_id in (4, 5)]
    assert {r.component_id for r in one} == {4} and sum(r.kept for r in one) == 1
    empty = [r for r in found if r.doc_id in (1, 2, 3)]
    assert all(r.n_shingles == 0 and r.kept and r.component_id == r.doc_id for r in empty)
    assert near_duplicates(none).count() == 0
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 2 and kept.where("text = 'one'").count() == 1


def test_connected_components(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame(path + star + [(7, 7), (900, 900), (3, 2), (100, 101)], "u bigint, v bigint")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {900: 900}
    assert connected_components(edges.where(F.lit(False))).count() == 0


def test_components_leave_one_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda _: str(tmp_path))
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "u bigint, v bigint")
    assert connected_components(edges).where("component = 0").count() == 41
    assert len(list(tmp_path.iterdir())) == 1


def test_settled(spark):
    settled = lambda links: _settled(spark.createDataFrame(links, "u bigint, v bigint"))
    assert settled([(2, 1), (3, 1), (9, 8)]) and settled([])
    assert not settled([(2, 1), (3, 2)]) and not settled([(3, 1), (3, 2)])


def test_one_of_each_leaves_its_keys(odd, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda _: str(tmp_path))
    kept = keep_one_of_each(odd)
    assert [path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()] == ["keys"]
    assert kept.count() == odd.count() - 2
