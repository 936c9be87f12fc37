import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm.conversation_trie import conversation_sequences, prefix_nodes

ROWS = "conv_id bigint, turn bigint, role string, text string"


def expected(conversations):
    """{(role, text) prefix: node} from {id: list of turns}, every prefix looked at by itself."""
    members = {}
    for c, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(c)
    nodes = []
    for prefix, ids in members.items():
        under = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in under if len(p) == len(prefix) + 1]
        leaves = [p for p in under if not any(q[: len(p)] == p and len(q) > len(p) for q in under)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(conversations[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        nodes.append((min(ids), len(prefix), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(nodes, key=str)


def nodes(found):
    return sorted([tuple(r) for r in found.collect()], key=str)


def table(spark, conversations):
    rows = [(c, i, role, text) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, ROWS)


def drawn(seed, n=120):
    """Conversations of few different turns, so that many share prefixes of all depths."""
    rng = np.random.default_rng(seed)
    said = [("user", "a"), ("user", "bé"), ("assistant", "a"), ("user", "")]
    out = {}
    for c in range(n):
        turns = [said[i] for i in rng.choice(len(said), rng.integers(1, 7), p=[0.6, 0.2, 0.1, 0.1])]
        out[int(rng.integers(0, 10**6))] = turns
    out[10**6] = [said[0]] * 60  # one long conversation, and most others on its way
    for c in range(40):
        out[2 * 10**6 + c] = [said[0], said[1], said[0]]  # copies
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_prefixes(spark, seed):
    conversations = drawn(seed)
    sequences = conversation_sequences(table(spark, conversations))
    want = expected(conversations)
    assert nodes(prefix_nodes(sequences)) == want
    # Many small ranges, whose paths are merged in several rounds.
    assert nodes(prefix_nodes(sequences, task_bytes=300, fan_in=3)) == want


def test_single_conversation_and_pieces_of_ids(spark, monkeypatch):
    alone = {7: [("user", "x"), ("assistant", "y")]}
    assert nodes(prefix_nodes(conversation_sequences(table(spark, alone)))) == expected(alone)
    monkeypatch.setattr("tickloom.llm.conversation_trie.ID_RUN", 8)
    copies = {c: [("user", "x")] for c in range(-20, 60, 3)}
    assert nodes(prefix_nodes(conversation_sequences(table(spark, copies)))) == expected(copies)


def test_conversation_without_turns(spark):
    sequences = spark.createDataFrame([(1, []), (2, [])], "id bigint, turns array<struct<digest:string,size:bigint>>")
    assert nodes(prefix_nodes(sequences)) == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,2").hexdigest())]


def test_odd_rows(spark):
    rows = [
        (1, 1, "user", "b"), (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (2, None, "", ""), (2, 5, "user", "a"), (2, 6, "user", "a"), (2, 7, "user", "c" * 100_000),
        (None, 0, "user", "a"), (3, 0, "use", "ra"), (4, 0, "user", "a"),
    ]
    more = [(*r, "x", 1, 2, "y") for r in rows]
    odd = spark.createDataFrame(more, ROWS + ", key string, n bigint, size int, turns string")
    a, none = ("user", "a"), ("", "")
    want = {1: [none, a, a, ("user", "b")], 2: [none, a, a, ("user", "c" * 100_000)], 3: [("use", "ra")], 4: [a]}
    assert nodes(prefix_nodes(conversation_sequences(odd))) == expected(want)
    assert prefix_nodes(conversation_sequences(odd.limit(0))).count() == 0
    assert prefix_nodes(conversation_sequences(odd.where(F.col("conv_id").isNull()))).count() == 0
