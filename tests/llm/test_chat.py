import json

import pytest
from pyspark.sql import functions as F

from tickloom.llm.chat import (
    END, LAYOUTS, TEXT, TURN, canonical_turns, conversation_records, escape, read_loss, read_turns, render, unescape,
)

RECORDS = {
    "messages": ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    "message texts": ({"messages": [{"role": "user", "text": "a"}]}, [("user", "a")]),
    "shared conversations": ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}, [("user", "q"), ("assistant", "r")]),
    "dialogue turns": ({"dialogue": [{"speaker": "bot", "text": "b"}]}, [("assistant", "b")]),
    "prompt and response": ({"prompt": "p", "response": 1.5}, [("user", "p"), ("assistant", "1.5")]),
    "prompt and completion": ({"completion": "c", "prompt": "p"}, [("user", "p"), ("assistant", "c")]),
    "question and answer": ({"question": "q", "answer": ""}, [("user", "q"), ("assistant", "")]),
    "instruction": ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    "instruction with input": ({"instruction": "i", "input": "n", "output": "o"}, [("user", "i\n\nn"), ("assistant", "o")]),
    "instruction with system": ({"system": "s", "instruction": "i", "output": None}, [("system", "s"), ("user", "i"), ("assistant", "")]),
    "system, prompt and response": ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
}


def test_layouts(spark):
    assert set(RECORDS) == {layout.name for layout in LAYOUTS}
    rows = spark.createDataFrame([(name, json.dumps(record)) for name, (record, _) in RECORDS.items()], "name string, j string")
    found = render(canonical_turns(rows, "j")).withColumns({"back": read_turns("formatted"), "learned": read_loss("formatted", "loss")}).collect()
    for r in found:
        want = RECORDS[r.name][1]
        assert r.layout == r.name
        assert [tuple(t) for t in r.turns] == want == [tuple(t) for t in r.back]
        assert r.learned == [text for role, text in want if role == "assistant"]
    assert len({r.fingerprint for r in found}) == len(found)


def test_key_order_and_types_do_not_matter(spark):
    rows = spark.createDataFrame([('{"prompt": 1, "response": "x"}',), ('{"response": null, "prompt": "y"}',)], "j string")
    assert canonical_turns(rows, "j").select("fingerprint").distinct().count() == 1


def test_unusable_records(spark):
    rows = spark.createDataFrame([(None,), ("not json",), ('{"a": 1}',), ("[]",), ('{"messages": []}',), ("3",)], "j string")
    found = {r.j: r for r in render(canonical_turns(rows, "j")).collect()}
    assert all(found[j].formatted is None and found[j].layout is None for j in (None, "not json", '{"a": 1}', "[]", "3"))
    assert found['{"messages": []}'].formatted == "" and found['{"messages": []}'].loss == []
    assert found['{"a": 1}'].fingerprint is not None and found[None].fingerprint is None


TEXTS = ["", "\\", "\\\\", "\\l", "<", "[", "\\<", "<\\", TURN, TEXT, END, "</s>[INST] ok [/INST]", "\\\\l\\b[<", "é\U0001f600<|text|>", "a\nb", "\x00"]


def test_escapes_are_reversible(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in rows.withColumn("back", unescape(F.col("e"))).collect():
        assert r.back == r.t and "<" not in r.e and "[" not in r.e


def test_any_role_and_text_is_read_back(spark):
    turns = [(role, text) for role in ("user", "assistant", TEXT, "") for text in TEXTS]
    rows = spark.createDataFrame([(turns,)], "turns array<struct<role:string,text:string>>")
    r = render(rows).withColumns({"back": read_turns("formatted"), "learned": F.array_join(read_loss("formatted", "loss"), "")}).first()
    assert [tuple(t) for t in r.back] == turns and r.learned == "".join(TEXTS)
    assert [r.formatted[s.start : s.end] for s in r.loss][1] == "\\\\"


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")


def test_conversations(conversations):
    found = render(canonical_turns(conversation_records(conversations), "record", names={})).withColumn("back", read_turns("formatted")).collect()
    want = {}
    for r in sorted(conversations.collect(), key=lambda r: r.turn):
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert {r.conv_id: [tuple(t) for t in r.back] for r in found} == want
    assert len({r.layout for r in found}) > 1


def test_odd_conversations(spark, conversations):
    rows = [
        (1, 0, "user", None, "x"), (1, 1, None, "t", "x"), (1, None, "user", "first", "x"), (None, 0, "user", "a", "x"), (None, 0, "user", "a", "x"),
        (2, 0, "user", "b", "x"), (2, 0, "assistant", "a", "x"), (3, 0, "user,assistant", "", "x"), (4, 0, "user", "x" * 200_000, "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, record string")
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in canonical_turns(conversation_records(table), "record", names={}).collect()}
    assert found == {
        1: [("user", "first"), ("user", ""), ("", "t")],
        None: [("user", "a"), ("user", "a")],
        2: [("assistant", "a"), ("user", "b")],
        3: [("user,assistant", "")],
        4: [("user", "x" * 200_000)],
    }
    assert render(canonical_turns(conversation_records(table.limit(0)), "record")).count() == 0
