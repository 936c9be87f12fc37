import hashlib
import importlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from compare import connect, differences  # noqa: E402

from tickloom.llm import sql  # noqa: E402
from tickloom.llm.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op3_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op5_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_pieces": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op10_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op11_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op12_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13_quality": ["doc_id", "held_out", "score", "predicted"],
}
# Rows that are not one for each document or conversation.
OF_GROUPS = ("op11_prefix_trie", "op12_collocations")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert got.columns[: len(CONTRACT.get(name, []))].tolist() == CONTRACT.get(name, [])
    if name not in OF_GROUPS:
        key = "conv_id" if name.startswith("op10") else "doc_id"
        table = "conversations" if name.startswith("op10") else "documents"
        ids = connect(FOLDER).execute(f"select distinct {key} from {table}").df()[key]
        assert sorted(got[key]) == sorted([*ids, -1] if name.startswith("op10") else ids)
    if name in sql.SQL:
        assert differences(got, connect(FOLDER).execute(sql.SQL[name]).df()) == ""


def test_decoded_texts_are_the_texts(spark):
    """Texts without the blank's stand-in come back as they were."""
    digests = {r.doc_id: r.decoded_sha256 for r in QUERIES["op6_pieces"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        assert digests[r.doc_id] == hashlib.sha256(r.text.encode()).hexdigest()


def test_pipeline(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = pipeline.run(spark, FOLDER).collect()
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "pieces"]
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and 0.8 * docs.count() < len(ids) < docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.text, []).append(r.doc_id)
    for copies in texts.values():
        assert sum(i in ids for i in copies) <= 1


def test_pipeline_on_odd_rows(spark, odd, none):
    pipeline = importlib.import_module("corpus_pipeline")
    for table in (odd, none):
        for name, stage in pipeline.STAGES[:-1]:
            assert stage(spark, table, FOLDER).columns == table.columns
        assert pipeline.STAGES[-1][1](spark, table, FOLDER).count() == table.count()
