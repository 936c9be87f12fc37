import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm.pieces import Encoder, Vocabulary, encode_pieces, token_numbers

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Vocabulary.read(PATH))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(encoder, library, text):
    ids, decoded = encoder.encode(text)
    want = library.encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
    assert decoded == library.decode(want), repr(text)


PARTS = [
    "a", "e", "t", "h", "the", "ing", " ", "  ", "    ", "\n", "\t", "é", "ß", "日", "\U0001f600", "▁", "</s>", "<0x0A>",
    "0", "2023", "=", "-", "----", "ab", "A", "́", "\x00", "�", "==", "//", "''", "aaaa", "<s>", "　", "퟿", "￿",
]


def test_random_texts(encoder, library):
    rng = random.Random(1)
    for _ in range(8000):
        same(encoder, library, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))))


def test_blanks_and_long_runs(encoder, library):
    for n in (1, 2, 3, 5, 15, 16, 17, 31, 33, 64, 100):
        for end in ("", "a", "the", "\n"):
            same(encoder, library, " " * n + end)
    for text in ("ab" * 5000, "x" * 9000, "日本" * 3000, "=" * 4001, "the" * 3000):
        same(encoder, library, text)


def test_prefix_table_is_unique(encoder):
    """At each prefix exactly one token is whole and compatible with the one before it."""
    for text in ("▁international", "▁thththing", "▁unbelievably", "aaaaaaa"):
        last = encoder.table(text)
        for end in range(1, len(text) + 1):
            fits = [
                i
                for piece, i in encoder.ids.items()
                if text[:end].endswith(piece)
                and encoder.stays_whole(i)
                and (end == len(piece) or encoder.compatible(last[end - len(piece)], i))
            ]
            assert fits == [last[end]]


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr("tickloom.llm.pieces.REMEMBERED", 20)
    small = Encoder(Vocabulary.read(PATH))
    for i in range(300):
        same(small, library, f"word{i} and word{i // 2} again")
    assert len(small.memory) <= 20 and len(small.older) <= 20 and len(small.pairs) <= 41


def check(df, library):
    rows = encode_pieces(df, PATH).select("doc_id", "ids", "decoded", token_numbers().alias("n"), F.sha2("ids", 256).alias("digest"))
    texts = {}
    for r in df.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(library.encode(r.text or "", add_bos=True, add_eos=True))
    found = rows.collect()
    assert len(found) == df.count()
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids in texts[r.doc_id] and r.n == len(ids) and r.decoded == library.decode(ids)
        assert r.digest == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_documents(documents, library):
    check(documents, library)


def test_odd_rows(odd, none, library):
    check(odd, library)
    assert encode_pieces(none, PATH).count() == 0


def test_other_kinds_of_models_are_refused(tmp_path):
    (tmp_path / "empty.model").write_bytes(b"")
    with pytest.raises(ValueError):
        Vocabulary.read(str(tmp_path / "empty.model"))
