import re

import numpy as np
import pyarrow as pa

from tickloom.llm.words import LETTERS, NOT_SPACE, chunks, split_words

from plain import ascii_lower

TEXTS = ["One two  one\n", None, "", "é TWO one", "x", " ", "two"]


def spelled(words):
    return [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]


def test_words_and_bounds():
    for kind, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = split_words(pa.array(TEXTS), kind)
        want = [re.findall(pattern, ascii_lower(t)) for t in TEXTS]
        assert spelled(words) == [w for ws in want for w in ws]
        assert np.diff(words.bounds).tolist() == [len(ws) for ws in want]


def test_equal_words_have_equal_hashes():
    words = split_words(pa.array(TEXTS), NOT_SPACE)
    by_word = {}
    for word, h in zip(spelled(words), words.hashes):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_stay_in_their_text():
    words = split_words(pa.array(["a b c", "d", "a b c d"]), NOT_SPACE)
    hashes, inside = words.shingles(3)
    assert inside.tolist() == [True, False, False, False, True, True]
    assert hashes[0] == hashes[4] != hashes[5]


def test_chunks_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (0, 5, 50, 1, 1)] + [None], "n": range(6)})
    parts = list(chunks(batch, size=10))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(6))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 10 for p in parts)
