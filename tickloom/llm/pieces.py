"""Subword encoding and decoding with a merge-type vocabulary (byte-pair merges by score).

Encoding merges, again and again, the adjacent pair whose joined piece has the best score. The
same result is found here without merging. For each prefix of the text there is exactly one last
token, so a table of these tokens is enough:

* an automaton over the vocabulary gives all pieces that end at a place;
* a piece can be the last token if it stays whole when it is encoded alone, and if the token that
  ends where it begins is compatible with it, that is, the two joined are encoded as these two;
* the ids are read off backwards, from the last token of the whole text.

Pieces never cross from another character to a word mark (the blank's stand-in; this is checked
when a vocabulary is read), so a text falls apart into stretches that are encoded on their
own, and stretches seen before come from a memory of bounded size. A character without a piece is
written as bytes. What is decoded is put together from the pieces of the ids alone.

Defined results: a null or empty text gives the begin and end ids only and decodes to the empty text.
Very long texts, also without blanks, take time in proportion to their length. Repeated rows are
encoded alike. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.tables import ship_package, text_rows
from tickloom.llm.words import chunks

MARK = "▁"
REMEMBERED = 250_000  # stretches in each of two generations of the memory
LONGEST = 64  # characters of a stretch worth remembering

NORMAL, UNKNOWN_KIND, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at : at + size]
            at += size


@dataclass
class Vocabulary:
    """Pieces of a model file with their scores and kinds, in the order of their ids."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    begin: int = 1
    end: int = 2

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        pieces, scores, kinds, settings, normal = [], [], [], {}, {}
        for number, value in _fields(Path(path).read_bytes()):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                settings = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if settings.get(3) != 2 or normal.get(2) or normal.get(4, 1) or not normal.get(5, 1) or settings.get(24):
            raise ValueError("only merge-type models without text normalisation are supported")
        if not settings.get(35) or USER in kinds:
            raise ValueError("only models with byte pieces and without user-defined pieces are supported")
        if any(MARK in p.lstrip(MARK) for p, k in zip(pieces, kinds) if k == NORMAL):
            raise ValueError("a piece goes on past the end of a word")
        return cls(pieces, scores, kinds, bool(normal.get(3, 1)), settings.get(41, 1), settings.get(42, 2))


@dataclass
class Encoder:
    """Prefix-table encoder over one vocabulary."""

    vocabulary: Vocabulary
    memory: dict = field(default_factory=dict)
    older: dict = field(default_factory=dict)

    def __post_init__(self):
        import ahocorasick

        v = self.vocabulary
        self.ids = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == NORMAL}
        self.shown = ["" if k == CONTROL else p.replace(MARK, " ") for p, k in zip(v.pieces, v.kinds)]
        self.sizes = [len(p) for p in v.pieces]
        self.scores = {p: v.scores[i] for p, i in self.ids.items()}
        self.characters = {p for p in self.ids if len(p) == 1}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == BYTE}
        self.value = {i: bytes([b]) for b, i in self.bytes.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.whole: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        # Word marks with the word behind them, or a word at the very start.
        self.stretch = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging; the definition that whole pieces and compatible
        pairs are tested against."""
        parts = list(text)
        score = self.scores.get
        joined = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, s in enumerate(joined):
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            joined[max(at - 1, 0) : at + 2] = [score(a + b) for a, b in zip(parts[max(at - 1, 0) : at + 1], parts[max(at, 1) : at + 2])]

    def stays_whole(self, piece: int) -> bool:
        known = self.whole.get(piece)
        if known is None:
            known = self.whole[piece] = self.merged(self.vocabulary.pieces[piece]) == [self.vocabulary.pieces[piece]]
        return known

    def compatible(self, left: int, right: int) -> bool:
        both = left << 32 | right
        known = self.pairs.get(both)
        if known is None:
            a, b = self.vocabulary.pieces[left], self.vocabulary.pieces[right]
            if len(self.pairs) > 2 * REMEMBERED:
                self.pairs.clear()
            known = self.pairs[both] = self.merged(a + b) == [a, b]
        return known

    def table(self, text: str) -> list[int]:
        """Last token of every prefix, 0 for the empty one; all characters have a piece, and
        0, the unknown piece, is never a token."""
        last = [0] * (len(text) + 1)
        pairs = self.pairs
        for at, (piece, size) in self.automaton.iter(text):
            if last[at + 1]:
                continue
            begin = at + 1 - size
            if begin:
                left = last[begin]
                known = pairs.get(left << 32 | piece)
                if known if known is not None else left and self.compatible(left, piece):
                    last[at + 1] = piece
            elif self.stays_whole(piece):
                last[at + 1] = piece
        return last

    def known_run(self, text: str) -> list[int]:
        """Ids of a run of characters that all have a piece, read backwards from the table."""
        last, sizes = self.table(text), self.sizes
        out, at = [], len(text)
        while at:
            piece = last[at]
            out.append(piece)
            at -= sizes[piece]
        return out[::-1]

    def stretch_ids(self, text: str) -> list[int]:
        if self.characters.issuperset(text):
            return self.known_run(text)
        out, run = [], []
        for c in text:
            if c in self.characters:
                run.append(c)
                continue
            if run:
                out += self.known_run("".join(run))
                run = []
            out += [self.bytes[b] for b in c.encode("utf-8", "surrogatepass")]
        if run:
            out += self.known_run("".join(run))
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of a stretch or of whole encodings, without the dummy prefix taken off."""
        if self.value.keys().isdisjoint(ids):
            return "".join([self.shown[i] for i in ids])
        out, held = [], b""
        for i in ids:
            if i in self.value:
                held += self.value[i]
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = b""
            out.append(self.shown[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def remembered(self, stretch: str) -> tuple[bytes, str]:
        """(ids as little-endian numbers, decoded text) of a stretch."""
        found = self.memory.get(stretch) or self.older.get(stretch)
        if found is None:
            ids = self.stretch_ids(stretch)
            found = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids))
        if len(stretch) <= LONGEST:
            if len(self.memory) >= REMEMBERED:
                self.older, self.memory = self.memory, {}
            self.memory[stretch] = found
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids with begin and end as little-endian numbers, decoded text)."""
        v = self.vocabulary
        marked = text.replace(" ", MARK)
        if marked and v.dummy_prefix:
            marked = MARK + marked
        known = self.memory.get
        parts = [known(x) or self.remembered(x) for x in self.stretch.findall(marked)]
        begin, end = (int(i).to_bytes(4, "little") for i in (v.begin, v.end))
        decoded = "".join([p[1] for p in parts])
        if v.dummy_prefix and decoded.startswith(" "):
            decoded = decoded[1:]
        return b"".join([begin, *[p[0] for p in parts], end]), decoded


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder for each vocabulary and worker process, so that its memory outlives a task."""
    key = hash((tuple(vocabulary.pieces), tuple(vocabulary.scores)))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def _encode(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for part in (part for batch in batches for part in chunks(batch)):
            found = [encoder.encode(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1] for f in found], pa.string()),
                ],
                names=["doc_id", "text_hash", "ids", "decoded"],
            )

    return run


def encode_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, ids (little-endian 32-bit numbers, begin
    and end ids included) and decoded (the text that the ids give). The vocabulary file at
    ``path`` is read on the driver and sent along; its size is fixed."""
    ship_package(docs.sparkSession)
    rows = text_rows(docs, key, text)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encode(Vocabulary.read(path)), f"doc_id {id_type}, text_hash bigint, ids binary, decoded string")


def token_numbers(ids: str = "ids") -> F.Column:
    """Number of ids in an encoding."""
    return (F.octet_length(ids) / 4).cast("bigint")
