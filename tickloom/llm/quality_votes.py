"""Quality of texts by a vote of the nearest labelled texts in a latent-semantic space.

A text is a bag of hashed features of three kinds: words (ASCII letters lower-cased), runs of three
character classes (letter case, digit, blank, line break, each ASCII sign for itself), and marks of style
(ten-step shares of repeated words, capitals, signs, digits and blanks). Counts are log-damped and
weighted by inverse document frequencies, counted over all documents; each kind is scaled to length one
before they are joined. The main axes of the labelled examples, found by subspace iteration on their
second moments, span the latent space. The labelled vectors go to all tasks; every document's cosines
with all of them are computed as blocked matrix products, and its ``neighbours`` nearest vote with their
label, weighted by a power of the cosine and by how common their label is among all labelled rows.

The model is fitted on at most about ``sample`` labelled documents, half of each label where there are
enough, drawn by a hash of the id; only their sparse vectors reach the driver. Everything else covers
all rows: document frequencies, label shares, and the scores, over whole texts.

Defined results: a null or empty text, and every text where nothing was labelled, gets the share of
label 1 (0.5 without labels). Labelled rows without an id or label teach nothing; several labels of one
document all vote; a label above 0 counts as 1. Equal texts get equal scores. An empty table gives an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.tables import ship_package, text_rows
from tickloom.llm.words import NOT_SPACE, chunks, split_words

WORD_BITS, SHAPE_BITS = 11, 11
MARKS, STEPS = 5, 11
WIDTH = (1 << WORD_BITS) + (1 << SHAPE_BITS) + MARKS * STEPS
WEIGHTS = (0.5, 1.0, 1.0)  # of words, shapes and marks
SAMPLE = 6000
AXES = 48
NEIGHBOURS = 25
SHARPNESS = 8
BLOCK = 256  # documents whose cosines are computed at once

# Character classes: capitals, small letters (and all that is not ASCII) and digits are one class each.
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 65, 97, 97, 48
_SPREAD = np.uint32(0x9E3779B1)


def _edges(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of ``texts`` and where each text begins and ends."""
    raw = texts.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def _shares(flags: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Tenths of the bytes (or words) of each text that have a flag."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return 10 * (total[at[1:]] - total[at[:-1]]) // np.maximum(sizes, 1)


def features(texts: pa.Array) -> np.ndarray:
    """Counts of ``WIDTH`` features for each text; a row of zeros for an empty one."""
    texts = texts.fill_null("")
    n = len(texts)
    data, at = _edges(texts)
    sizes = np.diff(at)
    words = split_words(texts, NOT_SPACE)
    per_text = np.diff(words.bounds)
    counts = np.zeros((n, WIDTH), np.float32)

    def count(owner: np.ndarray, bucket: np.ndarray, first: int, width: int) -> None:
        counts[:, first : first + width] = np.bincount(owner * width + bucket, minlength=n * width).reshape(n, width)

    owner = np.repeat(np.arange(n), per_text)
    count(owner, (words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), 0, 1 << WORD_BITS)
    kinds = _CLASS[data]
    if len(data) > 2:
        runs = kinds[:-2] * np.uint32(0x10001) + kinds[1:-1] * np.uint32(0x101) * np.uint32(0x5BD1) + kinds[2:] * np.uint32(0x85EB)
        inside = np.repeat(np.arange(n), sizes)
        same = inside[:-2] == inside[2:]
        bucket = ((runs * _SPREAD) >> np.uint32(32 - SHAPE_BITS)).astype(np.int64)
        count(inside[:-2][same], bucket[same], 1 << WORD_BITS, 1 << SHAPE_BITS)
    again = np.zeros(len(words.hashes), bool)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    again[words.bounds[:-1][per_text > 0]] = False
    signs = (data > 32) & (data < 127) & (kinds == data) & ~np.isin(kinds, (48, 65, 97))
    marks = [
        _shares(again, words.bounds, per_text),
        _shares(kinds == 65, at, sizes),
        _shares(signs, at, sizes),
        _shares(kinds == 48, at, sizes),
        _shares(np.isin(kinds, (9, 10, 13, 32)), at, sizes),
    ]
    filled = np.flatnonzero(sizes)
    for i, mark in enumerate(marks):
        counts[filled, WIDTH - MARKS * STEPS + i * STEPS + mark[filled]] = 1
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Feature vectors: damped counts times ``idf``, each kind scaled, then the whole to length one."""
    out = np.zeros_like(counts)
    some = counts > 0
    out[some] = 1 + np.log(counts[some])
    out *= idf
    begin = 0
    for width, weight in zip((1 << WORD_BITS, 1 << SHAPE_BITS, MARKS * STEPS), WEIGHTS):
        part = out[:, begin : begin + width]
        part *= weight / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
        begin += width
    return _unit(out)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def main_axes(blocks: Iterator[np.ndarray], axes: int = AXES, rounds: int = 12) -> np.ndarray:
    """The ``axes`` main directions (one a column) of rows given in blocks, by subspace iteration on
    their second moments."""
    moments = np.zeros((WIDTH, WIDTH), np.float32)
    for block in blocks:
        moments += block.T @ block
    basis = np.random.default_rng(7).standard_normal((WIDTH, axes)).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(moments @ basis)
    return basis.astype(np.float32)


@dataclass
class VoteModel:
    idf: np.ndarray
    axes: np.ndarray  # feature, axis
    vectors: np.ndarray  # labelled example, axis; each of length one
    labels: np.ndarray
    shares: np.ndarray  # how much an example of label 0 and of 1 counts
    prior: float

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Weighted share of label 1 among the nearest examples, from cosines with all of them."""
        out = np.full(len(counts), self.prior)
        filled = np.flatnonzero(counts.any(axis=1))
        k = min(neighbours, len(self.labels))
        if not k:
            return out
        for begin in range(0, len(filled), BLOCK):
            rows = filled[begin : begin + BLOCK]
            cosines = _unit(weighted(counts[rows], self.idf) @ self.axes) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k] if k < cosines.shape[1] else np.broadcast_to(np.arange(k), cosines.shape)
            votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0.0).astype(np.float64) ** SHARPNESS
            votes *= self.shares[self.labels[near]]
            # A vote of little weight leaves the share of all labelled rows.
            out[rows] = ((votes * self.labels[near]).sum(axis=1) + 1e-6 * self.prior) / (votes.sum(axis=1) + 1e-6)
        return np.clip(out, 0.0, 1.0)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(WIDTH, np.int64), 0
    for batch in batches:
        for part in chunks(batch):
            counts = features(part.column("text"))
            seen += (counts > 0).sum(axis=0)
            n += int(counts.any(axis=1).sum())
    at = np.flatnonzero(seen)
    # Feature -1 counts the documents.
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at].astype(np.int32)), pa.array(np.r_[n, seen[at]])], names=["feature", "n"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            counts = features(part.column("text"))
            found = [np.flatnonzero(row) for row in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("text_hash"),
                    part.column("label"),
                    pa.array([at.astype(np.int16).tobytes() for at in found], pa.binary()),
                    pa.array([row[at].tobytes() for row, at in zip(counts, found)], pa.binary()),
                ],
                names=["text_hash", "label", "places", "counts"],
            )


def fit_votes(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> VoteModel:
    """Model from ``labels`` (``key``, ``label``) and the texts they belong to in ``docs``."""
    ship_package(docs.sparkSession)
    rows = text_rows(docs, key, text)
    frequencies = rows.select("text").mapInArrow(_frequencies, "feature int, n bigint")
    idf, total = np.zeros(WIDTH), 0
    for row in frequencies.groupBy("feature").agg(F.sum("n").alias("n")).collect():  # at most WIDTH + 1 rows
        if row.feature < 0:
            total = row.n
        else:
            idf[row.feature] = row.n
    idf = np.where(idf > 0, np.log((1 + total) / (1 + idf)) + 1, 0.0).astype(np.float32)

    known = labels.select(labels[key].alias("id"), (labels[label] > 0).cast("int").alias("label"))
    known = known.where("id is not null and label is not null")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    everything = sum(sizes.values())
    prior = sizes.get(1, 0) / everything if everything else 0.5
    drawn = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = F.lit(False)
    for value, n in sizes.items():
        wanted |= (F.col("label") == value) & (drawn < max(sample / 2, sample - (everything - n)) / n)
    # About ``sample`` ids whatever the size of the table, so they may be broadcast.
    chosen = F.broadcast(known.where(wanted).distinct())
    found = rows.join(chosen, rows["doc_id"] == chosen["id"]).select("text", "text_hash", "label")
    found = found.mapInArrow(_examples, "text_hash bigint, label int, places binary, counts binary")
    found = found.dropDuplicates(["text_hash", "label"]).orderBy(F.xxhash64("text_hash"), "text_hash", "label").limit(2 * sample)
    taken = sorted(found.collect(), key=lambda r: (r.text_hash is None, r.text_hash or 0, r.label))
    taken = [r for r in taken if len(r.places)]
    if not taken:
        return VoteModel(idf, np.zeros((WIDTH, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.int64), np.ones(2), prior)

    def blocks() -> Iterator[np.ndarray]:
        for begin in range(0, len(taken), BLOCK):
            part = taken[begin : begin + BLOCK]
            counts = np.zeros((len(part), WIDTH), np.float32)
            for i, r in enumerate(part):
                counts[i, np.frombuffer(r.places, np.int16)] = np.frombuffer(r.counts, np.float32)
            yield weighted(counts, idf)

    axes = main_axes(blocks())
    vectors = _unit(np.concatenate([block @ axes for block in blocks()]))
    learned = np.array([r.label for r in taken], np.int64)
    share = np.array([sizes.get(v, 0) / everything / max((learned == v).sum(), 1) * len(learned) for v in (0, 1)])
    return VoteModel(idf, axes, vectors, learned, share, prior)


def _score(model: VoteModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                scores = model.scores(features(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def score_quality(docs: DataFrame, model: VoteModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher where label 1 is likelier) for every row of ``docs``."""
    ship_package(docs.sparkSession)
    rows = text_rows(docs, key, text).select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_score(model), f"doc_id {id_type}, score double")
