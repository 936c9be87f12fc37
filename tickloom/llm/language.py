"""Language of texts: multinomial logistic regression on TF-IDF character n-grams.

Features are the character 1-, 2- and 3-grams of the lower-cased text with every run of other
characters than letters read as one blank, hashed to ``BUCKETS`` numbers. A text's feature is
its n-gram count (log-damped) times the inverse document frequency, scaled to length one.
Document frequencies are counted over all documents the model may learn from. The weights are
fitted by follow-the-regularised-leader with L1 and L2 penalties, which leaves most of them zero;
a temperature, fitted on examples the weights did not see, calibrates the probabilities.

Fitting uses a sample of at most about ``sample`` documents, equally shared by the languages. Every label
is learned; the weights take 256 KB a label, so more than ``max_languages`` are refused with an error. Which documents are taken follows from a
hash of the text, at a rate that follows from the number of different texts of the language. Only their sparse feature vectors, of at most ``BUCKETS`` numbers each, reach the
driver. Prediction reads every text whole.

Defined results: a text that is null or has no letter gets ``und`` with score 0, as does every
text where nothing could be learned (no labelled row). Rows without a label, an id or a text are not
learned from. Ties go to the language first in the alphabet. Repeated rows are predicted alike.
An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.tables import ship_package, text_rows
from tickloom.llm.words import chunks

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
SAMPLE = 6000
MAX_LANGUAGES = 1024
UNKNOWN = "und"

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def _letters_table() -> np.ndarray:
    """For each code point its lower-case letter, or a blank; what has no single lower-case
    letter of its own stands for itself."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_TABLE: list[np.ndarray] = []


def _features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text (buckets, counts); nothing for a text without letters."""
    if not _TABLE:
        _TABLE.append(_letters_table())
    for text in texts:
        points = _TABLE[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = points == 32
        if blank.all():
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        keep = ~blank
        keep[1:] |= ~blank[:-1]  # one blank after each word
        points = np.concatenate([[np.uint32(32)], points[keep], [np.uint32(32)]]) * _MULTIPLIERS[0]
        counts = np.zeros(BUCKETS, np.int64)
        for size in GRAMS:
            n = len(points) - size + 1
            grams = np.full(n, size, np.uint32)
            for i in range(size):
                grams = (grams ^ points[i : i + n]) * _MULTIPLIERS[1]
                grams ^= grams >> np.uint32(15)
            counts += np.bincount((grams * _MULTIPLIERS[2]) >> np.uint32(32 - 15), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield at, counts[at]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for part in chunks(batch):
            yield part, part.column("text").fill_null("").to_pylist()


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(BUCKETS, np.int64), 0
    for _, texts in _texts(batches):
        for at, _ in _features(texts):
            seen[at] += 1
            n += bool(len(at))
    at = np.flatnonzero(seen)
    # Bucket -1 counts the documents.
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[-1, at].astype(np.int32)), pa.array(np.r_[n, seen[at]])], names=["bucket", "n"]
    )


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = set()  # drawn texts, of which there are about as many as the sample has
    for part, texts in _texts(batches):
        names = list(zip(part.column("lang").to_pylist(), part.column("text_hash").to_pylist()))
        new = [i for i, name in enumerate(names) if not (name in seen or seen.add(name))]
        part, texts = part.take(pa.array(new, pa.int64())), [texts[i] for i in new]
        found = list(_features(texts))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("lang"),
                part.column("text_hash"),
                pa.array([at.astype(np.int32).tobytes() for at, _ in found], pa.binary()),
                pa.array([count.astype(np.int32).tobytes() for _, count in found], pa.binary()),
            ],
            names=["lang", "text_hash", "buckets", "counts"],
        )


def _scaled(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm > 0 else values


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_regularised_leader(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    classes: int,
    epochs: int = 5,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 1e-2,
    l2: float = 1e-3,
    seed: int = 0,
) -> np.ndarray:
    """Weights (bucket, class) after ``epochs`` passes over sparse rows (buckets, values). Each
    class has its own adaptive step per bucket; weights whose gradient sum stays within ``l1``
    are zero."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at):
        shrunk = np.sign(z[at]) * l1 - z[at]
        return np.where(np.abs(z[at]) <= l1, 0.0, shrunk / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            w = weights(at)
            error = _softmax(values @ w)
            error[labels[i]] -= 1
            gradient = values[:, None] * error
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    return weights(np.arange(BUCKETS))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Divisor of the logits with the least cross-entropy, by golden-section search on its
    logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t):
        p = _softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _softmax(_scaled(at, counts, self.idf) @ self.weights[at] / self.temperature)


def fit_language(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = SAMPLE,
    max_languages: int = MAX_LANGUAGES,
) -> LanguageModel:
    """Model learned from text and label of all rows of ``docs`` that have both."""
    ship_package(docs.sparkSession)
    rows = text_rows(docs.where(docs[lang].isNotNull() & docs[text].isNotNull()), key, text, lang=docs[lang].cast("string"))
    # Copies of a text are drawn together, so the rate follows from the number of different texts with letters.
    texts = F.approx_count_distinct(F.when(F.col("text").rlike(r"\p{L}"), F.col("text_hash")), 0.02).alias("texts")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), texts).orderBy(F.desc("count"), "lang").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} labels; a model of more needs a higher max_languages")
    if not counts:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)

    idf = np.zeros(BUCKETS)
    frequencies = rows.select("text").mapInArrow(_document_frequencies, "bucket int, n bigint")
    total = 0
    for row in frequencies.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS + 1 rows
        if row.bucket < 0:
            total = row.n
        else:
            idf[row.bucket] = row.n
    idf = np.where(idf > 0, np.log((1 + total) / (1 + idf)) + 1, 0.0)

    share = sample / len(counts)
    # A number from 0 to 1 that depends on the text alone.
    drawn = F.pmod(F.xxhash64("text_hash", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = F.lit(False)
    for row in counts:
        wanted |= (F.col("lang") == row["lang"]) & (drawn < share / max(row["texts"], 1))
    vectors = rows.where(wanted).mapInArrow(_vectors, "lang string, text_hash bigint, buckets binary, counts binary")
    taken = sorted(vectors.distinct().collect(), key=lambda r: (r.text_hash, r.lang))

    languages = sorted(row["lang"] for row in counts)
    examples, labels = [], []
    for row in taken:
        at = np.frombuffer(row.buckets, np.int32)
        if len(at):
            examples.append((at, _scaled(at, np.frombuffer(row.counts, np.int32), idf)))
            labels.append(languages.index(row.lang))
    labels = np.array(labels, np.int64)
    aside = np.arange(len(labels)) % 5 == 4
    fitted = [x for x, out in zip(examples, aside) if not out]
    weights = follow_the_regularised_leader(fitted, labels[~aside], len(languages))
    logits = np.array([values @ weights[at] for (at, values), out in zip(examples, aside) if out]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, temperature(logits, labels[aside]))


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches):
            names, scores = [], []
            for at, counts in _features(texts):
                if not len(at) or not model.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(at, counts)
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
            columns = [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (its calibrated probability) for every row of ``docs``."""
    ship_package(docs.sparkSession)
    rows = text_rows(docs, key, text).select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_predict(model), f"doc_id {id_type}, lang_pred string, score double")


def keep_languages(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    wanted: list[str] | None = None,
    min_score: float = 0.4,
) -> DataFrame:
    """Rows of ``docs`` with a recognised language (one of ``wanted`` where given) that is at
    least ``min_score`` probable; all columns as they were."""
    ship_package(docs.sparkSession)
    wanted = model.languages if wanted is None else wanted

    @F.pandas_udf("boolean")
    def accepted(column):
        import pandas as pd

        out = []
        for begin in range(0, len(column), 64):
            for at, counts in _features(column.iloc[begin : begin + 64].fillna("").tolist()):
                if not len(at) or not model.languages:
                    out.append(False)
                    continue
                p = model.probabilities(at, counts)
                best = int(p.argmax())
                out.append(bool(model.languages[best] in wanted and p[best] >= min_score))
        return pd.Series(out, dtype=bool)

    return docs.where(accepted(docs[text].cast("string")))
