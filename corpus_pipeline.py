"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``; the last returns encodings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.decontaminate import drop_contaminated
from tickloom.llm.language import fit_language, keep_languages
from tickloom.llm.line_dedup import drop_repeated_lines
from tickloom.llm.near_dedup import keep_one_of_each
from tickloom.llm.pieces import encode_pieces, token_numbers
from tickloom.llm.queries import piece_vocabulary
from tickloom.llm.tables import read
from tickloom.session import fresh_path, write_once


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language stay; those without letters, or with no language that is at
    least 40 per cent probable, go."""
    return keep_languages(docs, fit_language(docs))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of alike lines one line stays in the whole corpus; documents left without
    text go."""
    return drop_repeated_lines(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return keep_one_of_each(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more lie in benchmark windows go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document; ids as little-endian 32-bit numbers."""
    rows = encode_pieces(docs, piece_vocabulary())
    return rows.select("doc_id", token_numbers().alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_languages),
    ("line_dedup", unrepeated_lines),
    ("near_dedup", one_of_near_duplicates),
    ("decontamination", clean_of_benchmark),
    ("pieces", encoded),
]

# Learned models, min-wise samples and subword merges have no SQL; tests compare the stages
# with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        write_once(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
    return docs
