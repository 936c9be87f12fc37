"""Small helpers of the operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import tickloom
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm.prefilter import bit_table, marked
from tickloom.session import discard, fresh_path, stored, stored_alone  # noqa: F401

_shipped: set[str] = set()


# Rows and bytes handed to Python at once; texts may be long.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Ready the session for functions that run in Python: batches of bounded size, and this
    package's modules on the executors, once per application."""
    sc = spark.sparkContext
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        setting = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(setting, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(setting, str(most))
    if sc.applicationId in _shipped:
        return
    root = Path(tickloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tickloom-code-")) / "tickloom-modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", **more) -> DataFrame:
    """Only the columns an operator works on, under its own names, so that no other column of
    ``docs`` can clash with them. A null text counts as empty; ``text_hash`` tells it apart."""
    return docs.select(
        docs[key].alias("doc_id"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
        F.xxhash64(docs[text].cast("string")).alias("text_hash"),
        *[column.alias(name) for name, column in more.items()],
    )


def without_rows(docs: DataFrame, keys: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id and text are not in ``keys`` (doc_id, text_hash); a null id or text is a
    value like any other. Rows that a filter of fixed size tells apart from all keys are passed on as
    they are; only the others are shuffled."""
    same, rest = _split(docs, keys, key, text)
    right = keys.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text_hash"))
    rest = rest.join(right, (F.col("__hash") == F.col("__text_hash")) & rest[key].eqNullSafe(F.col("__id")), "left_anti")
    return same.unionByName(rest.select(*docs.columns))


def one_of_repeated(docs: DataFrame, keys: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one of each set of rows that have the same id and text, where ``keys`` has all ids
    and texts that are repeated."""
    same, rest = _split(docs, keys, key, text)
    return same.unionByName(rest.dropDuplicates([key, "__hash"]).select(*docs.columns))


def _split(docs: DataFrame, keys: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows that have no part in ``keys`` for certain, and the others with ``__hash``."""
    rows = docs.withColumn("__hash", F.xxhash64(docs[text].cast("string")))
    rows = rows.withColumn("__both", F.xxhash64(docs[key], "__hash"))
    table = bit_table(keys.select(F.xxhash64("doc_id", "text_hash").alias("both")), "both")
    rows = marked(rows, "__both", table, "__maybe")
    return rows.where(~F.col("__maybe")).select(*docs.columns), rows.where("__maybe")


def hex_digest(column) -> F.Column:
    return F.sha2(F.coalesce(column, F.lit("")), 256)
