"""Micro-batches delivered exactly once, to several targets, whatever fails in between.

Spark repeats a micro-batch that was not finished, with the same number and the same rows. A target that
can be replaced as a whole is written aside and renamed into place, so a batch is there or not.
What cannot be taken back is written under a ledger of (target, batch): a batch already in it is
skipped. Between such a write and its entry lies the one place where a batch can be sent twice; its
messages carry the same ids then, and ``without_redelivered`` drops the second ones where they are read, as it
does with messages that a source delivers again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.sources.sinks import BatchWriter, json_messages, settings

MESSAGE_KEY = ("pair", "ts", "seq", "raw")


def without_redelivered(envelopes: DataFrame, delay_seconds: float = 10.0, keys: tuple = MESSAGE_KEY) -> DataFrame:
    """The first of all messages with equal ``keys`` that come within ``delay_seconds`` of each other in
    event time. Lines that could not be read have no time and are left out; count them before."""
    timed = envelopes.where("ts is not null").withColumn("_time", F.timestamp_micros(F.round(F.col("ts") * 1e6).cast("long")))
    return timed.withWatermark("_time", f"{delay_seconds} seconds").dropDuplicatesWithinWatermark(list(keys)).drop("_time")


class Files:
    """The file system a folder is in, as Spark sees it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def size(self, folder: str) -> int:
        return self._fs.getContentSummary(self._path(folder)).getLength()

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))] if self.exists(folder) else []


class Ledger:
    """Which batches each target has, as empty files ``<folder>/<target>/<batch>``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder, self._files = folder.rstrip("/"), Files(spark, folder)

    def has(self, target: str, batch_id: int) -> bool:
        return self._files.exists(f"{self.folder}/{target}/{batch_id}")

    def enter(self, target: str, batch_id: int) -> None:
        self._files.touch(f"{self.folder}/{target}/{batch_id}")

    def batches(self, target: str) -> list[int]:
        return sorted(int(name) for name in self._files.names(f"{self.folder}/{target}") if name.isdigit())


def renamed_table(path: str) -> BatchWriter:
    """Each batch as a Parquet folder ``batch=<n>`` that appears at once and is never written twice."""

    def write(rows: DataFrame, batch_id: int) -> None:
        files, final = Files(rows.sparkSession, path), f"{path}/batch={batch_id}"
        if files.exists(final):
            return
        aside = f"{path}/_aside/batch={batch_id}"  # names with an underscore are not read as data
        rows.write.mode("overwrite").parquet(aside)
        files.rename(aside, final)

    return write


def numbered_messages(batch: DataFrame, batch_id: int) -> DataFrame:
    """JSON messages with an ``id`` that a repeated batch gives again."""
    lines = json_messages(batch)
    return lines.withColumn("id", F.concat(F.lit(f"{batch_id}:"), F.hex(F.xxhash64("value"))))


def deliver_stream(
    df: DataFrame, targets: dict[str, BatchWriter], ledger: str, checkpoint: str, once: bool = False,
    each: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """One query with several targets: each micro-batch is worked out once and written to every target
    whose ledger has not got it. ``each`` may turn a batch into what is written, from the batch and its number."""
    book = Ledger(df.sparkSession, ledger)

    def write_all(batch: DataFrame, batch_id: int) -> None:
        missing = [name for name in targets if not book.has(name, batch_id)]
        if not missing:
            return
        rows = each(batch, batch_id) if each else batch
        held = rows.persist() if len(missing) > 1 else rows
        try:
            for name in missing:
                targets[name](held, batch_id)
                book.enter(name, batch_id)
        finally:
            if held is not rows or len(missing) > 1:
                held.unpersist()

    return settings(df.writeStream.foreachBatch(write_all).option("checkpointLocation", checkpoint), once, None).start()
