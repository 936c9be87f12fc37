"""Readers for raw tick messages and stored tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.parse import decode_envelope
from tickloom.schemas import METRIC


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes from newline-delimited JSON, one per line; unreadable lines are flagged.

    Where a line has no ``seq`` its content breaks ties in time, the same on a stream as here:
    the place of a line is known to neither side for certain.
    """
    return decode_envelope(_numbered(spark.read.text(path)))


def _numbered(lines: DataFrame) -> DataFrame:
    return lines.withColumn("seq", F.xxhash64("value"))


def stream_archive(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Envelopes from files that keep arriving in a folder, oldest first."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("_landed"))
    return decode_envelope(_numbered(lines), received=F.col("_landed")).drop("_landed")


def stream_kafka(
    spark: SparkSession, servers: str, topic: str = "ticks.raw", messages_per_batch: int | None = None
) -> DataFrame:
    """Envelopes from a topic, from the earliest message on the first run.

    Needs the Spark Kafka connector on the class path. The broker's time stands in for a
    missing ``ts`` and the offset breaks ties.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if messages_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    messages = reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("_landed"),
        F.col("offset").alias("seq"),
    )
    return decode_envelope(messages, received=F.col("_landed")).drop("_landed")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_metrics(spark: SparkSession, folder: str, models: list[str]) -> tuple[DataFrame, list[str]]:
    """(long metric table, models without a metrics file)."""
    absent = [m for m in models if not _exists(spark, f"{folder}/{m}/metrics")]
    result = spark.createDataFrame([], METRIC)
    for model in models:
        if model in absent:
            continue
        text = spark.read.option("wholetext", True).text(f"{folder}/{model}/metrics")
        splits = text.select(
            F.explode(F.from_json("value", "map<string,map<string,double>>")).alias("split", "metrics")
        )
        long = splits.select(F.lit(model).alias("model"), "split", F.explode("metrics").alias("metric", "value"))
        result = result.unionByName(long)
    return result, absent
