"""Writers: tables, streams, metrics and run records."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def settings(writer, once: bool, every: str | None):
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def write_table(df: DataFrame, path: str, partition_by: list[str] | tuple = ()) -> None:
    """Replace the table at ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, once: bool = False, every: str | None = None
) -> StreamingQuery:
    """Append each micro-batch as new Parquet files. The checkpoint and the sink's own log
    make a repeated batch invisible to readers."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return settings(writer, once, every).start(path)


def json_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row in ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def kafka_stream(df: DataFrame, servers: str, topic: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Each row as a JSON message keyed by pair. Needs the Spark Kafka connector."""
    messages = df.select(
        F.col("pair").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return settings(writer, once, None).start()


def json_stream(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """The same messages as lines of text files."""
    writer = json_messages(df).writeStream.format("text").option("checkpointLocation", checkpoint)
    return settings(writer, once, None).start(path)


BatchWriter = Callable[[DataFrame, int], None]


def to_folder(path: str) -> BatchWriter:
    """Writes each batch of lines to a folder of its own, which a retry overwrites."""
    return lambda lines, batch_id: lines.write.mode("overwrite").text(f"{path}/batch={batch_id}")


def to_table(path: str) -> BatchWriter:
    """The same for rows, as Parquet."""
    return lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def to_topic(servers: str, topic: str) -> BatchWriter:
    """Sends each batch of lines to a topic; a retry may send it again. Needs the Spark Kafka
    connector."""

    def write(lines: DataFrame, batch_id: int) -> None:
        lines.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def save_stream(
    df: DataFrame, table: BatchWriter, messages: BatchWriter | None, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """One query with two sinks: each micro-batch is worked out once, written as rows, and what was
    written is sent as JSON messages too."""

    def write_both(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist() if messages else batch
        try:
            table(held, batch_id)
            if messages:
                messages(json_messages(held), batch_id)
        finally:
            if messages:
                held.unpersist()

    writer = df.writeStream.foreachBatch(write_both).option("checkpointLocation", checkpoint)
    return settings(writer, once, None).start()


def tee_stream(
    envelopes: DataFrame, queue: str | BatchWriter, archive: str | BatchWriter, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Each micro-batch to a queue and to an archive as the same JSON lines. Each target is a folder
    or a writer such as ``to_topic``."""
    writers = [to_folder(target) if isinstance(target, str) else target for target in (queue, archive)]

    def write_both(batch: DataFrame, batch_id: int) -> None:
        lines = json_messages(batch).persist()
        try:
            for write in writers:
                write(lines, batch_id)
        finally:
            lines.unpersist()

    kept = envelopes.select("ts", "pair", "raw", "seq")
    writer = kept.writeStream.foreachBatch(write_both).option("checkpointLocation", checkpoint)
    return settings(writer, once, None).start()


def write_metrics(metrics: DataFrame, folder: str) -> None:
    """One JSON document {split: {metric: value}} per model, from a long metric table."""
    per_split = metrics.groupBy("model", "split").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("values")
    )
    documents = per_split.groupBy("model").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("split", "values")))).alias("value")
    )
    for row in metrics.select("model").distinct().collect():
        one = documents.where(F.col("model") == row["model"]).select("value")
        one.coalesce(1).write.mode("overwrite").text(f"{folder}/{row['model']}/metrics")


def write_importance(importance: DataFrame, folder: str) -> None:
    """Feature importance as CSV with a header, one folder per model."""
    for row in importance.select("model").distinct().collect():
        one = importance.where(F.col("model") == row["model"]).orderBy(F.abs("value").desc(), "feature")
        one.select("feature", "value").coalesce(1).write.mode("overwrite").option("header", True).csv(
            f"{folder}/{row['model']}/feature_importance"
        )
