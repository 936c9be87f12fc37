"""A stream of features that ends after a number of messages.

The count of messages read and of rows emitted comes with the progress of every micro-batch. A listener
adds them up and stops the query once a batch that lies wholly behind the wanted message has emitted a row, or
the source has no more. What the last batches gave too much is cut off at the exact row.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.operators.ordering import keys_at_ranks
from tickloom.schemas import DEFAULT_WINDOW_SECONDS
from tickloom.session import stored
from tickloom.sources.sinks import append_stream
from tickloom.streaming.trailing import stream_features


class StopAfter(StreamingQueryListener):
    """Sets ``reached`` when rows have been emitted by a batch that began after ``messages`` messages."""

    def __init__(self, messages: int):
        self.messages, self.read, self.emitted = messages, 0, 0
        self.query_id: str | None = None
        self.reached = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.id) != self.query_id:
            return
        found = progress.observedMetrics
        emitted = found["features"]["emitted"] if "features" in found else 0
        if emitted and self.read >= self.messages:
            self.reached.set()
        self.read += found["envelopes"]["lines_read"] if "envelopes" in found else 0
        self.emitted += emitted

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_until(spark: SparkSession, query: StreamingQuery, messages: int, poll_seconds: float = 0.2) -> StopAfter:
    """Wait for ``query`` to end or to have emitted a row after ``messages`` messages; then stop it."""
    listener = StopAfter(messages)
    listener.query_id = str(query.id)
    spark.streams.addListener(listener)
    try:
        while not query.awaitTermination(poll_seconds):
            if listener.reached.is_set():
                break
    finally:
        query.stop()
        spark.streams.removeListener(listener)
    return listener


def cut_features(features: DataFrame, arrivals: DataFrame, messages: int) -> DataFrame:
    """``features`` up to the first row at or after the message of that number among ``arrivals``
    (ts, seq); all of them where there are fewer messages or no such row."""
    places = stored(arrivals.select(F.round(F.col("ts") * 1e6).cast("long").alias("ts_us"), "seq").where("ts_us is not null"), "arrivals")
    if messages <= 0 or places.count() < messages:
        return features
    at, seq = keys_at_ranks(places, "ts_us", "seq", [messages - 1])[messages - 1]
    place = F.struct("ts_us", "seq")
    here = F.struct(F.lit(at).alias("ts_us"), F.lit(seq).alias("seq"))
    stop = features.where(place >= here).agg(F.min(place)).first()[0]
    if stop is None:
        return features
    return features.where(place <= F.struct(F.lit(stop["ts_us"]).alias("ts_us"), F.lit(stop["seq"]).alias("seq")))


def first_stream_features(
    envelopes: DataFrame, arrivals: DataFrame, messages: int, output: str, checkpoint: str,
    window_seconds: float = DEFAULT_WINDOW_SECONDS, delay_seconds: float = 10.0, once: bool = True,
) -> DataFrame:
    """Feature rows of a streamed run over ``envelopes`` that ends after ``messages`` messages, usable or not.

    ``arrivals`` is the same source as a table: the place of the last message is looked up there. The
    table at ``output`` holds all that was written before the query stopped."""
    spark = envelopes.sparkSession
    query = append_stream(stream_features(envelopes, window_seconds, delay_seconds), output, checkpoint, once=once)
    run_until(spark, query, messages)
    return cut_features(spark.read.parquet(output), arrivals, messages)
