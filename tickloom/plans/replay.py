"""Features from an archive of raw messages."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.ordering import keys_at_ranks
from tickloom.operators.parse import ingest_counts, parse_ticks
from tickloom.operators.trailing import tick_features
from tickloom.schemas import DEFAULT_WINDOW_SECONDS
from tickloom.session import stored
from tickloom.sources.raw import read_archive
from tickloom.sources.sinks import write_table


@dataclass
class Replay:
    features: DataFrame
    counts: DataFrame


def replay(
    spark: SparkSession, archive: str, output: str, window_seconds: float = DEFAULT_WINDOW_SECONDS
) -> Replay:
    """Read the archive, write the feature table, and report what was read."""
    envelopes = read_archive(spark, archive)
    write_table(tick_features(parse_ticks(envelopes), window_seconds), output)
    return Replay(spark.read.parquet(output), ingest_counts(envelopes))


def bounded_features(
    envelopes: DataFrame, messages: int, window_seconds: float = DEFAULT_WINDOW_SECONDS
) -> DataFrame:
    """Feature rows of a run that stops after a number of messages.

    Every message counts, usable or not. The run stops at the first feature row at or
    after that count, which is therefore included.
    """
    arrivals = stored(envelopes.withColumn("ts_us", F.round(F.col("ts") * 1e6).cast("long")), "arrivals")
    ticks = parse_ticks(arrivals.drop("ts_us"))
    if messages <= 0 or arrivals.count() < messages:
        return tick_features(ticks, window_seconds)
    at, seq = keys_at_ranks(arrivals, "ts_us", "seq", [messages - 1])[messages - 1]
    place = F.struct("ts_us", "seq")
    here = F.struct(F.lit(at).alias("ts_us"), F.lit(seq).alias("seq"))
    last = arrivals.agg(F.max("ts_us")).first()[0]
    # Only as much of what follows is looked at as it takes to find the row that ends the run.
    reach = int(window_seconds * 1_000_000)
    while True:
        features = tick_features(ticks.where(F.col("ts_us") <= at + reach), window_seconds)
        stop = features.where(place >= here).agg(F.min(place)).first()[0]
        if stop is not None or at + reach >= last:
            break
        reach *= 4
    if stop is None:
        return features
    return features.where(place <= F.struct(F.lit(stop["ts_us"]).alias("ts_us"), F.lit(stop["seq"]).alias("seq")))
