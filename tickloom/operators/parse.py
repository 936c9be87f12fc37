"""From raw envelopes to validated ticks."""

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.loose_json import number, with_given_text, with_object
from tickloom.schemas import DEFAULT_PAIR

TICK_COLUMNS = [
    "pair", "ts", "ts_us", "seq", "price", "best_bid", "best_ask",
    "midprice", "spread", "volume_24h", "time",
]


# Payload fields that are read.
PAYLOAD_FIELDS = [
    "price", "last_price", "best_bid", "bid", "best_ask", "ask", "volume_24h", "time", "timestamp",
]


def decode_envelope(messages: DataFrame, value: str = "value", received: Column | None = None) -> DataFrame:
    """Text messages ``{"ts":…, "pair":…, "raw":"…"}`` to columns, plus ``is_bad``.

    ``received`` stands in for a missing ``ts``; pass the broker's or the file's time,
    never the current time, so that a replay gives the same rows. An optional ``seq``
    field carries the order of arrival; a ``seq`` column already there is kept.
    """
    holder = with_object(messages, "_doc", value, "ts double, pair string, raw string, seq long")
    ts = F.col("_doc.ts")
    if received is not None:
        ts = F.coalesce(ts, F.when(F.col("_doc").isNotNull(), received.cast("double")))
    arrival = F.col("seq") if "seq" in messages.columns else F.lit(0).cast("long")
    kept = [c for c in messages.columns if c not in (value, "seq")]
    return holder.select(
        *kept,
        F.coalesce(F.col("_doc.pair"), F.lit(DEFAULT_PAIR)).alias("pair"),
        ts.alias("ts"),
        F.coalesce(F.col("_doc.seq"), arrival).alias("seq"),
        F.coalesce(F.col("_doc.raw"), F.lit("")).alias("raw"),
        ts.isNull().alias("is_bad"),
    )


def parse_quotes(envelopes: DataFrame, raw: str = "raw") -> DataFrame:
    """Add the struct column ``quote``; NULL where the payload holds no usable tick.

    Names fall back (``price`` to ``last_price`` and so on) when a field is not given.
    With a price but not both quotes, both quotes are set around the price.
    """
    kept = envelopes.columns
    field = lambda name: F.col(f"_field.{name}")
    df = with_given_text(envelopes, "_field", raw, PAYLOAD_FIELDS, plain=["volume_24h"])
    df = df.select(
        *kept,
        F.coalesce(field("price"), field("last_price")).alias("_price"),
        F.coalesce(field("best_bid"), field("bid")).alias("_bid"),
        F.coalesce(field("best_ask"), field("ask")).alias("_ask"),
        # The default stands in for a field that is absent, not for one that is null, empty or zero.
        F.when(field("volume_24h_absent"), F.lit("0.0")).otherwise(field("volume_24h_text")).alias("volume_24h"),
        F.coalesce(field("time"), field("timestamp")).alias("time"),
    )
    priced = F.col("_price").isNotNull()
    around = priced & (F.col("_bid").isNull() | F.col("_ask").isNull())
    df = df.select(
        *kept,
        priced.alias("_priced"),
        number(F.col("_price")).alias("_price"),
        F.when(~around, number(F.col("_bid"))).alias("_bid"),
        F.when(~around, number(F.col("_ask"))).alias("_ask"),
        around.alias("_around"),
        "volume_24h",
        "time",
    )
    df = df.select(
        *kept,
        "_priced",
        "_price",
        "_around",
        F.when(F.col("_around"), F.col("_price") * 0.9999).otherwise(F.col("_bid")).alias("best_bid"),
        F.when(F.col("_around"), F.col("_price") * 1.0001).otherwise(F.col("_ask")).alias("best_ask"),
        "volume_24h",
        "time",
    )
    df = df.withColumn("midprice", (F.col("best_bid") + F.col("best_ask")) / 2.0)
    quote = F.struct(
        F.when(F.col("_priced"), F.col("_price")).otherwise(F.col("midprice")).alias("price"),
        "best_bid",
        "best_ask",
        "midprice",
        (F.col("best_ask") - F.col("best_bid")).alias("spread"),
        "volume_24h",
        "time",
    )
    readable = F.col("midprice").isNotNull() & (~F.col("_priced") | F.col("_price").isNotNull())
    # Quotes set around a price of zero are themselves not given.
    readable = readable & ~(F.col("_around") & (F.col("_price") == 0.0))
    return df.select(*kept, F.when(readable, quote).alias("quote"))


def micros(ts: str = "ts") -> Column:
    return F.round(F.col(ts) * 1e6).cast("long")


def parse_ticks(envelopes: DataFrame) -> DataFrame:
    """Valid ticks only: bad envelopes, empty or unreadable payloads and messages
    without a usable price or both quotes are left out."""
    good = envelopes.where(F.col("ts").isNotNull() & (F.col("raw") != ""))
    if "is_bad" in envelopes.columns:
        good = good.where(~F.col("is_bad"))
    quotes = parse_quotes(good).select(
        "pair", "ts", micros().alias("ts_us"), "seq", F.inline(F.when(F.col("quote").isNotNull(), F.array("quote")))
    )
    return quotes.select(*TICK_COLUMNS)


def ingest_counts(envelopes: DataFrame) -> DataFrame:
    """One row: lines read, bad lines, empty payloads, valid ticks."""
    flags = parse_quotes(envelopes)
    bad = F.col("is_bad") if "is_bad" in envelopes.columns else F.col("ts").isNull()
    return flags.agg(
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(bad).alias("bad_lines"),
        F.count_if(~bad & (F.col("raw") == "")).alias("empty_payloads"),
        F.count_if(~bad & (F.col("raw") != "") & F.col("quote").isNotNull()).alias("valid_ticks"),
    )
