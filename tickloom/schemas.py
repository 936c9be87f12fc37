"""Column layouts shared by every job."""

from pyspark.sql import types as T

DEFAULT_PAIR = "BTC-USD"
DEFAULT_WINDOW_SECONDS = 60

# The five model features, in the order the feature table has them.
FEATURES = [
    "midprice_return_mean",
    "midprice_return_std",
    "bid_ask_spread",
    "trade_intensity",
    "order_book_imbalance",
]

# Bookkeeping columns that never reach a model.
METADATA = ["ts", "pair", "raw_price", "window_size", "window_duration"]

TICK = T.StructType(
    [
        T.StructField("pair", T.StringType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("best_bid", T.DoubleType()),
        T.StructField("best_ask", T.DoubleType()),
        T.StructField("midprice", T.DoubleType()),
        T.StructField("spread", T.DoubleType()),
        T.StructField("volume_24h", T.StringType()),
        T.StructField("time", T.StringType()),
    ]
)

FEATURE_ROW = T.StructType(
    [
        T.StructField("pair", T.StringType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("midprice_return_mean", T.DoubleType()),
        T.StructField("midprice_return_std", T.DoubleType()),
        T.StructField("bid_ask_spread", T.DoubleType()),
        T.StructField("trade_intensity", T.DoubleType()),
        T.StructField("order_book_imbalance", T.DoubleType()),
        T.StructField("window_size", T.LongType()),
        T.StructField("window_duration", T.DoubleType()),
        T.StructField("raw_price", T.DoubleType()),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

IMPORTANCE = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
