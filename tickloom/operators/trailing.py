"""Trailing-window features per tick, in time linear in the number of ticks.

Time is cut into blocks exactly one window wide. The window of a tick then covers a
tail of the previous block and the head of its own block up to the tick, so two running
aggregates, one over each block, describe it. They merge with the usual parallel
variance formula, which only adds non-negative terms: no precision is lost to
cancellation, unlike differences of running sums.

Several blocks form a slice. Rows are shuffled once, by key and slice; only the last
block of a slice is sent twice. A single busy key therefore spreads over many tasks.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from tickloom.schemas import DEFAULT_WINDOW_SECONDS

BLOCKS_PER_SLICE = 16


def floor_div(value: str, by: int) -> str:
    """SQL text for integer floor division, right for times before 1970 too."""
    return f"((({value}) - pmod({value}, {by}L)) div {by}L)"


def _two_sided(ticks: DataFrame, window_us: int, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Each tick once in its own block and once as ``past`` of the next block."""
    here = floor_div("_home", BLOCKS_PER_SLICE)
    next_one = floor_div("_home + 1", BLOCKS_PER_SLICE)
    spread = (
        ticks.withColumn("_home", F.expr(floor_div("ts_us", window_us)))
        .withColumn("_slice", F.explode(F.expr(f"array_distinct(array({here}, {next_one}))")))
        .repartition(*keys, "_slice")
    )
    copies = F.expr(
        f"""array_compact(array(
            if({here} = _slice, struct(_home as block, false as past), null),
            if({next_one} = _slice, struct(_home + 1 as block, true as past), null)))"""
    )
    copied = spread.withColumn("_copy", F.explode(copies)).select(
        *[c for c in spread.columns if c != "_home"],
        F.col("_copy.block").alias("_block"),
        F.col("_copy.past").alias("_past"),
    )
    return copied, [*keys, "_slice", "_block"]


def window_frames(ticks: DataFrame, window_us: int, keys: list[str] | tuple = ("pair",)) -> DataFrame:
    """Add the frame columns of the window ``[ts_us - window_us, ts_us]`` to each tick.

    Needs ``ts_us``, ``seq``, ``midprice``, ``spread``. The lower bound is inclusive;
    ticks with the same time count only up to their own ``seq``. Returns are log ratios
    between neighbours that are both inside the window. Adds ``window_size``,
    ``first_us``, ``return_mean``, ``return_std`` (population), ``spread_mean``. The
    return columns are NULL when a midprice in the window is not positive and finite.
    """
    keys = list(keys)
    mid = F.col("midprice")
    usable = (mid > 0) & ~F.isnan(mid) & (mid < F.lit(float("inf")))
    carried = list(ticks.columns)
    base = ticks.where(F.col("ts_us").isNotNull()).withColumns(
        {"seq": F.coalesce("seq", F.lit(0)), "_ln": F.when(usable, F.ln(mid))}
    )
    rows, part = _two_sided(base, window_us, keys)

    up = W.partitionBy(*part).orderBy("ts_us", "seq")
    now, past, ln = ~F.col("_past"), F.col("_past"), F.col("_ln")
    rows = rows.withColumns(
        {
            "_prev_ln": F.lag("_ln").over(up),
            "_prev_past": F.lag("_past").over(up),
            "_next_ln": F.lead("_ln").over(up),
            "_next_past": F.lead("_past").over(up),
        }
    ).withColumns(
        {
            "_back": F.when(now & ~F.col("_prev_past"), ln - F.col("_prev_ln")),
            "_bridge": F.when(now & F.col("_prev_past"), ln - F.col("_prev_ln")),
            "_ahead": F.when(past & F.col("_next_past"), F.col("_next_ln") - ln),
        }
    )

    head = up.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns(
        {
            "_h_rows": F.count_if(now).over(head),
            "_h_bad": F.count_if(now & ln.isNull()).over(head),
            "_h_links": F.count("_back").over(head),
            "_h_mean": F.avg("_back").over(head),
            "_h_var": F.var_pop("_back").over(head),
            "_h_spread": F.sum(F.when(now, F.col("spread"))).over(head),
            "_h_first": F.min(F.when(now, F.col("ts_us"))).over(head),
            "_bridge": F.first("_bridge", ignorenulls=True).over(head),
        }
    )

    start = F.when(past, F.col("ts_us")).otherwise(F.col("ts_us") - F.lit(window_us))
    down = (
        W.partitionBy(*part)
        .orderBy(F.col("_start").desc(), F.col("_past").desc(), F.col("seq").desc())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    rows = (
        rows.withColumn("_start", start)
        .withColumns(
            {
                "_t_rows": F.count_if(past).over(down),
                "_t_bad": F.count_if(past & ln.isNull()).over(down),
                "_t_links": F.count("_ahead").over(down),
                "_t_mean": F.avg("_ahead").over(down),
                "_t_var": F.var_pop("_ahead").over(down),
                "_t_spread": F.sum(F.when(past, F.col("spread"))).over(down),
                "_t_first": F.min(F.when(past, F.col("ts_us"))).over(down),
            }
        )
        .where(now)
    )

    zero = F.lit(0.0)
    bridge = F.when(F.col("_t_rows") > 0, F.col("_bridge"))
    size = F.col("_h_rows") + F.col("_t_rows")
    clean = (F.col("_h_bad") + F.col("_t_bad") == 0) & (size >= 2)
    total = (
        F.coalesce(F.col("_h_links") * F.col("_h_mean"), zero)
        + F.coalesce(F.col("_t_links") * F.col("_t_mean"), zero)
        + F.coalesce(bridge, zero)
    )
    rows = rows.withColumns(
        {
            "window_size": size,
            "first_us": F.least(F.col("_h_first"), F.col("_t_first")),
            "return_mean": F.when(clean, total / (size - 1)),
            "spread_mean": (
                F.coalesce("_h_spread", zero) + F.coalesce("_t_spread", zero)
            ) / size,
        }
    )
    centre = F.col("return_mean")
    off = lambda mean: (mean - centre) * (mean - centre)
    squares = (
        F.coalesce(F.col("_h_links") * (F.col("_h_var") + off(F.col("_h_mean"))), zero)
        + F.coalesce(F.col("_t_links") * (F.col("_t_var") + off(F.col("_t_mean"))), zero)
        + F.coalesce(off(bridge), zero)
    )
    return rows.select(
        *carried,
        *([] if "_slice" in carried else ["_slice"]),
        "window_size",
        "first_us",
        "return_mean",
        F.when(clean, F.sqrt(squares / (size - 1))).alias("return_std"),
        "spread_mean",
    )


def tick_features(
    ticks: DataFrame,
    window_seconds: float = DEFAULT_WINDOW_SECONDS,
    keys: list[str] | tuple = ("pair",),
) -> DataFrame:
    """The feature table: one row per tick whose window holds at least two ticks.

    ``keys=()`` treats all pairs as one sequence.
    """
    slim = ticks.select("pair", "ts", "ts_us", "seq", "midprice", "spread", "price")
    frames = window_frames(slim, int(round(window_seconds * 1_000_000)), keys)
    seconds = (F.col("ts_us") - F.col("first_us")) / F.lit(1e6)
    mid = F.col("midprice")
    return (
        frames.where("window_size >= 2")
        .withColumn("window_duration", seconds)
        .select(
            "pair",
            "ts",
            "ts_us",
            "seq",
            F.col("return_mean").alias("midprice_return_mean"),
            F.col("return_std").alias("midprice_return_std"),
            F.col("spread_mean").alias("bid_ask_spread"),
            F.when(
                F.col("window_duration") > 0,
                F.col("window_size") / F.col("window_duration"),
            ).otherwise(0.0).alias("trade_intensity"),
            F.when((mid > 0) & ~F.isnan(mid), F.col("spread_mean") / mid)
            .otherwise(0.0)
            .alias("order_book_imbalance"),
            "window_size",
            "window_duration",
            F.col("price").alias("raw_price"),
        )
    )


def forward_volatility(
    ticks: DataFrame,
    horizon_seconds: float = DEFAULT_WINDOW_SECONDS,
    keys: list[str] | tuple = ("pair",),
) -> DataFrame:
    """Population std of the log returns that follow each tick within the horizon.

    The trailing window seen in a mirror: times and order are negated, which only flips
    the sign of the returns. NULL when no tick follows within the horizon.
    """
    slim = ticks.select("pair", "ts", "ts_us", "seq", "midprice", "spread")
    mirrored = slim.withColumns({"ts_us": -F.col("ts_us"), "seq": -F.coalesce("seq", F.lit(0))})
    frames = window_frames(mirrored, int(round(horizon_seconds * 1_000_000)), keys)
    return frames.select(
        "pair",
        "ts",
        (-F.col("ts_us")).alias("ts_us"),
        (-F.col("seq")).alias("seq"),
        (F.col("window_size") - 1).alias("ticks_ahead"),
        F.col("return_std").alias("forward_return_std"),
    )
