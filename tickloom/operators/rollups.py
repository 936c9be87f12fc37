"""Bars over fixed windows of time, and sessions between gaps, for tables and for streams.

A table's sliding bars are made from panes as wide as the slide: ticks are summed once per pane, and only
panes are copied into the windows they belong to. On a stream Spark's own windows do the
same with the watermark, which decides when a bar or session is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.operators.trailing import floor_div

BAR_COLUMNS = ["pair", "start_us", "end_us", "n_ticks", "open", "high", "low", "close", "spread_mean"]
SESSION_COLUMNS = ["pair", "first_us", "last_us", "n_ticks", "open", "high", "low", "close"]

_PLACE = ("ts_us", "seq")


def _us(seconds: float) -> int:
    return int(round(seconds * 1_000_000))


def _opening() -> Column:
    return F.min(F.struct(*_PLACE, "midprice"))


def _closing() -> Column:
    return F.max(F.struct(*_PLACE, "midprice"))


def _timed(ticks: DataFrame, delay_seconds: float) -> DataFrame:
    return ticks.withColumn("event_time", F.timestamp_micros("ts_us")).withWatermark("event_time", f"{delay_seconds} seconds")


def bars(ticks: DataFrame, width_seconds: float, slide_seconds: float | None = None) -> DataFrame:
    """One row per pair and window that holds a tick: first, highest, lowest and last midprice, mean
    spread and number of ticks. Windows begin at multiples of the slide (the width, if none is given)
    and hold their start, not their end. The width must be a multiple of the slide."""
    width, slide = _us(width_seconds), _us(slide_seconds or width_seconds)
    if slide <= 0 or width % slide:
        raise ValueError("the width must be a multiple of the slide")
    pane = F.expr(f"{floor_div('ts_us', slide)} * {slide}L")
    panes = ticks.where("ts_us is not null").groupBy("pair", pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), _opening().alias("first"), F.max("midprice").alias("top"), F.min("midprice").alias("bottom"),
        _closing().alias("last"), F.sum("spread").alias("spreads"), F.count("spread").alias("n_spreads"),
    )
    starts = F.sequence(F.col("pane") - width + slide, F.col("pane"), F.lit(slide))
    windows = panes.withColumn("start_us", F.explode(starts)).groupBy("pair", "start_us").agg(
        F.sum("n").alias("n_ticks"), F.min("first")["midprice"].alias("open"), F.max("top").alias("high"), F.min("bottom").alias("low"),
        F.max("last")["midprice"].alias("close"), (F.sum("spreads") / F.sum("n_spreads")).alias("spread_mean"),
    )
    return windows.withColumn("end_us", F.col("start_us") + width).select(*BAR_COLUMNS)


def stream_bars(ticks: DataFrame, width_seconds: float, slide_seconds: float | None = None, delay_seconds: float = 10.0) -> DataFrame:
    """The same on a stream. In append mode a bar comes once, when the watermark passes its end; in update mode
    with every batch that changes it, the latest one counting."""
    text = lambda seconds: f"{_us(seconds)} microseconds"
    window = F.window("event_time", text(width_seconds), text(slide_seconds or width_seconds))
    grouped = _timed(ticks, delay_seconds).groupBy("pair", window.alias("w")).agg(
        F.count(F.lit(1)).alias("n_ticks"), _opening()["midprice"].alias("open"), F.max("midprice").alias("high"),
        F.min("midprice").alias("low"), _closing()["midprice"].alias("close"), F.avg("spread").alias("spread_mean"),
    )
    return grouped.withColumns({"start_us": F.unix_micros("w.start"), "end_us": F.unix_micros("w.end")}).select(*BAR_COLUMNS)


def latest_bars(updates: DataFrame, batch: str = "batch") -> DataFrame:
    """The last version of each bar among the updates of numbered batches."""
    values = [c for c in BAR_COLUMNS if c not in ("pair", "start_us")]
    last = updates.groupBy("pair", "start_us").agg(F.max_by(F.struct(*values), batch).alias("last"))
    return last.select("pair", "start_us", "last.*").select(*BAR_COLUMNS)


def sessions(ticks: DataFrame, gap_seconds: float = 60.0, block_seconds: float = 3600.0) -> DataFrame:
    """Runs of a pair's ticks with no more than ``gap_seconds`` between neighbours.

    Runs are found within blocks of time first, so that a busy pair spreads over many tasks; then a
    run that ends a block is joined with the one that begins the next, of which there are few."""
    gap, block = _us(gap_seconds), max(_us(block_seconds), _us(gap_seconds) + 1)
    rows = ticks.where("ts_us is not null").withColumn("_block", F.expr(floor_div("ts_us", block)))
    runs = _islands(rows, ["pair", "_block"], "ts_us", "ts_us", gap, list(_PLACE)).groupBy("pair", "_block", "_island").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi"), _opening().alias("first"),
        F.max("midprice").alias("top"), F.min("midprice").alias("bottom"), _closing().alias("last"),
    )
    return _islands(runs, ["pair"], "lo", "hi", gap, ["lo"]).groupBy("pair", "_island").agg(
        F.min("lo").alias("first_us"), F.max("hi").alias("last_us"), F.sum("n").alias("n_ticks"),
        F.min("first")["midprice"].alias("open"), F.max("top").alias("high"), F.min("bottom").alias("low"),
        F.max("last")["midprice"].alias("close"),
    ).select(*SESSION_COLUMNS)


def _islands(rows: DataFrame, keys: list[str], begin: str, end: str, gap: int, order: list[str]) -> DataFrame:
    """Number the runs of rows per key whose ``begin`` is at most ``gap`` after the row before's ``end``."""
    over = Window.partitionBy(*keys).orderBy(*order)
    opens = F.coalesce(F.col(begin) - F.lag(end).over(over) > gap, F.lit(True)).cast("int")
    return rows.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(over.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")


def stream_sessions(ticks: DataFrame, gap_seconds: float = 60.0, delay_seconds: float = 10.0) -> DataFrame:
    """The same on a stream: a session comes once, when the watermark has passed its last tick by the
    gap."""
    window = F.session_window("event_time", f"{_us(gap_seconds)} microseconds")
    grouped = _timed(ticks, delay_seconds).groupBy("pair", window.alias("w")).agg(
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"), F.count(F.lit(1)).alias("n_ticks"),
        _opening()["midprice"].alias("open"), F.max("midprice").alias("high"), F.min("midprice").alias("low"),
        _closing()["midprice"].alias("close"),
    )
    return grouped.select(*SESSION_COLUMNS)
