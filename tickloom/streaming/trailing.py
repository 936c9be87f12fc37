"""Trailing-window features on a stream of ticks.

State is kept per pair and slice of time. The last window of a slice is also sent to the
next one, where it only serves as history, so no state has to be handed on: slices of a
busy pair run side by side when a backlog is read, and each slice's state is dropped when
the watermark passes its end.
"""

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.parse import parse_ticks
from tickloom.operators.trailing import BLOCKS_PER_SLICE, floor_div
from tickloom.schemas import DEFAULT_WINDOW_SECONDS, FEATURE_ROW
from tickloom.session import ROCKSDB, send_by_value, ship_code

STATE = "ts_us long, seq long, midprice double, spread double"
_STATE_COLUMNS = ["ts_us", "seq", "midprice", "spread"]


def _merge(a: tuple, b: tuple) -> tuple:
    """Two sets of (number, mean, sum of squared deviations), as arrays, taken together."""
    n = a[0] + b[0]
    with np.errstate(invalid="ignore", divide="ignore"):
        share = np.where(n > 0, b[0] / n, 0.0)
    gap = b[1] - a[1]
    return n, a[1] + gap * share, a[2] + b[2] + gap * gap * a[0] * share


def _running(n: np.ndarray, values: np.ndarray, group: np.ndarray) -> tuple:
    """(number, mean, squared deviations) from the first row of each group up to every row. Each
    pass doubles the reach, and sets are merged, never subtracted, so precision does not
    depend on what a group holds elsewhere."""
    state = (n.astype(float), np.where(n > 0, values, 0.0), np.zeros(len(values)))
    reach = 1
    first = np.searchsorted(group, group, side="left")
    place = np.arange(len(group)) - first
    longest = int(place.max(initial=0))
    while reach <= longest:
        at = np.flatnonzero(place >= reach)
        merged = _merge(tuple(x[at - reach] for x in state), tuple(x[at] for x in state))
        for x, new in zip(state, merged):
            x[at] = new
        reach *= 2
    return state


def window_arrays(us: np.ndarray, mid: np.ndarray, spread: np.ndarray, rows: np.ndarray, window_us: int) -> dict:
    """Features of the windows ending at ``rows``, over ticks already in order.

    As in batch, time is cut into blocks one window wide, and a window is the tail of one block and the
    head of the next: running figures from both ends of each block describe every window, so the
    work grows with the number of ticks and not with that of the ticks in a window.
    """
    start = np.searchsorted(us, us[rows] - window_us, side="left")
    size = rows - start + 1
    usable = (mid > 0) & np.isfinite(mid)
    logs = np.log(np.where(usable, mid, np.nan))
    bad = np.cumsum(np.concatenate([[0], ~usable]))
    spoiled = bad[rows + 1] > bad[start]
    links = np.diff(logs, prepend=np.nan)
    block = us // window_us
    opens = np.concatenate([[True], np.diff(block) > 0]) if len(us) else np.zeros(0, bool)
    known = np.isfinite(links)
    values = np.where(known, links, 0.0)

    # Heads leave the link into the block out, tails take all links behind a tick.
    head = _running(known & ~opens, values, block)
    behind = np.concatenate([known[1:], [False]]) & ~np.concatenate([opens[1:], [True]]) if len(us) else known
    ahead = np.where(behind, np.concatenate([values[1:], [0.0]]), 0.0) if len(us) else values
    tail = tuple(x[::-1] for x in _running(behind[::-1], ahead[::-1], -block[::-1]))
    every = np.ones(len(us), bool)
    head_spread = _running(every, spread, block)
    tail_spread = tuple(x[::-1] for x in _running(every[::-1], spread[::-1], -block[::-1]))

    own = np.searchsorted(block, block[rows], side="left")  # first tick of the row's block
    both = start < own
    pick = lambda state, at: tuple(x[at] for x in state)
    nothing = (np.zeros(len(rows)),) * 3
    only = lambda state: tuple(np.where(both, x, 0.0) for x in state)
    cross = (known[own] & both).astype(float), np.where(both, values[own], 0.0), nothing[0]
    within = _merge(only(_merge(pick(tail, start), cross)), pick(head, rows))
    # A window that begins inside its own block begins at the block's first tick.
    average = _merge(only(pick(tail_spread, start)), pick(head_spread, rows))
    mean = np.where(spoiled, np.nan, within[1])
    std = np.where(spoiled, np.nan, np.sqrt(np.maximum(within[2], 0.0) / np.maximum(within[0], 1)))
    return {"start": start, "size": size, "mean": mean, "std": std, "spread": average[1]}


def feature_rows(pair, ticks, us, mid, found, ok, at) -> pd.DataFrame:
    """Rows of the feature table for ``ticks``, which are at the places ``at``."""
    seconds = (us[at] - us[found["start"][ok]]) / 1e6
    size, spread = found["size"][ok], found["spread"][ok]
    with np.errstate(divide="ignore", invalid="ignore"):
        intensity = np.where(seconds > 0, size / seconds, 0.0)
        imbalance = np.where(mid > 0, spread / mid, 0.0)
    nullable = lambda a: pd.Series(np.where(np.isnan(a), None, a), dtype=object)
    return pd.DataFrame(
        {
            "pair": pair,
            "ts": ticks["ts"].to_numpy(),
            "ts_us": us[at],
            "seq": ticks["seq"].to_numpy("int64"),
            "midprice_return_mean": nullable(found["mean"][ok]),
            "midprice_return_std": nullable(found["std"][ok]),
            "bid_ask_spread": spread,
            "trade_intensity": intensity,
            "order_book_imbalance": imbalance,
            "window_size": size.astype("int64"),
            "window_duration": seconds,
            "raw_price": ticks["price"].to_numpy(),
        }
    )


class TrailingWindow(StatefulProcessor):
    """Keeps, per key, the ticks that a tick not yet too late may still need.

    Spark drops a tick that is behind the watermark of the batch before. State is therefore cut one
    window behind the watermark, not behind the newest tick: what is let through finds its whole
    window. A tick behind the last cut, should one come, is left out as well.
    """

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ticks = handle.getListState("ticks", STATE)
        self.cut = handle.getValueState("cut", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pair, slice_no = key
        parts = list(rows)
        if not parts:
            return
        new = pd.concat(parts, ignore_index=True)
        new["emit"] = ~new["past"]
        cut = self.cut.get()[0] if self.cut.exists() else None
        if cut is not None:
            new = new[new["ts_us"] >= cut + self.window_us]
        held = list(self.ticks.get())
        if held:
            past = pd.DataFrame(held, columns=_STATE_COLUMNS).assign(emit=False)
            ticks = pd.concat([past, new], ignore_index=True)
        else:
            ticks = new
            end_us = (slice_no + 1) * BLOCKS_PER_SLICE * self.window_us
            self.handle.registerTimer(int(end_us // 1000) + 1)
        self._keep(held, new, timerValues.getCurrentWatermarkInMs() * 1000 - self.window_us)
        if not len(new):
            return
        new = ticks
        ticks = new.sort_values(["ts_us", "seq"], kind="stable", ignore_index=True)

        us = ticks["ts_us"].to_numpy("int64")
        rows_out = np.flatnonzero(ticks["emit"].to_numpy(bool))
        if len(rows_out):
            mid = ticks["midprice"].to_numpy("float64")
            found = window_arrays(us, mid, ticks["spread"].to_numpy("float64"), rows_out, self.window_us)
            ok = found["size"] >= 2
            at = rows_out[ok]
            if len(at):
                yield feature_rows(pair, ticks.iloc[at], us, mid[at], found, ok, at)

    def _keep(self, held: list, new: pd.DataFrame, cut: int) -> None:
        """Add the new ticks; rewrite the state only when half of it has become useless."""
        as_rows = lambda df: list(zip(*[df[c].tolist() for c in _STATE_COLUMNS]))
        useful = [row for row in held if row[0] >= cut]
        if held and 2 * len(useful) <= len(held):
            rows = [tuple(row) for row in useful] + as_rows(new[new["ts_us"] >= cut])
            if rows:
                self.ticks.put(rows)
            else:
                self.ticks.clear()
            self.cut.update((cut,))
        elif len(new):
            self.ticks.appendList(as_rows(new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.ticks.clear()
        self.cut.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_features(
    envelopes: DataFrame, window_seconds: float = DEFAULT_WINDOW_SECONDS, delay_seconds: float = 10.0
) -> DataFrame:
    """One feature row per valid tick with at least two ticks in its window.

    Within a micro-batch ticks are taken in the order of (time, seq). A tick that comes
    later than ``delay_seconds`` behind the newest is dropped and counted by Spark
    (``numRowsDroppedByWatermark``); one that is late by less gets features from the ticks
    before it in time, and rows already sent are not revised.
    """
    spark = envelopes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_code(spark)
    send_by_value(__name__)
    window_us = int(round(window_seconds * 1_000_000))
    block = floor_div("ts_us", window_us)
    here, after = floor_div("_block", BLOCKS_PER_SLICE), floor_div("_block + 1", BLOCKS_PER_SLICE)
    # Counts of every micro-batch, in the query's progress under ``observedMetrics``.
    counted = envelopes.observe(
        "envelopes", F.count(F.lit(1)).alias("lines_read"), F.count_if("is_bad").alias("bad_lines")
    )
    ticks = (
        parse_ticks(counted)
        .observe("ticks", F.count(F.lit(1)).alias("valid_ticks"))
        .withColumn("event_time", F.timestamp_micros("ts_us"))
        .withWatermark("event_time", f"{delay_seconds} seconds")
        .withColumn("_block", F.expr(block))
        .withColumn("slice", F.explode(F.expr(f"array_distinct(array({here}, {after}))")))
        .withColumn("past", F.expr(f"slice != {here}"))
        .select("pair", "slice", "past", "ts", "ts_us", "seq", "midprice", "spread", "price", "event_time")
    )
    features = ticks.groupBy("pair", "slice").transformWithStateInPandas(
        statefulProcessor=TrailingWindow(window_us),
        outputStructType=FEATURE_ROW,
        outputMode="append",
        timeMode="eventTime",
    )
    return features.observe("features", F.count(F.lit(1)).alias("emitted"))


def parity(batch: DataFrame, stream: DataFrame, digits: int = 9) -> DataFrame:
    """One row: how many feature rows each side has and how many agree.

    Rows meet on (pair, ts_us, seq) and agree when every number is equal up to rounding.
    """
    key = ["pair", "ts_us", "seq"]
    numbers = [c for c in batch.columns if c not in key]
    left = batch.select(*key, *[F.col(c).alias(f"b_{c}") for c in numbers], F.lit(1).alias("in_batch"))
    right = stream.select(*key, *[F.col(c).alias(f"s_{c}") for c in numbers], F.lit(1).alias("in_stream"))
    equal = F.lit(True)
    for c in numbers:
        equal = equal & (
            F.col(f"b_{c}").eqNullSafe(F.col(f"s_{c}"))
            | F.coalesce(F.abs(F.col(f"b_{c}") - F.col(f"s_{c}")) <= 10.0**-digits, F.lit(False))
        )
    both = F.col("in_batch").isNotNull() & F.col("in_stream").isNotNull()
    return left.join(right, key, "full_outer").agg(
        F.count("in_batch").alias("batch_rows"),
        F.count("in_stream").alias("stream_rows"),
        F.count_if(both & equal).alias("equal_rows"),
        F.count_if(~both | ~equal).alias("different_rows"),
    )


def check_messages(messages: DataFrame, checkpoint: str, enough: int = 100, idle_seconds: float = 10.0) -> DataFrame:
    """One row about a stream: messages seen, whether there were ``enough``, and the seconds it took.
    Stops as soon as there are enough, or when none have come for ``idle_seconds``; writes
    nothing but its place in the stream."""
    start = time.monotonic()
    state = {"seen": 0, "last": start}

    def count(batch: DataFrame, batch_id: int) -> None:
        if found := batch.limit(enough).count():
            state["seen"] = min(enough, state["seen"] + found)
            state["last"] = time.monotonic()

    query = messages.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).start()
    try:
        while state["seen"] < enough and time.monotonic() - state["last"] < idle_seconds:
            if query.awaitTermination(0.1):
                break
    finally:
        query.stop()
    row = (state["seen"], state["seen"] >= enough, time.monotonic() - start)
    return messages.sparkSession.createDataFrame([row], "messages_seen long, enough boolean, seconds double")


def count_messages(messages: DataFrame, enough: int = 100) -> DataFrame:
    """One row: messages seen, counting no further than ``enough``, and whether there are
    enough."""
    return messages.limit(enough).agg(F.count(F.lit(1)).alias("messages_seen")).withColumn(
        "enough", F.col("messages_seen") >= enough
    )
