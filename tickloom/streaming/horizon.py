"""Volatility of what follows each tick, on a stream.

A tick's row can only be given once its horizon has closed: when the watermark has passed the tick's
time plus the horizon, so that no tick inside it can arrive any more. Ticks wait in state, keyed by pair
and slice of time; the first horizon of a slice is also sent to the slice before it, for whose last ticks it is
the future. An event-time timer marks the next tick that is due, so rows come out in the first batch
that may give them, and state is dropped as they do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.parse import parse_ticks
from tickloom.operators.trailing import BLOCKS_PER_SLICE, floor_div
from tickloom.schemas import DEFAULT_WINDOW_SECONDS
from tickloom.session import ROCKSDB, send_by_value, ship_code
from tickloom.streaming.trailing import window_arrays

WAITING = "ts_us long, seq long, midprice double, spread double, ts double, own boolean"
_WAITING_COLUMNS = ["ts_us", "seq", "midprice", "spread", "ts", "own"]
FORWARD_ROW = "pair string, ts double, ts_us long, seq long, ticks_ahead long, forward_return_std double"


def forward_figures(ticks: pd.DataFrame, rows: np.ndarray, horizon_us: int) -> tuple[np.ndarray, np.ndarray]:
    """(ticks ahead, standard deviation of their returns) of ``rows`` of ordered ticks: the trailing
    window of the same ticks in a mirror, which only flips the sign of the returns."""
    last = len(ticks) - 1
    back = ticks.iloc[::-1]
    found = window_arrays(
        -back["ts_us"].to_numpy("int64"), back["midprice"].to_numpy("float64"), back["spread"].to_numpy("float64"), last - rows, horizon_us
    )
    ahead = found["size"] - 1
    return ahead, np.where(ahead > 0, found["std"], np.nan)


class ForwardVolatility(StatefulProcessor):
    def __init__(self, horizon_us: int):
        self.horizon_us = horizon_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ticks = handle.getListState("ticks", WAITING)
        self.due = handle.getValueState("due", "ms long")

    def _due_ms(self, ts_us: int) -> int:
        return -(-(ts_us + self.horizon_us) // 1000)

    def _wake(self, at: int | None) -> None:
        """One timer for the first tick that is due."""
        now = self.due.get()[0] if self.due.exists() else None
        if at == now:
            return
        if now is not None:
            self.handle.deleteTimer(now)
            self.due.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.due.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        new = pd.concat(parts, ignore_index=True) if parts else None
        if new is None or not len(new):
            return iter(())
        self.ticks.appendList(list(zip(*[new[c].tolist() for c in _WAITING_COLUMNS])))
        # A slice without ticks of its own is only looked at again to be dropped.
        end_us = (key[1] + 1) * BLOCKS_PER_SLICE * self.horizon_us
        own = new[new["own"]]
        first = self._due_ms(int(own["ts_us"].min())) if len(own) else self._due_ms(end_us)
        now = self.due.get()[0] if self.due.exists() else None
        self._wake(first if now is None else min(first, now))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        held = pd.DataFrame(list(self.ticks.get()), columns=_WAITING_COLUMNS)
        ticks = held.sort_values(["ts_us", "seq"], kind="stable", ignore_index=True)
        us, own = ticks["ts_us"].to_numpy("int64"), ticks["own"].to_numpy(bool)
        closed = own & (us + self.horizon_us <= passed)
        out = np.flatnonzero(closed)
        # Ticks still to come are later than the watermark and only look ahead.
        waiting = us[own & ~closed]
        needed = min(int(waiting.min()) if len(waiting) else passed + 1, passed + 1)
        kept = ticks[(us >= needed) & ~closed]
        if len(kept):
            self.ticks.put(list(zip(*[kept[c].tolist() for c in _WAITING_COLUMNS])))
            end_us = (key[1] + 1) * BLOCKS_PER_SLICE * self.horizon_us
            self._wake(self._due_ms(int(waiting.min()) if len(waiting) else max(end_us, passed)))
        else:
            self.ticks.clear()
        if not len(out):
            return iter(())
        ahead, std = forward_figures(ticks, out, self.horizon_us)
        rows = ticks.iloc[out]
        return iter(
            [
                pd.DataFrame(
                    {
                        "pair": key[0],
                        "ts": rows["ts"].to_numpy("float64"),
                        "ts_us": us[out],
                        "seq": rows["seq"].to_numpy("int64"),
                        "ticks_ahead": ahead.astype("int64"),
                        "forward_return_std": pd.Series(np.where(np.isnan(std), None, std), dtype=object),
                    }
                )
            ]
        )

    def close(self) -> None:
        pass


def two_slices(ticks: DataFrame, width_us: int, towards: int) -> DataFrame:
    """Each tick in its own slice of time and, within one block of the edge, in the next one
    (``towards`` 1) or the one before (-1); ``own`` tells which."""
    here = floor_div("_block", BLOCKS_PER_SLICE)
    there = floor_div(f"_block + {towards}", BLOCKS_PER_SLICE)
    return (
        ticks.withColumn("_block", F.expr(floor_div("ts_us", width_us)))
        .withColumn("slice", F.explode(F.expr(f"array_distinct(array({here}, {there}))")))
        .withColumn("own", F.expr(f"slice = {here}"))
        .drop("_block")
    )


def stream_horizon(envelopes: DataFrame, horizon_seconds: float = DEFAULT_WINDOW_SECONDS, delay_seconds: float = 10.0) -> DataFrame:
    """``ticks_ahead`` and ``forward_return_std`` of every valid tick, once its horizon has closed.
    Ticks more than ``delay_seconds`` behind the newest are dropped and counted by Spark."""
    spark = envelopes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_code(spark)
    send_by_value(__name__, "tickloom.streaming.trailing")
    horizon_us = int(round(horizon_seconds * 1_000_000))
    ticks = parse_ticks(envelopes).withColumn("event_time", F.timestamp_micros("ts_us")).withWatermark("event_time", f"{delay_seconds} seconds")
    ticks = two_slices(ticks, horizon_us, -1).select("pair", "slice", "own", "ts", "ts_us", "seq", "midprice", "spread", "event_time")
    return ticks.groupBy("pair", "slice").transformWithStateInPandas(
        statefulProcessor=ForwardVolatility(horizon_us), outputStructType=FORWARD_ROW, outputMode="append", timeMode="eventTime"
    )


def label_stream(forward: DataFrame, threshold: float) -> DataFrame:
    """1 where what followed was at least ``threshold`` volatile, 0 where less, NULL where nothing followed."""
    std: Column = F.col("forward_return_std")
    return forward.withColumn("label", F.when(std.isNotNull(), (std >= threshold).cast("int")))
