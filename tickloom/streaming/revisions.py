"""Trailing-window features that late ticks revise, as a stream of changes.

A tick that arrives late, but within the delay, belongs to the windows of ticks whose rows have already
been sent. Their old rows are then taken back and new ones sent, each change with a revision number
that grows with every batch of its pair and slice. Downstream the last change per tick counts;
whatever the order of arrival within the delay, the merged rows are those of a batch job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.operators.parse import parse_ticks
from tickloom.operators.trailing import BLOCKS_PER_SLICE
from tickloom.schemas import DEFAULT_WINDOW_SECONDS, FEATURE_ROW
from tickloom.session import ROCKSDB, send_by_value, ship_code
from tickloom.streaming.horizon import two_slices
from tickloom.streaming.trailing import feature_rows, window_arrays

HELD = "ts_us long, seq long, midprice double, spread double, ts double, price double, own boolean"
_HELD_COLUMNS = ["ts_us", "seq", "midprice", "spread", "ts", "price", "own"]
INSERT, RETRACT = "insert", "retract"
KEY = ["pair", "ts_us", "seq"]
CHANGE_ROW = T.StructType([*FEATURE_ROW.fields, T.StructField("change", T.StringType()), T.StructField("revision", T.LongType())])


class RevisedWindow(StatefulProcessor):
    """Keeps, per pair and slice, the ticks that a tick not yet too late may still change or need:
    those up to one window behind the watermark."""

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ticks = handle.getListState("ticks", HELD)
        self.revision = handle.getValueState("revision", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        new = pd.concat(parts, ignore_index=True)[_HELD_COLUMNS] if parts else None
        if new is None or not len(new):
            return
        held = pd.DataFrame(list(self.ticks.get()), columns=_HELD_COLUMNS).astype(new.dtypes.to_dict())
        if self.revision.exists():
            revision = self.revision.get()[0] + 1
        else:
            revision = 1
            end_us = (key[1] + 1) * BLOCKS_PER_SLICE * self.window_us
            self.handle.registerTimer(int(end_us // 1000) + 1)
        self.revision.update((revision,))
        together = pd.concat([held.assign(fresh=False), new.assign(fresh=True)], ignore_index=True)
        together = together.sort_values(["ts_us", "seq"], kind="stable", ignore_index=True)
        cut = timerValues.getCurrentWatermarkInMs() * 1000 - self.window_us
        kept = together[together["ts_us"] >= cut]
        if len(kept):
            self.ticks.put(list(zip(*[kept[c].tolist() for c in _HELD_COLUMNS])))
        else:
            self.ticks.clear()

        us, fresh = together["ts_us"].to_numpy("int64"), together["fresh"].to_numpy(bool)
        own = together["own"].to_numpy(bool)
        start = np.searchsorted(us, us - self.window_us, side="left")
        seen = np.concatenate([[0], np.cumsum(fresh)])
        touched = own & (seen[np.arange(len(us)) + 1] > seen[start])
        before = np.flatnonzero(touched[~fresh])
        if len(before):
            yield from self._changes(key[0], together[~fresh], before, RETRACT, revision)
        yield from self._changes(key[0], together, np.flatnonzero(touched), INSERT, revision)

    def _changes(self, pair, ticks: pd.DataFrame, rows: np.ndarray, change: str, revision: int) -> Iterator[pd.DataFrame]:
        us, mid = ticks["ts_us"].to_numpy("int64"), ticks["midprice"].to_numpy("float64")
        found = window_arrays(us, mid, ticks["spread"].to_numpy("float64"), rows, self.window_us)
        ok = found["size"] >= 2
        if ok.any():
            at = rows[ok]
            yield feature_rows(pair, ticks.iloc[at], us, mid[at], found, ok, at).assign(change=change, revision=revision)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.ticks.clear()
        self.revision.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_changes(envelopes: DataFrame, window_seconds: float = DEFAULT_WINDOW_SECONDS, delay_seconds: float = 10.0) -> DataFrame:
    """Changes of the feature table: the columns of a feature row, ``change`` and ``revision``.
    (pair, ts_us, seq) must tell ticks apart."""
    spark = envelopes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_code(spark)
    send_by_value(__name__, "tickloom.streaming.trailing")
    window_us = int(round(window_seconds * 1_000_000))
    ticks = parse_ticks(envelopes).withColumn("event_time", F.timestamp_micros("ts_us")).withWatermark("event_time", f"{delay_seconds} seconds")
    ticks = two_slices(ticks, window_us, 1).select("pair", "slice", "own", "ts", "ts_us", "seq", "midprice", "spread", "price", "event_time")
    return ticks.groupBy("pair", "slice").transformWithStateInPandas(
        statefulProcessor=RevisedWindow(window_us), outputStructType=CHANGE_ROW, outputMode="append", timeMode="eventTime"
    )


def merge_changes(changes: DataFrame) -> DataFrame:
    """The feature table after all ``changes``: the last one per tick, where it is an insertion."""
    columns = [c for c in changes.columns if c not in ("change", "revision")]
    last = F.max_by(F.struct("change", *[c for c in columns if c not in KEY]), F.struct("revision", F.col("change") == INSERT))
    merged = changes.groupBy(*KEY).agg(last.alias("last")).where(F.col("last.change") == INSERT)
    return merged.select(*[F.col(c) if c in KEY else F.col(f"last.{c}").alias(c) for c in columns])
