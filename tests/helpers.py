"""Plain restatements of the definitions, one row at a time, to test against."""

import json
import math
from collections import deque

import numpy as np
from pyspark.sql import functions as F

from tickloom.schemas import TICK


def tick_rows(rows):
    """(pair, seconds, seq, mid, spread) as tick tuples."""
    return [
        (pair, float(ts), int(round(ts * 1e6)), seq, mid, mid - spread / 2, mid + spread / 2, mid, spread, None, None)
        for pair, ts, seq, mid, spread in rows
    ]


def ticks(spark, rows):
    return spark.createDataFrame(tick_rows(rows), TICK)


def expected_features(rows, window_seconds, by_pair=True):
    """{(pair, ts_us, seq): features}, holding the window as a queue."""
    window = int(window_seconds * 1e6)
    queues, out = {}, {}
    for pair, ts, seq, mid, spread in sorted(rows, key=lambda r: (round(r[1] * 1e6), r[2])):
        us = int(round(ts * 1e6))
        queue = queues.setdefault(pair if by_pair else "", deque())
        queue.append((us, mid, spread))
        while queue[0][0] < us - window:
            queue.popleft()
        if len(queue) < 2:
            continue
        mids = np.array([q[1] for q in queue])
        good = np.all(mids > 0)
        returns = np.diff(np.log(mids)) if good else None
        seconds = (queue[-1][0] - queue[0][0]) / 1e6
        avg = float(np.mean([q[2] for q in queue]))
        out[(pair, us, seq)] = (
            float(np.mean(returns)) if good else None,
            float(np.std(returns)) if good else None,
            avg,
            len(queue) / seconds if seconds > 0 else 0.0,
            avg / mid if mid > 0 else 0.0,
            len(queue),
            seconds,
        )
    return out


FEATURE_COLUMNS = [
    "midprice_return_mean", "midprice_return_std", "bid_ask_spread", "trade_intensity",
    "order_book_imbalance", "window_size", "window_duration",
]


def assert_features(df, expected, tolerance=1e-12):
    got = {(r.pair, r.ts_us, r.seq): tuple(r[c] for c in FEATURE_COLUMNS) for r in df.collect()}
    assert got.keys() == expected.keys()
    for key, want in expected.items():
        for name, a, b in zip(FEATURE_COLUMNS, got[key], want):
            if a is None or b is None:
                assert a is b, (key, name, a, b)
            else:
                assert math.isclose(a, b, rel_tol=1e-9, abs_tol=tolerance), (key, name, a, b)


def random_ticks(seed, n=600, pairs=("A", "B"), volatile=1e-5):
    """Bursts, ties, gaps longer than a window and a jump far above normal noise."""
    rng = np.random.default_rng(seed)
    rows, now, level = [], 1_700_000_000.0, {p: 100.0 * (i + 1) for i, p in enumerate(pairs)}
    for seq in range(n):
        now += float(rng.choice([0.0, 0.01, 0.5, 3.0, 20.0, 60.0, 300.0], p=[0.15, 0.3, 0.3, 0.12, 0.08, 0.03, 0.02]))
        pair = str(rng.choice(pairs))
        level[pair] *= math.exp(rng.normal(0, volatile))
        mid = level[pair] * (10 if rng.random() < 0.005 else 1)
        rows.append((pair, round(now, 6), seq, mid, float(rng.uniform(0, 0.1))))
    return rows


def lines(rows):
    """Archive lines, quotes set so that midprice and spread come back exactly enough."""
    for pair, ts, seq, mid, spread in rows:
        raw = json.dumps({"price": str(mid), "best_bid": mid - spread / 2, "best_ask": str(mid + spread / 2)})
        yield json.dumps({"ts": ts, "pair": pair, "raw": raw, "seq": seq})


def from_archive(rows):
    """The same rows with midprice and spread as they come out of the quotes."""
    out = []
    for pair, ts, seq, mid, spread in rows:
        bid, ask = mid - spread / 2, mid + spread / 2
        out.append((pair, ts, seq, (bid + ask) / 2, ask - bid))
    return out


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.select(key, F.col(value)).collect()}
