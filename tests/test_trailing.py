import numpy as np
import pytest

from helpers import assert_features, expected_features, random_ticks, ticks
from tickloom.operators.labels import label_horizon
from tickloom.operators.trailing import forward_volatility, tick_features


@pytest.mark.parametrize("seed,window", [(1, 60), (2, 60), (3, 7), (4, 1000)])
def test_against_a_queue(spark, seed, window):
    rows = random_ticks(seed)
    assert_features(tick_features(ticks(spark, rows), window), expected_features(rows, window))


def test_one_sequence_over_all_pairs(spark):
    rows = random_ticks(5)
    got = tick_features(ticks(spark, rows), 60, keys=())
    assert_features(got, expected_features(rows, 60, by_pair=False))


def test_large_moves_do_not_spoil_small_ones(spark):
    rows = random_ticks(6, n=400, pairs=("A",), volatile=1e-9)
    want = expected_features(rows, 60)
    got = {(r.pair, r.ts_us, r.seq): r.midprice_return_std for r in tick_features(ticks(spark, rows), 60).collect()}
    assert max(abs(got[k] - want[k][1]) for k in want) < 1e-15


def test_edges(spark):
    t = 1_700_000_000.0
    rows = [
        ("A", t, 1, 100.0, 1.0),          # first tick: no row
        ("A", t + 60, 2, 101.0, 1.0),     # exactly one window old: kept
        ("A", t + 121, 3, 102.0, 1.0),    # gap: no row
        ("B", t, 4, 50.0, 1.0),
        ("B", t, 5, 50.0, 1.0),           # two ticks at one time: intensity 0, std 0
        ("C", -60.0, 6, 5.0, 1.0),        # times before 1970
        ("C", -0.5, 7, 5.5, 1.0),
    ]
    got = {r.seq: r for r in tick_features(ticks(spark, rows), 60).collect()}
    assert sorted(got) == [2, 5, 7]
    assert (got[2].window_size, got[2].window_duration, got[2].midprice_return_std) == (2, 60.0, 0.0)
    assert got[2].midprice_return_mean == pytest.approx(np.log(101 / 100))
    assert (got[5].trade_intensity, got[5].window_duration) == (0.0, 0.0)
    assert got[7].window_duration == 59.5


def test_unusable_midprice_blanks_returns_only(spark):
    rows = [("A", 1000.0 + i, i, m, 0.5) for i, m in enumerate([10.0, 0.0, 11.0, -1.0, 12.0])]
    rows += [("A", 2000.0 + i, 10 + i, m, 0.5) for i, m in enumerate([10.0, 11.0])]
    assert_features(tick_features(ticks(spark, rows), 60), expected_features(rows, 60))


def test_forward_horizon(spark):
    rows = random_ticks(7, n=300)
    ordered = sorted(rows, key=lambda r: (round(r[1] * 1e6), r[2]))
    got = {r.seq: (r.ticks_ahead, r.forward_return_std) for r in forward_volatility(ticks(spark, rows), 60).collect()}
    for i, (pair, ts, seq, mid, _) in enumerate(ordered):
        ahead = [r for r in ordered[i + 1:] if r[0] == pair and round(r[1] * 1e6) <= round(ts * 1e6) + 60_000_000]
        assert got[seq][0] == len(ahead)
        if not ahead:
            assert got[seq][1] is None
        else:
            std = np.std(np.diff(np.log([mid] + [r[3] for r in ahead])))
            assert got[seq][1] == pytest.approx(std, abs=1e-12)
    labels = {r.seq: r.label for r in label_horizon(ticks(spark, rows), 1e-5, 60).collect()}
    assert all(labels[s] == (None if v is None else int(v >= 1e-5)) for s, (_, v) in got.items())


def test_one_shuffle_and_slices_spread_a_busy_pair(spark):
    df = tick_features(ticks(spark, random_ticks(8, pairs=("A",))), 60)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "_slice" in plan.split("Exchange")[1].split("\n")[0]
