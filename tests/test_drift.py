from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pytest

from tickloom.functions.statistics import ks_p_value
from tickloom.operators import drift, profile, quality


def brute_p(d, n, m):
    hits = 0
    for chosen in combinations(range(n + m), n):
        first, i, j, gap = set(chosen), 0, 0, 0.0
        for k in range(n + m):
            i, j = (i + 1, j) if k in first else (i, j + 1)
            gap = max(gap, abs(i / n - j / m))
        hits += gap >= d - 1e-12
    return hits / comb(n + m, n)


def test_ks_p_values():
    assert ks_p_value(1.0, 21, 22) == pytest.approx(1.9010512665849565e-12, rel=1e-12)
    for n, m in [(5, 4), (4, 6), (1, 3)]:
        for d in (0.2, 0.4, 0.5, 0.75, 1.0):
            assert ks_p_value(d, n, m) == pytest.approx(brute_p(d, n, m), rel=1e-12)
    assert ks_p_value(0.02, 9000, 9500) == pytest.approx(ks_p_value(0.02, 10**4 + 1, 9000), rel=0.2)


def frames(spark, a, b):
    return (spark.createDataFrame(pd.DataFrame(x)) for x in (a, b))


@pytest.mark.parametrize("small_group", [None, 0])
def test_distances(spark, small_group):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(0, 1, 400), 2), np.round(rng.normal(0.3, 2, 300), 2)
    ref, cur = frames(spark, {"x": a}, {"x": b})
    got = drift.distances(drift.both_sides(ref, cur, ["x"]), ["x"], small_group).first()
    grid = np.unique(np.concatenate([a, b]))
    gap = np.abs([(a <= v).mean() - (b <= v).mean() for v in grid])
    assert got.ks == pytest.approx(gap.max(), rel=1e-12)
    assert got.area == pytest.approx((gap[:-1] * np.diff(grid)).sum(), rel=1e-12)
    assert (got.n_reference, got.n_current, got.n_values) == (400, 300, len(grid))


def test_published_scores(spark):
    """The label column of the published report, and fully separated small samples."""
    ref, cur = frames(spark, {"label": [0] * 22809 + [1] * 907}, {"label": [0] * 2732 + [1] * 2351})
    got = drift.drift_by_column(ref, cur, ["label"]).first()
    assert got.test == drift.JENSEN_SHANNON and got.drift
    assert got.score == pytest.approx(0.3693593047833502, rel=1e-12)
    ref, cur = frames(spark, {"x": np.arange(21.0)}, {"x": np.arange(100.0, 122.0)})
    got = drift.drift_by_column(ref, cur, ["x"]).first()
    assert got.test == drift.KS and got.drift and got.score == pytest.approx(1.9010512665849565e-12, rel=1e-12)


def test_dataset_drift_needs_half(spark):
    rows = lambda *flags: spark.createDataFrame([(f,) for f in flags], "drift boolean")
    assert drift.dataset_drift(rows(True, True, True, False, False, False)).first().dataset_drift
    assert not drift.dataset_drift(rows(True, False, False)).first().dataset_drift


def test_densities_and_constant_column(spark):
    a = np.random.default_rng(3).gamma(2, 1, 500)
    ref, cur = frames(spark, {"x": a}, {"x": np.full(20, 0.25)})
    got = drift.densities(ref, cur, ["x"]).toPandas().sort_values(["side", "bin"])
    want, edges = np.histogram(a, 10, density=True)
    mine = got[got.side == "reference"]
    assert np.allclose(mine.density, want) and np.allclose(mine.bin_start, edges[:-1])
    flat, edges = np.histogram(np.full(20, 0.25), 10, density=True)
    mine = got[got.side == "current"]
    assert np.allclose(mine.density, flat) and np.allclose(mine.bin_start, edges[:-1])


def test_histogram_bins_like_numpy(spark):
    a = np.round(np.random.default_rng(4).uniform(0, 1, 2000), 2)
    got = profile.histogram(spark.createDataFrame(pd.DataFrame({"x": a})), "x", 50).orderBy("bin").toPandas()
    lo, w = a.min(), (a.max() - a.min()) / 50
    edges = lo + np.arange(51) * w
    want = [((a >= edges[i]) & ((a < edges[i + 1]) | (i == 49))).sum() for i in range(50)]
    assert got.n.tolist() == want and got.n.sum() == len(a)


def test_published_quality_of_small_window(spark):
    """21 rows with four constant columns, two of them equal."""
    rng = np.random.default_rng(5)
    ref = {"mean": np.zeros(21), "std": np.zeros(21), "spread": np.full(21, 0.01), "intensity": rng.random(21), "imbalance": np.full(21, 1e-7)}
    cur = {k: rng.random(22) for k in ref}
    a, b = frames(spark, ref, cur)
    sides = drift.both_sides(a, b, list(ref))
    got = {(r.side, r.metric): r.value for r in quality.dataset_summary(sides).collect()}
    assert got[("reference", "number_of_constant_columns")] == 4
    assert got[("reference", "number_of_almost_constant_columns")] == 4
    assert got[("reference", "number_of_duplicated_columns")] == 1
    assert got[("current", "number_of_constant_columns")] == 0
    facts = {r.column_name: r for r in quality.column_summary(sides).where("side = 'reference'").collect()}
    assert facts["spread"].unique_percentage == 4.76 and facts["spread"].most_common_percentage == 100.0
    assert facts["intensity"].unique == 21 and facts["intensity"].most_common_percentage == 4.76


def test_missing_and_infinite(spark):
    rows = [(1.0, "a"), (float("nan"), ""), (None, None), (float("inf"), "b"), (float("-inf"), "b")]
    df = spark.createDataFrame(rows, "x double, t string")
    sides = drift.both_sides(df, df.limit(0), ["x", "t"])
    kinds = {(r.column_name, r.kind): r.n for r in quality.missing_kinds(sides).collect()}
    assert kinds == {
        ("x", "empty"): 0, ("x", "-Infinity"): 1, ("x", "Infinity"): 1, ("x", "null"): 2,
        ("t", "empty"): 1, ("t", "-Infinity"): 0, ("t", "Infinity"): 0, ("t", "null"): 1,
    }
    total = {r.metric: r.value for r in quality.missing_overview(sides).collect()}
    assert total["number_of_missing_values"] == 6 and total["number_of_rows_with_missing_values"] == 4
    assert {r.column_name: r.n_missing for r in profile.null_counts(df).collect()} == {"x": 2, "t": 1}


def test_describe_and_correlations(spark):
    pdf = pd.DataFrame(np.random.default_rng(6).normal(size=(300, 2)), columns=["a", "b"])
    pdf["c"] = 1.0
    df = spark.createDataFrame(pdf)
    for small_group in (None, 0):
        got = profile.describe(df, ["a", "b"], small_group=small_group).toPandas().set_index("column_name").loc[["a", "b"]]
        want = pdf[["a", "b"]].describe().T
        want.columns = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
        assert np.allclose(got.astype(float), want)
    got = {(r.column_a, r.column_b): r.correlation for r in profile.correlations(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(pdf.a.corr(pdf.b), rel=1e-9)
    assert got[("a", "c")] is None and got[("a", "a")] == pytest.approx(1.0)
    assert len(got) == 9


def test_ecdf_and_sweep(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 2, 4]], "x double")
    got = {r.value: r.percentile for r in profile.ecdf(df, "x").collect()}
    assert got == {1.0: 50.0, 2.0: 75.0, 4.0: 100.0}
    swept = {r.threshold_name: (r.n_reaching, r.pct_reaching) for r in profile.threshold_sweep(df, "x", {"low": 2.0, "high": 9.0}).collect()}
    assert swept == {"low": (2, 50.0), "high": (0, 0.0)}
    assert {r.x: r.share for r in profile.value_shares(df, "x").collect()} == {1.0: 0.5, 2.0: 0.25, 4.0: 0.25}
    gaps = spark.createDataFrame([("A", 0, 1), ("A", 2_500_000, 2), ("B", 9, 3)], "pair string, ts_us long, seq long")
    assert {r.seq: r.gap_seconds for r in profile.arrival_gaps(gaps).collect()} == {1: 2.5, 2: None, 3: None}


def test_uniques_of_numbers_need_no_sort(spark):
    """Values are grouped by how often they occur; among equally common ones the least is reported."""
    rows = [("reference", 2.0, 7), ("reference", -1.0, 7), ("reference", 10.0, None), ("reference", None, 3), ("current", float("inf"), None), ("current", -0.0, None), ("current", 0.0, None), ("current", float("nan"), None)]
    sides = spark.createDataFrame(rows, "side string, x double, k int")
    found = quality.uniques(sides)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.side, r.column_name): (r.n_rows, r.n_missing, r.n_unique, r.top_n, r.top_value) for r in found.collect()}
    assert got == {
        ("reference", "x"): (4, 1, 3, 1, "-1.0"), ("reference", "k"): (4, 1, 2, 2, "7"),
        ("current", "x"): (4, 1, 2, 2, "0.0"), ("current", "k"): (4, 4, 0, None, None),
    }


def test_early_late_report_stores_its_columns_once(spark, monkeypatch):
    from tickloom.plans import reports
    from tickloom.operators.labels import split_early_late

    rows = spark.createDataFrame([(i, i, float(i % 7), "x" * 50) for i in range(40)], "ts_us long, seq long, midprice_return_std double, note string")
    plain, kept, wide = reports.stored, [], ["ts_us", "seq", "midprice_return_std"]
    monkeypatch.setattr(reports, "stored", lambda df, name="stage": kept.append(df.columns) or plain(df, name))
    got = reports.early_late_report(rows)
    assert [c for c in kept if "ts_us" in c] == [wide]
    split = split_early_late(rows)
    want = reports.combined_report(split.where("split = 'reference'"), split.where("split = 'current'"), ["midprice_return_std"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
