import numpy as np
import pandas as pd
import pytest

from tickloom.operators.drift import both_sides, distances
from tickloom.operators.sketches import K, merge_range, range_drift, range_percentiles, range_uniques, rank_error, sketch_rows

DAY = 86_400_000_000


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 40_000
    pdf = pd.DataFrame({"ts_us": rng.integers(-5 * DAY, 15 * DAY, n), "a": rng.lognormal(0, 2, n), "b": rng.integers(0, 50, n).astype(float)})
    pdf.loc[pdf.ts_us >= 5 * DAY, "a"] *= 1.5
    pdf.loc[:200, "a"] = np.nan
    pdf.loc[300:320, "a"] = np.inf
    return pdf, spark.createDataFrame(pdf)


def finite(values):
    return np.sort(values[np.isfinite(values)])


def test_ranks_are_within_the_bound(rows):
    pdf, df = rows
    table = sketch_rows(df, ["a", "b"], 86_400)
    assert table.count() == 40
    fractions = [0.01, 0.1, 0.5, 0.9, 0.99]
    for begin, end in ((None, None), (0, 4 * DAY)):
        part = pdf if begin is None else pdf[(pdf.ts_us >= begin) & (pdf.ts_us < end)]
        merged = merge_range(table, begin, end)
        for r in range_percentiles(merged, fractions).collect():
            values = finite(part[r.column_name].to_numpy())
            assert r.n == len(values)
            below, upto = np.searchsorted(values, r.value, "left") / len(values), np.searchsorted(values, r.value, "right") / len(values)
            assert below - rank_error() <= r.fraction <= upto + rank_error()
        ends = {r.column_name: (r.lowest, r.highest) for r in merged.collect()}
        for c in ("a", "b"):
            values = finite(part[c].to_numpy())
            assert ends[c] == (values[0], values[-1])
        for r in range_uniques(merged).collect():
            assert r.n_unique == pytest.approx(len(np.unique(finite(part[r.column_name].to_numpy()))), rel=0.06)


def test_adding_buckets_equals_one_pass(rows):
    _, df = rows
    whole = merge_range(sketch_rows(df, ["b"], 86_400)).first()
    parts = sketch_rows(df.where(f"ts_us < {3 * DAY}"), ["b"], 86_400).unionByName(sketch_rows(df.where(f"ts_us >= {3 * DAY}"), ["b"], 86_400))
    merged = merge_range(parts).first()
    assert (merged.n, merged.lowest, merged.highest) == (whole.n, whole.lowest, whole.highest)


def test_drift_is_within_its_error(rows):
    _, df = rows
    table = sketch_rows(df, ["a", "b"], 86_400)
    got = {r.column_name: r for r in range_drift(merge_range(table, None, 5 * DAY), merge_range(table, 5 * DAY, None)).collect()}
    sides = both_sides(df.where(f"ts_us < {5 * DAY}"), df.where(f"ts_us >= {5 * DAY}"), ["a", "b"])
    for r in distances(sides, ["a", "b"]).collect():
        assert abs(got[r.column_name].ks - r.ks) <= got[r.column_name].error
        assert (got[r.column_name].n_reference, got[r.column_name].n_current) == (r.n_reference, r.n_current)
    assert got["a"].ks > 0.07 and got["a"].ks > 3 * got["b"].ks and K == 1000


def test_empty_ranges(rows):
    _, df = rows
    table = sketch_rows(df.limit(0), ["a"], 60)
    assert table.count() == 0 and merge_range(table).count() == 0
    assert range_drift(merge_range(table), merge_range(sketch_rows(df, ["a"], 86_400))).count() == 0
