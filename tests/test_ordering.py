import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import labels, ordering
from tickloom.operators.ordering import percentiles, running_totals, value_at_ranks, with_next


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows hold one value; one group holds most rows."""
    rng = np.random.default_rng(0)
    n = 6000
    value = np.where(rng.random(n) < 0.34, 7.0, rng.lognormal(0, 3, n))
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.9, "big", "small"), "v": value, "w": rng.integers(0, 5, n)})
    pdf.loc[:20, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))


@pytest.mark.parametrize("small_group,buckets", [(10**6, None), (0, 37)])
def test_running_totals(skewed, small_group, buckets):
    pdf, df = skewed
    got = running_totals(df, "v", {"w": F.col("w"), "n": F.lit(1)}, ["g"], small_group, buckets).toPandas()
    want = pdf.dropna().groupby(["g", "v"]).agg(w=("w", "sum"), n=("w", "size")).reset_index()
    for group, part in want.groupby("g"):
        mine = got[got.g == group].sort_values("v")
        assert mine.v.tolist() == part.v.tolist()
        assert mine.cum_w.tolist() == part.w.cumsum().tolist()
        assert mine.cum_n.tolist() == part.n.cumsum().tolist()
        assert set(mine.total_n) == {part.n.sum()}
        assert mine.next_value.tolist()[:-1] == part.v.tolist()[1:] and np.isnan(mine.next_value.iloc[-1])


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_running_totals_cut_ranges_again(skewed, keys, monkeypatch):
    """Few cuts at a time, so that ranges are cut three times over; what is collected stays small."""
    pdf, df = skewed
    monkeypatch.setattr(ordering, "MOST_CUTS", 4)
    collected = []
    count = ordering.bucket_count
    monkeypatch.setattr(ordering, "bucket_count", lambda *a: collected.append(count(*a)) or collected[-1])
    got = running_totals(df, "v", {"n": F.lit(1)}, keys, small_group=0, bucket_rows=150).toPandas().sort_values([*keys, "v"])
    counts = pdf.dropna().assign(n=1).groupby([*keys, "v"]).n.sum()
    want = counts.groupby(level=0).cumsum() if keys else counts.cumsum()
    assert got.cum_n.tolist() == want.tolist() and len(collected) >= 3 and max(collected) == 4
    assert set(got.total_n) == (set(counts.groupby(level=0).sum()) if keys else {counts.sum()})
    inside = got.next_value.notna()
    assert (got.next_value[inside] == got.v.shift(-1)[inside]).all() and (~inside).sum() == (2 if keys else 1)


def test_running_totals_without_groups(skewed):
    pdf, df = skewed
    got = running_totals(df, "v", {"n": F.lit(1)}, small_group=0, buckets=8).toPandas().sort_values("v")
    assert got.cum_n.tolist() == pdf.v.dropna().value_counts().sort_index().cumsum().tolist()


@pytest.mark.parametrize("small_group", [10**6, 0])
def test_percentiles(skewed, small_group):
    pdf, df = skewed
    fractions = [0.0, 0.25, 0.5, 0.953, 0.999, 1.0]
    got = percentiles(df, ["v", "w"], fractions, small_group, 16).collect()
    assert len(got) == 12
    for row in got:
        want = np.percentile(pdf[row.column_name].dropna(), row.fraction * 100)
        assert row.value == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("small_group", [10**6, 100])
def test_value_at_ranks(skewed, small_group):
    pdf, df = skewed
    ordered = np.sort(pdf.v.dropna())
    ranks = [0, 1, 2500, 3000, len(ordered) - 1]
    found = value_at_ranks(df, "v", ranks, small_group, 8)
    for rank in ranks:
        assert found[rank] == (ordered[rank], int((ordered < ordered[rank]).sum()))
    with pytest.raises(ValueError):
        value_at_ranks(df, "v", [len(ordered)])


@pytest.mark.parametrize("n,small_group", [(1, None), (2, None), (7, 0), (1000, None), (1000, 100)])
def test_split_sizes_with_tied_times(spark, n, small_group):
    rng = np.random.default_rng(n)
    us = np.where(rng.random(n) < 0.4, 50, rng.integers(0, 100, n))
    pdf = pd.DataFrame({"ts_us": us, "seq": rng.permutation(n)})
    got = labels.split_by_position(spark.createDataFrame(pdf), labels.TRAIN_SHARES, small_group=small_group).toPandas()
    got = got.sort_values(["ts_us", "seq"]).split.tolist()
    a, b = int(n * 0.7), int(n * 0.7) + int(n * 0.15)
    assert got == ["train"] * a + ["validation"] * (b - a) + ["test"] * (n - b)


def test_published_split_sizes():
    n = 33_881
    a = int(n * 0.7)
    assert (a, int(n * 0.15), n - a - int(n * 0.15)) == (23_716, 5_082, 5_083)


@pytest.mark.parametrize("block_us", [10, 1000, 10**9])
def test_next_row_across_blocks(spark, block_us):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"pair": rng.choice(["A", "B"], 200), "ts_us": rng.integers(0, 5000, 200), "seq": range(200), "x": rng.random(200)})
    pdf.loc[5, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = with_next(df, "x", "nxt", block_us=block_us).toPandas().set_index("seq").nxt
    ordered = pdf.sort_values(["ts_us", "seq"])
    want = ordered.groupby("pair").x.shift(-1)
    want.index = ordered.seq
    assert got.sort_index().equals(want.sort_index())


def test_label_rules(spark):
    rows = [("A", i, i, s) for i, s in enumerate([0.1, 0.5, None, 0.2, 0.9])]
    df = spark.createDataFrame(rows, "pair string, ts_us long, seq long, midprice_return_std double")
    got = [r.label for r in labels.label_next_row(df, 0.5).orderBy("seq").collect()]
    assert got == [1, 0, 0, 1, 0]
    assert [r.label for r in labels.label_same_row(df, 0.5).orderBy("seq").collect()] == [0, 1, 0, 0, 1]
    report = labels.missing_report(df, ["midprice_return_std", "seq"]).collect()
    assert {r.column_name: (r.n_missing, r.rows_kept) for r in report} == {"midprice_return_std": (1, 4), "seq": (0, 4)}


def test_next_row_shuffles_the_table_once(spark):
    rows = spark.createDataFrame([("A", 1, 1, 1.0), (None, 1, 2, 2.0), ("", 2, 3, 3.0), (None, 10**10, 4, 4.0)], "pair string, ts_us long, seq long, v double")
    found = with_next(rows, "v", "ahead")
    assert {r.seq: r.ahead for r in found.collect()} == {1: None, 2: 4.0, 3: None, 4: None}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = with_next(rows, "v", "ahead")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Firsts of blocks, their chain, the chain's way to the join; the table itself goes once.
    assert plan.count("Exchange hashpartitioning") == 4


def test_infinite_values_and_one_hot_group(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(v,) for v in [-inf, *map(float, range(8)), inf, inf, inf, inf]], "v double")
    points = [0.0, 0.05, 0.5, 0.9, 1.0]
    ways = [{r.fraction: r.value for r in percentiles(rows, ["v"], points, small_group=s).collect()} for s in (2, 1_000_000)]
    assert ways[0] == ways[1] and ways[0][0.9] == inf and ways[0][0.0] == -inf
    groups = [(f"g{i}", float(i % 3)) for i in range(5000)] + [("hot", float(i % 700)) for i in range(3000)] + [(None, 1.0)] * 3
    table = spark.createDataFrame(groups, "k string, v double")
    totals = [
        sorted((str(r.k), r.v, r.n, r.cum_n, r.total_n, str(r.next_value)) for r in running_totals(table, "v", {"n": F.lit(1)}, ["k"], small_group=s).collect())
        for s in (100, 1_000_000)
    ]
    assert totals[0] == totals[1] and len(totals[0]) == 5701


def test_percentiles_search_no_cut_points_row_by_row(skewed, monkeypatch):
    """Rows are compared with a range around each rank; none is looked up among cut points."""
    pdf, df = skewed

    def refused(*given):
        raise AssertionError("a search for every row")

    monkeypatch.setattr(ordering, "bucket_of", refused)
    fractions = [0.0, 0.004, 0.25, 0.5, 0.75, 0.999, 1.0]
    for buckets in (2, 16, 500):
        got = {(r.column_name, r.fraction): r.value for r in percentiles(df, ["v", "w"], fractions, 0, buckets).collect()}
        want = {(c, f): pdf[c].quantile(f) for c in ("v", "w") for f in fractions}
        assert got == pytest.approx(want, rel=1e-12)


def test_percentiles_where_the_quantiles_are_off(skewed, monkeypatch):
    pdf, df = skewed
    wrong = lambda value, fractions, accuracy: F.transform(fractions, lambda _: F.max(value))
    monkeypatch.setattr(F, "approx_percentile", wrong)
    monkeypatch.setattr(ordering, "value_at_ranks", lambda df, c, ranks: {r: (float(pdf[c].dropna().sort_values().iloc[r]), 0) for r in ranks})
    got = {r.fraction: r.value for r in percentiles(df, ["v"], [0.25, 0.5], 0, 16).collect()}
    assert got == pytest.approx({f: pdf.v.quantile(f) for f in (0.25, 0.5)}, rel=1e-12)


def test_percentiles_of_an_empty_column_beside_a_full_one(spark):
    rows = spark.range(100).select(F.lit(None).cast("double").alias("none"), F.col("id").cast("double").alias("x"))
    assert [tuple(r) for r in percentiles(rows, ["none", "x"], [0.5], small_group=0).collect()] == [("x", 0.5, 49.5)]
    assert percentiles(rows, ["none"], [0.5], small_group=-1).collect() == []
