import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.models import boosting
from tickloom.models.boosting import MISSING, BoostedTrees, Tree, best_split, boost, feature_cuts
from tickloom.models.classifiers import fit_logistic, fit_trees, importance
from tickloom.models.registry import load_model, predict, save_model
from tickloom.schemas import FEATURES


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_tree(x, g, h, cuts, depth, rate, rows=None, place=1, out=None):
    """{place: (feature, cut, missing left, gain) or value}, splitting one node after the other and
    trying every cut row by row."""
    out = {} if out is None else out
    rows = np.arange(len(g)) if rows is None else rows
    total_g, total_h = g[rows].sum(), h[rows].sum()
    best = None
    if place < 2**depth:
        for feature in range(x.shape[1]):
            v = x[rows, feature]
            for left_too in (True, False) if np.isnan(v).any() else (True,):
                for cut in cuts[feature]:
                    left = (v <= cut) | (np.isnan(v) & left_too)
                    lg, lh = g[rows[left]].sum(), h[rows[left]].sum()
                    rg, rh = total_g - lg, total_h - lh
                    if lh < 1 or rh < 1:
                        continue
                    gain = 0.5 * (lg**2 / (lh + 1) + rg**2 / (rh + 1) - total_g**2 / (total_h + 1))
                    if gain > 1e-6 and (best is None or gain > best[3] * (1 + 1e-9)):
                        best = (feature, cut, left_too, gain, left)
    if best is None:
        out[place] = -rate * total_g / (total_h + 1)
        return out
    out[place] = best[:4]
    plain_tree(x, g, h, cuts, depth, rate, rows[best[4]], 2 * place, out)
    plain_tree(x, g, h, cuts, depth, rate, rows[~best[4]], 2 * place + 1, out)
    return out


def plain_margin(tree, row):
    place = 1
    while isinstance(tree[place], tuple):
        feature, cut, left_too, _ = tree[place]
        place = 2 * place + (0 if (left_too if np.isnan(row[feature]) else row[feature] <= cut) else 1)
    return tree[place]


@pytest.fixture(scope="module")
def drawn():
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(500, 3)), 2)
    x[rng.random((500, 3)) < 0.05] = np.nan
    y = (np.nan_to_num(x[:, 0]) ** 2 + np.nan_to_num(x[:, 1]) + rng.normal(size=500) > 1.5).astype(int)
    return x, y


def test_equals_a_plain_restatement(spark, drawn, monkeypatch):
    x, y = drawn
    names = ["a", "b", "c"]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y)).repartition(3)
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)  # margins are written back on the way
    weight = (y == 0).sum() / (y == 1).sum()
    cuts = feature_cuts(df, names)
    model = boost(df, names, "y", weight, depth=3, rounds=5)
    margin = np.zeros(len(y))
    for tree in model.trees:
        p = sigmoid(margin)
        w = np.where(y == 1, weight, 1.0)
        want = plain_tree(x, w * (p - y), w * p * (1 - p), cuts, 3, 0.1)
        places = {0: 1}
        for node, feature in enumerate(tree.feature):
            place = places[node]
            if feature < 0:
                assert tree.value[node] == pytest.approx(want.pop(place), rel=1e-9)
                continue
            found = want.pop(place)
            assert (feature, tree.cut[node], tree.missing_left[node]) == found[:3]
            assert tree.gain[node] == pytest.approx(found[3], rel=1e-9)
            places[tree.left[node]], places[tree.right[node]] = 2 * place, 2 * place + 1
        assert not want
        again = plain_tree(x, w * (p - y), w * p * (1 - p), cuts, 3, 0.1)
        margin += [plain_margin(again, row) for row in x]
    got = model.transform(df).toPandas()
    want = {tuple(map(str, row)): sigmoid(m) for row, m in zip(x, margin)}
    assert np.allclose(got.spike_probability, [want[tuple(map(str, row))] for row in got[names].to_numpy()], rtol=1e-9)
    assert (got.predicted_label == (got.spike_probability > 0.5)).all()


def test_cuts_leave_equal_values_together(spark):
    df = spark.createDataFrame([(float(i % 3), None if i % 5 else float("nan")) for i in range(100)], "a double, b double")
    a, b = feature_cuts(df, ["a", "b"])
    assert a.tolist() == [0.0, 1.0, 2.0] and not len(b)


def test_no_split_without_gain():
    g, h = np.zeros((1, MISSING + 1)), np.zeros((1, MISSING + 1))
    h[0, :4] = 5.0
    assert best_split(g, h, [np.arange(3.0)], 1.0, 1.0) is None
    g[0, :4] = [1.0, 1.0, -1.0, -1.0]
    split = best_split(g, h, [np.arange(3.0)], 1.0, 1.0)
    assert (split.feature, split.bin) == (0, 1) and best_split(g, h, [np.arange(3.0)], 1.0, 11.0) is None


def test_a_tree_of_one_leaf():
    tree = Tree()
    tree.add(0.25, 4.0)
    assert BoostedTrees(["a"], [tree, tree]).margin(np.array([[1.0, np.nan]])).tolist() == [0.5, 0.5]


def test_saved_and_loaded(spark, drawn, tmp_path):
    x, y = drawn
    rows = pd.DataFrame(np.column_stack([x, x[:, :2] * 2]), columns=FEATURES).assign(label=y, row=range(len(y)))
    df = spark.createDataFrame(rows)
    model = fit_trees(df, rounds=4)
    path = str(tmp_path / "trees")
    save_model(model, path, spark, "boosted_trees")
    again, kind = load_model(path, spark)
    assert kind == "boosted_trees" and again.logged() == model.logged() and again.logged()["max_depth"] == "5"
    key = lambda m: predict(m, df).select("row", "predicted_label", "spike_probability").orderBy("row").collect()
    assert key(again) == key(model)
    assert set(predict(again, df).columns) == {*df.columns, "predicted_label", "spike_probability"}
    shares = importance(again, "t", spark).collect()
    assert sum(r.value for r in shares) == pytest.approx(1.0) and [r.value for r in shares] == sorted((r.value for r in shares), reverse=True)
    with pytest.raises(ValueError):
        fit_trees(df.where("label = 1"), rounds=1)


def test_missing_features(spark, drawn):
    x, y = drawn
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, x[:, :2]]), columns=FEATURES).assign(label=y))
    with pytest.raises(ValueError, match="missing"):
        fit_logistic(df)
    complete = df.dropna().where(" and ".join(f"not isnan({f})" for f in FEATURES))
    model = fit_logistic(complete)
    assert model.transform(complete).where(F.col("spike_probability").between(0, 1)).count() == complete.count()
    with pytest.raises(Exception, match="a feature is missing"):
        model.transform(df).collect()


def test_a_level_looks_at_its_own_tree_alone(spark, drawn, monkeypatch):
    x, y = drawn
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y)).repartition(3)
    plain, seen = boosting._histograms, []

    def counted(*given):
        trees = [t for g in given for t in (g if isinstance(g, list) else [g]) if isinstance(t, Tree)]
        seen.append(len(trees))
        return plain(*given)

    monkeypatch.setattr(boosting, "_histograms", counted)
    boost(df, ["a", "b", "c"], "y", 1.0, depth=2, rounds=4)
    assert set(seen) == {1}


def test_margins_at_cuts_infinities_and_missing_values():
    tree = Tree()
    for value in (0.0, 1.0, 2.0, 4.0, 8.0):
        tree.add(value, 1.0)
    tree.feature[0], tree.cut[0], tree.missing_left[0], tree.left[0], tree.right[0] = 0, 0.5, False, 1, 2
    tree.feature[2], tree.cut[2], tree.missing_left[2], tree.left[2], tree.right[2] = 1, -3.0, True, 3, 4
    nan, inf = float("nan"), float("inf")
    values = np.array([[0.5, 0.6, -inf, inf, nan, nan, 0.6], [9.0, -3.0, inf, -2.9, nan, inf, -inf]])
    assert BoostedTrees(["a", "b"], [tree]).margin(values).tolist() == [1.0, 4.0, 1.0, 8.0, 4.0, 8.0, 4.0]
