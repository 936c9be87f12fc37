import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.models.classifiers import LOGISTIC, available_columns, fit_logistic, importance
from tickloom.models.registry import load_model, predict, prediction_counts, save_model
from tickloom.models.zscore import ZScoreModel, fit_zscore
from tickloom.operators import evaluate
from tickloom.plans.scoring import latency_check
from tickloom.schemas import FEATURES

# Published counts per model and split (tn, fp, fn, tp) with accuracy, F1, precision, recall.
PUBLISHED = {
    ("zscore", "train"): ((22808, 1, 282, 625), (0.9881, 0.8154, 0.9984, 0.6891)),
    ("zscore", "validation"): ((3104, 2, 330, 1646), (0.9347, 0.9084, 0.9988, 0.8330)),
    ("zscore", "test"): ((2731, 1, 182, 2169), (0.9640, 0.9595, 0.9995, 0.9226)),
    ("logistic", "train"): ((16017, 6792, 409, 498), (0.6964, 0.1215, 0.0683, 0.5491)),
    ("logistic", "validation"): ((3105, 1, 1087, 889), (0.7859, 0.6204, 0.9989, 0.4499)),
    ("logistic", "test"): ((2531, 201, 1845, 506), (0.5975, 0.3309, 0.7157, 0.2152)),
    ("trees", "train"): ((22774, 35, 0, 907), (0.9985, 0.9811, 0.9628, 1.0)),
    ("trees", "validation"): ((3059, 47, 11, 1965), (0.9886, 0.9855, 0.9766, 0.9944)),
    ("trees", "test"): ((2679, 53, 3, 2348), (0.9890, 0.9882, 0.9779, 0.9987)),
}


def test_rates_from_published_counts(spark):
    rows = [(m, s, *counts) for (m, s), (counts, _) in PUBLISHED.items()]
    schema = "model string, split string, " + ", ".join(f"{c} long" for c in evaluate.METRICS[6:])
    for row in evaluate.rates(spark.createDataFrame(rows, schema)).collect():
        want = PUBLISHED[(row.model, row.split)][1]
        assert (row.accuracy, row.f1_score, row.precision, row.recall) == pytest.approx(want, abs=5e-5)


def brute_areas(y, s):
    """Average precision, ROC-AUC and trapezoid area from the definitions."""
    thresholds = np.unique(s)[::-1]
    points = [(y[s >= t].sum(), (1 - y)[s >= t].sum()) for t in thresholds]
    pos = y.sum()
    ap = trap = 0.0
    last_r, last_p = 0.0, 1.0
    for tp, fp in points:
        r, p = tp / pos, tp / (tp + fp)
        ap += (r - last_r) * p
        trap += (r - last_r) * (p + last_p) / 2
        last_r, last_p = r, p
    wins = sum((a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0])
    return ap, wins / (pos * (len(y) - pos)), trap


@pytest.mark.parametrize("small_group", [None, 0])
def test_areas_with_tied_scores(spark, small_group):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 200)
    s = np.round(rng.random(200) * 0.5 + y * 0.3, 1)
    df = spark.createDataFrame(pd.DataFrame({"m": "x", "label": y, "spike_probability": s}))
    curve = evaluate.score_curve(df, ["m"], small_group=small_group)
    got = evaluate.curve_areas(curve, ["m"]).first()
    assert (got.pr_auc, got.roc_auc, got.pr_curve_area) == pytest.approx(brute_areas(y, s), rel=1e-12)


def test_areas_of_very_many_rows(spark):
    """Counts whose products pass 64 bits."""
    n = 4_000_000_000_000
    row = (n, n, n, n, n, n, 1.0, 1.0, 0)
    names = ["pos", "neg", "true_positives", "false_positives", "total_pos", "total_neg", "precision", "precision_before", "true_positives_before"]
    got = evaluate.curve_areas(spark.createDataFrame([row], names)).first()
    assert (got.pr_auc, got.roc_auc) == (1.0, 0.5)


def test_single_class(spark):
    rows = [("m", "s", 0, 0, 0.1), ("m", "s", 0, 0, 0.2), ("m", "t", 1, 1, 0.2), ("m", "u", 0, 1, 0.2)]
    df = spark.createDataFrame(rows, "model string, split string, label int, predicted_label int, spike_probability double")
    got = {r.split: r for r in evaluate.evaluate(df).collect()}
    assert (got["s"].accuracy, got["s"].f1_score, got["s"].pr_auc, got["s"].roc_auc) == (1.0, 0.0, 0.0, 0.0)
    assert got["s"].true_negatives is None and got["t"].true_positives is None
    assert got["t"].pr_auc == 1.0 and got["u"].false_positives == 1


def test_zscore_demo(spark, tmp_path):
    rng = np.random.default_rng(42)
    x = rng.exponential(1e-4, 1000)
    x[rng.choice(1000, 50, replace=False)] *= 10
    df = spark.createDataFrame(pd.DataFrame({"midprice_return_std": x, "n": range(1000)}))
    model = fit_zscore(df)
    assert (model.mean, model.std) == pytest.approx((x.mean(), x.std()), rel=1e-12)
    save_model(model, str(tmp_path / "z"), spark)
    loaded, kind = load_model(str(tmp_path / "z"), spark)
    assert (loaded, kind) == (model, "zscore")
    got = loaded.transform(df).orderBy("n").toPandas()
    z = (x - x.mean()) / (x.std() + 1e-10)
    assert got.predicted_label.tolist() == (x > x.mean() + 2 * x.std()).astype(int).tolist()
    assert np.allclose(got.spike_probability, 1 / (1 + np.exp(-(z - 2))), rtol=1e-12)
    assert prediction_counts(got_df := loaded.transform(df)).first().predicted_spikes == got.predicted_label.sum()
    assert "spike_probability" in got_df.columns


def test_errors(spark, tmp_path):
    df = spark.range(3).withColumn("x", F.lit(1.0))
    with pytest.raises(ValueError):
        ZScoreModel().transform(df)
    with pytest.raises(ValueError):
        fit_zscore(df)
    with pytest.raises(ValueError):
        load_model(str(tmp_path / "nothing"), spark)
    with pytest.raises(ValueError, match="midprice_return_std"):
        predict(ZScoreModel(mean=0.0, std=1.0), df)
    with pytest.raises(ValueError):
        save_model(object(), str(tmp_path / "m"), spark, "forest")
    with pytest.raises(ValueError):
        available_columns(["nope"], df)
    save_model(ZScoreModel(mean=0.0, std=1.0), str(tmp_path / "z"), spark)
    with pytest.raises(ValueError):
        load_model(str(tmp_path / "z"), spark, LOGISTIC)


def test_available_columns(spark):
    a = spark.range(1).selectExpr("1 as f", "1 as g", "0 as label")
    assert available_columns(["f", "g", "h"], a, a.drop("g")) == ["f", "label"]
    assert available_columns(["f"], a, a.drop("label")) == ["f"]


def newton_logistic(x, y, steps=50):
    """Weighted logistic regression with an L2 penalty of one half the squared norm."""
    n, pos = len(y), y.sum()
    w = np.where(y == 1, n / (2 * pos), n / (2 * (n - pos)))
    a = np.column_stack([np.ones(n), x])
    penalty = np.diag([0.0] + [1.0] * x.shape[1])
    beta = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-a @ beta))
        gradient = a.T @ (w * (p - y)) + penalty @ beta
        hessian = (a * (w * p * (1 - p))[:, None]).T @ a + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_logistic_matches_its_objective(spark, tmp_path):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=400) > 1).astype(int)
    df = spark.createDataFrame(pd.DataFrame(x, columns=FEATURES).assign(label=y, row=range(400)))
    model = fit_logistic(df)
    want = newton_logistic(x, y)
    assert model.intercept == pytest.approx(want[0], abs=1e-9)
    assert np.allclose(model.coefficients, want[1:], atol=1e-9)
    ranked = [r.feature for r in importance(model, LOGISTIC, spark).collect()]
    assert ranked == [f for _, f in sorted(zip(-np.abs(want[1:]), FEATURES))]
    save_model(model, str(tmp_path / "lr"), spark, LOGISTIC)
    again, kind = load_model(str(tmp_path / "lr"), spark)
    scored = predict(again, df).orderBy("row").toPandas()
    p = 1 / (1 + np.exp(-(want[0] + x @ want[1:])))
    assert kind == LOGISTIC and np.allclose(scored.spike_probability, p, atol=1e-9)
    assert set(scored.columns) == {*FEATURES, "label", "row", "predicted_label", "spike_probability"}


def test_latency(spark):
    assert latency_check(spark, 119.9).first().status == "PASS"
    assert latency_check(spark, 120.0).first().status == "FAIL"


def test_verdict_and_comparison(spark):
    rows = [("a", "test", "pr_auc", 0.5), ("b", "test", "pr_auc", 0.75), ("a", "test", "recall", 0.1), ("b", "train", "pr_auc", 0.1)]
    metrics = spark.createDataFrame(rows, "model string, split string, metric string, value double")
    got = evaluate.verdict(metrics, "a", "b").first()
    assert (got.improvement_pct, got.better_model, got.baseline_meets_target, got.challenger_meets_target) == (50.0, "b", False, True)
    assert evaluate.verdict(metrics, "none", "b").first().improvement_pct is None
    table = {r.model: r for r in evaluate.compare_models(metrics).collect()}
    assert table["a"].recall == 0.1 and table["b"].recall is None
