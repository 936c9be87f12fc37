import pytest

from helpers import lines, random_ticks
from tickloom.cli import main
from tickloom.operators.evaluate import METRICS
from tickloom.plans import reports, training
from tickloom.plans.replay import bounded_features, replay
from tickloom.schemas import FEATURES
from tickloom.session import work_dir
from tickloom.sources.raw import read_metrics
from tickloom.sources.sinks import write_importance


@pytest.fixture(scope="module")
def replayed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("replay")
    (folder / "in").mkdir()
    rows = random_ticks(21, n=800, pairs=("A",))
    (folder / "in" / "slice.ndjson").write_text("\n".join([*lines(rows), "bad"]) + "\n")
    result = replay(spark, str(folder / "in"), str(folder / "features"), 60)
    return folder, result


def test_replay_counts(replayed):
    _, result = replayed
    assert result.counts.first().asDict() == {"lines_read": 801, "bad_lines": 1, "empty_payloads": 0, "valid_ticks": 800}
    assert 700 < result.features.count() < 800


def test_train_score_and_report(spark, replayed):
    folder, result = replayed
    tau = result.features.selectExpr("percentile(midprice_return_std, 0.7)").first()[0]
    trained = training.train(spark, result.features, str(folder / "models"), tau, rounds=3)
    sizes = {r.split: r["count"] for r in trained.rows.groupBy("split").count().collect()}
    n = result.features.count()
    assert sizes["train"] == int(n * 0.7) and sizes["validation"] == int(n * 0.15) and sum(sizes.values()) == n
    names = ["zscore", "logistic_regression", "boosted_trees"]
    saved, absent = read_metrics(spark, str(folder / "models"), [*names, "other"])
    assert absent == ["other"]
    kept = lambda df: sorted((r.model, r.split, r.metric, round(r.value, 9)) for r in df.collect())
    assert kept(saved) == kept(trained.metrics)
    assert {r.metric for r in saved.collect()} <= set(METRICS)
    text = spark.read.option("header", True).csv(str(folder / "models/logistic_regression/feature_importance"))
    assert sorted(r.feature for r in text.collect()) == sorted(FEATURES)
    runs = spark.read.parquet(str(folder / "models/runs"))
    assert runs.select("run_id").distinct().count() == 1
    assert runs.where("kind = 'param' and name = 'threshold_tau'").count() == 3
    comparison, verdict = reports.model_report(spark, str(folder / "models"), "zscore", "logistic_regression")
    assert comparison.count() == 2 and verdict.count() == 1
    with pytest.raises(ValueError):
        reports.model_report(spark, str(folder / "models"), "zscore", "other")

    for kind in names:
        out = str(folder / f"scored_{kind}")
        main(["infer", "--model-path", trained.paths[kind], "--data-path", str(folder / "features"), "--output-path", out])
        scored = spark.read.parquet(out)
        assert scored.count() == n and set(result.features.columns) < set(scored.columns)
        assert scored.where("spike_probability < 0 or spike_probability > 1").count() == 0

    main(["train-test-drift", "--train", str(folder / "models/train_data"), "--test", str(folder / "models/test_data"), "--output", str(folder / "report")])
    report = spark.read.parquet(str(folder / "report"))
    tests = {r.column_name: r for r in report.where("section = 'drift_by_column' and metric = 'score'").collect()}
    assert set(tests) == {*FEATURES, "label"} and tests["label"].text == "K-S p_value"
    assert {r.section for r in report.select("section").distinct().collect()} == {
        "drift_by_column", "dataset_drift", "density", "dataset_summary", "uniques_and_nans_by_column",
        "column_summary", "missing_by_kind", "missing_values",
    }


def test_bounded_run(spark):
    """Unusable messages count, and the run stops at the next row it can emit."""
    raw = ['{"price": 1}', '{"price": 2}', "", "bad", '{"price": 3}', '{"price": 4}', "bad"]
    rows = [("A", 100.0 + i, i, r) for i, r in enumerate(raw)]
    df = spark.createDataFrame(rows, "pair string, ts double, seq long, raw string")
    seqs = lambda n: sorted(r.seq for r in bounded_features(df, n, 60).collect())
    assert seqs(1) == [1] and seqs(2) == [1] and seqs(3) == [1, 4] and seqs(5) == [1, 4] and seqs(6) == [1, 4, 5]
    assert seqs(7) == [1, 4, 5] and seqs(0) == [1, 4, 5] and seqs(100) == [1, 4, 5]


def test_work_dir_comes_from_the_session(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_importance_order(spark, tmp_path):
    rows = [("m", "small", 0.1), ("m", "big", -5.0), ("m", "middle", 1.0)]
    write_importance(spark.createDataFrame(rows, "model string, feature string, value double"), str(tmp_path))
    text = spark.read.option("header", True).csv(str(tmp_path / "m" / "feature_importance"))
    assert [r.feature for r in text.collect()] == ["big", "middle", "small"]
