import numpy as np
import pytest

from tickloom.llm.language import fit_language, follow_the_regularised_leader, keep_languages, predict_language, temperature


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_language(docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    held = docs.where("crc32(cast(doc_id as string)) % 4 = 2")
    found = predict_language(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)
    assert (model.weights == 0).mean() > 0.5  # the penalty leaves a sparse model


def test_learning_ignores_the_fold_it_predicts(documents):
    a = fit_language(documents.where("doc_id % 2 = 0"))
    b = fit_language(documents.where("doc_id % 2 = 0"))
    assert a.temperature == b.temperature and np.array_equal(a.weights, b.weights)


def test_odd_rows(odd, none, documents):
    model = fit_language(documents)
    found = {(r.doc_id, r.lang_pred == "und") for r in predict_language(odd, model).collect()}
    assert {(1, True), (2, True), (3, True), (6, True), (4, False), (None, False)} <= found
    assert predict_language(none, model).count() == 0
    kept = keep_languages(odd, model, min_score=0.0)
    assert kept.columns == odd.columns
    assert kept.where("doc_id in (1, 2, 3, 6)").count() == 0 and kept.where("doc_id is null").count() == 1


def test_nothing_to_learn(odd, none):
    for table in (none, odd.where("lang is null")):
        model = fit_language(table)
        assert {(r.lang_pred, r.score) for r in predict_language(odd, model).collect()} == {("und", 0.0)}


def test_leader_separates_and_shrinks():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 300)
    rows = [(np.array([k, 10 + rng.integers(0, 50)]), np.array([1.0, 0.5])) for k in labels]
    weights = follow_the_regularised_leader(rows, labels, 3)
    assert weights[:3].argmax(axis=1).tolist() == [0, 1, 2]
    sparse = follow_the_regularised_leader(rows, labels, 3, l1=2.0)
    assert (sparse != 0).sum() < (weights != 0).sum()


def test_temperature_of_overconfident_scores():
    rng = np.random.default_rng(1)
    logits = np.zeros((4000, 2))
    logits[:, 1] = rng.normal(0, 2, 4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-logits[:, 1]))).astype(int)
    assert abs(temperature(logits * 3, labels) - 3) < 0.3


def test_language_of_copies_has_examples(spark):
    """A few texts with very many copies are all drawn."""
    rows = [(i, f"die alten Häuser stehen am Fluss {chr(97 + i % 4) * 4}", "de") for i in range(4000)]
    rows += [(10_000 + i, f"the old houses stand by river {chr(97 + i % 26)}{chr(97 + i // 26)}", "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = fit_language(docs, sample=40)
    found = predict_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang <> lang_pred").count() == 0


def test_more_labels_than_the_limit_are_refused(spark):
    rows = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(5)], "doc_id bigint, text string, lang string")
    assert len(fit_language(rows, max_languages=5).languages) == 5
    with pytest.raises(ValueError):
        fit_language(rows, max_languages=4)
