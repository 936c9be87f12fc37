import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tickloom.llm.quality_votes import MARKS, STEPS, WIDTH, VoteModel, features, fit_votes, score_quality, weighted
from tickloom.llm.queries import op13_quality

FOLDER = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    got = {r.doc_id: r for r in op13_quality(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [r for r in labels if got[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert len(held) > 50
    right = [got[r.doc_id].predicted == r.quality for r in held]
    assert np.mean(right) > 0.95
    low = [got[r.doc_id].score for r in held if r.quality == 0]
    high = [got[r.doc_id].score for r in held if r.quality == 1]
    assert np.mean([a < b for a in low for b in high]) > 0.98


def test_votes_equal_a_plain_vote():
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab AB1!\n"), 40)) for _ in range(60)]
    counts = features(pa.array(texts))
    model = VoteModel(np.ones(WIDTH, np.float32), rng.standard_normal((WIDTH, 6)).astype(np.float32), np.zeros((0, 0)), np.zeros(0, int), np.array([1.0, 2.0]), 0.4)
    vectors = weighted(counts, model.idf) @ model.axes
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    model.vectors, model.labels = vectors[:40], rng.integers(0, 2, 40)
    got = model.scores(counts[40:], neighbours=7)
    for vector, score in zip(vectors[40:], got):
        near = sorted(range(40), key=lambda i: -float(vector @ vectors[i]))[:7]
        votes = [(max(float(vector @ vectors[i]), 0.0) ** 8 * model.shares[model.labels[i]], model.labels[i]) for i in near]
        want = (sum(v * y for v, y in votes) + 1e-6 * 0.4) / (sum(v for v, _ in votes) + 1e-6)
        assert abs(score - want) < 1e-3


def test_features_of_one_text_do_not_depend_on_the_others():
    texts = ["one one one", "", None, "A!! B!!\nc 1", "é" * 5, "ab", "one one one"]
    together = features(pa.array(texts))
    for text, row in zip(texts, together):
        assert (features(pa.array([text], pa.string()))[0] == row).all()
    assert not together[1].any() and not together[2].any()
    marks = together[0][WIDTH - MARKS * STEPS :].reshape(MARKS, STEPS)
    assert marks[0].argmax() == 6  # two of three words repeat the one before
    assert (together[0] == together[6]).all()


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (5, None), (None, 1), (9, 1), (99, 0)], "doc_id bigint, quality int")
    model = fit_votes(odd, labels)
    rows = score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2)} == {model.prior}
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    assert score_quality(none, model).count() == 0
    for docs, known in ((none, labels), (odd, labels.limit(0)), (none, labels.limit(0))):
        empty = fit_votes(docs, known)
        assert not len(empty.labels)
        assert score_quality(odd, empty).where(F.col("score") == empty.prior).count() == odd.count()
