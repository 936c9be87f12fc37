import numpy as np
import pandas as pd
import pytest

from tickloom.operators.drift import dataset_drift, drift_by_column
from tickloom.operators.evaluate import curve_areas, score_curve
from tickloom.streaming.triggers import current_triggers, reference_figures, watch_stream

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    make = lambda n, shift: pd.DataFrame({"a": rng.normal(shift, 1, n), "b": rng.normal(shift, 1, n), "label": rng.integers(0, 2, n)})
    reference, live = make(4000, 0.0), make(3000, 1.0)
    live["spike_probability"] = (np.floor((live.label * 0.3 + rng.random(3000) * 0.7) * 99) + 0.5) / 100
    live["predicted_label"] = (live.spike_probability > 0.5).astype(int)
    return reference, live


def test_rules_while_rows_come(spark, rows, tmp_path):
    reference, live = rows
    ref = spark.createDataFrame(reference)
    figures = reference_figures(ref, FEATURES).cache()
    source, folder = str(tmp_path / "in"), str(tmp_path / "sums")
    for part in range(3):
        spark.createDataFrame(live[part * 1000 : (part + 1) * 1000]).coalesce(1).write.mode("append").parquet(source)
        scored = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        # One score in each range: nothing is lost by counting ranges.
        watch_stream(scored, figures, FEATURES, folder, str(tmp_path / "marks"), True, bins=100).awaitTermination()
        so_far = spark.createDataFrame(live[: (part + 1) * 1000])
        got = {r.rule: r for r in spark.read.parquet(f"{folder}/triggers/batch={part}").collect()}
        assert got["pr_auc_low"].value == pytest.approx(curve_areas(score_curve(so_far)).first().pr_auc, rel=1e-9)
        assert got["spike_rate_high"].value == pytest.approx(100 * live.predicted_label[: (part + 1) * 1000].mean())
        want = dataset_drift(drift_by_column(ref, so_far.select(*FEATURES), FEATURES)).first().dataset_drift
        assert (got["drift"].value == 1.0) == want == got["drift"].fired is True
    again = {r.rule: (r.value, r.fired) for r in current_triggers(spark, folder, figures, bins=100).collect()}
    assert again == {rule: (r.value, r.fired) for rule, r in got.items()}
    assert got["spike_rate_high"].fired and not got["pr_auc_low"].fired
