"""Times the main jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registered import queries as q  # noqa: E402
from tickloom.models.classifiers import fit_logistic, fit_trees  # noqa: E402
from tickloom.models.registry import predict  # noqa: E402
from tickloom.models.zscore import fit_zscore  # noqa: E402
from tickloom.session import get_spark, stored  # noqa: E402

# Each runs whole: from the test table, or from a stored feature table as a pipeline would.
NAMES = [
    "window_features", "next_row_label", "train_validation_test", "metrics_by_split", "describe_features",
    "describe_lines", "line_percentiles", "line_ecdf", "line_distances", "drift_tests", "line_summary",
    "feature_correlations", "streamed_features", "archive_replay", "early_late_report",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(q.window_features(spark, folder))  # starting up and compiling is not part of any query
    times = {}
    for name in NAMES:
        start = time.perf_counter()
        run(getattr(q, name)(spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    features = q.split_rows(spark, folder)
    start = time.perf_counter()
    model = fit_zscore(features)
    times["zscore_fit"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    run(predict(model, features))
    times["zscore_score"] = round(time.perf_counter() - start, 3)
    train = features.where("split = 'train'")
    start = time.perf_counter()
    fit_logistic(train)
    times["logistic_fit"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    fit_trees(train, rounds=100)
    times["trees_fit"] = round(time.perf_counter() - start, 3)
    few = stored(features.limit(5000), "few")
    start = time.perf_counter()
    run(predict(model, few))
    times["zscore_score_5000"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the main jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
