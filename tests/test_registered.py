import pytest

import __spark_entry__ as contract
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
# A cross-section; ``python tests/compare.py`` runs all of them.
NAMES = [
    "parse_payloads", "window_features", "first_messages", "next_row_label", "train_validation_test",
    "metrics_by_split", "describe_features", "volatility_histogram", "line_distances", "feature_summary",
    "missing_totals", "streamed_features",
]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert len(got)
    assert differences(got, connect(FOLDER).execute(contract.oracle_sql()[name]).df()) == ""


def test_contract(spark):
    assert set(contract.oracle_sql()) < set(contract.queries())
    assert all(contract.oracle_sql().values())
    assert contract.entry(spark).limit(1).count() == 1
