import json

import pytest

from tickloom.operators.parse import ingest_counts, parse_ticks
from tickloom.sources.raw import read_archive

P, LOW, HIGH = 100.0, 100.0 * 0.9999, 100.0 * 1.0001
# payload -> (price, bid, ask), or None where the message is dropped
CASES = [
    ({"price": "100.0", "best_bid": "99.9", "best_ask": "100.1"}, (P, 99.9, 100.1)),
    ({"price": 100}, (P, LOW, HIGH)),
    ({"price": "100", "best_bid": "99.9"}, (P, LOW, HIGH)),
    ({"best_bid": 99.9, "best_ask": 100.1}, ((99.9 + 100.1) / 2, 99.9, 100.1)),
    ({"last_price": "100", "bid": "99.9", "ask": "100.1"}, (P, 99.9, 100.1)),
    ({"price": "", "last_price": "100"}, (P, LOW, HIGH)),
    ({"price": 0, "last_price": "100"}, (P, LOW, HIGH)),
    ({"price": None, "last_price": "100"}, (P, LOW, HIGH)),
    ({"price": False, "last_price": "100"}, (P, LOW, HIGH)),
    ({"price": [], "last_price": "100"}, (P, LOW, HIGH)),
    ({"price": {}, "last_price": "100"}, (P, LOW, HIGH)),
    ({"price": "100", "best_bid": 0, "best_ask": "100.1"}, (P, LOW, HIGH)),
    ({"best_bid": "0", "best_ask": "100.1"}, (50.05, 0.0, 100.1)),
    ({"price": "0", "best_bid": 1, "best_ask": 3}, (0.0, 1.0, 3.0)),
    ({"price": "0"}, None),
    ({"price": " 1_00.0 "}, (P, LOW, HIGH)),
    ({"price": "1e2"}, (P, LOW, HIGH)),
    ({"price": "100d"}, None),
    ({"price": "0x64"}, None),
    ({"price": "1__0"}, None),
    ({"price": True}, (1.0, 0.9999, 1.0001)),
    ({"price": "true"}, None),
    ({"price": [1]}, None),
    ({"price": "abc"}, None),
    ({"price": "abc", "best_bid": 1, "best_ask": 2}, None),
    ({"best_bid": "abc", "best_ask": 2}, None),
    ({"type": "subscriptions"}, None),
    ("[1, 2]", None),
    ("12", None),
    ("{bad", None),
    ('{"price": 100} trailing', None),
    ('{"price": 100}{"price": 100}', None),
    ("{'price': 100}", None),
    ("", None),
    ('{"price": 5, "price": 100}', (P, LOW, HIGH)),
]


def test_payload_rules(spark):
    rows = [("X", float(i), i, c if isinstance(c, str) else json.dumps(c)) for i, (c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "pair string, ts double, seq long, raw string")
    got = {r.seq: r for r in parse_ticks(df).collect()}
    for i, (case, want) in enumerate(CASES):
        if want is None:
            assert i not in got, case
            continue
        row = got[i]
        assert (row.price, row.best_bid, row.best_ask) == pytest.approx(want, rel=1e-15), case
        assert row.midprice == pytest.approx((want[1] + want[2]) / 2, rel=1e-15)
        assert row.spread == pytest.approx(want[2] - want[1], abs=1e-12)


def test_time_and_volume(spark):
    rows = [
        ("X", 1.0, 1, '{"price": 1, "volume_24h": "5", "time": "t1", "timestamp": "t2"}'),
        ("X", 2.0, 2, '{"price": 1, "time": "", "timestamp": "t2"}'),
    ]
    df = spark.createDataFrame(rows, "pair string, ts double, seq long, raw string")
    got = {r.seq: (r.volume_24h, r.time) for r in parse_ticks(df).collect()}
    assert got == {1: ("5", "t1"), 2: ("0.0", "t2")}


def test_archive_skips_and_counts_bad_lines(spark, tmp_path):
    good = json.dumps({"ts": 1.5, "pair": "A", "raw": '{"price": 100}'})
    no_pair = json.dumps({"ts": 2.5, "raw": '{"price": 100}'})
    empty = json.dumps({"ts": 3.5, "pair": "A", "raw": ""})
    no_raw = json.dumps({"ts": 4.5, "pair": "A"})
    no_ts = json.dumps({"pair": "A", "raw": '{"price": 100}'})
    lines = [good, "not json", "[1]", no_pair, empty, no_raw, no_ts, good + " x"]
    (tmp_path / "slice.ndjson").write_text("\n".join(lines) + "\n")
    envelopes = read_archive(spark, str(tmp_path))
    assert ingest_counts(envelopes).first().asDict() == {
        "lines_read": 8, "bad_lines": 4, "empty_payloads": 2, "valid_ticks": 2,
    }
    assert [(r.pair, r.ts) for r in parse_ticks(envelopes).orderBy("ts").collect()] == [("A", 1.5), ("BTC-USD", 2.5)]


def test_plan_reads_and_parses_once(spark, tmp_path):
    (tmp_path / "slice.ndjson").write_text('{"ts": 1, "raw": "{}"}\n')
    plan = parse_ticks(read_archive(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 1
    assert "Python" not in plan
