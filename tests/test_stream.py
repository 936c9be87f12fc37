import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import assert_features, expected_features, from_archive, lines, random_ticks
from tickloom.operators.parse import parse_ticks
from tickloom.operators.trailing import tick_features
from tickloom.sources.raw import read_archive, stream_archive
from tickloom.sources.sinks import append_stream, save_stream, tee_stream, to_folder, to_table
from tickloom.streaming.trailing import check_messages, count_messages, parity, stream_features, window_arrays


def land(folder, name, rows, mtime):
    path = folder / name
    path.write_text("\n".join(lines(rows)) + "\n")
    os.utime(path, (mtime, mtime))


def run(spark, source, base, window=60, delay=0.0, files=None):
    """One run over what has landed since the last one; returns the finished query."""
    features = stream_features(stream_archive(spark, str(source), files), window, delay)
    query = append_stream(features, str(base / "out"), str(base / "progress"), once=True)
    query.awaitTermination()
    return query


def test_batch_and_stream_agree_across_batches_and_restarts(spark, tmp_path):
    rows = sorted(random_ticks(11, n=240), key=lambda r: (round(r[1] * 1e6), r[2]))
    cut = next(i for i in range(70, 90) if round(rows[i][1] * 1e6) == round(rows[i - 1][1] * 1e6))
    source = tmp_path / "in"
    source.mkdir()
    for i in range(2):
        part = rows[:cut] if i == 0 else rows[cut:160]  # equal times on both sides of the boundary
        land(source, f"{i}.ndjson", part, 1_700_000_000 + i * 10)
    run(spark, source, tmp_path, files=1)
    land(source, "2.ndjson", rows[160:], 1_700_000_050)
    run(spark, source, tmp_path, files=1)  # a new query on the same checkpoint
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert_features(streamed, expected_features(from_archive(rows), 60))
    batch = tick_features(parse_ticks(read_archive(spark, str(source))), 60)
    got = parity(batch, streamed).first()
    assert got.batch_rows == got.stream_rows == got.equal_rows > 100 and got.different_rows == 0


def test_batch_and_stream_agree_without_seq(spark, tmp_path):
    """Envelopes as exchanges send them: ties in time are ordered by content on both sides."""
    rows = sorted(random_ticks(5, n=150), key=lambda r: (round(r[1] * 1e6), r[2]))
    source = tmp_path / "in"
    source.mkdir()
    texts = [json.loads(x) for x in lines(rows)]
    for i in range(3):
        part = [json.dumps({k: v for k, v in x.items() if k != "seq"}) for x in texts[i * 50:(i + 1) * 50]]
        (source / f"{i}.ndjson").write_text("\n".join(part) + "\n")
        os.utime(source / f"{i}.ndjson", (1_700_000_000 + i,) * 2)
    run(spark, source, tmp_path)
    batch = tick_features(parse_ticks(read_archive(spark, str(source))), 60)
    got = parity(batch, spark.read.parquet(str(tmp_path / "out"))).first()
    assert got.batch_rows == got.stream_rows == got.equal_rows > 80 and got.different_rows == 0


def test_late_ticks(spark, tmp_path):
    t = 1_700_000_000.0
    tick = lambda ts, seq, mid=100.0: ("A", t + ts, seq, mid, 0.1)
    source = tmp_path / "in"
    source.mkdir()
    land(source, "0.ndjson", [tick(0, 1), tick(30, 2), tick(100, 3)], 1_700_000_000)
    run(spark, source, tmp_path, delay=20.0)
    # 85 is late but within 20 s of 100: it sees only what is before it. 50 is too late.
    land(source, "1.ndjson", [tick(85, 4, 101.0), tick(50, 5), tick(110, 6)], 1_700_000_010)
    query = run(spark, source, tmp_path, delay=20.0)
    got = {r.seq: r.window_size for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {2: 2, 4: 2, 6: 3}
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress)
    assert dropped >= 1


def test_late_ticks_after_a_jump_find_their_whole_window(spark, tmp_path):
    t = 1_700_000_000.0
    tick = lambda ts, seq: ("A", t + ts, seq, 100.0, 0.1)
    source = tmp_path / "in"
    source.mkdir()
    steps = [range(100, 151, 10), range(600, 651, 10), (165, 170, 700), (640, 705), (200, 710)]
    rows = [[tick(ts, 1000 * i + ts) for ts in step] for i, step in enumerate(steps)]
    for i, part in enumerate(rows[:3]):
        land(source, f"{i}.ndjson", part, 1_700_000_000 + i)
    run(spark, source, tmp_path, delay=10.0, files=1)
    for i, part in enumerate(rows[3:], 3):  # a restart on the same checkpoint
        land(source, f"{i}.ndjson", part, 1_700_000_000 + i)
    query = run(spark, source, tmp_path, delay=10.0, files=1)
    got = {r.seq: r.window_size for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress)
    assert (got[2165], got[2170]) == (6, 7)
    assert 4200 not in got and dropped >= 1
    # What is let through equals batch over all that had come before it.
    accepted = [r for part in rows for r in part if r[2] != 4200]
    for part in rows:
        for row in part:
            if row[2] in got:
                before = [r for r in accepted if (r[1], r[2]) <= (row[1], row[2]) and r[1] >= row[1] - 60 and r[2] // 1000 <= row[2] // 1000]
                assert got[row[2]] == len(before), row


def test_windows_cost_the_same_at_any_tick_rate():
    rng = np.random.default_rng(0)
    took = {}
    for rate in (10, 100, 1000):
        n = 120_000
        us = np.cumsum(rng.integers(1, 2_000_000 // rate, n)).astype("int64")
        mid, spread = 100 * np.exp(np.cumsum(rng.normal(0, 1e-5, n))), rng.random(n)
        begin = time.process_time()
        found = window_arrays(us, mid, spread, np.arange(n), 60_000_000)
        took[rate] = time.process_time() - begin
        for i in (5, n // 2, n - 1):
            part = slice(found["start"][i], i + 1)
            returns = np.diff(np.log(mid[part]))
            assert np.isclose(found["mean"][i], returns.mean(), rtol=1e-9) and np.isclose(found["std"][i], returns.std(), rtol=1e-9)
            assert np.isclose(found["spread"][i], spread[part].mean(), rtol=1e-12)
    assert took[1000] < 6 * took[10] + 0.2


def test_state_is_dropped_once_a_slice_is_over(spark, tmp_path):
    t = 1_700_000_000.0
    source = tmp_path / "in"
    source.mkdir()
    for i in range(3):
        land(source, f"{i}.ndjson", [("A", t + i * 5000 + k, i * 10 + k, 100.0, 0.1) for k in range(3)], 1_700_000_000 + i)
    query = run(spark, source, tmp_path, files=1)
    states = [p["stateOperators"][0] for p in query.recentProgress]
    assert sum(s["customMetrics"].get("numDeletedTimers", 0) for s in states) == 2
    assert states[-1]["numRowsTotal"] == 1  # only the slice still open


def test_tee_writes_both_copies(spark, tmp_path):
    rows = random_ticks(12, n=20)
    source = tmp_path / "in"
    source.mkdir()
    land(source, "0.ndjson", rows, 1_700_000_000)
    paths = [str(tmp_path / n) for n in ("queue", "archive")]
    tee_stream(stream_archive(spark, str(source)), *paths, str(tmp_path / "progress"), once=True).awaitTermination()
    texts = [sorted(r.value for r in spark.read.text(p).collect()) for p in paths]
    assert texts[0] == texts[1] and len(texts[0]) == 20
    assert {json.loads(x)["seq"] for x in texts[0]} == set(range(20))


def test_one_query_with_two_sinks_and_its_counts(spark, tmp_path):
    rows = random_ticks(13, n=60)
    source = tmp_path / "in"
    source.mkdir()
    land(source, "0.ndjson", rows, 1_700_000_000)
    (source / "1.ndjson").write_text("not json\n")
    features = stream_features(stream_archive(spark, str(source)), 60, 0.0)
    table, messages = str(tmp_path / "table"), str(tmp_path / "messages")
    query = save_stream(features, to_table(table), to_folder(messages), str(tmp_path / "progress"), once=True)
    query.awaitTermination()
    written = spark.read.parquet(table).drop("batch")
    assert written.count() == spark.read.text(messages).count() > 20
    seen = [p["observedMetrics"] for p in query.recentProgress]
    total = lambda name, metric: sum(m[name][metric] for m in seen if name in m)
    assert total("envelopes", "lines_read") >= 61 and total("envelopes", "bad_lines") >= 1
    assert total("ticks", "valid_ticks") >= 60 and total("features", "emitted") >= written.count()


def test_check_stops_early_or_when_idle(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    land(source, "0.ndjson", random_ticks(14, n=30), 1_700_000_000)
    some = check_messages(stream_archive(spark, str(source)), str(tmp_path / "a"), 10, idle_seconds=60.0).first()
    assert (some.messages_seen, some.enough) == (10, True) and some.seconds < 60
    few = check_messages(stream_archive(spark, str(source)), str(tmp_path / "b"), 100, idle_seconds=3.0).first()
    assert (few.messages_seen, few.enough) == (30, False) and few.seconds >= 3


def test_message_count(spark):
    assert count_messages(spark.range(500), 100).first().asDict() == {"messages_seen": 100, "enough": True}
    assert count_messages(spark.range(5), 100).first().asDict() == {"messages_seen": 5, "enough": False}
    assert count_messages(spark.range(0), 1).agg(F.sum("messages_seen")).first()[0] == 0


def test_missing_time_takes_the_landing_time(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "0.ndjson").write_text(json.dumps({"pair": "A", "raw": '{"price": 1}'}) + "\nnot json\n")
    os.utime(source / "0.ndjson", (1_700_000_000, 1_700_000_000))
    rows = stream_archive(spark, str(source))
    append_stream(rows, str(tmp_path / "out"), str(tmp_path / "p"), once=True).awaitTermination()
    got = sorted((r.is_bad, r.ts) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got[0] == (False, pytest.approx(1_700_000_000.0)) and got[1][0] is True
