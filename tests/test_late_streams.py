import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import assert_features, expected_features, from_archive, lines, random_ticks
from tickloom.operators.parse import parse_ticks
from tickloom.operators.trailing import forward_volatility
from tickloom.sources.raw import read_archive, stream_archive
from tickloom.sources.sinks import append_stream
from tickloom.streaming.horizon import label_stream, stream_horizon
from tickloom.streaming.revisions import merge_changes, stream_changes

T0 = 1_700_000_000.0


def land(folder, name, rows, mtime):
    path = folder / name
    path.write_text("\n".join(lines(rows)) + "\n")
    os.utime(path, (mtime, mtime))


def shuffled(seed, n=160):
    """Ticks in three parts, of which some come a part late, in any order."""
    rows = sorted(random_ticks(seed, n=n), key=lambda r: (round(r[1] * 1e6), r[2]))
    rng = np.random.default_rng(seed)
    parts = [[], [], []]
    for i, row in enumerate(rows):
        parts[min(3 * i // n + int(rng.random() < 0.15), 2)].append(row)
    return rows, [[part[i] for i in rng.permutation(len(part))] for part in parts]


def run(spark, base, flow):
    query = append_stream(flow(stream_archive(spark, str(base / "in"), 1)), str(base / "out"), str(base / "progress"), once=True)
    query.awaitTermination()
    return spark.read.parquet(str(base / "out")).where("pair <> '~end'")


def end(after):
    return [("~end", T0 + after, 10**6, 1.0, 0.1)]


def test_horizon_after_restarts_and_late_ticks(spark, tmp_path):
    rows, parts = shuffled(4)
    (tmp_path / "in").mkdir()
    flow = lambda s: label_stream(stream_horizon(s, 60, 10**6), 1e-5)
    for i, part in enumerate(parts):
        land(tmp_path / "in", f"{i}.ndjson", part, T0 + i)
        run(spark, tmp_path, flow)
    early = spark.read.parquet(str(tmp_path / "out")).count()
    land(tmp_path / "in", "9.ndjson", end(10**7), T0 + 9)
    got = run(spark, tmp_path, flow)
    assert early < got.count() == len(rows)
    batch = forward_volatility(parse_ticks(read_archive(spark, str(tmp_path / "in"))), 60)
    key = lambda df: {(r.pair, r.ts_us, r.seq): (r.ticks_ahead, r.forward_return_std) for r in df.collect()}
    want = {k: v for k, v in key(batch).items() if k[0] != "~end"}
    found = key(got)
    assert found.keys() == want.keys()
    for k, (n, std) in want.items():
        assert found[k][0] == n and (found[k][1] == std or found[k][1] == pytest.approx(std, rel=1e-9, abs=1e-14))
    labels = got.where("(label is null) <> (forward_return_std is null) or label <> cast(forward_return_std >= 1e-5 as int)")
    assert labels.count() == 0


def test_a_row_comes_when_its_horizon_has_closed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tick = lambda ts, seq: ("A", T0 + ts, seq, 100.0 + seq, 0.1)
    flow = lambda s: stream_horizon(s, 60, 0)
    land(tmp_path / "in", "0.ndjson", [tick(0, 1), tick(30, 2), tick(59, 3)], T0)
    assert run(spark, tmp_path, flow).count() == 0
    land(tmp_path / "in", "1.ndjson", [tick(60, 4)], T0 + 1)
    assert {r.seq: r.ticks_ahead for r in run(spark, tmp_path, flow).collect()} == {1: 3}
    land(tmp_path / "in", "2.ndjson", [tick(200, 5)], T0 + 2)
    assert {r.seq: r.ticks_ahead for r in run(spark, tmp_path, flow).collect()} == {1: 3, 2: 2, 3: 1, 4: 0}


@pytest.mark.parametrize("seed", [6, 8])
def test_merged_changes_equal_batch(spark, tmp_path, seed):
    rows, parts = shuffled(seed)
    (tmp_path / "in").mkdir()
    for i, part in enumerate(parts):
        land(tmp_path / "in", f"{i}.ndjson", part, T0 + i)
        changes = run(spark, tmp_path, lambda s: stream_changes(s, 60, 10**6))
    assert_features(merge_changes(changes), expected_features(from_archive(rows), 60))
    counts = {r.change: r["count"] for r in changes.groupBy("change").count().collect()}
    assert counts["retract"] > 0 and counts["insert"] - counts["retract"] == merge_changes(changes).count()


def test_a_retracted_row_is_the_row_that_was_sent(spark, tmp_path):
    rows, parts = shuffled(6)
    (tmp_path / "in").mkdir()
    for i, part in enumerate(parts):
        land(tmp_path / "in", f"{i}.ndjson", part, T0 + i)
        changes = run(spark, tmp_path, lambda s: stream_changes(s, 60, 10**6))
    numbers = ["midprice_return_std", "bid_ask_spread", "window_size"]
    sent = {}
    for r in changes.orderBy("revision", F.desc("change")).collect():
        key, values = (r.pair, r.ts_us, r.seq), [r[c] for c in numbers]
        if r.change == "retract":
            assert sent.pop(key) == pytest.approx(values, rel=1e-9, abs=1e-15)
        else:
            assert key not in sent
            sent[key] = values


PROGRAM = """
    import sys
    sys.path.insert(0, {root!r})
    from tickloom.session import get_spark
    from tickloom.operators.drift import drift_by_column
    from tickloom.sources.raw import stream_archive
    from tickloom.sources.sinks import append_stream
    from tickloom.streaming.trailing import stream_features
    spark = get_spark("elsewhere", "local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions="2")
    a = spark.range(50).selectExpr("cast(id as double) as x")
    assert drift_by_column(a, a.selectExpr("x + 100 as x"), ["x"]).first().drift
    append_stream(stream_features(stream_archive(spark, {source!r})), {out!r}, {marks!r}, once=True).awaitTermination()
    assert spark.read.parquet({out!r}).count() > 0
"""


def test_code_reaches_the_workers_from_any_folder(tmp_path):
    """Started elsewhere, without the package installed or on the Python path."""
    (tmp_path / "in").mkdir()
    (tmp_path / "cwd").mkdir()
    land(tmp_path / "in", "0.ndjson", random_ticks(1, n=40), T0)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    program = textwrap.dedent(PROGRAM).format(root=root, source=str(tmp_path / "in"), out=str(tmp_path / "out"), marks=str(tmp_path / "marks"))
    path = tmp_path / "program.py"
    path.write_text(program)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, str(path)], cwd=tmp_path / "cwd", env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
