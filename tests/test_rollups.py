import os

import pytest
from pyspark.sql import functions as F

from helpers import from_archive, lines, random_ticks, ticks
from tickloom.operators.parse import parse_ticks
from tickloom.operators.rollups import bars, latest_bars, sessions, stream_bars, stream_sessions
from tickloom.sources.raw import stream_archive
from tickloom.sources.sinks import append_stream

T0 = 1_700_000_000.0


def plain_bars(rows, width, slide):
    out = {}
    for pair, ts, seq, mid, spread in sorted(rows, key=lambda r: (round(r[1] * 1e6), r[2])):
        us = round(ts * 1e6)
        start = us // slide * slide
        while start > us - width:
            out.setdefault((pair, start), []).append((mid, spread))
            start -= slide
    return {
        key: (len(v), v[0][0], max(m for m, _ in v), min(m for m, _ in v), v[-1][0], pytest.approx(sum(s for _, s in v) / len(v)))
        for key, v in out.items()
    }


def plain_sessions(rows, gap):
    out, open_ = [], {}
    for pair, ts, seq, mid, _ in sorted(rows, key=lambda r: (round(r[1] * 1e6), r[2])):
        us = round(ts * 1e6)
        if pair in open_ and us - open_[pair][-1][0] <= gap:
            open_[pair].append((us, mid))
        else:
            open_[pair] = [(us, mid)]
            out.append((pair, open_[pair]))
    return sorted((p, v[0][0], v[-1][0], len(v), v[0][1], max(m for _, m in v), min(m for _, m in v), v[-1][1]) for p, v in out)


def as_bars(df):
    return {(r.pair, r.start_us): (r.n_ticks, r.open, r.high, r.low, r.close, r.spread_mean) for r in df.collect()}


@pytest.mark.parametrize("width, slide", [(60, None), (60, 20), (0.5, 0.25)])
def test_bars(spark, width, slide):
    rows = random_ticks(2, n=300)
    got = bars(ticks(spark, rows), width, slide)
    assert as_bars(got) == plain_bars(rows, int(width * 1e6), int((slide or width) * 1e6))
    assert got.where("end_us - start_us <> %d" % int(width * 1e6)).count() == 0


def test_bars_need_a_fitting_slide(spark):
    with pytest.raises(ValueError):
        bars(ticks(spark, []), 60, 25)
    assert bars(ticks(spark, []), 60).count() == 0


@pytest.mark.parametrize("block", [61, 100, 3600])
def test_sessions(spark, block):
    rows = random_ticks(3, n=400) + [("C", T0, 1, 1.0, 0.1), ("C", T0 + 60, 2, 2.0, 0.1), ("C", T0 + 120.000001, 3, 3.0, 0.1)]
    got = sessions(ticks(spark, rows), 60, block)
    assert sorted(tuple(r) for r in got.collect()) == plain_sessions(rows, 60_000_000)
    assert sessions(ticks(spark, []), 60, block).count() == 0


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Three files, later ones holding some late ticks, and one far ahead that closes everything."""
    rows = sorted(random_ticks(7, n=180), key=lambda r: r[1])
    rows += [("C", T0, 1000, 1.0, 0.1), ("C", T0 + 60, 1001, 2.0, 0.1), ("C", T0 + 120.000001, 1002, 3.0, 0.1)]
    folder = tmp_path_factory.mktemp("rollups")
    (folder / "in").mkdir()
    parts = [[], [], []]
    for i, row in enumerate(rows):
        parts[min(i // 60 + (i % 9 == 0), 2)].append(row)
    parts[2].append(("~end", T0 + 10**7, 10**6, 1.0, 0.1))
    for i, part in enumerate(parts):
        path = folder / "in" / f"{i}.ndjson"
        path.write_text("\n".join(lines(part)) + "\n")
        os.utime(path, (T0 + i,) * 2)
    return folder, from_archive(rows)


def streamed(spark, folder, name, flow):
    source = parse_ticks(stream_archive(spark, str(folder / "in"), 1))
    append_stream(flow(source), str(folder / name), str(folder / f"{name}_progress"), once=True).awaitTermination()
    return spark.read.parquet(str(folder / name)).where("pair <> '~end'")


def test_streamed_bars(spark, landed):
    folder, rows = landed
    got = streamed(spark, folder, "bars", lambda s: stream_bars(s, 60, 30, 10**6))
    assert as_bars(got) == plain_bars(rows, 60_000_000, 30_000_000)


def test_updated_bars(spark, landed):
    folder, rows = landed
    out = str(folder / "updates")
    source = parse_ticks(stream_archive(spark, str(folder / "in"), 1))
    write = lambda df, batch: df.withColumn("batch", F.lit(batch)).write.mode("append").parquet(out)
    query = stream_bars(source, 60, None, 10**6).writeStream.outputMode("update").foreachBatch(write)
    query.option("checkpointLocation", str(folder / "updates_progress")).trigger(availableNow=True).start().awaitTermination()
    updates = spark.read.parquet(out)
    assert updates.count() > latest_bars(updates).count()
    assert as_bars(latest_bars(updates).where("pair <> '~end'")) == plain_bars(rows, 60_000_000, 60_000_000)


def test_streamed_sessions(spark, landed):
    folder, rows = landed
    got = streamed(spark, folder, "sessions", lambda s: stream_sessions(s, 60, 10**6))
    assert sorted(tuple(r) for r in got.collect()) == plain_sessions(rows, 60_000_000)
