import os

import pytest

from helpers import lines, random_ticks
from tickloom.cli import main
from tickloom.operators.parse import parse_ticks
from tickloom.plans.replay import bounded_features
from tickloom.sources.delivery import Ledger, deliver_stream, numbered_messages, renamed_table, without_redelivered
from tickloom.sources.raw import read_archive, stream_archive
from tickloom.streaming.bounded import cut_features, first_stream_features

T0 = 1_700_000_000.0


def land(folder, name, rows, mtime):
    path = folder / name
    path.write_text("\n".join(lines(rows)) + "\n")
    os.utime(path, (mtime, mtime))


@pytest.fixture
def landed(tmp_path):
    rows = sorted(random_ticks(9, n=120), key=lambda r: (round(r[1] * 1e6), r[2]))
    (tmp_path / "in").mkdir()
    for i in range(4):
        land(tmp_path / "in", f"{i}.ndjson", rows[i * 30 : (i + 1) * 30], T0 + i)
    return tmp_path, rows


def values(spark, path):
    return sorted(r.value for r in spark.read.parquet(str(path)).collect())


class Failing:
    """A writer that fails the first time it gets a certain batch: before or after it has written."""

    def __init__(self, write, batch, after):
        self.write, self.batch, self.after, self.failed = write, batch, after, False

    def __call__(self, rows, batch_id):
        fails = batch_id == self.batch and not self.failed
        self.failed |= fails
        if not fails or self.after:
            self.write(rows, batch_id)
        if fails:
            raise OSError("away")


@pytest.mark.parametrize("after", [False, True])
def test_a_failed_batch_is_there_once(spark, landed, after):
    """Also where it failed between the write and its entry in the ledger."""
    base, rows = landed
    targets = {"a": renamed_table(str(base / "a")), "b": Failing(renamed_table(str(base / "b")), 2, after)}
    ledger = str(base / "ledger")

    def start():
        envelopes = stream_archive(spark, str(base / "in"), 1)
        query = deliver_stream(envelopes.select("ts", "pair", "seq"), targets, ledger, str(base / "marks"), True, numbered_messages)
        query.awaitTermination()

    with pytest.raises(Exception, match="away"):
        start()
    book = Ledger(spark, ledger)
    assert book.batches("a") == [0, 1, 2] and book.batches("b") == [0, 1]
    start()
    assert book.batches("a") == book.batches("b") == [0, 1, 2, 3]
    assert values(spark, base / "a") == values(spark, base / "b") and len(values(spark, base / "a")) == len(rows)
    assert spark.read.parquet(str(base / "a")).select("id").distinct().count() == len(rows)


def test_a_target_that_cannot_be_replaced_is_skipped(spark, landed):
    base, rows = landed
    sent = []
    targets = {"topic": lambda batch, n: sent.extend((n, r.value) for r in batch.collect()), "b": Failing(renamed_table(str(base / "b")), 1, False)}

    def start():
        envelopes = stream_archive(spark, str(base / "in"), 1).select("ts", "pair", "seq")
        deliver_stream(envelopes, targets, str(base / "ledger"), str(base / "marks"), True, numbered_messages).awaitTermination()

    with pytest.raises(Exception, match="away"):
        start()
    start()
    assert len(sent) == len(set(sent)) == len(rows)


def test_redelivered_messages(spark, landed):
    base, rows = landed
    land(base / "in", "9.ndjson", rows[:50], T0 + 9)
    (base / "in" / "bad.ndjson").write_text("no json\n")
    messages = without_redelivered(stream_archive(spark, str(base / "in"), 1), 10**6).select("ts", "pair", "seq", "raw")
    deliver_stream(messages, {"a": renamed_table(str(base / "a"))}, str(base / "ledger"), str(base / "marks"), True).awaitTermination()
    got = spark.read.parquet(str(base / "a"))
    assert got.count() == got.select("seq").distinct().count() == len(rows)


@pytest.mark.parametrize("messages", [1, 45, 90, 120, 500])
def test_bounded_stream_equals_bounded_batch(spark, landed, messages):
    base, rows = landed
    arrivals = read_archive(spark, str(base / "in"))
    got = first_stream_features(stream_archive(spark, str(base / "in"), 1), arrivals, messages, str(base / "out"), str(base / "marks"), 60, 0.0)
    want = bounded_features(arrivals, messages, 60)
    key = lambda df: sorted((r.pair, r.seq, r.window_size) for r in df.collect())
    assert key(got) == key(want) and len(key(got)) > 0


def test_stream_stops_early(spark, landed):
    """Nothing is left to cut after a table without the wanted message; the command writes what is asked."""
    base, rows = landed
    everything = parse_ticks(read_archive(spark, str(base / "in")))
    assert cut_features(everything, read_archive(spark, str(base / "in")), 1000).count() == len(rows)
    out = str(base / "first")
    main(["featurize", "--input", str(base / "in"), "--output", out, "--checkpoint", str(base / "m"), "--max-messages", "40", "--delay-seconds", "0", "--once"])
    want = bounded_features(read_archive(spark, str(base / "in")), 40, 60)
    assert spark.read.parquet(out).count() == want.count()
