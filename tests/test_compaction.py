import pytest

from tickloom.sources import compaction
from tickloom.sources.compaction import compact, file_count, manifest, read_batches, replaced
from tickloom.sources.delivery import renamed_table


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def write(spark, path, batches):
    for n in batches:
        renamed_table(path)(spark.range(n * 10, n * 10 + 10).repartition(2), n)


def test_same_rows_in_fewer_files(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        read_batches(spark, path)
    write(spark, path, range(5))
    before = file_count(spark, path)
    held = read_batches(spark, path)  # a reader that began before
    assert compact(spark, path) == 1 and file_count(spark, path) == 1 < before
    assert ids(read_batches(spark, path)) == ids(held) == list(range(50))
    assert replaced(spark, path) == [f"batch={n}" for n in range(5)]
    write(spark, path, range(5, 8))
    assert ids(read_batches(spark, path)) == list(range(80))
    assert compact(spark, path) == 2 and compact(spark, path) == 2  # nothing left to do
    assert ids(read_batches(spark, path)) == list(range(80)) and file_count(spark, path) == 1
    assert len(replaced(spark, path)) == 9 and manifest(spark, path)["last"] == 7


def test_large_batches_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark, path, range(4))
    assert compact(spark, path, target_bytes=1) == 0 and file_count(spark, path) == 8
    size = compaction.Files(spark, path).size(f"{path}/batch=0")
    assert compact(spark, path, target_bytes=2 * size) == 1
    assert len(manifest(spark, path)["entries"]) == 2 and ids(read_batches(spark, path)) == list(range(40))


def test_a_compaction_cut_short_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write(spark, path, range(3))

    def away(*_):
        raise OSError("away")

    with monkeypatch.context() as m:
        m.setattr(compaction.Files, "rename", away)
        with pytest.raises(OSError):
            compact(spark, path)
    assert manifest(spark, path)["version"] == 0 and ids(read_batches(spark, path)) == list(range(30))
    assert compact(spark, path) == 1 and ids(read_batches(spark, path)) == list(range(30))
