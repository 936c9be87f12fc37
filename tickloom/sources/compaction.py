"""Few large files instead of many small ones, in tables that streams write batch by batch.

Such a table is a folder of ``batch=<n>`` folders. Compaction writes neighbouring small batches anew as one
folder beside them and then publishes a manifest: the list of folders that make up the table, under the
next version number, by one rename. A reader takes the newest manifest and the batches that came
after it, so it sees a batch either as it was written or compacted, never both, and a compaction
that is cut short changes nothing. Replaced folders stay for readers that have begun with an older manifest;
``replaced`` lists them for the folder's expiry rule.
"""

from __future__ import annotations

import json
from math import ceil

from pyspark.sql import DataFrame, SparkSession

from tickloom.sources.delivery import Files

TARGET_BYTES = 128 << 20
_MANIFESTS, _COMPACT, _ASIDE = "_manifests", "_compact", "_aside"


def _batches(files: Files, path: str) -> list[int]:
    return sorted(int(name.removeprefix("batch=")) for name in files.names(path) if name.startswith("batch="))


def _versions(files: Files, path: str) -> list[int]:
    return sorted(int(name) for name in files.names(f"{path}/{_MANIFESTS}") if name.isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """``last`` batch in the manifest and its ``entries``: [folder, first batch, last batch]."""
    files = Files(spark, path)
    known = _versions(files, path)
    if not known:
        return {"version": 0, "last": -1, "entries": []}
    version = known[-1] if version is None else version
    return json.loads(spark.read.option("wholetext", True).text(f"{path}/{_MANIFESTS}/{version}").first().value)


def _entries(spark: SparkSession, path: str, known: dict) -> list[list]:
    new = [n for n in _batches(Files(spark, path), path) if n > known["last"]]
    return known["entries"] + [[f"batch={n}", n, n] for n in new]


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The table as it stands: compacted folders, then the batches after them."""
    folders = [f"{path}/{entry[0]}" for entry in _entries(spark, path, manifest(spark, path))]
    if not folders:
        raise ValueError(f"{path} holds no batches")
    return spark.read.parquet(*folders)


def file_count(spark: SparkSession, path: str) -> int:
    files = Files(spark, path)
    return sum(name.endswith(".parquet") for entry in _entries(spark, path, manifest(spark, path)) for name in files.names(f"{path}/{entry[0]}"))


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Compact what is smaller than ``target_bytes``; gives the version of the manifest that holds.

    Neighbours are joined until they reach the size, so of any two neighbours in the manifest at
    least one has it: the number of files is at most about twice the table's size over the target."""
    files = Files(spark, path)
    known = manifest(spark, path)
    entries, groups, size = _entries(spark, path, known), [], 0
    sizes = {entry[0]: files.size(f"{path}/{entry[0]}") for entry in entries}
    for entry in entries:
        if groups and size < target_bytes and sizes[entry[0]] < target_bytes:
            groups[-1].append(entry)
            size += sizes[entry[0]]
        else:
            groups.append([entry])
            size = sizes[entry[0]]
    if not any(len(group) > 1 for group in groups):
        return known["version"]
    version, made = known["version"] + 1, []
    for group in groups:
        if len(group) == 1:
            made.append(group[0])
            continue
        first, last = group[0][1], group[-1][2]
        folder = f"{_COMPACT}/{version}-{first}-{last}"
        whole = spark.read.parquet(*[f"{path}/{entry[0]}" for entry in group])
        parts = max(1, ceil(sum(sizes[entry[0]] for entry in group) / target_bytes))
        whole.coalesce(parts).write.mode("overwrite").parquet(f"{path}/{folder}")
        made.append([folder, first, last])
    text = json.dumps({"version": version, "last": entries[-1][2], "entries": made})
    files.write(f"{path}/{_ASIDE}/{version}", text)
    files.rename(f"{path}/{_ASIDE}/{version}", f"{path}/{_MANIFESTS}/{version}")
    return version


def replaced(spark: SparkSession, path: str) -> list[str]:
    """Folders of earlier manifests and compacted batches that the newest manifest does not name."""
    files = Files(spark, path)
    now = manifest(spark, path)
    named = {entry[0] for entry in now["entries"]}
    old = {f"batch={n}" for n in _batches(files, path) if n <= now["last"]}
    for version in _versions(files, path)[:-1]:
        old |= {entry[0] for entry in manifest(spark, path, version)["entries"]}
    return sorted(old - named)
