"""Prefix trie of conversations: every distinct sequence of first turns is a node.

A conversation is its turns in order, each as a digest of role and text (128 bits of SHA-256) and the
text's size; texts are not moved. Equal conversations are counted together, then all are sorted by the
digests, which puts those with a common prefix next to each other. Within a range of that order the trie
follows from the lengths of the common prefixes of neighbours alone: these edges are taken in descending
depth and united by union-find. A union at depth d creates, or widens, the branching node of depth d;
between a node and the next branching above it lies a chain of nodes with the same members.

Nodes that hold the first or the last conversation of a range may go on in the next one. A range's
forest is contracted to these two paths, with what hangs from them summed up depth by depth; 64 ranges'
paths are then merged by the same union-find, and so on until one range is left. Nodes inside are
complete at once, but for the number of a parent that is on such a path; it is looked up at the end.

The unit that stays together is one conversation, with 24 bytes for each turn; ids of equal
conversations are joined in pieces of 65,536 and only their digest is taken in one stream.

Defined results: turns are ordered by ``turn``, null first, those of equal turn by digest; repeated rows
are turns of their own. A null role or text is empty. Rows without a conversation's id are left out. An
empty table has no nodes; a conversation without turns is a member of the root alone. Other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, functions as F

from tickloom.llm.tables import fresh_path, ship_package, stored

DIGEST = 16
ID_RUN = 1 << 16  # ids joined in one string
TASK_BYTES = 2 << 20  # of digests in one range
FAN_IN = 64  # ranges whose paths are merged at once

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, parent_ref binary, ref binary, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
HANGING = "array<struct<depth:bigint,n:bigint,least:bigint,children:bigint,leaves:bigint,saved:bigint,ends:string>>"
PATH = f"part bigint, side int, key binary, sizes array<bigint>, hanging {HANGING}"
_NODE_FIELDS = [f.split()[0] for f in NODE.split(", ")]


def conversation_sequences(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turns): each conversation's turns in order, as digest (hex) and size of the text in bytes."""
    said = lambda name: F.coalesce(rows[name].cast("string"), F.lit(""))
    whole = F.concat(F.char_length(said(role)).cast("string"), F.lit(":"), said(role), said(text))
    turns = rows.where(rows[key].isNotNull()).select(
        rows[key].cast("bigint").alias("id"),
        F.struct(
            rows[turn].alias("turn"), F.substring(F.sha2(whole, 256), 1, 2 * DIGEST).alias("digest"), F.octet_length(said(text)).cast("bigint").alias("size")
        ).alias("said"),
    )
    ordered = F.sort_array(F.collect_list("said"))
    return turns.groupBy("id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


class _Path:
    """A conversation, or one end of a contracted range: digests, sizes, and what hangs from it."""

    __slots__ = ("key", "sizes", "hanging", "refs")

    def __init__(self, key, sizes, hanging):
        self.key, self.sizes, self.hanging, self.refs = key, sizes, hanging, None

    def ref(self, depth: int) -> bytes:
        """Name of the node at ``depth``, the same on every path that goes through it."""
        if self.refs is None:
            state = hashlib.blake2b(digest_size=DIGEST)
            self.refs = [state.digest()]
            for at in range(0, len(self.key), DIGEST):
                state.update(self.key[at : at + DIGEST])
                self.refs.append(state.copy().digest())
        return self.refs[depth]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two conversations begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    if n <= 16 * DIGEST:
        at = 0
        while a[at : at + DIGEST] == b[at : at + DIGEST]:
            at += DIGEST
        return at // DIGEST
    return int(np.argmax(np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8))) // DIGEST


class _Forest:
    """Union-find over a sorted list of paths. A component's root holds the node at its ``top``
    depth as far as it is summed up: members, least id, children, leaves and bytes saved below."""

    def __init__(self, paths: list[_Path], whole: bool, named: bool):
        n = len(paths)
        self.paths, self.whole, self.named = paths, whole, named
        self.up = list(range(n))
        self.low, self.high = list(range(n)), list(range(n))
        self.top = [len(p.key) // DIGEST for p in paths]
        self.n, self.least, self.children = [0] * n, [None] * n, [0] * n
        self.leaves, self.saved, self.ends = [0] * n, [0] * n, [None] * n
        self.waiting: list[list[int]] = [[] for _ in paths]  # nodes whose parent is not complete
        self.nodes: dict[str, list] = {name: [] for name in _NODE_FIELDS}
        self.hanging: tuple[list, list] = ([], [])

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def _clear(self, r: int) -> None:
        self.n[r], self.least[r], self.children[r], self.leaves[r], self.saved[r], self.ends[r], self.waiting[r] = 0, None, 0, 0, 0, None, []

    def climb(self, r: int, depth: int) -> None:
        """Complete the component's nodes below ``depth``, which becomes its top."""
        first, last = self.low[r] == 0, self.high[r] == len(self.paths) - 1
        path = self.paths[self.low[r] if first or not last else self.high[r]]
        if not self.whole and (first or last):
            top = self.top[r]
            if top > depth:
                if self.n[r] or self.children[r] or self.ends[r] is not None:
                    row = (top, self.n[r], self.least[r], self.children[r], self.leaves[r], self.saved[r], self.ends[r])
                    self.hanging[0 if first else 1].append(row)
                for i in self.waiting[r]:
                    self.nodes["parent_ref"][i] = path.ref(top)
                self._clear(r)
                self.top[r] = depth
            return
        nodes = self.nodes
        while self.top[r] > depth:
            at = self.top[r]
            leaves = self.leaves[r] if self.children[r] else 1
            saved = self.saved[r] + ((self.n[r] - 1) * path.sizes[at - 1] if at else 0)
            row = (self.least[r], at, None, None, path.ref(at) if self.named else None, self.n[r], self.children[r], leaves, saved, self.ends[r])
            place = len(nodes["depth"])
            for name, value in zip(_NODE_FIELDS, row):
                nodes[name].append(value)
            for i in self.waiting[r]:
                nodes["parent_conv_id"][i] = self.least[r]
            self.waiting[r] = [place]
            self.children[r], self.leaves[r], self.saved[r], self.ends[r] = 1, leaves, saved, None
            self.top[r] = at - 1

    def add(self, r: int, n, least, children, leaves, saved, ends) -> None:
        self.n[r] += n
        if least is not None and (self.least[r] is None or least < self.least[r]):
            self.least[r] = least
        self.children[r] += children
        self.leaves[r] += leaves
        self.saved[r] += saved
        if ends is not None:
            self.ends[r] = ends

    def unite(self, a: int, b: int) -> None:
        if len(self.waiting[a]) < len(self.waiting[b]):
            a, b = b, a
        self.up[b] = a
        self.add(a, self.n[b], self.least[b], self.children[b], self.leaves[b], self.saved[b], self.ends[b])
        self.waiting[a] += self.waiting[b]
        self.low[a], self.high[a] = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])
        self._clear(b)

    def build(self) -> list[_Path]:
        """Unites all paths; gives the contracted ones, or nothing where the range is ``whole``."""
        paths = self.paths
        if not paths:
            return []
        events = [(row[0], i, row[1:]) for i, path in enumerate(paths) for row in path.hanging]
        events += [(_common(paths[i].key, paths[i + 1].key), i, None) for i in range(len(paths) - 1)]
        events.sort(key=lambda e: -e[0])
        for depth, i, hanging in events:
            r = self.find(i)
            self.climb(r, depth)
            if hanging is not None:
                self.add(r, *hanging)
                continue
            s = self.find(i + 1)
            self.climb(s, depth)
            self.unite(r, s)
        self.climb(self.find(0), -1)
        if self.whole:
            return []
        ends = [_Path(paths[0].key, paths[0].sizes, self.hanging[0])]
        if len(paths) > 1:
            ends.append(_Path(paths[-1].key, paths[-1].sizes, self.hanging[1]))
        return ends


_HANGING_FIELDS = ("depth", "n", "least", "children", "leaves", "saved", "ends")
_HANGING_TYPE = pa.list_(pa.struct([(name, pa.string() if name == "ends" else pa.int64()) for name in _HANGING_FIELDS]))
_TYPES = {"parent_ref": pa.binary(), "ref": pa.binary(), "ends": pa.string()}
_SCHEMA = pa.schema(
    [(name, _TYPES.get(name, pa.int64())) for name in _NODE_FIELDS]
    + [("part", pa.int64()), ("side", pa.int32()), ("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("hanging", _HANGING_TYPE)]
)


def _output(forest: _Forest, ends: list[_Path], part: int) -> pa.Table:
    """Complete nodes, then the contracted paths; the fields of the other kind are null."""
    n, m = len(forest.nodes["depth"]), len(ends)
    columns = {name: values + [None] * m for name, values in forest.nodes.items()}
    columns |= {
        "part": [None] * n + [part] * m,
        "side": [None] * n + list(range(m)),
        "key": [None] * n + [p.key for p in ends],
        "sizes": [None] * n + [p.sizes for p in ends],
        "hanging": [None] * n + [[dict(zip(_HANGING_FIELDS, row)) for row in p.hanging] for p in ends],
    }
    return pa.table({f.name: pa.array(columns[f.name], f.type) for f in _SCHEMA}, schema=_SCHEMA)


def _of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forest of one range of sorted conversations; rows of one key are pieces of its ids in order."""
    paths: list[_Path] = []
    key, digest, n, least, sizes = None, None, 0, None, None

    def close():
        if key is not None:
            paths.append(_Path(key, sizes, [(len(key) // DIGEST, n, least, 0, 0, 0, digest.hexdigest())]))

    for batch in batches:
        for row in zip(*[batch.column(name).to_pylist() for name in ("key", "sizes", "n", "least", "ids")]):
            if row[0] == key:
                digest.update(b",")
                n += row[2]
                least = min(least, row[3])
            else:
                close()
                key, sizes, n, least = row[:4]
                digest = hashlib.sha256()
            digest.update(row[4].encode())
    close()
    forest = _Forest(paths, False, False)
    ends = forest.build()
    yield from _output(forest, ends, TaskContext.get().partitionId()).to_batches()


def _of_paths(whole: bool, fan_in: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["side"]))
        paths = [_Path(r["key"], r["sizes"], [tuple(h.values()) for h in r["hanging"]]) for r in rows]
        forest = _Forest(paths, whole, True)
        ends = forest.build()
        return _output(forest, ends, rows[0]["part"] // fan_in)

    return run


def prefix_nodes(sequences: DataFrame, task_bytes: int = TASK_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """All nodes of the trie of ``sequences`` (id, turns), one row for each id: conv_id (least member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    spark = sequences.sparkSession
    ship_package(spark)
    rows = sequences.select(
        "id",
        F.unhex(F.array_join("turns.digest", "")).alias("key"),
        F.col("turns.size").alias("sizes"),
        F.floor(F.col("id") / ID_RUN).alias("run"),
    )
    runs = rows.groupBy("key", "run").agg(
        F.first("sizes").alias("sizes"),
        F.count(F.lit(1)).alias("n"),
        F.min("id").alias("least"),
        F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), ",").alias("ids"),
    )
    seen, path = Observation(), fresh_path(spark, "trie-keys")
    runs.observe(seen, F.sum(F.length("key") + F.length("ids")).alias("bytes")).write.parquet(path)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil((seen.get["bytes"] or 0) / task_bytes))
    runs = spark.read.schema(runs.schema).parquet(path)
    schema = f"{NODE}, {PATH}"
    sorted_runs = runs.repartitionByRange(parts, "key").sortWithinPartitions("key", "run")
    level = stored(sorted_runs.mapInArrow(_of_range, schema), "trie-ranges")
    levels = [level]
    while parts:
        whole = parts <= fan_in
        paths = level.where("key is not null").groupBy(F.floor(F.col("part") / fan_in))
        level = stored(paths.applyInArrow(_of_paths(whole, fan_in), schema), "trie-paths")
        levels.append(level)
        parts = 0 if whole else ceil(parts / fan_in)
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    nodes = nodes.where("depth is not null").select(*_NODE_FIELDS)
    inner = nodes.where("parent_ref is null")
    open_ = nodes.where("ref is not null").select(F.col("ref").alias("parent_ref"), F.col("conv_id").alias("above"))
    rest = nodes.where("parent_ref is not null").join(open_, "parent_ref").withColumn("parent_conv_id", F.col("above"))
    ends = F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    return inner.select(*columns).unionByName(rest.select(*columns)).select(*columns[:-1], ends)
