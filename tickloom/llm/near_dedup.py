"""Near-duplicate documents: chosen-path set similarity join over minwise tokens.

A document's set is its distinct word shingles. Documents with equal sets form a class and are
joined through one representative. Each tree starts with all representatives in one node; a
node draws minwise positions, 1/similarity of them on average, and each position deals the
node's documents out by the token they have there. A node of at most ``NODE_LIMIT`` documents
is compared exhaustively, a larger one branches again, unless its documents are so alike that
branching does not take them apart; then it is compared in blocks. A similar pair stays together along
some path of a tree with a probability that falls slowly with depth; ``TREES`` independent
trees bring what one tree misses below a thousandth for pairs at the threshold (after up to five
branchings; below half a per cent at the deepest).

Within a node documents are compared by one byte per minwise token, and only to leave out pairs
that are more than four standard deviations below the threshold, or that bitmaps of the sets rule
out. Every link is then confirmed on the full sets. Confirmation takes two rounds: a spanning
forest of each node's likely pairs first; then all likely pairs that this left in different
components, so that a large group of near copies costs links in proportion to its size and no
link between components is lost.

Defined results: a null or empty text, or one without words, has an empty set, size 0, and is
linked with nothing, not even with another empty one. A text with fewer words than a shingle has
its whole word sequence as its only shingle. Equal texts are always linked. Repeated rows (same
id and text) belong to one group, of which one row is kept. Rows with a null id take part; the
least id of a component ignores them. An empty table gives an empty result. Other columns of the
input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.components import connected_components
from tickloom.llm.tables import one_of_repeated, ship_package, stored, stored_alone, text_rows, without_rows
from tickloom.llm.words import NOT_SPACE, chunks, mix, split_words

WORDS = 5
SIMILARITY = 80  # per cent
TREES = 10
TOKENS = 128  # minwise tokens in a signature
NODE_LIMIT = 1000  # documents compared with each other in one task
MAX_DEPTH = 10
BITS = 8192  # of the bitmap of a set
SHRINK = 0.8  # nodes are branched as long as that leaves so much less in large nodes

_rng = np.random.default_rng(7)
_A = (_rng.integers(1, 2**31, TOKENS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 2**32, TOKENS, dtype=np.uint32)


def _signature(shingles: np.ndarray) -> np.ndarray:
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(TOKENS, 2**32 - 1, np.uint32)
    for begin in range(0, len(low), 2048):
        part = low[begin : begin + 2048, None] * _A + _B
        part ^= part >> np.uint32(15)
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _children(nodes: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for the positions each node draws; tokens has a signature per row."""
    rows = np.arange(len(nodes))
    drawn = mix(nodes ^ np.uint64(0x5BD1E995))
    first = (drawn % np.uint64(TOKENS)).astype(np.int64)
    step = 1 + (mix(drawn) % np.uint64(TOKENS - 1)).astype(np.int64)
    again = mix(drawn + np.uint64(1)) < np.uint64((1 / similarity - 1) * 2**64)
    rows = np.concatenate([rows, rows[again]])
    place = np.concatenate([first, ((first + step) % TOKENS)[again]])
    child = mix(mix(nodes[rows] + place.astype(np.uint64)) + tokens[rows, place].astype(np.uint64))
    return rows, child


def _document_sets(words, size: int) -> Iterator[np.ndarray]:
    hashes, inside = words.shingles(size)
    for first, last in zip(words.bounds[:-1], words.bounds[1:]):
        if last - first >= size:
            yield np.unique(hashes[first : last - size + 1])
        elif last > first:
            yield np.array([words.sequence(first, last)], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _sketch(similarity: float, size: int):
    roots = mix(np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in chunks(batch)):
            sets = list(_document_sets(split_words(part.column("text"), NOT_SPACE), size))
            n = len(sets)
            counts = np.array([len(s) for s in sets], np.int64)
            sums = np.zeros((2, n), np.uint64)
            tokens = np.zeros((n, TOKENS), np.uint32)
            for i, s in enumerate(sets):
                if len(s):
                    sums[0, i] = mix(s).sum(dtype=np.uint64)
                    sums[1, i] = mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
                    tokens[i] = _signature(s)
            rows, child = _children(np.tile(roots, n), np.repeat(tokens, TREES, axis=0), similarity)
            owner = rows // TREES
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(counts),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(child[order].view(np.int64))),
                    pa.array([row.tobytes() for row in tokens.astype(np.uint8)], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "h1", "h2", "nodes", "bytes"],
            )

    return run


def _branch(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column("node").to_numpy().view(np.uint64)
            tokens = np.frombuffer(b"".join(batch.column("bytes").to_pylist()), np.uint8).reshape(-1, TOKENS)
            rows, child = _children(nodes, tokens, similarity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), batch.column("rep").take(pa.array(rows))], names=["node", "rep"]
            )

    return run


def _likely(tokens: np.ndarray, sizes: np.ndarray, labels: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i, j with different labels that may reach the similarity, and how many bytes agree."""
    s = similarity / 100
    least = TOKENS * (s - 4.5 * np.sqrt(s * (1 - s) / TOKENS))
    # Documents of the most common label come last and need no turn of their own.
    names, which, counts = np.unique(labels, return_inverse=True, return_counts=True)
    order = np.argsort(which == counts.argmax(), kind="stable")
    turns = len(labels) - counts.max()
    tokens, sizes, labels = tokens[order], sizes[order], labels[order]
    found = []
    for i in range(turns):
        j = i + 1 + np.flatnonzero(labels[i + 1 :] != labels[i])
        small, great = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        j = j[100 * small >= similarity * great]
        equal = (tokens[j] == tokens[i]).sum(axis=1)
        good = equal >= least
        if good.any():
            j = j[good]
            found.append((np.full(len(j), order[i]), order[j], equal[good]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _forest(n: int, i: np.ndarray, j: np.ndarray, equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs, most alike first."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k in np.argsort(-equal, kind="stable"):
        a, b = root(int(i[k])), root(int(j[k]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(k)
            if len(kept) == n - 1:
                break
    return i[kept], j[kept]


def _possible(i, j, bits: np.ndarray, sizes: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs, those that their bitmaps do not rule out. A common shingle sets a common bit, or
    shares its bit with another one in both sets, which bounds the intersection from above."""
    shared = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    kept = []
    for begin in range(0, len(i), 4096):
        a, b = i[begin : begin + 4096], j[begin : begin + 4096]
        most = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64) + np.minimum(shared[a], shared[b])
        most = np.minimum(most, np.minimum(sizes[a], sizes[b]))
        kept.append(100 * most >= similarity * (sizes[a] + sizes[b] - most))
    kept = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[kept], j[kept]


def _compare(similarity: int, forest: bool):
    """Compares the documents of each node; rows come sorted by node, and a node's rows are
    bounded, so that only one node has to be held at a time."""

    def node_pairs(table, reps, tokens, sizes):
        if forest:  # everything is still apart
            i, j, equal = _likely(tokens, sizes, np.arange(len(reps)), similarity)
            i, j = _forest(len(reps), i, j, equal) if len(i) > 1 else (i, j)
        else:
            i, j, _ = _likely(tokens, sizes, table.column("label").to_numpy(), similarity)
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)
            i, j = _possible(i, j, bits, sizes, similarity)
        return np.minimum(reps[i], reps[j]), np.maximum(reps[i], reps[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(out):
            a, b = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        rest, out = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            nodes = table.column("node").to_numpy()
            last = int(np.searchsorted(nodes, nodes[-1], "left"))  # the last node may go on
            rest = table.slice(last)
            out += whole_nodes(table.slice(0, last))
            if sum(len(x[0]) for x in out) > 50_000:
                yield emit(out)
                out = []
        if rest is not None:
            out += whole_nodes(rest)
        if out:
            yield emit(out)

    def whole_nodes(table: pa.Table):
        if not table.num_rows:
            return []
        nodes = table.column("node").to_numpy()
        reps = table.column("rep").to_numpy()
        sizes = table.column("n_shingles").to_numpy()
        tokens = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(-1, TOKENS)
        cuts = np.flatnonzero(np.diff(nodes)) + 1
        out = []
        for first, last in zip(np.r_[0, cuts], np.r_[cuts, len(nodes)]):
            if last - first > 1:
                pairs = node_pairs(table.slice(first, last - first), reps[first:last], tokens[first:last], sizes[first:last])
                if len(pairs[0]):
                    out.append(pairs)
        return out

    return run


def _blocks(members: DataFrame) -> DataFrame:
    """First round: a node that no branching made small is dealt into blocks."""
    blocks = F.ceil(F.col("n") / NODE_LIMIT).cast("int")
    block = F.xxhash64("node", F.pmod(F.xxhash64("node", "rep"), blocks))
    return members.select(F.when(blocks == 1, F.col("node")).otherwise(block).alias("node"), "rep")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Second round: nodes with several labels. In one that is still large the documents of its
    most common label are dealt into blocks, and each other document goes to all of these, so that
    all pairs of different labels meet."""
    known = members.select("node", "rep").join(labels, "rep")
    counts = known.groupBy("node", "label").agg(F.count("*").alias("n"))
    nodes = counts.groupBy("node").agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max(F.struct("n", "label"))["label"].alias("common"))
    nodes = nodes.where("labels > 1").select("node", "common", F.ceil(F.col("n") / NODE_LIMIT).cast("int").alias("blocks"))
    known = known.join(nodes, "node")
    own = F.array(F.pmod(F.xxhash64("node", "rep"), F.col("blocks")).cast("int"))
    goes = F.when(F.col("label") == F.col("common"), own).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = known.select("node", "rep", "label", "blocks", F.explode(goes).alias("block"))
    node = F.when(F.col("blocks") == 1, F.col("node")).otherwise(F.xxhash64("node", "block"))
    return dealt.select(node.alias("node"), "rep", "label")


def _members(spark, sketches: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """(node, rep, n): the last node of every path, and its size."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frontier = sketches.select("nodes", "rep").join(classes.select("rep"), "rep", "left_semi")
    frontier = frontier.select(F.explode("nodes").alias("node"), "rep").distinct()
    found, tokens, before = [], sketches.select("rep", "bytes"), None
    for depth in range(MAX_DEPTH + 1):
        frontier = stored(frontier, "frontier")
        sizes = frontier.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        sized = frontier.join(sizes, "node")
        found.append(sized.where(F.col("n") <= NODE_LIMIT).select("node", "rep", "n"))
        large = sized.where(F.col("n") > NODE_LIMIT).select("node", "rep", "n")
        count = large.count()
        if not count:
            break
        if depth == MAX_DEPTH or before and count > SHRINK * before:
            found.append(large)  # near copies of one another; no path takes them apart
            break
        before = count
        # Only documents in large nodes are asked for their tokens again.
        if depth == 0:
            tokens = stored(tokens.join(large.select("rep").distinct(), "rep", "left_semi"), "tokens")
        grown = large.select("node", "rep").join(tokens, "rep").repartition(partitions)
        frontier = grown.mapInArrow(_branch(similarity), "node bigint, rep bigint").distinct()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return stored(out, "members")


def _pairs(spark, members: DataFrame, signatures: DataFrame, similarity: int, forest: bool) -> DataFrame:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = members.join(signatures, "rep").repartition(partitions, "node").sortWithinPartitions("node")
    return rows.mapInArrow(_compare(similarity, forest), "a bigint, b bigint").distinct()


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in chunks(batch)):
            sets = list(_document_sets(split_words(part.column("text"), NOT_SPACE), size))
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            bits = np.zeros((len(sets), BITS), bool)
            for row, s in zip(bits, sets):
                row[(s >> np.uint64(20)) % np.uint64(BITS)] = True
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("rep"),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    pa.array([row.tobytes() for row in packed], pa.binary()),
                ],
                names=["rep", "shingles", "bits"],
            )

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(100 * both >= similarity * (F.size("left") + F.size("right") - both)).select(
        F.col("a").alias("u"), F.col("b").alias("v")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, component_id (least id of the
    component), kept (true for one row of each component).

    ``words`` per shingle and ``similarity`` in per cent of the union. Words are lower-cased
    (A-Z) and split at spaces and control spaces."""
    spark, share = docs.sparkSession, similarity / 100
    ship_package(spark)
    source = text_rows(docs, key, text)
    id_type = source.schema["doc_id"].dataType.simpleString()
    sketches = source.mapInArrow(
        _sketch(share, words),
        f"doc_id {id_type}, text_hash bigint, n_shingles bigint, h1 bigint, h2 bigint, nodes array<bigint>, bytes binary",
    )
    sketches = stored(sketches.withColumn("row", F.monotonically_increasing_id()), "sketches")

    classes = sketches.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("row").alias("rep"))
    classes = stored(classes, "classes")
    by_rep = sketches.withColumnRenamed("row", "rep")

    members = _members(spark, by_rep, classes, share)
    first = stored(_pairs(spark, _blocks(members), by_rep.select("rep", "n_shingles", "bytes"), similarity, True), "pairs")
    near = first.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    near = near.join(by_rep.select("rep", "doc_id", "text_hash"), "rep")
    texts = source.join(
        near.select("rep", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")),
        (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id")),
    )
    sets = texts.select("rep", "text").mapInArrow(_full_sets(words), "rep bigint, shingles array<bigint>, bits binary")
    sets = stored(sets, "sets")
    links = stored(_confirmed(first, sets, similarity), "links")

    labels = near.select("rep").join(connected_components(links).withColumnRenamed("node", "rep"), "rep", "left")
    labels = stored(labels.select("rep", F.coalesce("component", "rep").alias("label")), "labels")
    signatures = by_rep.select("rep", "n_shingles", "bytes").join(sets.select("rep", "bits"), "rep")
    second = _pairs(spark, _mixed(members, labels), signatures, similarity, False)
    second = second.join(first, ["a", "b"], "left_anti")
    more = stored(_confirmed(second, sets, similarity), "links")
    components = labels
    if not more.isEmpty():
        # Components of components: few, as most links were found in the first round.
        ends = [labels.select(F.col("rep").alias(c), F.col("label").alias(f"{c}_label")) for c in ("u", "v")]
        joined = more.join(ends[0], "u").join(ends[1], "v").select(F.col("u_label").alias("u"), F.col("v_label").alias("v"))
        merged = connected_components(joined).withColumnRenamed("node", "label")
        components = labels.join(merged, "label", "left").select("rep", F.coalesce("component", "label").alias("label"))
    components = components.withColumnRenamed("label", "component")
    grouped = classes.join(components, "rep", "left")
    grouped = grouped.select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    rows = sketches.select("row", "doc_id", "text_hash", "n_shingles", "h1", "h2").join(grouped, ["h1", "h2"], "left")
    # A document with an empty set has no class; it is a component of its own.
    rows = rows.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("row")))
    rows = stored(rows.drop("h1", "h2"), "rows")
    heads = rows.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("head")
    )
    return rows.join(heads, "component").select(
        "doc_id", "text_hash", "n_shingles", "component_id", (F.col("row") == F.col("head")).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns as they were."""

    def removed() -> DataFrame:
        found = near_duplicates(docs, key, text, **options)
        keys = found.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
        return keys.where("not kept or n > 1")

    keys = stored_alone(removed, "keys")
    rows = without_rows(docs, keys.where("not kept"), key, text)
    repeated = keys.where("kept and n > 1")
    return rows if repeated.isEmpty() else one_of_repeated(rows, repeated, key, text)
