"""Second-order boosted trees from histograms that Spark adds up.

Features are cut once at quantiles into at most ``BINS`` ranges and stored as small numbers. Every level
of every tree is one job: tasks sum the first and second derivatives of the log-loss for each (node,
feature, bin), Spark adds the tasks' sums as a tree, and the driver, which gets an array whose size depends
on nodes, features and bins alone, picks for each node the split of greatest gain

    1/2 (GL^2 / (HL + l) + GR^2 / (HR + l) - G^2 / (H + l)),

missing values being tried on both sides. A leaf's value is -rate G / (H + l). Positives' derivatives are
multiplied by a weight. A finished tree's leaves are added to the held margins once, so a level looks at its
own tree alone; the margins are written back every few rounds, which bounds what a lost block costs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.session import ship_code, stored

TREES = "boosted_trees"
BINS = 256
MISSING = BINS  # bin of missing values
CUT_ACCURACY = 1_000_000
LEAST_GAIN = 1e-6
STORE_EVERY = 16  # rounds after which the margins are stored
FEW_PARTS = 64  # tasks whose sums the driver adds up itself

NODES = "tree int, node int, place int, feature string, cut double, missing_left boolean, `left` int, `right` int, value double, gain double, cover double"
PARAMS = "model_type string, features array<string>, settings map<string,string>"


@dataclass
class Tree:
    """Nodes as parallel lists; feature -1 marks a leaf. ``bin`` and ``cut`` say the same: a row
    goes left when its bin is at most ``bin``, that is, its value at most ``cut``."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for column, start in (
            (self.feature, -1), (self.bin, 0), (self.cut, 0.0), (self.missing_left, True), (self.left, -1),
            (self.right, -1), (self.value, value), (self.gain, 0.0), (self.cover, cover),
        ):
            column.append(start)
        return len(self.value) - 1

    def depth(self) -> int:
        level = [0] * len(self.feature)  # children come after their parents
        for node, feature in enumerate(self.feature):
            if feature >= 0:
                level[self.left[node]] = level[self.right[node]] = level[node] + 1
        return max(level)


class Walk:
    """A tree laid out for rows of bins, the last bin of ``width`` being that of missing values: where each
    bin leads from each node. A row goes left when its bin is at most the node's in ``bins``; leaves lead to
    themselves."""

    def __init__(self, tree: Tree, bins: list[int], width: int):
        inner = np.flatnonzero(np.array(tree.feature) >= 0)
        goes_left = np.arange(width) <= np.array(bins)[inner, None]
        goes_left[:, -1] = np.array(tree.missing_left)[inner]
        leads = np.repeat(np.arange(len(tree.feature))[:, None], width, axis=1)
        leads[inner] = np.where(goes_left, np.array(tree.left)[inner, None], np.array(tree.right)[inner, None])
        self.leads, self.width, self.depth = leads.ravel(), width, tree.depth()
        self.feature, self.value = np.maximum(tree.feature, 0), np.array(tree.value)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf each row (a column of ``bins``) ends in."""
        rows = bins.shape[1]
        flat, row = np.ascontiguousarray(bins).ravel(), np.arange(rows)
        begin = self.feature * rows
        at = np.zeros(rows, np.int64)
        for _ in range(self.depth):
            at = self.leads[at * self.width + flat[begin[at] + row]]
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.places(bins)]


def _walk(tree: Tree) -> Walk:
    return Walk(tree, tree.bin, BINS + 1)


def _bins(values: np.ndarray, marks: np.ndarray, missing: int) -> np.ndarray:
    """How many of ``marks`` lie below each value, or ``missing`` where it is NaN."""
    found = np.searchsorted(marks, values, side="left")
    found[np.isnan(values)] = missing
    return found


def _logistic(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))


@dataclass
class BoostedTrees:
    features: list[str]
    trees: list[Tree]
    settings: dict[str, str] = field(default_factory=dict)

    def _walks(self) -> tuple[list[np.ndarray], int, list[Walk]]:
        """(cuts of each feature, bin of missing values, trees) for values binned by the trees' own cuts; laid
        out once, where it is used."""
        if "_laid_out" not in self.__dict__:
            used = [[] for _ in self.features]
            for tree in self.trees:
                for feature, cut in zip(tree.feature, tree.cut):
                    if feature >= 0:
                        used[feature].append(cut)
            marks = [np.unique(np.array(cuts, np.float64)) for cuts in used]
            missing = max(map(len, marks), default=0) + 1
            at = lambda f, cut: int(np.searchsorted(marks[f], cut)) if f >= 0 else 0
            walks = [Walk(t, [at(f, cut) for f, cut in zip(t.feature, t.cut)], missing + 1) for t in self.trees]
            self.__dict__["_laid_out"] = marks, missing, walks
        return self.__dict__["_laid_out"]

    def margin(self, values: np.ndarray) -> np.ndarray:
        """Sum of the trees' leaves; ``values`` has a row per feature, NaN where missing."""
        marks, missing, walks = self._walks()
        bins = np.stack([_bins(row, cuts, missing) for row, cuts in zip(values, marks)])
        total = np.zeros(values.shape[1])
        for walk in walks:
            total += walk.margins(bins)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``predicted_label`` and ``spike_probability``; missing values go the way learned."""
        ship_code(df.sparkSession)
        model = BoostedTrees(self.features, self.trees)

        @F.pandas_udf("double")
        def probability(columns: pd.DataFrame) -> pd.Series:
            values = columns.to_numpy("float64", na_value=np.nan).T
            return pd.Series(_logistic(model.margin(np.ascontiguousarray(values))))

        scored = df.withColumn("spike_probability", probability(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features])))
        columns = [*df.columns, (F.col("spike_probability") > 0.5).cast("int").alias("predicted_label"), "spike_probability"]
        return scored.select(*columns)

    def importance(self) -> list[tuple[str, float]]:
        """Average gain of a feature's splits, as a share of all features' together."""
        gains, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    gains[feature] += gain
                    splits[feature] += 1
        average = gains / np.maximum(splits, 1)
        return list(zip(self.features, (average / max(average.sum(), 1e-300)).tolist()))

    def logged(self) -> dict[str, str]:
        return dict(self.settings)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row per node; ``place`` is 1 for a root, 2p and 2p + 1 for the children of p."""
        rows = []
        for number, tree in enumerate(self.trees):
            place = [1] * len(tree.feature)
            for node, feature in enumerate(tree.feature):
                if feature >= 0:
                    place[tree.left[node]], place[tree.right[node]] = 2 * place[node], 2 * place[node] + 1
            for node, feature in enumerate(tree.feature):
                name = self.features[feature] if feature >= 0 else None
                cut = float(tree.cut[node]) if feature >= 0 else None
                rows.append(
                    (number, node, place[node], name, cut, bool(tree.missing_left[node]), tree.left[node], tree.right[node],
                     float(tree.value[node]), float(tree.gain[node]), float(tree.cover[node]))
                )
        return spark.createDataFrame(rows, NODES)

    def save(self, path: str, spark: SparkSession) -> None:
        spark.createDataFrame([(TREES, self.features, self.settings)], PARAMS).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str, params, spark: SparkSession) -> "BoostedTrees":
        features = list(params["features"])
        place = {name: i for i, name in enumerate(features)}
        trees: list[Tree] = []
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():
            if r.tree == len(trees):
                trees.append(Tree())
            tree = trees[-1]
            node = tree.add(r.value, r.cover)
            if r.feature is not None:
                tree.feature[node], tree.cut[node], tree.gain[node] = place[r.feature], r.cut, r.gain
                tree.missing_left[node], tree.left[node], tree.right[node] = r.missing_left, r.left, r.right
        return cls(features, trees, dict(params["settings"]))


def feature_cuts(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """For each feature the values at which its range is cut: rows of bin b are above b of them."""
    shares = [i / bins for i in range(1, bins)]
    value = lambda f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))
    found = df.agg(*[F.percentile_approx(value(f), shares, CUT_ACCURACY).alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(found[f"c{i}"] or [], np.float64)) for i in range(len(features))]


def _binned(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for i, marks in enumerate(cuts):
                values = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                columns.append(pa.array(_bins(values, marks, MISSING).astype(np.int16)))
            label = batch.column(len(cuts)).to_numpy(zero_copy_only=False).astype(np.int8)
            columns += [pa.array(label), pa.array(np.zeros(len(label)))]
            yield pa.RecordBatch.from_arrays(columns, names=[*[f"b{i}" for i in range(len(cuts))], "y", "margin"])

    return run


def _block(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, labels, margins) of a batch of binned rows."""
    columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    return np.stack(columns[:-2]).astype(np.int16), columns[-2], columns[-1]


def _advanced(trees: list[Tree]):
    """The binned rows with the trees' leaves added to their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = [_walk(tree) for tree in trees]
        for batch in batches:
            bins, _, margin = _block(batch)
            margin = sum((walk.margins(bins) for walk in walks), margin)
            yield batch.set_column(batch.num_columns - 1, "margin", pa.array(margin))

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch as one row of three byte strings."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in _block(batch)], names=["bins", "y", "margin"])


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y = np.frombuffer(row.y, np.int8)
    return np.frombuffer(row.bins, np.int16).reshape(-1, len(y)), y, np.frombuffer(row.margin, np.float64)


def derivatives(margin: np.ndarray, y: np.ndarray, positive_weight: float) -> tuple[np.ndarray, np.ndarray]:
    p = _logistic(margin)
    weight = np.where(y == 1, positive_weight, 1.0)
    return weight * (p - y), np.maximum(weight * p * (1 - p), 1e-16)


def _moved(tree: Tree):
    """Blocks with the leaves of a finished tree added to their margins."""

    def run(blocks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        walk = _walk(tree)
        for bins, y, margin in blocks:
            yield bins, y, margin + walk.margins(bins)

    return run


def _histograms(n: int, tree: Tree, nodes: list[int], positive_weight: float):
    """A task's sums of g and h for each node of ``nodes``, feature and bin."""
    width = BINS + 1
    wanted = np.full(len(tree.feature), -1)
    wanted[nodes] = np.arange(len(nodes))

    def run(blocks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
        walk = _walk(tree)
        total = np.zeros((2, len(nodes), n, width))
        for bins, y, margin in blocks:
            slope, bend = derivatives(margin, y, positive_weight)
            at = wanted[walk.places(bins)]
            some = at >= 0
            if not some.all():
                at, slope, bend, bins = at[some], slope[some], bend[some], bins[:, some]
            first = at * width
            for i in range(n):
                cell = first + bins[i]
                for sums, part in zip(total, (slope, bend)):
                    sums[:, i] += np.bincount(cell, part, len(nodes) * width).reshape(len(nodes), width)
        yield total.reshape(-1)

    return run


@dataclass
class Split:
    feature: int
    bin: int
    missing_left: bool
    gain: float
    left: tuple[float, float]
    right: tuple[float, float]


def best_split(g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], penalty: float, least_cover: float) -> Split | None:
    """The split of greatest gain of one node from its sums by (feature, bin), the last bin being
    that of missing values. Gains that agree to nine digits go to the first feature, missing values on
    the left, and the lowest bin."""
    total_g, total_h = g[0].sum(), h[0].sum()
    score = lambda a, b: a * a / (b + penalty)
    best = None
    for feature, marks in enumerate(cuts):
        n = len(marks)
        if not n:
            continue
        for missing_left in (True, False):
            if missing_left:
                extra_g, extra_h = g[feature, MISSING], h[feature, MISSING]
            elif h[feature, MISSING] > 0:
                extra_g = extra_h = 0.0
            else:
                continue
            left_g = np.cumsum(g[feature, :n]) + extra_g
            left_h = np.cumsum(h[feature, :n]) + extra_h
            right_g, right_h = total_g - left_g, total_h - left_h
            gains = 0.5 * (score(left_g, left_h) + score(right_g, right_h) - score(total_g, total_h))
            gains[(left_h < least_cover) | (right_h < least_cover)] = -np.inf
            top = gains.max()
            if not top > LEAST_GAIN or best and top <= best.gain * (1 + 1e-9):
                continue
            at = int(np.argmax(gains >= top * (1 - 1e-9)))
            best = Split(feature, at, missing_left, float(gains[at]), (left_g[at], left_h[at]), (right_g[at], right_h[at]))
    return best


def grow(sums, cuts: list[np.ndarray], depth: int, rate: float, penalty: float, least_cover: float) -> Tree:
    """One tree, level by level. ``sums(tree, nodes)`` gives the sums (node, feature, bin) of g and h."""
    tree = Tree()
    nodes = [tree.add(0.0, 0.0)]
    for level in range(depth):
        g, h = sums(tree, nodes)
        if level == 0:
            total_g, total_h = g[0, 0].sum(), h[0, 0].sum()
            tree.value[0], tree.cover[0] = -rate * total_g / (total_h + penalty), total_h
        after = []
        for k, node in enumerate(nodes):
            split = best_split(g[k], h[k], cuts, penalty, least_cover)
            if split is None:
                continue
            tree.feature[node], tree.bin[node], tree.cut[node] = split.feature, split.bin, float(cuts[split.feature][split.bin])
            tree.missing_left[node], tree.gain[node] = split.missing_left, split.gain
            children = [tree.add(-rate * a / (b + penalty), b) for a, b in (split.left, split.right)]
            tree.left[node], tree.right[node] = children
            after += children
        nodes = after
        if not nodes:
            break
    return tree


def _held(binned: DataFrame) -> RDD:
    """The stored rows as blocks of arrays, which every level of the next trees reads again. They are
    kept where there is room and read from the table where they are lost."""
    return binned.mapInArrow(_packed, "bins binary, y binary, margin binary").rdd.map(_unpacked).persist(StorageLevel.MEMORY_AND_DISK)


def boost(
    df: DataFrame, features: list[str], label: str, positive_weight: float, depth: int = 5, rounds: int = 100, rate: float = 0.1,
    penalty: float = 1.0, least_cover: float = 1.0,
) -> BoostedTrees:
    """Trees fitted to ``label`` (0 or 1), one after the other, from margin 0."""
    spark = df.sparkSession
    ship_code(spark)
    n = len(features)
    cuts = feature_cuts(df, features)
    rows = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("tinyint").alias(label))
    schema = ", ".join([*[f"b{i} smallint" for i in range(n)], "y tinyint, margin double"])
    binned = stored(rows.mapInArrow(_binned(cuts), schema), "binned")
    trees: list[Tree] = []
    finished = 0  # trees whose leaves are in the stored margins
    held = _held(binned)

    def sums(tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        total = held.mapPartitions(_histograms(n, tree, nodes, positive_weight)).treeReduce(np.add, 2 if parts > FEW_PARTS else 1)
        if len(nodes) == 1 and len(tree.feature) == 1:  # the blocks of this tree are there now
            while before:
                before.pop().unpersist()
        return total.reshape(2, len(nodes), n, BINS + 1)

    parts = held.getNumPartitions()
    before: list[RDD] = []  # blocks of the tree before
    for _ in range(rounds):
        if len(trees) - finished >= STORE_EVERY:
            binned = stored(binned.mapInArrow(_advanced(trees[finished:]), schema), "binned")
            before.append(held)
            held, finished = _held(binned), len(trees)
            parts = held.getNumPartitions()
        elif trees:
            before.append(held)
            held = held.mapPartitions(_moved(trees[-1])).persist(StorageLevel.MEMORY_AND_DISK)
        trees.append(grow(sums, cuts, depth, rate, penalty, least_cover))
    for blocks in [*before, held]:
        blocks.unpersist()
    settings = {
        "max_depth": str(depth), "learning_rate": repr(rate), "n_estimators": str(rounds), "scale_pos_weight": repr(positive_weight),
        "reg_lambda": repr(penalty), "min_child_weight": repr(least_cover),
    }
    return BoostedTrees(list(features), trees, settings)
