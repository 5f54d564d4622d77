"""Random forests of all folds at once, grown from counted cells instead of rows.

A tree never sees more of a feature than its bin: up to ``MAX_BINS`` ranges between thresholds, or
the categories.  Rows in the same bins with the same label are one cell with a count per fold, and
training costs what the cells cost, not what the rows cost.  With as many cells as rows it is the
usual training.

The method is that of MLlib: thresholds from a sample of about 10,000 training rows of each fit,
Gini gain, all subsets of few categories and those in the order of their impurity else, a draw of
features for every node, merged leaves of equal predictions.  A bootstrap draws each row Poisson(1)
times; the ``n`` rows of a cell are together drawn Poisson(n) times, which is the same distribution.

Trees grow level by level.  Tasks add up the classes per tree, node, feature and bin, the sums of a
tree meet in a group that chooses its splits, and the driver sees the chosen splits alone.  Draws
follow from the seed, the fold, the tree and the ordered cells, so a model depends neither on the
cores nor on how the input is split.
"""

from __future__ import annotations

import json
import math
import sys
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..sources import staged_table, temporary_workspace
from ..sources.workspace import write_text
from .sampling import row_key

# workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 32
MAX_CLASSES = 100
SPLIT_SAMPLE = 10_000  # training rows of a fit from which thresholds are taken, as in MLlib
CELLS_A_PART = 250_000
TREES_A_TASK = 8  # at least, where tasks share the trees
NODES_A_BLOCK = 256  # whose histograms travel as one value
DRAWS = 1 << 30

NODE = (
    "id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)
CHOSEN = (
    "unit int, node int, feature int, cut int, mask long, gain double, "
    "total array<double>, left array<double>, right array<double>"
)


def split_draw(df: DataFrame, features: str) -> Column:
    """Number in 0 .. ``DRAWS``-1 by which a row is sampled for thresholds; equal rows with one key share it."""
    return F.pmod(F.xxhash64(row_key(df), vector_to_array(features)), F.lit(DRAWS)).cast("int")


# --- bins -----------------------------------------------------------------------


@dataclass(frozen=True)
class Binning:
    """How the features are cut.

    ``arity`` has the number of categories of each feature, 0 for numbers (and for a single
    category, which cannot be split).  ``points[fit]`` are the thresholds of the features in one
    fit, ``edges`` those of all fits together: cells are cut at the edges, so they fit every fit.
    """

    arity: list[int]
    edges: list[np.ndarray]
    points: list[list[np.ndarray]]
    classes: list[int]  # of each fit
    unordered: list[list[bool]]  # of each fit and feature

    def map_of(self, fit: int, feature: int) -> np.ndarray:
        """Code of a cell -> bin of the fit."""
        if self.arity[feature]:
            return np.arange(self.arity[feature])
        points = self.points[fit][feature]
        return np.append(np.searchsorted(points, self.edges[feature]), len(points))

    def width(self, feature: int) -> int:
        return self.arity[feature] or len(self.edges[feature]) + 1


def category_sizes(df: DataFrame, features: str) -> tuple[int, dict[int, int]]:
    """Length of the vector, and the number of categories of each nominal element."""
    described = df.schema[features].metadata.get("ml_attr", {})
    attributes = described.get("attrs", {})
    sizes = {at["idx"]: 2 for at in attributes.get("binary", [])}
    for at in attributes.get("nominal", []):
        size = len(at["vals"]) if "vals" in at else at.get("num_vals")
        if size is None:
            raise ValueError(f"feature {at['idx']} is nominal, but the number of its values is not known")
        sizes[at["idx"]] = size
    length = described.get("num_attrs")
    if length is None:
        length = df.select(F.size(vector_to_array(features))).first()[0]
    return length, sizes


def split_points(values: np.ndarray, counts: np.ndarray, splits: int) -> np.ndarray:
    """Thresholds between distinct rising ``values``: all, or about ``splits`` that part the rows evenly."""
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) <= splits:
        return middles
    stride = counts.sum() / (splits + 1)
    seen, target, kept = np.cumsum(counts), stride, []
    for at, middle in enumerate(middles):
        if abs(seen[at] - target) < abs(seen[at + 1] - target):
            kept.append(middle)
            target += stride
    return np.array(kept)


def fit_binning(rows: DataFrame, features: str, label: str, draw: str, folds: int) -> Binning:
    """Thresholds of each fold's training rows, and of all rows as the last fit."""
    y = F.col(label)
    bad = F.coalesce((y < 0) | (y != F.floor(y)) | F.isnan(y), F.lit(True)) | F.col(features).isNull()
    tally = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.max(label).alias("label"), F.count_if(bad).alias("bad")).collect()
    if any(row["bad"] for row in tally):
        raise ValueError(f"each training row needs {features}, and as {label} a whole number of 0 or more")
    held = {row["fold"]: row for row in tally}
    sizes, classes = [], []
    for fit in range(folds + 1):
        training = [row for fold, row in held.items() if fold != fit]
        if not training or fit < folds and fit not in held:
            raise ValueError(f"The {'validation' if training else 'training'} data at fold {fit} is empty.")
        sizes.append(sum(row["n"] for row in training))
        classes.append(int(max(row["label"] for row in training)) + 1)
    if max(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has {max(classes)} classes, more than {MAX_CLASSES}")
    length, nominal = category_sizes(rows, features)
    arity = [nominal.get(j, 0) for j in range(length)]
    for j, size in enumerate(arity):
        if size > min(MAX_BINS, *sizes):
            raise ValueError(f"feature {j} has {size} categories, more than the {min(MAX_BINS, *sizes)} bins")
    arity = [size if size > 1 else 0 for size in arity]

    limit = math.ceil(min(1.0, SPLIT_SAMPLE / min(sizes)) * DRAWS)
    numbers = [j for j, size in enumerate(arity) if not size]
    sample = (
        rows.filter(F.col(draw) < limit).select("fold", F.posexplode(vector_to_array(features)).alias("feature", "value"))
        .filter(F.col("feature").isin(numbers) & (F.abs("value") < math.inf))  # nor one that is not a number
        .groupBy("fold", "feature", "value").agg(F.count(F.lit(1)).alias("n")).toPandas()
    )
    points = []
    for fit in range(folds + 1):
        found = sample[sample["fold"] != fit].groupby(["feature", "value"])["n"].sum()
        at = []
        for j in range(length):
            seen = found.loc[j].sort_index() if j in found.index.get_level_values(0) else pd.Series(dtype=float)
            at.append(split_points(seen.index.to_numpy(float), seen.to_numpy(float), min(MAX_BINS, sizes[fit]) - 1))
        points.append(at)
    edges = [np.unique(np.concatenate([at[j] for at in points])) for j in range(length)]
    few = [int(math.log2(min(MAX_BINS, size) // 2 + 1) + 1) for size in sizes]
    unordered = [[k > 2 and 0 < size <= few[fit] for size in arity] for fit, k in enumerate(classes)]
    return Binning(arity, edges, points, classes, unordered)


def count_cells(rows: DataFrame, features: str, label: str, bins: Binning, folds: int) -> DataFrame:
    """(c0, c1, ..., label, n0, n1, ...): the code of every feature, and the rows of each fold.

    A value equal to a threshold lies left of it, one that is not a number right of all.
    """
    values = rows.select("fold", F.col(label).cast("int").alias("label"), vector_to_array(features).alias("v"))
    values = values.select("fold", "label", *[F.col("v")[j].alias(f"v{j}") for j in range(len(bins.arity))])
    cut = [j for j, edges in enumerate(bins.edges) if len(edges)]
    if cut:
        values = Bucketizer(
            inputCols=[f"v{j}" for j in cut], outputCols=[f"b{j}" for j in cut], handleInvalid="keep",
            splitsArray=[[-math.inf, *np.nextafter(bins.edges[j], math.inf).tolist(), math.inf] for j in cut],
        ).transform(values)
    codes = []
    for j, size in enumerate(bins.arity):
        code = F.col(f"v{j}") if size else F.least(f"b{j}", F.lit(float(len(bins.edges[j])))) if j in cut else F.lit(0)
        if size:
            known = (code >= 0) & (code < size) & (code == F.floor(code))
            code = F.when(known, code).otherwise(F.raise_error(F.lit(f"feature {j} has a value that is no category of its {size}")))
        codes.append(code.cast("short").alias(f"c{j}"))
    names = [f"c{j}" for j in range(len(codes))]
    return values.select("fold", "label", *codes).groupBy(*names, "label").agg(
        *[F.count_if(F.col("fold") == fold).alias(f"n{fold}") for fold in range(folds)])


# --- trees ----------------------------------------------------------------------


@dataclass(frozen=True)
class Unit:
    """One tree: of which fit (a fold that is left out, or none), its number, and the features drawn for a node."""

    fit: int
    tree: int
    drawn: int


class Tree:
    """Nodes in the order of growth; the right child of a node follows its left one."""

    def __init__(self, classes: int) -> None:
        self.feature, self.cut, self.mask, self.left, self.depth, self.gain = [-1], [0], [0], [-1], [0], [-1.0]
        self.stats = [np.zeros(classes)]

    def split(self, node: int, feature: int, cut: int, mask: int, gain: float, sides: Sequence[np.ndarray]) -> list[int]:
        """Split a node; its children that can be split again."""
        first = len(self.feature)
        self.feature[node], self.cut[node], self.mask[node], self.gain[node], self.left[node] = feature, cut, mask, gain, first
        for stats in sides:
            for column, empty in ((self.feature, -1), (self.cut, 0), (self.mask, 0), (self.left, -1), (self.gain, -1.0)):
                column.append(empty)
            self.depth.append(self.depth[node] + 1)
            self.stats.append(stats)
        return [first + side for side, stats in enumerate(sides) if stats.max() < stats.sum()]

    def walks(self, leaf: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """What :func:`descend` needs; nodes marked in ``leaf`` end the way."""
        feature = np.array(self.feature, np.int16)
        if leaf is not None:
            feature = np.where(leaf, -1, feature).astype(np.int16)
        return feature, np.array(self.cut, np.int16), np.array(self.mask, np.int64), np.array(self.left, np.int32)

    def leaves(self, depth: int) -> np.ndarray:
        """Which nodes are leaves of the tree cut at ``depth``, leaves of equal predictions merged."""
        leaf = np.array([left < 0 or at >= depth for left, at in zip(self.left, self.depth, strict=True)])
        best = [int(np.argmax(stats)) for stats in self.stats]
        for node in reversed(range(len(leaf))):  # children come after their parent
            if not leaf[node]:
                a = self.left[node]
                leaf[node] = leaf[a] and leaf[a + 1] and best[a] == best[a + 1]
        return leaf


def descend(walks: tuple[np.ndarray, ...], codes: np.ndarray, categorical: np.ndarray) -> np.ndarray:
    """The node in which each cell ends."""
    feature, cut, mask, left = walks
    node = np.zeros(len(codes), np.int32)
    moving = np.flatnonzero(feature[node] >= 0)
    while len(moving):
        at = node[moving]
        f = feature[at]
        code = codes[moving, f]
        inside = np.where(categorical[f], (mask[at] >> code.astype(np.int64)) & 1 == 1, code <= cut[at])
        at = left[at] + ~inside
        node[moving] = at
        moving = moving[feature[at] >= 0]
    return node


def gini(stats: np.ndarray) -> np.ndarray:
    """Impurity along the last axis; 0 without rows."""
    total = stats.sum(-1)
    return np.where(total > 0, 1 - ((stats / np.maximum(total, 1)[..., None]) ** 2).sum(-1), 0.0)


def gains(total: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Gini gain of each candidate; ``left`` is (nodes, candidates, classes)."""
    right = total[:, None, :] - left
    n, nl, nr = total.sum(-1)[:, None], left.sum(-1), right.sum(-1)
    gain = gini(total)[:, None] - (nl * gini(left) + nr * gini(right)) / np.maximum(n, 1)
    return np.where((nl >= 1) & (nr >= 1), gain, -np.inf)


def best_splits(histogram: np.ndarray, drawn: np.ndarray, bins: Binning, fit: int) -> list[tuple]:
    """(feature, cut, mask, gain, total, left, right) of each node.

    ``histogram`` is (nodes, drawn features, bins, classes), ``drawn`` names the features.
    """
    nodes = len(histogram)
    best: list[tuple] = [(-1, 0, 0, -np.inf, histogram[i, 0].sum(0), None) for i in range(nodes)]
    for place in range(drawn.shape[1]):
        for f in np.unique(drawn[:, place]):
            at = np.flatnonzero(drawn[:, place] == f)
            size, points = bins.arity[f], bins.points[fit][f]
            h = histogram[at, place, : size or len(points) + 1]
            total = h.sum(1)
            if h.shape[1] < 2:
                continue
            order = masks = None
            if size and bins.unordered[fit][f]:
                masks = np.arange(1, 1 << (size - 1))
                left = np.einsum("mb,nbk->nmk", (masks[:, None] >> np.arange(size)) & 1, h)
            elif size:
                counted = h.sum(-1) > 0
                centre = gini(h) if bins.classes[fit] > 2 else h[..., 1] if h.shape[2] > 1 else h[..., 0]
                order = np.argsort(np.where(counted, centre, np.inf), axis=1, kind="stable")
                left = np.cumsum(np.take_along_axis(h, order[..., None], 1), 1)[:, :-1]
            else:
                left = np.cumsum(h, 1)[:, :-1]
            gain = gains(total, left)
            top = gain.argmax(1)
            for row, node in enumerate(at):
                if gain[row, top[row]] > best[node][3]:
                    cut = mask = 0
                    if masks is not None:
                        mask = int(masks[top[row]])
                    elif order is not None:
                        mask = sum(1 << int(c) for c in order[row, : top[row] + 1])
                    else:
                        cut = int(np.searchsorted(bins.edges[f], points[top[row]]))
                    best[node] = (int(f), cut, mask, float(gain[row, top[row]]), total[row], left[row, top[row]])
    return [
        (f, cut, mask, gain if np.isfinite(gain) else -1.0, total, total if left is None else left, total * 0 if left is None else total - left)
        for f, cut, mask, gain, total, left in best]


# --- growth ---------------------------------------------------------------------


@dataclass(frozen=True)
class Dealt:
    """Cells on their tasks: ``parts`` disjoint parts, each for ``groups`` groups of the work."""

    table: DataFrame
    parts: int
    groups: int
    folds: int
    features: int


def by_slot(
    batches: Iterator[pd.DataFrame], groups: int, features: int, folds: int,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, group, codes, labels, counts) of a task, each in the order of the cells."""
    frames = list(batches)
    if not frames:
        return
    frame = pd.concat(frames, ignore_index=True)
    names = [f"c{j}" for j in range(features)]
    for slot, cells in frame.groupby("slot"):
        cells = cells.sort_values([*names, "label"])
        yield (
            int(slot) // groups, int(slot) % groups, np.ascontiguousarray(cells[names].to_numpy(np.int16)),
            cells["label"].to_numpy(np.int64), cells[[f"n{fold}" for fold in range(folds)]].to_numpy(np.int64))


def deal_cells(cells: DataFrame, folds: int, features: int, trees: int, partitions: int) -> Dealt:
    """Many cells are parted; few are copied to tasks that share the trees, ``partitions`` at most."""
    parts = max(1, math.ceil(cells.count() / CELLS_A_PART))
    groups = max(1, min(partitions // parts, math.ceil(trees / TREES_A_TASK)))
    part = F.pmod(F.xxhash64("label", *[f"c{j}" for j in range(features)]), F.lit(parts))
    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    table = (
        cells.select("*", group.alias("group"))
        .select("*", (part * groups + F.col("group")).alias("slot")).drop("group")
        .repartitionByRange(parts * groups, "slot").persist(StorageLevel.MEMORY_AND_DISK)
    )
    return Dealt(table, parts, groups, folds, features)


def drawn_features(unit: Unit, nodes: Sequence[int], seed: int, features: int) -> np.ndarray:
    """The features that each node may split by, without repeats."""
    draws = [np.random.default_rng([seed, unit.fit, unit.tree, node, 1]).random(features) for node in nodes]
    return np.argsort(draws, axis=1)[:, : unit.drawn]


def grow_trees(cells: Dealt, units: Sequence[Unit], depth: int, bins: Binning, seed: int) -> list[Tree]:
    """All trees to the given depth, one job per level."""
    seed %= 1 << 64
    trees = [Tree(bins.classes[unit.fit]) for unit in units]
    active = {number: [0] for number in range(len(units))}
    for _ in range(max(1, depth)):  # the first level also counts the classes of the roots
        if not active:
            break
        splits = _level(cells, units, trees, active, bins, seed).collect()
        following: dict[int, list[int]] = {}
        for row in sorted(splits, key=lambda row: (row["unit"], row["node"])):
            tree = trees[row["unit"]]
            if row["node"] == 0:
                tree.stats[0] = np.array(row["total"])
            if row["gain"] > 0:
                sides = [np.array(row["left"]), np.array(row["right"])]
                again = tree.split(row["node"], row["feature"], row["cut"], row["mask"], row["gain"], sides)
                if again:
                    following.setdefault(row["unit"], []).extend(again)
        active = following
    return trees


def _level(
    cells: Dealt, units: Sequence[Unit], trees: Sequence[Tree], active: dict[int, list[int]], bins: Binning, seed: int,
) -> DataFrame:
    """The best split of every active node."""
    folds, features, groups = cells.folds, cells.features, cells.groups
    categorical = np.array([size > 0 for size in bins.arity])
    widest = max(len(at) + 1 for points in bins.points for at in points)
    widest = max(widest, *bins.arity)
    maps = np.zeros((folds + 1, features, max(bins.width(j) for j in range(features))), np.int64)
    for fit in range(folds + 1):
        for j in range(features):
            found = bins.map_of(fit, j)
            maps[fit, j, : len(found)] = found
    walks = {number: trees[number].walks() for number in active}
    drawn = {number: drawn_features(units[number], nodes, seed, features) for number, nodes in active.items()}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, group, codes, labels, counts in by_slot(batches, groups, features, folds):
            everything = counts.sum(1)
            for number in range(group, len(units), groups):
                if number not in active:
                    continue
                unit, nodes = units[number], active[number]
                known = everything - counts[:, unit.fit] if unit.fit < folds else everything
                weight = np.random.default_rng([seed, unit.fit, unit.tree, part, 0]).poisson(known)
                place = np.full(len(walks[number][0]), -1, np.int64)
                place[nodes] = np.arange(len(nodes))
                used = np.flatnonzero(weight)
                at = place[descend(walks[number], codes[used], categorical)]
                used, at = used[at >= 0], at[at >= 0]
                classes = bins.classes[unit.fit]
                for block in range(0, len(nodes), NODES_A_BLOCK):
                    here = (at >= block) & (at < block + NODES_A_BLOCK)
                    rows, slots = used[here], at[here] - block
                    own = drawn[number][block : block + NODES_A_BLOCK]
                    sums = np.zeros((len(own), unit.drawn, widest, classes))
                    for k in range(unit.drawn):
                        f = own[slots, k]
                        key = (slots * widest + maps[unit.fit, f, codes[rows, f]]) * classes + labels[rows]
                        sums[:, k] = np.bincount(key, weight[rows], len(own) * widest * classes).reshape(len(own), widest, classes)
                    yield pd.DataFrame({"unit": [number], "block": [block], "sums": [sums.tobytes()]})

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        number, block = int(frame["unit"].iloc[0]), int(frame["block"].iloc[0])
        unit, nodes = units[number], active[number][block : block + NODES_A_BLOCK]
        own = drawn[number][block : block + NODES_A_BLOCK]
        shape = (len(nodes), unit.drawn, widest, bins.classes[unit.fit])
        total = np.zeros(shape)
        for sums in frame["sums"]:
            total += np.frombuffer(sums).reshape(shape)
        found = best_splits(total, own, bins, unit.fit)
        return pd.DataFrame(
            [(number, node, *split) for node, split in zip(nodes, found, strict=True)],
            columns=["unit", "node", "feature", "cut", "mask", "gain", "total", "left", "right"])

    sums = cells.table.mapInPandas(count, "unit int, block int, sums binary")
    return sums.groupBy("unit", "block").applyInPandas(choose, CHOSEN)


def grid_pairs(
    cells: Dealt, forests: Sequence[Sequence[Sequence[int]]], depths: Sequence[int], units: Sequence[Unit],
    trees: Sequence[Tree], bins: Binning,
) -> DataFrame:
    """(point, fold, label, predicted, n): how the forests of each fold predict the rows left out.

    ``forests[point][fold]`` names the trees of a forest, ``depths[point]`` is where they are cut.
    """
    folds, features, groups = cells.folds, cells.features, cells.groups
    categorical = np.array([size > 0 for size in bins.arity])
    classes = max(bins.classes)
    used = {
        (number, depth): trees[number].leaves(depth)
        for forest, depth in zip(forests, depths, strict=True) for fold in forest for number in fold}
    walks = {key: trees[key[0]].walks(leaf) for key, leaf in used.items()}
    shares = {}
    for number in {number for number, _ in used}:
        stats = np.zeros((len(trees[number].stats), classes))
        stats[:, : bins.classes[units[number].fit]] = np.array(trees[number].stats)
        total = stats.sum(1, keepdims=True)
        shares[number] = np.divide(stats, total, out=np.zeros_like(stats), where=total > 0)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, group, codes, labels, counts in by_slot(batches, groups, features, folds):
            work = [(point, fold) for point in range(len(forests)) for fold in range(folds)]
            for point, fold in work[group::groups]:
                out = np.flatnonzero(counts[:, fold])
                votes = np.zeros((len(out), classes))
                for number in forests[point][fold]:
                    votes += shares[number][descend(walks[number, depths[point]], codes[out], categorical)]
                size = max(classes, int(labels.max(initial=0)) + 1)
                pairs = np.bincount(labels[out] * size + votes.argmax(1), counts[out, fold], size * size)
                seen = np.flatnonzero(pairs)
                yield pd.DataFrame({
                    "point": point, "fold": fold, "label": (seen // size).astype(float),
                    "predicted": (seen % size).astype(float), "n": pairs[seen].astype(np.int64)})

    return cells.table.mapInPandas(predict, "point int, fold int, label double, predicted double, n long")


# --- models ---------------------------------------------------------------------


def _nodes(tree: Tree, depth: int, bins: Binning, fit: int) -> list[tuple]:
    """The tree in the order and form in which MLlib saves it."""
    leaf, out = tree.leaves(depth), []

    def put(node: int) -> int:
        place = len(out)
        out.append(())
        stats = tree.stats[node]
        split, children = (-1, [], -1), (-1, -1)
        if not leaf[node]:
            children = put(tree.left[node]), put(tree.left[node] + 1)
            feature = tree.feature[node]
            size = bins.arity[feature]
            kept = [float(c) for c in range(size) if tree.mask[node] >> c & 1] if size else [float(bins.edges[feature][tree.cut[node]])]
            split = (feature, kept, size or -1)
        out[place] = (
            place, float(np.argmax(stats)), float(gini(stats)), stats.tolist(), int(stats.sum()),
            -1.0 if leaf[node] else float(tree.gain[node]), *children, split)
        return place

    put(0)
    return out


def forest_model(
    spark: SparkSession, estimator: RandomForestClassifier, trees: Sequence[Tree], depth: int, bins: Binning, fit: int,
) -> RandomForestClassificationModel:
    """The trees as a model of MLlib, by way of the form in which it saves models."""
    def described(kind: str, name: str, known: Callable[[str], bool], **more: int) -> str:
        params = [param for param in estimator.params if known(param.name)]
        return json.dumps({
            "class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version, "uid": f"{name}_{uuid.uuid4().hex[:12]}",
            "paramMap": {param.name: estimator.getOrDefault(param) for param in params if estimator.isSet(param)},
            "defaultParamMap": {param.name: estimator.getOrDefault(param) for param in params if estimator.hasDefault(param) and not estimator.isSet(param)},
            **more})

    single = DecisionTreeClassifier()
    whole = described(
        "RandomForestClassificationModel", "RandomForestClassifier", lambda name: True,
        numFeatures=len(bins.arity), numClasses=bins.classes[fit], numTrees=len(trees))
    each = [
        (number, described("DecisionTreeClassificationModel", "dtc", single.hasParam), 1.0) for number in range(len(trees))]
    nodes = [(number, node) for number, tree in enumerate(trees) for node in _nodes(tree, depth, bins, fit)]
    with temporary_workspace(spark, "forest") as path:
        write_text(spark, f"{path}/metadata/part-00000", whole + "\n")
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(nodes, f"treeID int, nodeData struct<{NODE}>").coalesce(1).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)
