"""The forest grown from counted cells: cells, splits, and the trees against MLlib."""

import itertools

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cellscope.operators import classify, encoding, forest, sampling


def gain_of(left, right):
    """Gini gain by its definition, from lists of classes."""
    def gini(rows):
        return 1 - sum((rows.count(c) / len(rows)) ** 2 for c in set(rows))

    both = left + right
    return gini(both) - (len(left) * gini(left) + len(right) * gini(right)) / len(both)


@pytest.fixture(scope="module")
def noisy(spark):
    """3,000 rows of a number, a category of 3 and one of 8; the label follows from them and from chance."""
    rows = spark.range(3000).withColumnRenamed("id", "index").withColumns({
        "x": (F.col("index") * 37 % 1000).cast("double"), "few": F.concat(F.lit("f"), F.col("index") % 3),
        "many": F.concat(F.lit("m"), F.col("index") * 7 % 8)})
    chance = F.pmod(F.xxhash64("index"), F.lit(10))
    label = F.when(chance < 2, chance % 3).when(F.col("x") < 300, 0).when(F.col("many").isin("m1", "m4"), 1).otherwise(F.col("index") % 3)
    rows = rows.withColumn("target_label", label.cast("double"))
    fitted = encoding.fit_encoding(rows, ["few", "many"])
    indexed = encoding.index_labels(rows, fitted, {"few": "few_i", "many": "many_i"})
    return VectorAssembler(inputCols=["x", "few_i", "many_i"], outputCol="rf_features").transform(indexed).select(
        "index", "rf_features", "target_label").localCheckpoint()


def binned(df, folds):
    rows = sampling.with_fold(df, folds).withColumn("draw", forest.split_draw(df, "rf_features"))
    bins = forest.fit_binning(rows, "rf_features", "target_label", "draw", folds)
    return rows, bins


def test_training_costs_cells_not_rows(spark, noisy, monkeypatch):
    """Ten times the rows in the same bins are no more cells to train on."""
    dealt, deal = [], forest.deal_cells

    def noted(cells, *rest):
        dealt.append((cells.count(), cells.agg(F.expr("sum(n0 + n1)")).first()[0]))
        return deal(cells, *rest)

    monkeypatch.setattr(forest, "deal_cells", noted)
    again = spark.range(10).withColumnRenamed("id", "copy").crossJoin(noisy.filter("index < 300"))
    fitted = classify.cross_validate(again.withColumn("index", F.col("index") + F.col("copy") * 3000).drop("copy"), [3], [3], 2, partitions=2)
    assert dealt[0][1] == 3000 == fitted.out_of_fold.count() and dealt[0][0] <= 300


def test_cells_hold_every_row(noisy):
    rows, bins = binned(noisy, 3)
    assert bins.arity == [0, 3, 8] and bins.unordered[0] == [False, True, False]
    assert all(25 <= len(points[0]) <= 32 for points in bins.points)
    cells = forest.count_cells(rows, "rf_features", "target_label", bins, 3).toPandas()
    assert cells[["n0", "n1", "n2"]].sum().sum() == 3000
    at = cells.groupby("c0")[["n0", "n1", "n2"]].sum().sum(axis=1)
    values = np.array([row.rf_features[0] for row in noisy.collect()])
    wanted = np.bincount(np.searchsorted(bins.edges[0], values))  # a threshold belongs to its left
    assert at.to_dict() == {code: n for code, n in enumerate(wanted) if n}


def test_values_at_and_beyond_thresholds(spark):
    points = [(i, [float(i % 4)], float(i % 2)) for i in range(40)]
    points += [(40, [float("nan")], 0.0), (41, [float("inf")], 1.0), (42, [float("-inf")], 1.0)]
    df = spark.createDataFrame(points, "index long, v array<double>, target_label double")
    from pyspark.ml.functions import array_to_vector

    df = df.select("index", array_to_vector("v").alias("rf_features"), "target_label")
    rows, bins = binned(df, 2)
    assert bins.edges[0].tolist() == [0.5, 1.5, 2.5]
    cells = forest.count_cells(rows, "rf_features", "target_label", bins, 2).toPandas()
    sizes = cells.assign(n=cells.n0 + cells.n1).groupby("c0")["n"].sum().to_dict()
    assert sizes == {0: 11, 1: 10, 2: 10, 3: 12}


def test_split_points():
    assert forest.split_points(np.array([1.0, 2.0, 5.0]), np.ones(3), 31).tolist() == [1.5, 3.5]
    assert forest.split_points(np.array([4.0]), np.ones(1), 31).tolist() == []
    assert forest.split_points(np.arange(8.0), np.ones(8), 3).tolist() == [1.5, 3.5, 5.5]
    assert forest.split_points(np.arange(4.0), np.array([97.0, 1, 1, 1]), 2).tolist() == [0.5, 1.5]


def test_best_splits_by_brute_force():
    random = np.random.default_rng(1)
    none = np.array([])
    bins = forest.Binning([0, 4, 6], [np.arange(5) + 0.5, none, none], [[np.arange(5) + 0.5, none, none]], [3], [[False, True, False]])
    for _ in range(20):
        rows = [[int(random.integers(6)), int(random.integers(4)), int(random.integers(6)), int(random.integers(3))] for _ in range(25)]
        sums = np.zeros((1, 3, 6, 3))
        for *codes, label in rows:
            for f, code in enumerate(codes):
                sums[0, f, code, label] += 1
        tried = []
        for f, size in ((0, 6), (1, 4), (2, 6)):
            order = range(size)
            sets = [set(order[: i + 1]) for i in range(size - 1)]
            if f == 1:
                sets = [set(s) for k in range(1, size) for s in itertools.combinations(range(size), k)]
            if f == 2:  # by the impurity of a category, empty ones last
                tally = [sums[0, 2, c] for c in range(size)]
                order = sorted(range(size), key=lambda c: 1 - ((tally[c] / tally[c].sum()) ** 2).sum() if tally[c].sum() else 9)
                sets = [set(order[: i + 1]) for i in range(size - 1)]
            for inside in sets:
                left, right = [r[3] for r in rows if r[f] in inside], [r[3] for r in rows if r[f] not in inside]
                if left and right:
                    tried.append(gain_of(left, right))
        (f, cut, mask, gain, total, left, right), = forest.best_splits(sums, np.array([[0, 1, 2]]), bins, 0)
        assert gain == pytest.approx(max(tried))
        sides = [[r[3] for r in rows if ((mask >> r[f]) & 1 if bins.arity[f] else r[f] <= cut) == side] for side in (1, 0)]
        assert gain_of(*sides) == pytest.approx(gain)
        assert left.tolist() == np.bincount(sides[0], minlength=3).tolist()
        assert right.tolist() == np.bincount(sides[1], minlength=3).tolist() and total.sum() == 25


def test_forest_is_as_good_as_that_of_mllib(noisy):
    train, test = sampling.split(noisy, [0.7, 0.3])
    ours = classify.cross_validate(train, [20], [6], 3, partitions=4).model
    theirs = classify.fit_forest(train, 20, 6, partitions=4)
    score = {name: classify.classification_metrics(classify.score(model, test)).first() for name, model in (("ours", ours), ("theirs", theirs))}
    assert score["ours"].accuracy == pytest.approx(score["theirs"].accuracy, abs=0.04)
    assert score["ours"].f1 == pytest.approx(score["theirs"].f1, abs=0.04)
    assert np.abs(ours.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.1
    rows = train.count()
    drawn = [sum(tree._call_java("rootNode").impurityStats().stats()) for tree in ours.trees]
    assert len(set(drawn)) > 10 and np.mean(drawn) == pytest.approx(rows, rel=0.05)  # a bootstrap of all rows each
    for model in (ours, theirs):
        assert model.getMaxDepth() == 6 and model.getNumTrees == 20 and model.numClasses == 3 and model.numFeatures == 3
        assert max(tree.depth for tree in model.trees) <= 6 and model.getFeaturesCol() == "rf_features"


def test_cells_in_parts(noisy, monkeypatch):
    """Cells of several parts, any split of the input, a grid with single trees and roots alone."""
    monkeypatch.setattr(forest, "CELLS_A_PART", 100)
    monkeypatch.setattr(forest, "NODES_A_BLOCK", 2)
    grid = dict(trees=[1, 4], depths=[0, 3], folds=2)
    first = classify.cross_validate(noisy.repartition(5), **grid, partitions=3)
    assert [(row.trees, row.depth) for row in first.scores.collect()] == [(1, 0), (1, 3), (4, 0), (4, 3)]
    best = max(first.scores.collect(), key=lambda row: row.mean_f1)
    assert best.mean_f1 == pytest.approx(np.mean([row.f1 for row in first.fold_scores.collect()]), abs=1e-12)
    assert first.model.getNumTrees == best.trees and first.model.getMaxDepth() == best.depth
    again = classify.cross_validate(noisy.coalesce(1), **grid, partitions=8)
    assert again.out_of_fold.exceptAll(first.out_of_fold).count() == 0
    assert again.model.toDebugString.split("\n", 1)[1] == first.model.toDebugString.split("\n", 1)[1]


def test_what_cannot_be_trained(noisy):
    for label in (None, float("nan"), -1.0, 0.5):
        bad = noisy.withColumn("target_label", F.when(F.col("index") != 7, F.col("target_label")).otherwise(F.lit(label).cast("double")))
        with pytest.raises(ValueError, match="whole number"):
            classify.cross_validate(bad, [2], [2], 2, partitions=2)
    with pytest.raises(ValueError, match="is empty"):
        classify.cross_validate(noisy.limit(1), [2], [2], 2, partitions=2)
