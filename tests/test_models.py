import math

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cellscope.operators import classify, encoding, reliability, runs, sampling, zones


@pytest.fixture(scope="module")
def points(spark):
    """Three well separated groups of towers in the plane, 100 each."""
    df = spark.range(300).withColumnRenamed("id", "index")
    group = F.col("index") % 3
    step = F.floor(F.col("index") / 3)
    df = df.withColumns({
        "x": group * 0.4 + (step % 10) * 0.004,
        "y": F.when(group == 1, 0.9).otherwise(0.1) + F.floor(step / 10) * 0.004,
    })
    return encoding.assemble(df, ["x", "y"], "v").cache()


def elements(df, vector, *names):
    values = vector_to_array(vector)
    return df.withColumns({name: values[place] for place, name in enumerate(names)})


# --- K-Means --------------------------------------------------------------------


def test_zone_labels(points):
    out = zones.kmeans_zones(points, 3, "v", partitions=4)
    assert out.count() == 300 and dict(out.dtypes)["prediction"] == "int"
    sizes = [row["count"] for row in zones.cluster_sizes(out).collect()]
    assert sizes == [100, 100, 100]


def test_sweep_keeps_the_best_silhouette(points):
    sweep = zones.kmeans_sweep(points, [2, 3, 4], "v", fraction=1.0, partitions=4)
    assert sweep.best_k == 3 and len(sweep.best_model.clusterCenters()) == 3
    rows = sweep.metrics.orderBy("k").collect()
    assert [row.k for row in rows if row.is_best] == [3]
    assert rows[0].wssse > rows[1].wssse > 0


def test_fits_repeat_on_other_partitionings(points):
    costs = [
        zones.fit_zones(df, 4, "v", partitions=3).summary.trainingCost
        for df in (points.coalesce(1), points.repartition(9))
    ]
    assert costs[0] == pytest.approx(costs[1], rel=1e-12)


def test_training_cost_is_the_distance_to_the_centres(points):
    model = zones.fit_zones(points, 3, "v", partitions=4)
    cost = zones.wssse(points, ["x", "y"], model.clusterCenters()).first().wssse
    assert cost == pytest.approx(model.summary.trainingCost, rel=1e-5)
    ours = zones.assign_nearest(points, ["x", "y"], model.clusterCenters(), "ours")
    assert model.transform(ours).filter("ours <> prediction").count() == 0


def test_equal_distance_goes_to_the_lowest_centre(spark):
    df = spark.createDataFrame([(0.5,), (0.6,), (None,)], "x double")
    out = zones.assign_nearest(df, ["x"], [(0.0,), (1.0,)], distance="d")
    assert sorted(out.collect(), key=str) == sorted(
        [(0.5, 0, 0.25), (0.6, 1, pytest.approx(0.16)), (None, None, None)], key=str
    )


def test_lloyd_step_moves_centres_to_the_means(points):
    moved = zones.lloyd_step(points, ["x", "y"], [(0.0, 0.0), (0.4, 1.0), (0.9, 0.0)]).collect()
    assert [row.towers for row in moved] == [100, 100, 100]
    assert moved[1].x == pytest.approx(0.418) and moved[1].y == pytest.approx(0.918)


def brute_silhouette(rows):
    def sq(a, b):
        return sum((u - v) ** 2 for u, v in zip(a, b))

    clusters = {}
    for point, label in rows:
        clusters.setdefault(label, []).append(point)
    total = 0.0
    for point, label in rows:
        own = clusters[label]
        if len(own) == 1:
            continue
        a = sum(sq(point, q) for q in own) / (len(own) - 1)
        b = min(sum(sq(point, q) for q in other) / len(other) for name, other in clusters.items() if name != label)
        total += 0 if a == b else (b - a) / max(a, b)
    return total / len(rows)


def test_silhouette_against_all_pairs(points):
    df = points.withColumn("prediction", F.when(F.col("index") == 0, 3).otherwise((F.col("index") % 3).cast("int")))
    rows = [((row.x, row.y), row.prediction) for row in df.collect()]
    assert zones.silhouette(df, "v").first().silhouette == pytest.approx(brute_silhouette(rows), abs=1e-9)


def test_sweep_measures_are_those_of_the_returned_models(points):
    sweep = zones.kmeans_sweep(points, [2, 3, 5], "v", fraction=0.5, partitions=4)
    sample = points.filter(sampling.row_draw(points, "sample") < 0.5)
    for row in sweep.metrics.collect():
        model = sweep.models[row.k]
        cost = zones.wssse(points, ["x", "y"], model.clusterCenters()).first().wssse
        assert row.wssse == pytest.approx(cost, rel=1e-9)
        assert row.silhouette_score == pytest.approx(zones.silhouette_score(model.transform(sample), "v"), rel=1e-9)


def test_tallies_of_all_k_are_one_scan(points, plan):
    centers = {2: [(0.0, 0.0), (0.5, 0.5)], 3: [(0.0, 0.0), (0.4, 0.9), (0.8, 0.1)]}
    assert plan(zones.centre_tallies(points, "v", centers)).count("InMemoryTableScan\n") <= 1
    rows = zones.centre_tallies(points, "v", centers, F.col("index") < 0).collect()
    assert sum(row.towers for row in rows if row.k == 3) == 300 and {row.n for row in rows} == {0}
    with pytest.raises(ValueError, match="fewer than two clusters"):
        zones.centre_silhouettes(points, "v", centers, rows)


def test_silhouettes_of_several_centres_against_all_pairs(points):
    centers = {2: [(0.0, 0.1), (0.6, 0.5)], 4: [(0.0, 0.1), (0.4, 0.9), (0.8, 0.1), (9.0, 9.0)], 3: [(0.0, 0.1), (0.42, 0.92), (0.8, 0.12)]}
    some = points.filter("index % 7 < 2 OR index = 5")
    tallies = zones.centre_tallies(some, "v", centers).collect()
    got = zones.centre_silhouettes(some, "v", centers, tallies).first()
    for k, at in centers.items():
        rows = [((row.x, row.y), row.prediction) for row in zones.assign_nearest(some, ["x", "y"], at).collect()]
        assert got[f"k{k}"] == pytest.approx(brute_silhouette(rows), abs=1e-9), k


# --- mixture --------------------------------------------------------------------


def test_memberships(points):
    out = reliability.gmm_reliability(points, 3, "v", partitions=4)
    assert out.columns[-2:] == ["probability", "gmm_cluster"] and out.count() == 300
    for row in out.collect():
        assert sum(row.probability) == pytest.approx(1)
        assert row.gmm_cluster == max(range(3), key=lambda i: row.probability[i])


def test_expressions_equal_the_trained_model(points):
    model = reliability.fit_reliability(points, 3, "v", partitions=4)
    parts = reliability.model_components(model)
    ours = reliability.gmm_responsibilities(points, ["x", "y"], parts, prediction="ours")
    both = elements(model.transform(ours), "probability", "m0", "m1", "m2")
    assert both.filter("ours <> gmm_cluster").count() == 0
    assert both.filter("abs(p0 - m0) + abs(p1 - m1) + abs(p2 - m2) > 1e-6").count() == 0
    fitness = reliability.log_likelihood(points, ["x", "y"], parts).first().log_likelihood
    assert fitness == pytest.approx(model.summary.logLikelihood, rel=1e-2)


def test_density_of_a_standard_normal(spark):
    part = reliability.Component(1.0, (0.0, 0.0), ((1.0, 0.0), (0.0, 1.0)))
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0)], "a double, b double")
    got = reliability.log_likelihood(df, ["a", "b"], [part]).first().log_likelihood
    assert got == pytest.approx(-2 * math.log(2 * math.pi) - 2.5)


def test_far_away_rows_keep_a_label(spark):
    part = reliability.Component(0.5, (0.0, 0.0), ((1e-4, 0.0), (0.0, 1e-4)))
    far = reliability.Component(0.5, (0.1, 0.1), ((1e-4, 0.0), (0.0, 1e-4)))
    df = spark.createDataFrame([(50.0, 50.0), (None, 1.0)], "a double, b double")
    rows = reliability.gmm_responsibilities(df, ["a", "b"], [part, far]).orderBy(F.asc_nulls_last("a")).collect()
    assert (rows[0].p0, rows[0].p1, rows[0].gmm_cluster) == (0.5, 0.5, 0)
    assert rows[1].gmm_cluster is None


@pytest.mark.parametrize("rule", reliability.SELECT_BY)
def test_mixture_sweep(points, rule):
    sweep = reliability.gmm_sweep(points, [2, 3], rule, "v", partitions=4)
    rows = sweep.metrics.orderBy("k").collect()
    pick = max if rule == "log_likelihood" else min
    assert sweep.best_k == pick(rows, key=lambda row: row[rule]).k
    for row in rows:
        assert row.bic == pytest.approx((2 * row.k + row.k - 1) * math.log(300) - 2 * row.log_likelihood)
        assert row.bic_full == pytest.approx(row.bic + 3 * row.k * math.log(300))
    again = reliability.with_criteria(sweep.metrics.withColumn("n", F.lit(300)), 2).orderBy("k").collect()
    assert [row.bic for row in again] == pytest.approx([row.bic for row in rows])


def test_fitness_is_that_of_the_returned_models(points):
    sweep = reliability.gmm_sweep(points, [2, 4], "log_likelihood", "v", partitions=4)
    for row in sweep.metrics.collect():
        parts = reliability.model_components(sweep.models[row.k])
        again = reliability.log_likelihood(points, ["x", "y"], parts).first().log_likelihood
        assert row.log_likelihood == pytest.approx(again, rel=1e-9)


def test_fitness_of_all_mixtures_is_one_scan(points, plan):
    part = reliability.Component(1.0, (0.3, 0.4), ((0.1, 0.0), (0.0, 0.2)))
    fitness = reliability.mixture_fitness(points, "v", {1: [part], 2: [part, part]})
    assert plan(fitness).count("InMemoryTableScan\n") <= 1 and plan(fitness).count("Exchange\n") <= 1
    rows = {row.k: row for row in fitness.collect()}
    assert rows[2].log_likelihood == pytest.approx(rows[1].log_likelihood + 300 * math.log(2)) and rows[1].n == 300


def test_constant_column_has_a_density_along_the_other(spark):
    part = reliability.Component(1.0, (0.0, 5.0), ((2.0, 0.0), (0.0, 0.0)))
    df = spark.createDataFrame([(1.0, 5.0)], "a double, b double")
    got = reliability.log_likelihood(df, ["a", "b"], [part]).first().log_likelihood
    assert got == pytest.approx(-math.log(2 * math.pi) - 0.5 * math.log(2) - 0.25)
    with pytest.raises(ValueError, match="without any variance"):
        reliability.precision_of([[0.0, 0.0], [0.0, 0.0]])


def test_unknown_rule(points):
    with pytest.raises(ValueError):
        reliability.gmm_sweep(points, [2], "aic", "v", partitions=4)


def test_summary_marks_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(2, 1.0), (3, 5.0), (4, 5.0)], "k int, log_likelihood double")
    assert [row.k for row in reliability.sweep_summary(df).collect() if row.is_best] == [3]


# --- classification -------------------------------------------------------------


@pytest.fixture(scope="module")
def opinions(spark):
    """True and predicted classes; class 3 is never predicted, class 4 never true."""
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 4 + [(2, 0)] + [(2, 2)] * 3 + [(3, 1)] * 2 + [(0, 4)]
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "target_label double, prediction_rf double")


def test_metrics_equal_the_library_evaluator(opinions):
    ours = classify.classification_metrics(opinions).first()
    for mine, theirs in (
        ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
        ("weighted_recall", "weightedRecall"), ("f1", "f1"),
    ):
        tool = MulticlassClassificationEvaluator(
            labelCol="target_label", predictionCol="prediction_rf", metricName=theirs
        )
        assert ours[mine] == pytest.approx(tool.evaluate(opinions)), mine


def test_metrics_per_group(opinions):
    both = opinions.withColumn("fold", F.lit(0)).unionByName(opinions.filter("target_label < 2").withColumn("fold", F.lit(1)))
    rows = {row.fold: tuple(row)[1:] for row in classify.classification_metrics(both, by=["fold"]).collect()}
    assert rows[0] == pytest.approx(tuple(classify.classification_metrics(opinions).first()))
    assert rows[1] == pytest.approx(tuple(classify.classification_metrics(opinions.filter("target_label < 2")).first()))


def test_absent_classes_score_zero(opinions):
    rows = {row.label: row for row in classify.classification_report(opinions).collect()}
    assert set(rows) == {"0.0", "1.0", "2.0", "3.0", "4.0", "accuracy", "macro avg", "weighted avg"}
    assert rows["3.0"][1:] == (0.0, 0.0, 0.0, 2)
    assert rows["4.0"][1:] == (0.0, 0.0, 0.0, 0)
    assert rows["0.0"].recall == pytest.approx(5 / 8)
    assert rows["accuracy"].f1_score == pytest.approx(12 / 18) and rows["accuracy"].support == 18


def test_confusion_matrix(opinions):
    wide = classify.confusion_matrix(opinions, values=[0.0, 1.0, 2.0, 3.0, 4.0])
    assert wide.columns == ["target_label", "0.0", "1.0", "2.0", "3.0", "4.0"]
    assert [tuple(row) for row in wide.collect()][0] == (0.0, 5, 2, 0, 0, 1)
    found = classify.confusion_matrix(opinions)
    assert found.columns == ["target_label", "0.0", "1.0", "2.0", "4.0"]


def test_distribution_and_crosstab(opinions):
    got = {(row.source, row["class"]): row["count"] for row in classify.class_distribution(opinions).collect()}
    assert got[("target", 0.0)] == 8 and got[("predicted", 1.0)] == 8 and ("target", 4.0) not in got
    assert classify.crosstab_long(opinions).first()["count"] == 5


@pytest.fixture(scope="module")
def labelled(points):
    names = ["radio", "Country", "generasi", "jangkauan"]
    df = points.withColumn("prediction", (F.col("index") % 3).cast("int"))
    df = df.withColumns({
        "SAM": F.col("prediction") * 10 + F.lit(1), "data_age_days": F.col("y") * 100, "gmm_cluster": F.lit(1),
        **{f"{name}_s": F.concat(F.lit("v"), (F.col("index") % 5).cast("string")) for name in names},
    })
    fitted = encoding.fit_encoding(df, [f"{name}_s" for name in names])
    outputs = dict(zip([f"{n}_s" for n in names], ["radio_index", "country_index", "generasi_index", "jangkauan_index"]))
    return encoding.index_labels(df, fitted, outputs).cache()


def test_features_skip_nulls_and_know_categories(labelled):
    holes = labelled.withColumn("SAM", F.when(F.col("index") > 9, F.col("SAM")))
    out = classify.rf_features(holes)
    assert out.count() == 290
    nominal = out.schema["rf_features"].metadata["ml_attr"]["attrs"]["nominal"]
    assert [attr["name"] for attr in nominal] == ["radio_index", "country_index", "generasi_index", "jangkauan_index"]


def test_forest_round_trip(labelled, tmp_path):
    train, test = sampling.split(classify.rf_features(labelled), [0.8, 0.2])
    fitted = classify.cross_validate(train, [5], [2, 4], folds=3, partitions=4)
    scores = fitted.scores.collect()
    assert [(row.trees, row.depth) for row in scores] == [(5, 2), (5, 4)]
    assert all(row.mean_f1 > 0.95 for row in scores)
    assert fitted.out_of_fold.count() == train.count() == fitted.out_of_fold.select("index").distinct().count()
    by_fold = fitted.fold_scores.collect()
    assert [row.fold for row in by_fold] == [0, 1, 2]
    assert max(row.mean_f1 for row in scores) == pytest.approx(sum(row.f1 for row in by_fold) / 3)
    for row in by_fold:
        own = classify.classification_metrics(fitted.out_of_fold.filter(F.col("fold") == row.fold)).first()
        assert tuple(row)[1:] == pytest.approx(tuple(own))
    out = classify.score(fitted.model, test)
    assert {"rawPrediction", "probability", "prediction_rf"} <= set(out.columns)
    assert out.filter("prediction_rf <> target_label").count() == 0
    classify.save_model(fitted.model, str(tmp_path / "m"))
    again = classify.load_model(RandomForestClassificationModel, str(tmp_path / "m"))
    assert again.getNumTrees == 5
    assert classify.score(again, out).filter("prediction_rf <> target_label").count() == 0


# --- runs -----------------------------------------------------------------------


def test_best_run(spark, points):
    sweep = zones.kmeans_sweep(points, [2, 3], "v", fraction=1.0, partitions=4)
    table = runs.sweep_runs(sweep.metrics, "KMeans", ["silhouette_score", "wssse"])
    table = table.unionByName(runs.run_metrics(spark, "RF", "RF_CV", {"trees": 5}, {"f1": 0.5}))
    assert table.count() == 2 * 3 + 2
    assert runs.best_run(table, "silhouette_score").first().run_name == "KMeans_K_3"
    assert runs.best_run(table, "wssse", largest=False).first().run_name == "KMeans_K_3"
    assert tuple(runs.best_run(table, "f1").first()) == ("", "RF", "RF_CV", 0.5)
    table = table.unionByName(runs.final_run(sweep.metrics, "KMeans", ["silhouette_score", "wssse"]))
    assert [row.experiment for row in runs.best_run(table, "wssse", largest=False).collect()] == ["KMeans"]
    other = runs.sweep_runs(sweep.metrics, "KMeans", ["wssse"], run_id="later")
    assert {row.run_id for row in runs.best_run(table.unionByName(other), "wssse").collect()} == {"", "later"}
