"""The batch jobs that follow preprocessing.  Paths may be on any file system Spark reads."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.clustering import GaussianMixtureModel, KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    FOREST_DEPTH,
    FOREST_FEATURES,
    FOREST_FOLDS,
    FOREST_TREES,
    MAP_SAMPLE_ROWS,
    SEED,
    SWEEP_KS,
    TRAIN_TEST_WEIGHTS,
)
from ..operators import classify, reliability, reports, rollups, runs, zones
from ..operators.measures import CELL_WEIGHT, add_batch, stored_cells
from ..operators.sampling import CELL_IDENTITY, sample_n, split
from ..sources import (
    read_clean,
    read_report,
    read_table,
    staged_table,
    write_bucketed,
    write_report,
    write_rows_csv,
    write_table,
)
from ..sources.schemas import PREDICTION_COLUMNS, PREDICTION_SCHEMA, REPORT_SCHEMAS

Labels = Mapping[int, str] | None


def run_reports(
    spark: SparkSession, clean: str, root: str, cells: str | None = None, batch: str | None = None,
) -> None:
    """The six descriptive reports, from one scan of the clean table.

    With ``cells`` the towers in ``clean`` are one delivery, named ``batch``: its cells are put
    into that table and the reports are those of all deliveries in it.
    """
    made = reports.report_cells(read_clean(spark, clean))
    if cells:
        if not batch:
            raise ValueError("a delivery needs a name: give batch")
        add_batch(made, cells, batch)
        made = stored_cells(spark, cells, reports.REPORT_DIMENSIONS)
    with staged_table(made, "report-cells") as cells:
        for name, report in {
            "overall_radio_percentage": reports.category_share(cells, "generasi", weight=CELL_WEIGHT),
            "top3_operator_per_negara": reports.top_k_per_group(cells, "Country", "Network", 3, CELL_WEIGHT),
            "rasio_modernisasi_usia": reports.modernisation(cells, CELL_WEIGHT),
            "sunburst_asean_operator": reports.ownership_hierarchy(cells, weight=CELL_WEIGHT),
            "pertumbuhan_tahunan": reports.yearly_growth(cells, CELL_WEIGHT),
            "top10_operator_asean": reports.top_operators(cells, 10, CELL_WEIGHT),
        }.items():
            write_report(report, f"{root}/{name}")


def write_labelled(rows: DataFrame, path: str, buckets: int | None) -> None:
    """A model's output; in ``buckets`` by tower, if the classifier's join is to move no rows.

    Vectors are left out of buckets: nothing after the models reads them.
    """
    if buckets is None:
        write_table(rows, path)
    else:
        vectors = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "vector"]
        write_bucketed(rows.drop(*vectors), path, "index", buckets, F.xxhash64(*CELL_IDENTITY))


def zone_profiles(labelled: DataFrame, root: str) -> None:
    """The four cluster profiles, from one scan, and the map sample."""
    with staged_table(zones.profile_cells(labelled), "zone-cells") as cells:
        for name, report in {
            "stats_utama": zones.cluster_stats(cells, CELL_WEIGHT),
            "Hierarki-Cluster-Lengkap": zones.cluster_hierarchy(cells, CELL_WEIGHT),
            "Dominasi-teknologi": zones.cluster_mix(cells, "generasi", CELL_WEIGHT),
            "Dominasi-Wilayah": zones.cluster_mix(cells, "jangkauan", CELL_WEIGHT),
        }.items():
            write_report(report, f"{root}/{name}")
    chosen = sample_n(labelled, MAP_SAMPLE_ROWS)
    write_report(chosen.select("LAT", "LON", "prediction", "Country", "Network"), f"{root}/sample_map_tower")


def _new_run() -> str:
    return uuid.uuid4().hex


def run_zones(
    spark: SparkSession, clean: str, table: str, root: str,
    model: str | None = None, metrics: str | None = None, ks: Sequence[int] = SWEEP_KS,
    parallelism: int = 2, buckets: int | None = None, run_id: str | None = None, *, partitions: int,
) -> KMeansModel:
    """Choose k by silhouette, write the zone table, its profiles, model and metrics.

    A job that is run again under its ``run_id`` replaces its metrics.
    """
    towers = read_clean(spark, clean)
    sweep = zones.kmeans_sweep(towers, ks, partitions=partitions, parallelism=parallelism)
    write_labelled(sweep.best_model.transform(towers), table, buckets)
    zone_profiles(read_table(spark, table), root)
    if model:
        classify.save_model(sweep.best_model, model)
    if metrics:
        write_runs(sweep.metrics, "KMeans", ["silhouette_score", "wssse"], metrics, run_id)
    return sweep.best_model


def write_runs(sweep: DataFrame, experiment: str, scores: list[str], path: str, run_id: str | None = None) -> None:
    """Record the runs of a sweep and its final run, under a new run id unless one is given."""
    run_id = run_id or _new_run()
    table = runs.sweep_runs(sweep, experiment, scores, run_id)
    runs.record_runs(table.unionByName(runs.final_run(sweep, experiment, scores, run_id)), path)


def run_reliability(
    spark: SparkSession, clean: str, table: str, root: str,
    model: str | None = None, metrics: str | None = None, ks: Sequence[int] = SWEEP_KS,
    select_by: str = "log_likelihood", parallelism: int = 2, buckets: int | None = None, run_id: str | None = None,
    *, partitions: int,
) -> GaussianMixtureModel:
    """Choose the mixture, write the reliability table, its profiles, model and metrics."""
    towers = read_clean(spark, clean)
    sweep = reliability.gmm_sweep(towers, ks, select_by, partitions=partitions, parallelism=parallelism)
    write_labelled(sweep.best_model.transform(towers), table, buckets)
    with staged_table(reliability.reliability_cells(read_table(spark, table)), "reliability-cells") as cells:
        write_report(reliability.reliability_profile(cells, CELL_WEIGHT), f"{root}/stats_utama_gmm")
        write_report(reliability.operator_reliability(cells, CELL_WEIGHT), f"{root}/distribusi_keandalan_operator")
    if model:
        classify.save_model(sweep.best_model, model)
    if metrics:
        write_runs(sweep.metrics, "GMM", ["log_likelihood", "bic", "bic_full"], metrics, run_id)
    return sweep.best_model


def run_classifier(
    spark: SparkSession, zone_table: str, reliability_table: str, root: str,
    model: str | None = None, metrics: str | None = None,
    trees: Sequence[int] = (FOREST_TREES,), depths: Sequence[int] = (FOREST_DEPTH,),
    folds: int = FOREST_FOLDS, parallelism: int = 2, run_id: str | None = None, *, partitions: int,
) -> RandomForestClassificationModel:
    """Cross profile, cross-validated forest, the measures of its folds, test metrics and prediction export.

    The scored test rows are written once; the confusion matrix and all metrics
    follow from one count of their (true, predicted) pairs.
    """
    # only what the features, the export and the draws need goes through the join, no vectors
    needed = {"index", *FOREST_FEATURES, *PREDICTION_COLUMNS, *CELL_IDENTITY}
    zone_rows = read_table(spark, zone_table)
    zone_rows = zone_rows.select(*[name for name in zone_rows.columns if name in needed])
    both = reports.join_models(zone_rows, read_table(spark, reliability_table))
    with staged_table(both, "joined") as joined:
        write_report(classify.cross_profile(joined), f"{root}/cross_profiling_output")
        train, test = split(classify.rf_features(joined), TRAIN_TEST_WEIGHTS)
        fitted = classify.cross_validate(train, trees, depths, folds, parallelism=parallelism, partitions=partitions)
        write_report(fitted.fold_scores, f"{root}/fold_scores")
        # row-level: as many files as tasks
        write_rows_csv(
            classify.prediction_report(classify.score(fitted.model, test)), f"{root}/rf_prediction_output")
    scored = read_report(spark, f"{root}/rf_prediction_output", PREDICTION_SCHEMA)
    target, predicted, weight = "kmeans_target_cluster", "rf_predicted_cluster", classify.PAIR_WEIGHT
    # zones are whole numbers, forest predictions are doubles: compare as the latter
    scored = scored.withColumn(target, F.col(target).cast("double"))
    with staged_table(classify.pair_counts(scored, target, predicted), "pairs") as pairs:
        # the class columns are the zones the model was trained on
        classes = [float(number) for number in range(fitted.model.numClasses)]
        matrix = classify.confusion_matrix(pairs, target, predicted, classes, weight)
        write_report(matrix.withColumnRenamed(target, classify.LABEL), f"{root}/confusion_matrix")
        if metrics:
            run_id = run_id or _new_run()
            result = classify.classification_metrics(pairs, target, predicted, weight).first().asDict()
            final = runs.run_metrics(
                spark, "RF", f"{runs.FINAL}_RF",
                {
                    "best_numTrees": fitted.model.getNumTrees,
                    "best_maxDepth": fitted.model.getOrDefault("maxDepth"),
                    "features": list(FOREST_FEATURES),
                    "seed": SEED,
                },
                {name: value for name, value in result.items() if value is not None},
                run_id,
            )
            grid = runs.sweep_runs(fitted.scores, "RF", ["mean_f1", "std_f1"], run_id, ("trees", "depth"))
            runs.record_runs(grid.unionByName(final), metrics)
    if model:
        classify.save_model(fitted.model, model)
    return fitted.model


def run_views(
    spark: SparkSession, report_root: str, zone_root: str, reliability_root: str,
    classifier_root: str, out: str,
    zone_labels: Labels = None, reliability_labels: Labels = None, short_labels: Labels = None,
    headings: Mapping[str, str] | None = None,
) -> None:
    """The tables behind the dashboard pages, from the reports of the other jobs.

    Labels belong to one trained model and are given by the caller; without them
    clusters are named by their number.  ``headings`` renames columns of the two
    tables that are shown as they are.  A missing report makes empty views.
    """
    def report(root: str, name: str) -> DataFrame:
        return read_report(spark, f"{root}/{name}", T.StructType.fromDDL(REPORT_SCHEMAS[name]))

    ownership = report(report_root, "sunburst_asean_operator")
    hierarchy = report(zone_root, "Hierarki-Cluster-Lengkap")
    technology = report(zone_root, "Dominasi-teknologi")
    operators = report(reliability_root, "distribusi_keandalan_operator")
    profile = report(reliability_root, "stats_utama_gmm")
    cross = report(classifier_root, "cross_profiling_output")
    # row-level: the one scan for its first rows apart, all evaluation follows from the pair counts
    scored = read_report(spark, f"{classifier_root}/rf_prediction_output", PREDICTION_SCHEMA)
    target, predicted, weight = "kmeans_target_cluster", "rf_predicted_cluster", classify.PAIR_WEIGHT
    as_double = scored.withColumn(target, F.col(target).cast("double"))
    zone_names = rollups.named(hierarchy, "prediction", zone_labels, "Cluster_Name")
    vendors = rollups.named(operators, "gmm_cluster", reliability_labels, "gmm_cluster_name")

    def shown(table: DataFrame, order_by: Sequence[str]) -> DataFrame:
        titles = {name: (headings or {}).get(name, name) for name in table.columns}
        return rollups.display(table, titles, [titles[name] for name in order_by])

    with staged_table(classify.pair_counts(as_double, target, predicted), "pairs") as pairs:
        for name, view in {
            "operator_tree": rollups.rollup_tree(ownership, ["region", "Country", "Network"], "tower_count"),
            "zone_tree": rollups.rollup_tree(zone_names, ["Cluster_Name", "Country", "Network"], "count"),
            "zone_generations": reports.category_share(
                technology, "generasi", within=["prediction"], weight="count"),
            "country_reliability": rollups.country_reliability(operators, short_labels),
            "reliability_profile": rollups.named(
                rollups.named(profile, "gmm_cluster", reliability_labels, "gmm_cluster_name"),
                "gmm_cluster", short_labels, "gmm_cluster_short",
            ).orderBy("gmm_cluster"),
            "operator_table": shown(vendors, ["Country", "Network", "gmm_cluster"]),
            "country_choices": reports.distinct_values(operators, "Country"),
            "cluster_choices": reports.distinct_values(operators, "gmm_cluster"),
            "cross_table": shown(cross, ["prediction", "gmm_cluster"]),
            "cross_heatmap": rollups.heatmap(
                cross, ("prediction", "Cluster "), ("gmm_cluster", "GMM "), "tower_count"
            ),
            "first_predictions": rollups.first_rows(scored, ["index"], 100),
            "classification_metrics": classify.classification_metrics(pairs, target, predicted, weight),
            "classification_report": classify.classification_report(pairs, target, predicted, weight),
            "confusion": classify.crosstab_long(pairs, target, predicted, weight),
            "class_distribution": classify.class_distribution(pairs, target, predicted, weight),
        }.items():
            write_report(view, f"{out}/{name}")


def run_slice(
    spark: SparkSession, reliability_root: str, out: str, country: str | None = None, cluster: int | None = None,
) -> None:
    """The operator report of one country and/or cluster, as a filter on the page selects it."""
    name = "distribusi_keandalan_operator"
    operators = read_report(spark, f"{reliability_root}/{name}", T.StructType.fromDDL(REPORT_SCHEMAS[name]))
    write_report(rollups.slice_report(operators, country, cluster), out)
