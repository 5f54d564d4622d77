"""All jobs in a row, from CSV files to the dashboard views."""

from pathlib import Path

import pytest

from cellscope.plans import jobs, preprocess
from cellscope.registry.fixture import towers_raw
from cellscope.operators import reports, runs
from cellscope.sources import CLEAN_COLUMNS, read_clean, read_report, read_table, write_rows_csv, write_table
from cellscope.sources.workspace import shared_folder
from tests.conftest import TABLES


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    at = {name: str(root / name) for name in (
        "csv", "clean", "funnel", "reports", "zones", "zone_reports", "reliability",
        "reliability_reports", "classifier", "views", "kmeans", "gmm", "forest", "runs",
    )}
    write_rows_csv(towers_raw(spark, f"{TABLES}/sf0.001"), at["csv"])
    preprocess.preprocess_csv(spark, at["csv"], at["clean"], at["funnel"], ("Country",))
    jobs.run_reports(spark, at["clean"], at["reports"])
    for _ in range(2):  # the second run stands for a job that is tried again
        jobs.run_zones(
            spark, at["clean"], at["zones"], at["zone_reports"], at["kmeans"], at["runs"], (2, 3), buckets=4, run_id="7",
            partitions=4)
    jobs.run_reliability(
        spark, at["clean"], at["reliability"], at["reliability_reports"], at["gmm"], at["runs"], (2, 3), buckets=4, run_id="7",
        partitions=4)
    jobs.run_classifier(
        spark, at["zones"], at["reliability"], at["classifier"], at["forest"], at["runs"],
        trees=[4], depths=[4], folds=2, partitions=4,
    )
    jobs.run_views(
        spark, at["reports"], at["zone_reports"], at["reliability_reports"], at["classifier"], at["views"],
        zone_labels={0: "first", 1: "second", 2: "third"}, headings={"Country": "country"})
    return at


def test_jobs_leave_no_staged_tables(spark, done):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir()} if folder.exists() else set()
    assert not left & {"clean", "raw", "report-cells", "zone-cells", "reliability-cells", "joined", "pairs"}


def test_missing_reports_make_empty_views(spark, tmp_path):
    gone = str(tmp_path / "none")
    jobs.run_views(spark, gone, gone, gone, gone, str(tmp_path / "views"))
    for name in ("zone_tree", "operator_table", "confusion", "cross_table", "first_predictions"):
        assert read_report(spark, f"{tmp_path}/views/{name}").count() == 0


def test_labels_are_the_caller_s(spark, done, tmp_path):
    tree = read_report(spark, f"{done['views']}/zone_tree")
    assert {row.Cluster_Name for row in tree.filter("Cluster_Name is not null").collect()} <= {"first", "second", "third"}
    assert "country" in read_report(spark, f"{done['views']}/operator_table").columns
    jobs.run_slice(spark, done["reliability_reports"], str(tmp_path / "slice"), "Indonesia", 0)
    assert read_report(spark, str(tmp_path / "slice")).filter("Country != 'Indonesia' or gmm_cluster != 0").count() == 0
    profile = read_report(spark, f"{done['views']}/reliability_profile").first()
    assert profile.gmm_cluster_name == f"Cluster {profile.gmm_cluster}"


def test_views_read_the_predictions_once_for_all_evaluation(spark, done, plan):
    from cellscope.operators import classify

    scored = read_report(spark, f"{done['classifier']}/rf_prediction_output")
    pairs = classify.pair_counts(scored, "kmeans_target_cluster", "rf_predicted_cluster")
    assert sum(row.pairs for row in pairs.collect()) == scored.count()
    for function in (classify.classification_metrics, classify.classification_report, classify.crosstab_long, classify.class_distribution):
        rows = function(scored, "kmeans_target_cluster", "rf_predicted_cluster").collect()
        counted = function(pairs, "kmeans_target_cluster", "rf_predicted_cluster", classify.PAIR_WEIGHT).collect()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, counted))


def test_clean_table(spark, done):
    clean = read_clean(spark, done["clean"])
    assert set(clean.columns) == set(CLEAN_COLUMNS) and clean.count() == 717
    funnel = read_report(spark, done["funnel"]).orderBy("step_no").collect()
    assert funnel[0].rows == 1500 and funnel[-1].rows == 717


def test_metadata_survives_the_files(spark, done):
    assert read_clean(spark, done["clean"]).schema["radio_index"].metadata["ml_attr"]["type"] == "nominal"


@pytest.mark.parametrize("name, columns", [
    ("overall_radio_percentage", ["generasi", "count", "percentage"]),
    ("top3_operator_per_negara", ["Country", "Network", "tower_count", "rank"]),
    ("rasio_modernisasi_usia", ["Country", "total_towers", "modernization_percentage", "avg_data_age_days"]),
    ("sunburst_asean_operator", ["region", "Country", "Network", "tower_count", "percentage_share"]),
    ("pertumbuhan_tahunan", ["created_year", "count"]),
    ("top10_operator_asean", ["Network", "total_menara_asean", "Negara_Dominan"]),
])
def test_reports(spark, done, name, columns):
    report = read_report(spark, f"{done['reports']}/{name}")
    assert report.columns == columns and report.count() > 0


def test_zone_outputs(spark, done):
    assert read_table(spark, done["zones"]).columns[-1] == "prediction"
    stats = read_report(spark, f"{done['zone_reports']}/stats_utama")
    assert stats.columns == ["prediction", "avg_lat", "avg_lon", "avg_range_radius", "avg_sample_count", "total_tower"]
    assert stats.groupBy().sum("total_tower").first()[0] == 717
    assert read_report(spark, f"{done['zone_reports']}/sample_map_tower").count() == 717


def test_reliability_outputs(spark, done):
    assert read_table(spark, done["reliability"]).columns[-1] == "gmm_cluster"
    profile = read_report(spark, f"{done['reliability_reports']}/stats_utama_gmm")
    assert profile.columns == ["gmm_cluster", "avg_sam", "avg_days_old", "tower_count"]


def test_classifier_outputs(spark, done):
    cross = read_report(spark, f"{done['classifier']}/cross_profiling_output")
    assert cross.columns == ["prediction", "gmm_cluster", "tower_count", "avg_sam", "avg_days_old", "avg_range_radius"]
    scored = read_report(spark, f"{done['classifier']}/rf_prediction_output")
    assert scored.columns == [
        "index", "LAT", "LON", "Country", "Network", "radio", "generasi", "jangkauan", "RANGE", "SAM",
        "data_age_days", "kmeans_target_cluster", "gmm_cluster", "rf_predicted_cluster",
    ]
    assert 90 < scored.count() < 200


def test_run_table(spark, done):
    names = {row.run_name for row in spark.read.parquet(done["runs"]).select("run_name").distinct().collect()}
    assert names == {
        "KMeans_K_2", "KMeans_K_3", "Final_Best_KMeans", "GMM_K_2", "GMM_K_3", "Final_Best_GMM",
        "RF_TREES_4_DEPTH_4", "Final_Best_RF"}
    table = runs.read_runs(spark, done["runs"])
    assert table.columns == ["run_id", "experiment", "run_name", "kind", "key", "value"]
    assert table.filter("experiment = 'KMeans' AND run_id = '7'").count() == table.filter("experiment = 'KMeans'").count() == 9
    assert table.filter("experiment = 'GMM' AND run_id = '7'").count() == 12


def test_models_are_joined_without_a_shuffle(spark, done, plan):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = reports.join_models(read_table(spark, done["zones"]), read_table(spark, done["reliability"]))
        assert both.count() == 717 and "Exchange" not in plan(both)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_fold_scores(spark, done):
    scores = read_report(spark, f"{done['classifier']}/fold_scores")
    assert scores.columns == ["fold", "accuracy", "weighted_precision", "weighted_recall", "f1"] and scores.count() == 2


def test_reports_of_deliveries(spark, done, tmp_path):
    clean, cells = read_clean(spark, done["clean"]), str(tmp_path / "cells")
    for name, part in (("a", clean.filter("index % 2 = 0")), ("b", clean.filter("index % 2 = 1"))):
        write_table(part, str(tmp_path / name))
        jobs.run_reports(spark, str(tmp_path / name), str(tmp_path / "out"), cells, name)
    jobs.run_reports(spark, str(tmp_path / "b"), str(tmp_path / "out"), cells, "b")  # once more
    for name in ("overall_radio_percentage", "top10_operator_asean", "sunburst_asean_operator"):
        whole = read_report(spark, f"{done['reports']}/{name}")
        assert read_report(spark, f"{tmp_path}/out/{name}").exceptAll(whole).count() == 0
        assert whole.exceptAll(read_report(spark, f"{tmp_path}/out/{name}")).count() == 0
    with pytest.raises(ValueError, match="needs a name"):
        jobs.run_reports(spark, done["clean"], str(tmp_path / "out"), cells)


def test_views(spark, done):
    for name in (
        "operator_tree", "zone_tree", "country_reliability", "reliability_profile", "cross_heatmap",
        "classification_metrics", "classification_report", "confusion", "class_distribution",
        "zone_generations", "operator_table", "country_choices", "cluster_choices", "cross_table", "first_predictions",
    ):
        assert read_report(spark, f"{done['views']}/{name}").count() > 0, name


def test_command_line(spark, done, tmp_path):
    from cellscope.__main__ import main

    main(["reports", "--clean", done["clean"], "--root", str(tmp_path / "again")])
    again = read_report(spark, f"{tmp_path}/again/top10_operator_asean")
    assert again.exceptAll(read_report(spark, f"{done['reports']}/top10_operator_asean")).count() == 0
