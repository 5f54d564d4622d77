import pytest
from pyspark.sql import functions as F

from cellscope.operators import features, reports, rollups, zones
from cellscope.operators.measures import CELL_WEIGHT, with_group_total


@pytest.fixture
def some(towers):
    rows = [
        {"Country": country, "Network": network, "radio": radio, "created": created}
        for country, network, radio, created, n in [
            ("Indonesia", "A", "LTE", 1500000000, 4),
            ("Indonesia", "B", "GSM", 1500000000, 2),
            ("Indonesia", "C", "NR", 1550000000, 2),
            ("Indonesia", "D", "UMTS", 1550000000, 1),
            ("Laos", "B", "GSM", 1500000000, 2),
            ("Laos", "A", "CDMA", 1600000000, 1),
        ]
        for _ in range(n)
    ]
    return features.enrich(towers(*rows))


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_share_of_generations(some):
    got = rows(reports.category_share(some, "generasi"))
    assert [(g, n) for g, n, _ in got] == [("2G", 5), ("4G", 4), ("5G", 2), ("3G", 1)]
    assert sum(p for *_, p in got) == pytest.approx(100)


def test_share_within_a_group(some):
    got = rows(reports.category_share(some, "Network", within=["Country"]))
    assert got[0] == ("Indonesia", "A", 4, pytest.approx(400 / 9))
    assert [row[:3] for row in got[-2:]] == [("Laos", "B", 2), ("Laos", "A", 1)]


def test_top_three_breaks_ties_by_name(some):
    got = rows(reports.top_k_per_group(some, "Country", "Network", 3))
    assert got == [
        ("Indonesia", "A", 4, 1), ("Indonesia", "B", 2, 2), ("Indonesia", "C", 2, 3),
        ("Laos", "B", 2, 1), ("Laos", "A", 1, 2),
    ]


def test_top_k_is_limited_before_the_shuffle(some, plan):
    assert "WindowGroupLimit" in plan(reports.top_k_per_group(some, "Country", "Network", 3))


def test_modernisation(some):
    got = {row.Country: row for row in reports.modernisation(some).collect()}
    assert got["Indonesia"].total_towers == 9
    assert got["Indonesia"].modernization_percentage == pytest.approx(600 / 9)
    assert got["Laos"].modernization_percentage == 0


def test_dominant_value_keeps_ties(some):
    got = rows(reports.dominant_value(some, "Network", "Country"))
    assert sorted(got) == [
        ("A", "Indonesia", 4), ("B", "Indonesia", 2), ("B", "Laos", 2), ("C", "Indonesia", 2), ("D", "Indonesia", 1),
    ]


def test_a_tied_operator_takes_two_places(some):
    assert rows(reports.top_operators(some, 3)) == [
        ("A", 5, "Indonesia"), ("B", 4, "Indonesia"), ("B", 4, "Laos"),
    ]


@pytest.mark.parametrize("report", [
    lambda df, w: reports.category_share(df, "generasi", weight=w),
    lambda df, w: reports.top_k_per_group(df, "Country", "Network", 3, w),
    lambda df, w: reports.modernisation(df, w),
    lambda df, w: reports.ownership_hierarchy(df, weight=w),
    lambda df, w: reports.yearly_growth(df, w),
    lambda df, w: reports.top_operators(df, 10, w),
    lambda df, w: reports.dominant_value(df, "Network", "Country", w),
])
def test_cells_give_the_same_reports(some, report):
    direct, from_cells = rows(report(some, None)), rows(report(reports.report_cells(some), CELL_WEIGHT))
    assert len(direct) == len(from_cells)
    for one, two in zip(direct, from_cells):
        assert one == pytest.approx(two)


def test_cells_skip_unfilled_measures(towers):
    df = features.enrich(towers({"updated": 1715360400 - 86400}, {"updated": None}))
    for table, weight in ((df, None), (reports.report_cells(df), CELL_WEIGHT)):
        assert reports.modernisation(table, weight).first().avg_data_age_days == 1.0


def test_group_total_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", 4)], "g string, v int")
    got = {(row.g, row.v): row.total for row in with_group_total(df, ["g"], "v", "total").collect()}
    assert got == {(None, 1): 3, (None, 2): 3, ("x", 4): 4}


def test_towers_are_scanned_once_for_a_share(some, spark, tmp_path):
    some.write.parquet(str(tmp_path / "t"))
    df = reports.ownership_hierarchy(spark.read.parquet(str(tmp_path / "t")))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_joined_models_drop_null_and_multiply_duplicate_keys(towers):
    zone = towers({"index": 1}, {"index": 2}, {"index": None}, {"index": 5}, numbered=False)
    zone = zone.withColumn("prediction", F.lit(0))
    other = towers({"index": 1}, {"index": 1}, {"index": None}, {"index": 2}, numbered=False)
    joined = reports.join_models(zone, other.withColumn("gmm_cluster", F.lit(3)))
    assert sorted(row["index"] for row in joined.collect()) == [1, 1, 2]
    assert joined.columns == [*zone.columns, "gmm_cluster"]


# --- views ----------------------------------------------------------------------


def test_tree_has_every_level(some):
    got = rows(rollups.rollup_tree(reports.ownership_hierarchy(some), ["region", "Country", "Network"], "tower_count"))
    assert got[0] == ("Asia Tenggara", None, None, 1, 12)
    assert got[1:3] == [("Asia Tenggara", "Indonesia", None, 2, 9), ("Asia Tenggara", "Laos", None, 2, 3)]
    assert len(got) == 1 + 2 + 6


def test_tree_tells_null_keys_from_totals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2)], "p string, q string, v int")
    got = sorted(rows(rollups.rollup_tree(df, ["p", "q"], "v")), key=str)
    assert got == [("a", "x", 2, 2), ("a", None, 1, 3), ("a", None, 2, 1)]


def test_slices(spark):
    df = spark.createDataFrame([("Laos", 1), ("Laos", 2), ("Brunei", 1)], "Country string, gmm_cluster int")
    assert rollups.slice_report(df).count() == 3
    assert rollups.slice_report(df, "Laos").count() == 2
    assert rollups.slice_report(df, cluster=1).count() == 2
    assert rollups.slice_report(df, "Laos", 0).count() == 0


def test_unmapped_code_has_no_label(spark):
    df = rollups.label_map(spark.createDataFrame([(0,), (9,)], "c int"), "c", {0: "zero"}, "name")
    assert dict(df.collect()) == {0: "zero", 9: None}


def test_heatmap_labels(spark):
    df = spark.createDataFrame([(0, 1, 5), (0, 1, 2)], "prediction int, gmm_cluster int, n int")
    got = rollups.heatmap(df, ("prediction", "Cluster "), ("gmm_cluster", "GMM "), "n")
    assert rows(got) == [("Cluster 0", "GMM 1", 7)]


def test_display(spark):
    df = rollups.display(spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string"), {"v": "Label (x)", "k": "Klaster"}, ["Klaster"])
    assert df.columns == ["Label (x)", "Klaster"] and rows(df) == [("a", 1), ("b", 2)]


def test_profiles_from_cells(some):
    labelled = some.withColumn("prediction", (F.col("index") % 2).cast("int"))
    cells = zones.profile_cells(labelled)
    for report in (
        zones.cluster_stats, zones.cluster_sizes, zones.cluster_hierarchy,
        lambda df, weight=None: zones.cluster_mix(df, "jangkauan", weight),
    ):
        for one, two in zip(rows(report(labelled)), rows(report(cells, weight=CELL_WEIGHT)), strict=True):
            assert one == pytest.approx(two)
