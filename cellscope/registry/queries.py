"""One query per operator: (spark, folder of the given tables) -> DataFrame.

Every query derives the tower table from the whole given tables and applies one
operator.  Numbers are rounded here, not in the operators, so that the checking
SQL can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.clustering import GaussianMixtureModel, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import lookup
from ..operators import (
    classify,
    encoding,
    features,
    quality,
    reliability,
    reports,
    rollups,
    runs,
    sampling,
    zones,
)
from ..operators.measures import CELL_WEIGHT, add_batch, count_by, merged_cells, stored_cells, tower_cells
from ..operators.reliability import Component
from ..plans.jobs import write_runs
from ..plans.preprocess import preprocess, preprocess_csv
from ..sources import (
    new_workspace,
    preview,
    read_clean,
    read_report,
    read_table,
    read_towers_csv,
    row_counts,
    stage_table,
    temporary_workspace,
    write_bucketed,
    write_report,
    write_rows_csv,
    write_table,
)
from .fixture import (
    CENTERS,
    HEADINGS,
    MIXTURE,
    RELIABILITY_LABELS,
    SHORT_LABELS,
    ZONE_LABELS,
    table,
    towers_raw,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PARTITIONS = 8  # of the training rows; the given tables are small
POSITION = ("lon_s", "lat_s", "range_s")
RELIABILITY = ("sam_s", "age_s")
PARTS = [
    Component(weight, mean, ((var1, cov), (cov, var2)))
    for weight, mean, (var1, cov, var2) in MIXTURE
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- inputs ---------------------------------------------------------------------


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to ``places`` digits; floats to four digits as doubles."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            value = F.round(value, places)
        elif isinstance(f.dataType, T.FloatType):
            value = F.round(value.cast("double"), 4)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_towers(towers_raw(spark, sf))


def rich(spark: SparkSession, sf: str) -> DataFrame:
    return features.enrich(clean(spark, sf))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched towers as a written table, for operators that read them more than once."""
    return stage_table(rich(spark, sf), "towers")


def unit_space(df: DataFrame) -> DataFrame:
    """Enriched towers with their place in the two min-max spaces, as number columns."""
    columns = [*config.SPATIAL_COLUMNS, *config.RELIABILITY_COLUMNS]
    bounds = encoding.fit_encoding(df, [], columns).bounds
    return df.withColumns({
        name: encoding.scaled(df, source, bounds.get(source, (0.0, 0.0)))
        for name, source in zip([*POSITION, *RELIABILITY], columns, strict=True)
    })


def in_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Towers with the zone of the nearest fixed centre as ``prediction``."""
    return zones.assign_nearest(unit_space(staged(spark, sf)), POSITION, CENTERS)


def in_clusters(df: DataFrame) -> DataFrame:
    """Add the reliability cluster of the fixed mixture, without its probabilities."""
    names = [f"p{number}" for number in range(len(PARTS))]
    return reliability.gmm_responsibilities(df, RELIABILITY, PARTS).drop(*names)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return in_clusters(in_zones(spark, sf))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled towers with a second opinion: the nearest centre by position alone."""
    flat = [center[:2] for center in CENTERS]
    out = zones.assign_nearest(labelled(spark, sf), POSITION[:2], flat, "flat_zone")
    return out.withColumns({
        "target_label": F.col("prediction").cast("double"),
        "prediction_rf": F.col("flat_zone").cast("double"),
    })


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    """The feature vectors and label indexes of the clean towers."""
    return encoding.encode_towers(staged(spark, sf))


def forest_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Forest input: indexed towers with both labels."""
    rows = labelled(spark, sf)
    fitted = encoding.fit_encoding(rows, list(config.INDEXED_COLUMNS))
    return classify.rf_features(encoding.index_labels(rows, fitted, config.INDEXED_COLUMNS))


def elements(df: DataFrame, vector: str, prefix: str, size: int) -> list:
    values = vector_to_array(vector)
    return [values[place].alias(f"{prefix}{place}") for place in range(size)]


# --- sources and sinks ----------------------------------------------------------


def _dirty_csv(spark: SparkSession, sf: str) -> str:
    """Raw towers as CSV; in the rows of one radio a number column holds text."""
    path = new_workspace(spark, "towers-csv")
    text = F.when(F.col("radio") == "WIFI", F.lit("n/a")).otherwise(F.col("changeable").cast("string"))
    write_rows_csv(towers_raw(spark, sf).withColumn("changeable", text), path)
    return path


@query
def s1_csv_scan(spark, sf):
    rows = read_towers_csv(spark, _dirty_csv(spark, sf))
    # numbers that may be null go out as doubles: clients differ on null integers
    return rounded(rows.select(
        "index", "radio", "LON", "LAT", "RANGE", F.col("updated").cast("double"), "Country"
    ))


@query
def s1_csv_bad_rows(spark, sf):
    rows = read_towers_csv(spark, _dirty_csv(spark, sf), on_bad="keep")
    return rows.groupBy(F.col("_corrupt_record").isNotNull().alias("bad")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def _in_quarantine(spark: SparkSession, sf: str) -> tuple[str, str, str]:
    """(clean table, funnel, quarantine) of the dirty file, which is parsed once for all three."""
    paths = tuple(new_workspace(spark, name) for name in ("clean", "funnel", "quarantine"))
    preprocess_csv(spark, _dirty_csv(spark, sf), paths[0], paths[1], quarantine=paths[2])
    return paths


@query
def s1_quarantine_funnel(spark, sf):
    """The funnel with a step for malformed rows, and the rows that were written on either side."""
    clean_path, funnel, aside = _in_quarantine(spark, sf)
    steps = read_report(spark, funnel, T.StructType.fromDDL("step_no int, step string, rows long"))
    written = [
        spark.read.parquet(path).agg(F.lit(number).alias("step_no"), F.lit(name).alias("step"), F.count(F.lit(1)).alias("rows"))
        for number, name, path in ((8, "written", clean_path), (9, "quarantined", aside))]
    return steps.unionByName(written[0]).unionByName(written[1])


@query
def s1_quarantined_rows(spark, sf):
    """The malformed rows as they stand in the file: their first fields and their number of fields."""
    fields = F.split("row", ",")
    rows = spark.read.parquet(_in_quarantine(spark, sf)[2])
    return rows.select(fields[0].cast("long").alias("index"), fields[1].alias("radio"), F.size(fields).alias("fields"))


@query
def s2_parquet_scan(spark, sf):
    path = new_workspace(spark, "clean")
    write_table(clean(spark, sf), path)
    return rounded(read_clean(spark, path).select("index", "radio", "LON", "LAT", "Network"))


@query
def s3_parquet_sink(spark, sf):
    path = new_workspace(spark, "clean-by-country")
    write_table(clean(spark, sf), path, partition_by=["Country"])
    rows = read_clean(spark, path)
    return rows.groupBy("Country").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("RANGE").alias("range_sum")
    )


@query
def s4_report_sink(spark, sf):
    path = new_workspace(spark, "report")
    write_report(reports.ownership_hierarchy(clean(spark, sf)), path)
    schema = "region string, Country string, Network string, tower_count long, percentage_share double"
    return rounded(spark.read.schema(schema).option("header", True).csv(path))


@query
def s5_report_read(spark, sf):
    path = new_workspace(spark, "report")
    write_report(reports.top_k_per_group(clean(spark, sf), "Country", "Network"), path)
    return read_report(spark, path).select(
        "Country", "Network", F.col("tower_count").cast("long"), F.col("rank").cast("int")
    )


@query
def s6_preview(spark, sf):
    return rounded(preview(clean(spark, sf), 20, ["index"]).select("index", "radio", "LON", "LAT", "Country"))


@query
def s6_row_counts(spark, sf):
    return row_counts(towers_raw(spark, sf), ["radio", "SAM", "updated"])


# --- filters --------------------------------------------------------------------


def _place(df: DataFrame) -> DataFrame:
    return rounded(df.select("index", "radio", "LON", "LAT", "Country", "Network"))


@query
def f1_filter_in(spark, sf):
    return _place(quality.filter_in(towers_raw(spark, sf), "Country", config.SE_ASIA))


@query
def f2_drop_columns(spark, sf):
    rows = quality.drop_columns(towers_raw(spark, sf), config.UNUSED_COLUMNS)
    return rounded(rows.withColumns({name: F.col(name).cast("double") for name in ("SAM", "updated")}))


@query
def f3_drop_nulls(spark, sf):
    return _place(quality.drop_nulls(towers_raw(spark, sf), config.CRITICAL_COLUMNS))


@query
def f4_filter_nonzero(spark, sf):
    return _place(quality.filter_nonzero(towers_raw(spark, sf), config.NONZERO_COLUMNS))


@query
def f5_filter_matches(spark, sf):
    return _place(quality.filter_matches(towers_raw(spark, sf), config.NAME_PATTERNS))


@query
def f6_filter_decimals(spark, sf):
    return _place(quality.filter_decimals(towers_raw(spark, sf), ["LON", "LAT"], config.MIN_DECIMALS))


@query
def f7_filter_bbox(spark, sf):
    return _place(quality.filter_bbox(towers_raw(spark, sf), config.BOUNDING_BOX))


@query
def f8_filter_ordered(spark, sf):
    return _place(quality.filter_ordered(towers_raw(spark, sf), "created", "updated"))


@query
def f9_filter_radio(spark, sf):
    return _place(quality.filter_in(towers_raw(spark, sf), "radio", config.RADIOS))


@query
def f10_quality_funnel(spark, sf):
    return quality.quality_funnel(towers_raw(spark, sf))


@query
def f10_funnel_of_staged_rows(spark, sf):
    return quality.quality_funnel(stage_table(towers_raw(spark, sf), "raw"))


@query
def f11_clean_towers(spark, sf):
    return rounded(clean(spark, sf))


@query
def f12_project(spark, sf):
    return quality.project(
        clean(spark, sf),
        {"index": "tower_id", "radio": "technology", "RANGE": "radius_m", "SAM": "samples"},
        {"RANGE": "double", "SAM": "long"},
    )


@query
def f13_constant_column(spark, sf):
    return clean(spark, sf).select(F.lit(config.REGION_NAME).alias("region"), "index", "Country")


# --- scalar features ------------------------------------------------------------


@query
def e1_data_age(spark, sf):
    return rounded(features.with_data_age(clean(spark, sf)).select("index", "updated", "data_age_days"))


@query
def e2_years(spark, sf):
    return features.with_years(clean(spark, sf)).select("index", "created_year", "updated_year")


@query
def e3_generation(spark, sf):
    return features.with_generation(towers_raw(spark, sf)).select("index", "radio", "generasi")


@query
def e4_coverage(spark, sf):
    return features.with_coverage(clean(spark, sf)).select("index", "RANGE", "jangkauan")


@query
def e5_reliability(spark, sf):
    return features.with_reliability(clean(spark, sf)).select("index", "SAM", "keandalan_data")


@query
def e6_display_coords(spark, sf):
    return rounded(features.with_display_coords(clean(spark, sf)).select("index", "LON_VIS", "LAT_VIS"))


@query
def e7_enrich(spark, sf):
    return rounded(rich(spark, sf))


# --- encoding -------------------------------------------------------------------


@query
def x1_frequency_index(spark, sf):
    rows = staged(spark, sf)
    fitted = encoding.fit_encoding(rows, list(config.INDEXED_COLUMNS))
    return encoding.index_labels(rows, fitted, config.INDEXED_COLUMNS).select(
        "index", *config.INDEXED_COLUMNS.values()
    )


@query
def x2_assemble(spark, sf):
    rows = encoding.assemble(clean(spark, sf), config.SPATIAL_COLUMNS, "v")
    return rounded(rows.select("index", *elements(rows, "v", "v", 3)), 4)


@query
def x3_assemble_skip(spark, sf):
    rows = encoding.assemble(towers_raw(spark, sf), ["SAM", "updated"], "v", on_invalid="skip")
    return rounded(rows.select("index", *elements(rows, "v", "v", 2)))


@query
def x4_minmax(spark, sf):
    rows = encoding.minmax(staged(spark, sf), ["MCC", "RANGE", "CID"], "v")
    return rounded(rows.select("index", *elements(rows, "v", "v", 3)))


@query
def x5_feature_vectors(spark, sf):
    rows = encoding.reliability_features(encoding.spatial_features(staged(spark, sf)))
    return rounded(rows.select(
        "index", *elements(rows, "prediction_features", "s", 3), *elements(rows, "reliability_metrics", "r", 2)
    ))


@query
def x5_identity_features(spark, sf):
    rows = encoding.identity_features(staged(spark, sf))
    return rounded(rows.select("index", *elements(rows, "mcc_mnc_scaled", "i", 3)))


@query
def x6_preprocess(spark, sf):
    rows = preprocess(stage_table(towers_raw(spark, sf), "raw"))
    vectors = [
        *elements(rows, "features_spatial", "spatial_", 3),
        *elements(rows, "prediction_features", "predict_", 3),
        *elements(rows, "reliability_metrics", "reliable_", 2),
    ]
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() != "vectorudt"]
    return rounded(rows.select(*plain, *vectors))


# --- descriptive reports --------------------------------------------------------


@query
def a1_category_share(spark, sf):
    return rounded(reports.category_share(rich(spark, sf), "generasi"))


@query
def a2_count_by(spark, sf):
    return count_by(clean(spark, sf), ["Country", "Network"], "tower_count")


@query
def a3_top_k_per_group(spark, sf):
    return reports.top_k_per_group(clean(spark, sf), "Country", "Network", 3)


@query
def a4_modernisation(spark, sf):
    return rounded(reports.modernisation(rich(spark, sf)))


@query
def a5_ownership_hierarchy(spark, sf):
    return rounded(reports.ownership_hierarchy(clean(spark, sf)))


@query
def a6_yearly_growth(spark, sf):
    return reports.yearly_growth(rich(spark, sf))


@query
def a7_dominant_value(spark, sf):
    return reports.dominant_value(clean(spark, sf), "Network", "Country")


@query
def a8_top_operators(spark, sf):
    return reports.top_operators(clean(spark, sf), 10)


@query
def a9_distinct_values(spark, sf):
    return reports.distinct_values(in_zones(spark, sf), "prediction")


@query
def a10_join_models(spark, sf):
    towers = unit_space(staged(spark, sf))
    kept = ["index", "Country", "SAM", "prediction"]
    zone_table = zones.assign_nearest(towers, POSITION, CENTERS).select(*kept)
    return reports.join_models(zone_table, in_clusters(towers)).select(*kept, "gmm_cluster")


@query
def a10_join_bucketed(spark, sf):
    """The same join from tables in buckets by tower: neither side is shuffled."""
    towers = unit_space(staged(spark, sf))
    kept = ["index", "Country", "SAM", "prediction"]
    paths = [new_workspace(spark, name) for name in ("zones-by-tower", "clusters-by-tower")]
    write_bucketed(zones.assign_nearest(towers, POSITION, CENTERS).select(*kept), paths[0], "index", PARTITIONS)
    write_bucketed(in_clusters(towers).select("index", "gmm_cluster"), paths[1], "index", PARTITIONS)
    return reports.join_models(*(read_table(spark, path) for path in paths)).select(*kept, "gmm_cluster")


def _six_reports(cells: DataFrame) -> DataFrame:
    """(report, item, value) of all six reports."""
    made = {
        "share": (reports.category_share(cells, "generasi", weight=CELL_WEIGHT), ["generasi"], "percentage"),
        "top": (reports.top_k_per_group(cells, "Country", "Network", 3, CELL_WEIGHT), ["Country", "Network"], "rank"),
        "modernisation": (reports.modernisation(cells, CELL_WEIGHT), ["Country"], "modernization_percentage"),
        "ownership": (
            reports.ownership_hierarchy(cells, weight=CELL_WEIGHT), ["Country", "Network"], "percentage_share"),
        "growth": (reports.yearly_growth(cells, CELL_WEIGHT), ["created_year"], "count"),
        "operators": (
            reports.top_operators(cells, 10, CELL_WEIGHT), ["Network", "Negara_Dominan"], "total_menara_asean"),
    }
    return rounded(reduce(DataFrame.unionByName, [
        report.select(
            F.lit(name).alias("report"), F.concat_ws("|", *[F.col(key).cast("string") for key in keys]).alias("item"),
            F.col(value).cast("double").alias("value"))
        for name, (report, keys, value) in made.items()
    ]))


@query
def a_reports_from_cells(spark, sf):
    """All six reports from one pre-aggregated table."""
    return _six_reports(stage_table(reports.report_cells(rich(spark, sf)), "report-cells"))


def _in_batches(spark: SparkSession, sf: str, cells: Callable[[DataFrame], DataFrame]) -> str:
    """Cells of the towers in three deliveries, the second of which is processed twice."""
    path, rows = new_workspace(spark, "cell-batches"), staged(spark, sf)
    for batch in (0, 1, 1, 2):
        add_batch(cells(rows.filter(F.col("index") % 3 == batch)), path, f"delivery-{batch}")
    return path


@query
def a_reports_from_batches(spark, sf):
    """All six reports from the stored cells of three deliveries."""
    path = _in_batches(spark, sf, reports.report_cells)
    return _six_reports(stage_table(stored_cells(spark, path, reports.REPORT_DIMENSIONS), "report-cells"))


@query
def k_profiles_from_batches(spark, sf):
    """The profile of each zone and the bounds of its towers, from the stored cells of three deliveries."""
    path = new_workspace(spark, "zone-batches")
    rows = zones.assign_nearest(unit_space(staged(spark, sf)), POSITION, CENTERS)
    for batch in (0, 1, 1, 2):
        part = rows.filter(F.col("index") % 3 == batch)
        add_batch(tower_cells(part, ["prediction", "Country"], zones.PROFILE_MEASURES, ["RANGE", "SAM"]), path, str(batch))
    cells = stage_table(stored_cells(spark, path, ["prediction", "Country"]), "zone-cells")
    bounds = merged_cells(cells, ["prediction"]).select("prediction", "RANGE_min", "RANGE_max", "SAM_min", "SAM_max")
    return rounded(zones.cluster_stats(cells, CELL_WEIGHT).join(bounds, "prediction"), 4)


# --- zones ----------------------------------------------------------------------


def _trained_zones(spark: SparkSession, sf: str):
    """A trained model, the towers with its zones, and those of the nearest centres."""
    rows = encoded(spark, sf)
    model = zones.fit_zones(rows, 5, partitions=PARTITIONS)
    scored = model.transform(rows)
    scored = scored.select("index", "Country", "prediction", *elements(scored, "prediction_features", "f", 3))
    return model, zones.assign_nearest(scored, ["f0", "f1", "f2"], model.clusterCenters(), "nearest", "distance")


@query
def k1_kmeans_zones(spark, sf):
    """Every tower is in the zone of its nearest centre."""
    _, rows = _trained_zones(spark, sf)
    return rows.select("index", "Country", (F.col("prediction") == F.col("nearest")).alias("in_nearest_zone"))


@query
def k1_zone_check(spark, sf):
    """The trained zones are all in use and cost no more than the fixed centres."""
    _, rows = _trained_zones(spark, sf)
    fixed = zones.assign_nearest(rows, ["f0", "f1", "f2"], CENTERS, "other", "other_distance")
    return fixed.agg(
        F.count(F.lit(1)).alias("towers"),
        F.count_if(~F.col("prediction").between(0, 4)).alias("out_of_range"),
        F.count_if(F.col("prediction") != F.col("nearest")).alias("not_nearest"),
        F.count_distinct("prediction").alias("zones"),
        (F.sum("distance") <= F.sum("other_distance")).alias("better_than_fixed"),
    )


def _first_best(metrics: DataFrame, score: str) -> DataFrame:
    """Whether exactly the first largest score is marked, on every row."""
    top = metrics.agg(F.max(F.struct(F.col(score), -F.col("k"))).alias("top")).select(-F.col("top.col2"))
    best = metrics.withColumn("__right", F.col("is_best") == (F.col("k") == top.scalar()))
    return best.withColumn("first_best_is_marked", F.col("__right")).drop("__right")


def _near(value, expected):
    """Equal but for the order of a sum."""
    return F.abs(value - expected) <= 1e-9 * F.greatest(F.abs(expected), F.lit(1.0))


@query
def k2_kmeans_sweep(spark, sf):
    """The sweep over all k: its marks, ranges, sample, and each model's cost and silhouette by K4 and K3."""
    rows = encoded(spark, sf)
    sweep = zones.kmeans_sweep(rows, partitions=PARTITIONS)
    drawn = rows.filter(sampling.row_draw(rows, "sample") < F.lit(config.SILHOUETTE_SAMPLE))
    sample = stage_table(drawn.select("prediction_features"), "sample")
    points = rows.select(*elements(rows, "prediction_features", "f", 3))
    costs = points.agg(*(
        F.sum(F.least(*zones.squared_distances(["f0", "f1", "f2"], model.clusterCenters()))).alias(str(k))
        for k, model in sweep.models.items())).first().asDict()
    costs = {int(k): cost for k, cost in costs.items()}
    scores = {k: zones.silhouette_score(model.transform(sample)) for k, model in sweep.models.items()}
    return _first_best(sweep.metrics, "silhouette_score").select(
        "k", F.lit(sample.count()).cast("long").alias("sample_rows"),
        F.col("silhouette_score").between(-1, 1).alias("in_range"), "first_best_is_marked",
        _near(F.col("wssse"), lookup(F.col("k"), costs)).alias("cost_follows"),
        _near(F.col("silhouette_score"), lookup(F.col("k"), scores)).alias("silhouette_follows"),
    )


@query
def k3_silhouette(spark, sf):
    rows = encoding.assemble(in_zones(spark, sf), POSITION, "position")
    return rounded(zones.silhouette(rows, "position"))


@query
def k3_silhouette_embeddings(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("embedding"), "label"
    )
    return rounded(zones.silhouette(rows, "embedding", "label"))


@query
def k4_wssse(spark, sf):
    return rounded(zones.wssse(unit_space(staged(spark, sf)), POSITION, CENTERS))


@query
def k5_assign_nearest(spark, sf):
    rows = zones.assign_nearest(
        unit_space(staged(spark, sf)), POSITION, CENTERS, distance="squared_distance"
    )
    return rounded(rows.select("index", "prediction", "squared_distance"))


@query
def k6_lloyd_step(spark, sf):
    return rounded(zones.lloyd_step(unit_space(staged(spark, sf)), POSITION, CENTERS))


@query
def k7_cluster_sizes(spark, sf):
    return zones.cluster_sizes(in_zones(spark, sf))


@query
def k8_cluster_stats(spark, sf):
    return rounded(zones.cluster_stats(in_zones(spark, sf)), 4)


@query
def k9_cluster_hierarchy(spark, sf):
    return zones.cluster_hierarchy(in_zones(spark, sf))


@query
def k10_cluster_generations(spark, sf):
    return zones.cluster_mix(in_zones(spark, sf), "generasi")


@query
def k11_cluster_coverage(spark, sf):
    return zones.cluster_mix(in_zones(spark, sf), "jangkauan")


@query
def k12_sample_rows(spark, sf):
    return sampling.sample_rows(clean(spark, sf), config.SILHOUETTE_SAMPLE).select("index", "Country")


@query
def k13_sample_n(spark, sf):
    chosen = sampling.sample_n(in_zones(spark, sf))
    return rounded(chosen.select("LAT", "LON", "prediction", "Country", "Network"))


@query
def k13_exact_sample(spark, sf):
    """A sample of a size that the small tables have too."""
    return sampling.sample_n(clean(spark, sf), 500).select("index", "Country")


# --- reliability ----------------------------------------------------------------


def _fixed_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Log-likelihood of the first 2..5 fixed Gaussians, in one scan: (k, log_likelihood, n)."""
    rows = unit_space(staged(spark, sf))
    fits = []
    for k in config.SWEEP_KS:
        total = sum(part.weight for part in PARTS[:k])
        some = [Component(p.weight / total, p.mean, p.covariance) for p in PARTS[:k]]
        fits.append(F.sum(reliability.mixture_log_density(RELIABILITY, some)).alias(f"fit_{k}"))
    cells = ", ".join(f"{k}, fit_{k}" for k in config.SWEEP_KS)
    return rows.agg(F.count(F.lit(1)).alias("n"), *fits).selectExpr(
        "n", f"stack({len(config.SWEEP_KS)}, {cells}) AS (k, log_likelihood)"
    )


def _memberships(spark: SparkSession, sf: str) -> DataFrame:
    rows = reliability.gmm_reliability(encoded(spark, sf), len(PARTS), partitions=PARTITIONS)
    total = F.aggregate("p", F.lit(0.0), lambda total, share: total + share)
    return rows.select("index", "gmm_cluster", vector_to_array("probability").alias("p")).select(
        "index", (F.abs(total - 1) <= 1e-9).alias("one_in_all"),
        (F.get("p", F.col("gmm_cluster")) >= F.array_max("p")).alias("label_is_largest"))


@query
def g1_gmm_reliability(spark, sf):
    """Memberships sum to 1 and the label is the largest of them, tower by tower."""
    return _memberships(spark, sf)


@query
def g1_membership_check(spark, sf):
    return _memberships(spark, sf).agg(
        F.count(F.lit(1)).alias("towers"),
        F.count_if(~F.col("one_in_all")).alias("not_one"),
        F.count_if(~F.col("label_is_largest")).alias("not_largest"),
    )


@query
def g2_gmm_sweep(spark, sf):
    """The sweep over all k: its marks, its criteria, and each model's fitness by G3."""
    rows = encoded(spark, sf)
    sweep = reliability.gmm_sweep(rows, partitions=PARTITIONS)
    points = rows.select(*elements(rows, "reliability_metrics", "f", 2))
    fitness = points.agg(F.count(F.lit(1)).alias("n"), *(
        F.sum(reliability.mixture_log_density(["f0", "f1"], reliability.model_components(model))).alias(str(k))
        for k, model in sweep.models.items())).first().asDict()
    n = fitness.pop("n")
    fitness = {int(k): value for k, value in fitness.items()}
    k, size, value = F.col("k"), F.log(F.lit(float(n))), F.col("log_likelihood")
    return _first_best(sweep.metrics, "log_likelihood").select(
        "k", F.lit(n).cast("long").alias("n"), "first_best_is_marked",
        _near(value, lookup(k, fitness)).alias("fitness_follows"),
        (_near(F.col("bic"), (3 * k - 1) * size - 2 * value)
         & _near(F.col("bic_full"), (6 * k - 1) * size - 2 * value)).alias("criteria_follow"),
    )


@query
def g3_log_likelihood(spark, sf):
    rows = unit_space(staged(spark, sf))
    return rounded(reliability.log_likelihood(rows, RELIABILITY, PARTS), 4)


@query
def g4_bic(spark, sf):
    return rounded(reliability.with_criteria(_fixed_sweep(spark, sf), len(RELIABILITY)), 4)


@query
def g5_responsibilities(spark, sf):
    rows = reliability.gmm_responsibilities(unit_space(staged(spark, sf)), RELIABILITY, PARTS)
    return rounded(rows.select("index", "p0", "p1", "p2", "p3", "p4", "gmm_cluster"))


@query
def g6_sweep_summary(spark, sf):
    return rounded(reliability.sweep_summary(_fixed_sweep(spark, sf)), 4)


@query
def g7_reliability_profile(spark, sf):
    return rounded(reliability.reliability_profile(labelled(spark, sf)))


@query
def g8_operator_reliability(spark, sf):
    return reliability.operator_reliability(labelled(spark, sf))


# --- classification -------------------------------------------------------------


@query
def r1_cross_profile(spark, sf):
    return rounded(classify.cross_profile(labelled(spark, sf)))


@query
def r2_rf_features(spark, sf):
    rows = forest_rows(spark, sf)
    return rounded(rows.select("index", *elements(rows, "rf_features", "f", 7), "target_label"))


@query
def r3_split(spark, sf):
    train, test = sampling.split(clean(spark, sf), config.TRAIN_TEST_WEIGHTS)
    named = [
        part.select("index", F.lit(name).alias("part"))
        for name, part in (("train", train), ("test", test))
    ]
    return named[0].unionByName(named[1])


@query
def r4_fit_forest(spark, sf):
    """The forest at its full size: trees, depth, features and importances."""
    train, _ = sampling.split(forest_rows(spark, sf), config.TRAIN_TEST_WEIGHTS)
    model = classify.fit_forest(train, partitions=PARTITIONS)
    weights = model.featureImportances.toArray()
    deepest = max(tree.depth for tree in model.trees)
    return train.agg(F.count(F.lit(1)).alias("training_rows")).select(
        F.lit(model.getNumTrees).alias("trees"), F.lit(model.numFeatures).alias("features"),
        F.lit(0 < deepest <= config.FOREST_DEPTH).alias("depth_fits"),
        F.lit(bool(weights.min() >= 0 and abs(weights.sum() - 1) < 1e-9)).alias("importances_fit"),
        "training_rows",
    )


@query
def r5_cross_validate(spark, sf):
    """Rows per fold, whether a fold's measures are those of its rows by R7, and the grid's mean that of the folds.

    The mean F1 has to beat naming the largest class everywhere.
    """
    train, _ = sampling.split(forest_rows(spark, sf), config.TRAIN_TEST_WEIGHTS)
    fitted = classify.cross_validate(train, partitions=PARTITIONS)
    mean_f1 = fitted.scores.first()["mean_f1"]
    by_fold = {row["fold"]: row for row in fitted.fold_scores.collect()}
    measures = ("accuracy", "weighted_precision", "weighted_recall", "f1")
    alike = {}
    for fold, row in by_fold.items():
        own = classify.classification_metrics(fitted.out_of_fold.filter(F.col("fold") == fold)).first()
        alike[fold] = all(abs(row[name] - own[name]) < 1e-9 for name in measures)
    mean_follows = abs(mean_f1 - sum(row["f1"] for row in by_fold.values()) / len(by_fold)) < 1e-9
    largest = train.groupBy("target_label").count().agg((F.max("count") / F.sum("count")).alias("share"))
    share = largest.first()["share"]
    folds = fitted.out_of_fold.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    return folds.withColumns({
        "fold_follows": lookup(F.col("fold"), alike), "mean_follows": F.lit(mean_follows),
        "above_majority": F.lit(mean_f1 > share * 2 * share / (1 + share))})


@query
def r6_score(spark, sf):
    """Class probabilities sum to 1 and the prediction is the largest, tower by tower."""
    train, test = sampling.split(forest_rows(spark, sf), config.TRAIN_TEST_WEIGHTS)
    scored = classify.score(classify.fit_forest(train, partitions=PARTITIONS), test)
    total = F.aggregate("p", F.lit(0.0), lambda total, share: total + share)
    return scored.select("index", "target_label", "prediction_rf", vector_to_array("probability").alias("p")).select(
        "index", "target_label", (F.abs(total - 1) <= 1e-9).alias("one_in_all"),
        (F.get("p", F.col("prediction_rf").cast("int")) >= F.array_max("p")).alias("largest_is_predicted"),
    )


@query
def r7_classification_metrics(spark, sf):
    return rounded(classify.classification_metrics(classified(spark, sf)))


@query
def r7_label_metrics(spark, sf):
    return rounded(classify.classification_metrics(table(spark, sf, "labels"), "quality", "toxic"))


@query
def r8_confusion_matrix(spark, sf):
    classes = [float(number) for number in range(len(CENTERS))]
    return classify.confusion_matrix(classified(spark, sf), values=classes)


@query
def r9_prediction_report(spark, sf):
    return rounded(classify.prediction_report(classified(spark, sf)))


@query
def r10_model_reload(spark, sf):
    """A forest and both clusterings read back from their folders score as before."""
    rows = encoded(spark, sf)
    train, test = sampling.split(forest_rows(spark, sf), config.TRAIN_TEST_WEIGHTS)

    def reloaded(kind: type, model):
        with temporary_workspace(spark, "model") as path:
            classify.save_model(model, path)
            return classify.load_model(kind, path)

    def differing(kind: type, model, rows: DataFrame, output: str, features: str) -> DataFrame:
        first = classify.score(model, rows).select(features, F.col(output).alias("before"))
        both = classify.score(reloaded(kind, model), first)
        return both.agg(F.count_if(F.col("before") != F.col(output)).alias("n"))

    forest = classify.fit_forest(train, partitions=PARTITIONS)
    return test.agg(F.count(F.lit(1)).alias("towers")).select(
        "towers",
        differing(RandomForestClassificationModel, forest, test, "prediction_rf", "rf_features").scalar().alias("differing"),
        differing(KMeansModel, zones.fit_zones(rows, 5, partitions=PARTITIONS), rows.drop("prediction"), "prediction", "prediction_features")
        .scalar().alias("zones_differing"),
        differing(GaussianMixtureModel, reliability.fit_reliability(rows, 5, partitions=PARTITIONS), rows, "gmm_cluster", "reliability_metrics")
        .scalar().alias("clusters_differing"),
    )


# --- run metrics ----------------------------------------------------------------


def _run_table(spark: SparkSession, sf: str) -> DataFrame:
    """The runs of the fixed mixtures and their final run, as the jobs write them: the job is run twice."""
    path = new_workspace(spark, "runs")
    sweep = stage_table(reliability.sweep_summary(_fixed_sweep(spark, sf)), "sweep")
    for _ in range(2):
        write_runs(sweep, "GMM", ["log_likelihood"], path, "one")
    return runs.read_runs(spark, path)


@query
def m1_run_metrics(spark, sf):
    return rounded(_run_table(spark, sf).withColumn("value", F.col("value").cast("double")), 4)


@query
def m2_best_run(spark, sf):
    """Best of the fixed mixtures, from the table that also has their final run."""
    return rounded(runs.best_run(_run_table(spark, sf), "log_likelihood"), 4)


# --- dashboard views ------------------------------------------------------------


@query
def d1_operator_tree(spark, sf):
    report = reports.ownership_hierarchy(clean(spark, sf))
    return rollups.rollup_tree(report, ["region", "Country", "Network"], "tower_count")


@query
def d2_zone_tree(spark, sf):
    named = rollups.label_map(
        zones.cluster_hierarchy(in_zones(spark, sf)), "prediction", ZONE_LABELS, "Cluster_Name"
    )
    return rollups.rollup_tree(named, ["Cluster_Name", "Country", "Network"], "count")


@query
def d3_label_map(spark, sf):
    profile = reliability.reliability_profile(labelled(spark, sf))
    # one code is left out of the mapping: it gets no label
    short = {code: label for code, label in SHORT_LABELS.items() if code != 4}
    named = rollups.label_map(profile, "gmm_cluster", RELIABILITY_LABELS, "gmm_cluster_name")
    named = rollups.label_map(named, "gmm_cluster", short, "gmm_cluster_short")
    return named.select("gmm_cluster", "gmm_cluster_name", "gmm_cluster_short", "tower_count")


@query
def d4_country_reliability(spark, sf):
    return rollups.country_reliability(reliability.operator_reliability(labelled(spark, sf)), SHORT_LABELS)


@query
def d5_slice_all(spark, sf):
    return rollups.slice_report(reliability.operator_reliability(labelled(spark, sf)))


@query
def d5_slice_country(spark, sf):
    return rollups.slice_report(reliability.operator_reliability(labelled(spark, sf)), country="Indonesia")


@query
def d5_slice_both(spark, sf):
    return rollups.slice_report(reliability.operator_reliability(labelled(spark, sf)), "Thailand", 1)


@query
def d6_filter_choices(spark, sf):
    return reports.distinct_values(reliability.operator_reliability(labelled(spark, sf)), "Country")


@query
def d7_classification_report(spark, sf):
    return rounded(classify.classification_report(classified(spark, sf)))


@query
def d8_crosstab(spark, sf):
    return classify.crosstab_long(classified(spark, sf))


@query
def d9_class_distribution(spark, sf):
    return classify.class_distribution(classified(spark, sf))


@query
def d10_heatmap(spark, sf):
    return rollups.heatmap(
        classify.cross_profile(labelled(spark, sf)),
        ("prediction", "Cluster "), ("gmm_cluster", "GMM "), "tower_count",
    )


@query
def d11_first_rows(spark, sf):
    return rounded(rollups.first_rows(classify.prediction_report(classified(spark, sf)), ["index"], 100))


@query
def d12_share_within(spark, sf):
    return rounded(reports.category_share(in_zones(spark, sf), "generasi", within=["prediction"]))


@query
def d13_display(spark, sf):
    report = rollups.label_map(
        reliability.operator_reliability(labelled(spark, sf)),
        "gmm_cluster", RELIABILITY_LABELS, "gmm_cluster_name",
    )
    return rollups.display(report, HEADINGS, ["country", "operator", "cluster"])
