"""Table layouts.  Names, types and order are fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

TOWER_SCHEMA = T.StructType([
    T.StructField(name, kind, True)
    for name, kind in (
        ("index", T.LongType()),
        ("radio", T.StringType()),
        ("MCC", T.IntegerType()),
        ("MNC", T.IntegerType()),
        ("TAC", T.IntegerType()),
        ("CID", T.LongType()),
        ("unit", T.IntegerType()),
        ("LON", T.FloatType()),
        ("LAT", T.FloatType()),
        ("RANGE", T.IntegerType()),
        ("SAM", T.IntegerType()),
        ("changeable", T.IntegerType()),
        ("created", T.LongType()),
        ("updated", T.LongType()),
        ("averageSignal", T.IntegerType()),
        ("Country", T.StringType()),
        ("Network", T.StringType()),
        ("Continent", T.StringType()),
    )
])

CLEAN_COLUMNS = (
    "index", "MCC", "MNC", "TAC", "CID", "unit",
    "radio", "radio_index", "generasi", "generasi_index",
    "LON", "LAT", "LON_VIS", "LAT_VIS", "RANGE", "SAM",
    "created", "updated", "created_year", "updated_year", "data_age_days",
    "Country", "Network", "country_index", "jangkauan", "jangkauan_index",
    "features_spatial", "prediction_features", "reliability_metrics",
)

PREDICTION_COLUMNS = (
    "index", "LAT", "LON", "Country", "Network", "radio", "generasi",
    "jangkauan", "RANGE", "SAM", "data_age_days",
    "prediction", "gmm_cluster", "prediction_rf",
)
PREDICTION_RENAMES = {
    "prediction": "kmeans_target_cluster",
    "prediction_rf": "rf_predicted_cluster",
}

# The prediction export as it is read back.
PREDICTION_SCHEMA = T.StructType([
    T.StructField(PREDICTION_RENAMES.get(name, name), kind, True)
    for name, kind in zip(
        PREDICTION_COLUMNS,
        (
            T.LongType(), T.FloatType(), T.FloatType(), T.StringType(), T.StringType(), T.StringType(),
            T.StringType(), T.StringType(), T.IntegerType(), T.IntegerType(), T.DoubleType(),
            T.IntegerType(), T.DoubleType(), T.DoubleType(),
        ),
        strict=True,
    )
])

# The reports as they are read back.
REPORT_SCHEMAS = {
    "sunburst_asean_operator": "region string, Country string, Network string, tower_count long, percentage_share double",
    "Hierarki-Cluster-Lengkap": "prediction int, Country string, Network string, count long",
    "Dominasi-teknologi": "prediction int, generasi string, count long",
    "stats_utama_gmm": "gmm_cluster int, avg_sam double, avg_days_old double, tower_count long",
    "distribusi_keandalan_operator": "Country string, Network string, gmm_cluster int, tower_count long",
    "cross_profiling_output": "prediction int, gmm_cluster double, tower_count long, avg_sam double, "
                              "avg_days_old double, avg_range_radius double",
}
