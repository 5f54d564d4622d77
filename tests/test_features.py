import pytest
from pyspark.sql import functions as F

from cellscope import config
from cellscope.functions import lookup, ratio, unit_hash, utc_year
from cellscope.operators import encoding, features, sampling


def column(df, name):
    return [row[0] for row in df.orderBy("index").select(name).collect()]


def test_age_is_never_negative(towers):
    df = towers({"updated": 1715360400 - 86400}, {"updated": 1715360401}, {"updated": 1715360400 - 43200}, {"updated": None})
    assert column(features.with_data_age(df), "data_age_days") == [1.0, 0.0, 0.5, None]


def test_absurd_epochs_do_not_fail(towers):
    far = 2**63 - 1
    df = towers({"updated": far, "created": -far}, {"updated": -far - 1})
    out = features.with_years(features.with_data_age(df))
    assert column(out, "data_age_days")[0] == 0.0
    assert column(out, "updated_year") == [None, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Jakarta", "America/Los_Angeles"])
def test_years_do_not_follow_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moments = spark.createDataFrame([(1704067199,), (1704067200,), (-1,)], "at long")
        years = [row[0] for row in moments.orderBy("at").select(utc_year(F.col("at"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert years == [1969, 2023, 2024]


def test_generation_of_every_radio(towers):
    radios = ["GSM", "UMTS", "LTE", "NR", "CDMA", "WIFI", None]
    df = features.with_generation(towers(*[{"radio": radio} for radio in radios]))
    assert column(df, "generasi") == ["2G", "3G", "4G", "5G", "2G", None, None]


def test_coverage_limits(towers):
    df = features.with_coverage(towers(*[{"RANGE": r} for r in (999, 1000, 5000, 5001)]))
    assert column(df, "jangkauan") == ["Urban", "Suburban", "Suburban", "Rural"]


def test_reliability_limits(towers):
    df = features.with_reliability(towers(*[{"SAM": s} for s in (2, 3, 9, 10)]))
    assert column(df, "keandalan_data") == ["low", "medium", "medium", "high"]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int").select(ratio(F.col("a"), F.col("b")).alias("r"))
    assert {row.r for row in df.collect()} == {None, 0.25}


def test_lookup_of_unknown_key(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int").select(lookup(F.col("k"), {1: "one"}).alias("v"))
    assert sorted(str(row.v) for row in df.collect()) == ["None", "None", "one"]


# --- encoding -------------------------------------------------------------------


def test_label_ties_go_by_name(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "c", "a", "b", "d", None]], "label string")
    out = encoding.frequency_index(df, "label", "place")
    assert dict(out.distinct().collect()) == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}
    assert out.count() == 7


def test_index_equals_the_library_indexer(spark, towers):
    from pyspark.ml.feature import StringIndexer

    df = features.enrich(towers(*[{"radio": r} for r in ["LTE", "NR", "NR", "GSM", "LTE", "CDMA"]]))
    theirs = StringIndexer(inputCol="radio", outputCol="theirs", handleInvalid="skip").fit(df)
    both = theirs.transform(encoding.frequency_index(df, "radio", "ours"))
    assert both.filter("ours <> theirs").count() == 0


def test_index_columns_are_nominal(towers):
    df = encoding.frequency_index(towers({}, {"radio": "NR"}), "radio", "place")
    assert df.schema["place"].metadata["ml_attr"]["type"] == "nominal"


def test_any_number_of_labels(spark):
    df = spark.range(100_000).selectExpr("cast(id % 50000 as string) label", "cast(id % 3 as string) other")
    assert {k: len(v) for k, v in encoding.fit_encoding(df, ["label", "other"]).labels.items()} == {"label": 50_000, "other": 3}
    indexed = encoding.frequency_index(df, "label", "place")
    assert indexed.selectExpr("count(distinct place)", "min(place)", "max(place)").first()[:] == (50_000, 0.0, 49_999.0)


def test_minmax_equals_the_library_scaler(spark, towers):
    from pyspark.ml.feature import MinMaxScaler

    df = towers({"RANGE": 5}, {"RANGE": 900, "LON": 120.55}, {"RANGE": 455, "LAT": 3.33})
    rows = encoding.minmax(encoding.assemble(df, ["LON", "LAT", "RANGE"], "raw"), ["LON", "LAT", "RANGE"], "ours")
    rows = MinMaxScaler(inputCol="raw", outputCol="theirs").fit(rows).transform(rows)
    for row in rows.select("ours", "theirs").collect():
        assert row.ours.toArray() == pytest.approx(row.theirs.toArray(), abs=1e-12)


def test_constant_column_scales_to_half(towers):
    rows = encoding.minmax(towers({"RANGE": 7}, {"RANGE": 7}), ["RANGE"], "v").collect()
    assert [row.v[0] for row in rows] == [0.5, 0.5]


def test_null_unit_fails_or_is_skipped(towers):
    df = towers({}, {"unit": None, "MCC": 999}, {"unit": 3, "MCC": 520})
    with pytest.raises(Exception, match="null"):
        encoding.identity_features(df).collect()
    rows = encoding.identity_features(df, on_invalid="skip").collect()
    # the skipped row does not widen the bounds
    assert sorted(row.mcc_mnc_scaled[0] for row in rows) == [0.0, 1.0]


def test_one_scan_for_all_statistics(spark, towers):
    df = features.enrich(towers({}, {"radio": "NR", "RANGE": 10}, {"Country": "Laos", "SAM": 50}))
    fitted = encoding.fit_tower_encoding(df)
    assert fitted.labels["radio"] == ["LTE", "NR"]
    assert fitted.labels["Country"] == ["Indonesia", "Laos"]
    assert fitted.bounds["RANGE"] == (10.0, 1200.0) and fitted.bounds["SAM"] == (5.0, 50.0)


def test_preprocess_gives_the_clean_layout(towers):
    from cellscope.plans.preprocess import preprocess
    from cellscope.sources import CLEAN_COLUMNS

    out = preprocess(towers({}, {"Country": "Laos", "unit": None}, {"SAM": 0}))
    assert tuple(out.columns) == CLEAN_COLUMNS
    assert out.count() == 2
    types = dict(out.dtypes)
    assert types["LON"] == types["LON_VIS"] == "float" and types["created_year"] == "int"
    assert types["radio_index"] == "double" and types["features_spatial"] == "vector"


# --- samples --------------------------------------------------------------------


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "index")
    one, many = df.coalesce(1), df.repartition(13)
    for part in (lambda d: sampling.sample_rows(d, 0.1), lambda d: sampling.split(d, [0.8, 0.2])[1]):
        assert part(one).exceptAll(part(many)).count() == 0
        assert part(one).count() == part(many).count()
    assert 400 < sampling.sample_rows(df, 0.1).count() < 600


def test_split_holds_every_row_once(spark):
    df = spark.range(3000).withColumnRenamed("id", "index")
    parts = sampling.split(df, [3, 1, 1])
    assert sum(part.count() for part in parts) == 3000
    assert parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct().count() == 3000


def test_folds_are_independent_of_the_split(spark):
    train, _ = sampling.split(spark.range(5000).withColumnRenamed("id", "index"), [0.8, 0.2])
    sizes = {row.fold: row["count"] for row in sampling.with_fold(train, 5).groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4]
    assert min(sizes.values()) > 600


def test_rows_without_index_still_spread(towers):
    df = towers(*[{"index": None, "CID": cid} for cid in range(200)])
    train, test = sampling.split(df, [0.5, 0.5])
    assert train.count() + test.count() == 200
    assert 60 < train.count() < 140


def test_sample_larger_than_the_table(spark):
    df = spark.range(50).withColumnRenamed("id", "index")
    assert sampling.sample_n(df, 10_000).count() == 50
    assert sampling.sample_n(df.limit(0), 10).count() == 0
    assert sampling.sample_n(df, 0).count() == 0


@pytest.mark.parametrize("n", [1, 100, 2999])
@pytest.mark.parametrize("bins", [1, 64])
def test_sample_has_the_least_draws(spark, n, bins):
    df = spark.range(3000).withColumnRenamed("id", "index").repartition(5)
    draws = df.withColumn("draw", sampling.row_draw(df, "sample")).orderBy("draw").limit(n)
    got = sampling.sample_n(df, n, bins=bins)
    assert sorted(row["index"] for row in got.collect()) == sorted(row["index"] for row in draws.collect())


def test_sample_of_equal_keys_has_n_rows(spark):
    df = spark.range(90).select((F.col("id") % 3).alias("index"))
    for n in (1, 29, 30, 31, 60, 89):
        assert sampling.sample_n(df, n, bins=16).count() == n


def test_sample_does_not_sort_the_rows(spark, plan):
    df = spark.range(3000).withColumnRenamed("id", "index")
    assert "Sort" not in plan(sampling.sample_n(df, 100)) and "Exchange" not in plan(sampling.sample_n(df, 100))


def test_small_fractions_of_huge_tables_are_exact_enough(spark):
    draws = spark.range(20000).select(unit_hash(F.col("id"), "x").alias("u"))
    row = draws.agg(F.min("u").alias("low"), F.max("u").alias("high"), F.countDistinct("u").alias("n")).first()
    assert 0 <= row.low < 0.001 and 0.999 < row.high < 1 and row.n == 20000
