"""Tables that outlive a job: buckets, cells of deliveries, quarantine."""

import glob

import pytest
from pyspark.sql import functions as F

from cellscope.operators import measures, reports
from cellscope.plans import preprocess
from cellscope.sources import TOWER_SCHEMA, read_clean, read_report, read_table, write_bucketed, write_table
from tests.test_sources import HEADER, ROWS


@pytest.fixture
def sorted_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def model_tables(spark):
    """Zones and clusters with null and repeated keys."""
    keys = [None, None, *range(50), 7, 7]
    zones = spark.createDataFrame([(k, f"z{i}") for i, k in enumerate(keys)], "index long, prediction string")
    clusters = spark.createDataFrame([(k, i) for i, k in enumerate([None, *range(30, 80), 30])], "index long, gmm_cluster int")
    return zones, clusters


def test_bucketed_join_moves_nothing(spark, tmp_path, plan, sorted_joins):
    zones, clusters = model_tables(spark)
    for name, df in (("zones", zones), ("clusters", clusters)):
        write_bucketed(df, str(tmp_path / name), "index", 4)
    stored = [read_table(spark, str(tmp_path / name)) for name in ("zones", "clusters")]
    joined, plain = reports.join_models(*stored), reports.join_models(zones, clusters)
    assert "Exchange" not in plan(joined) and "Exchange" in plan(plain)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect())) != []
    assert stored[0].count() == zones.count()
    assert all(row.n == 1 for row in stored[0].filter("index = 3").groupBy("index").agg(F.count("*").alias("n")).collect())


def test_one_file_per_bucket_and_rows_without_key_spread(spark, tmp_path):
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("index"), F.col("id").alias("cell")).repartition(6)
    write_bucketed(df, str(tmp_path / "spread"), "index", 4, F.xxhash64("cell"))
    back = read_table(spark, str(tmp_path / "spread"))
    assert back.count() == 4000 and back.filter("index IS NULL").count() == 2000
    sizes = spark.read.parquet(str(tmp_path / "spread")).groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("all"), F.count_if(F.col("index").isNull()).alias("without")).collect()
    assert max(row.without for row in sizes) < 1000  # not all in the hands of one task
    buckets = [name.rsplit("_", 1)[1] for name in glob.glob(str(tmp_path / "spread" / "part-*"))]
    assert len(set(buckets)) == 4 and len(buckets) <= 4 + 4


def test_buckets_can_be_written_over(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(spark.range(10).withColumnRenamed("id", "index"), path, "index", 4)
    write_bucketed(spark.range(5).withColumnRenamed("id", "index").withColumn("x", F.lit("a")), path, "index", 2)
    back = read_table(spark, path)
    assert back.columns == ["index", "x"] and back.count() == 5
    assert spark.catalog.listTables() is not None
    write_table(spark.range(3), str(tmp_path / "plain"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 3


def test_empty_table_in_buckets(spark, tmp_path):
    write_bucketed(spark.range(0).withColumnRenamed("id", "index"), str(tmp_path / "none"), "index", 3)
    assert read_table(spark, str(tmp_path / "none")).count() == 0


# --- cells ----------------------------------------------------------------------


def test_cells_of_deliveries_are_those_of_all(spark, tmp_path):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 2).alias("x"))
    cells = lambda part: measures.tower_cells(part, ["g"], ["x"], ["x"])
    path = str(tmp_path / "cells")
    for batch in (0, 1, 2, 1):
        measures.add_batch(cells(df.filter(F.col("id") % 3 == batch)), path, f"b{batch}")
    merged = measures.stored_cells(spark, path, ["g"])
    assert sorted(map(str, merged.select(*cells(df).columns).collect())) == sorted(map(str, cells(df).collect()))
    # a delivery that is delivered again with fewer rows
    measures.add_batch(cells(df.filter("id = 2")), path, "b2")
    total = measures.stored_cells(spark, path, ["g"]).agg(F.sum("towers")).first()[0]
    assert total == df.filter("id % 3 < 2 OR id = 2").count()


def test_only_the_new_delivery_is_scanned(spark, tmp_path, plan):
    path = str(tmp_path / "cells")
    for name in ("a", "b"):
        write_table(spark.range(10).withColumn("g", F.lit(name)), str(tmp_path / name))
        measures.add_batch(measures.tower_cells(read_clean(spark, str(tmp_path / name)), ["g"]), path, name)
    text = plan(measures.stored_cells(spark, path, ["g"]))
    assert str(tmp_path / "cells") in text and f"{tmp_path}/a]" not in text


# --- quarantine -----------------------------------------------------------------


def test_malformed_rows_are_put_aside(spark, tmp_path):
    (tmp_path / "towers.csv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    at = {name: str(tmp_path / name) for name in ("clean", "funnel", "aside", "plain")}
    preprocess.preprocess_csv(spark, str(tmp_path / "towers.csv"), at["clean"], at["funnel"], quarantine=at["aside"])
    assert sorted(row.row for row in spark.read.parquet(at["aside"]).collect()) == sorted([ROWS[1], ROWS[2], ROWS[4]])
    funnel = {row.step: row.rows for row in read_report(spark, at["funnel"]).collect()}
    assert funnel["raw"] == 5 and funnel["malformed"] == 2 and funnel["technical"] == 2
    preprocess.preprocess_csv(spark, str(tmp_path / "towers.csv"), at["plain"])
    plain, clean = (read_clean(spark, at[name]) for name in ("plain", "clean"))
    assert clean.columns == plain.columns and clean.exceptAll(plain).count() == plain.exceptAll(clean).count() == 0


def test_quarantine_of_a_clean_file_is_empty(spark, towers, tmp_path):
    from cellscope.sources import write_rows_csv

    write_rows_csv(towers({}, {}, {"Country": "France"}), str(tmp_path / "csv"))
    preprocess.preprocess_csv(spark, str(tmp_path / "csv"), str(tmp_path / "clean"), quarantine=str(tmp_path / "aside"))
    assert spark.read.parquet(str(tmp_path / "aside")).count() == 0
    assert read_clean(spark, str(tmp_path / "clean")).count() == 2
    assert set(TOWER_SCHEMA.fieldNames()) > {"Country"}
