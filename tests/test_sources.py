import os

import pytest

from cellscope.sources import (
    TOWER_SCHEMA,
    preview,
    read_clean,
    read_report,
    read_towers_csv,
    row_counts,
    schema_table,
    staged_table,
    write_report,
    write_table,
)
from cellscope.sources import workspace

HEADER = ",".join(TOWER_SCHEMA.fieldNames())
ROWS = [
    "1,GSM,510,1,1,1,1,106.82,1.23,100,1,1,1,2,0,Indonesia,XL,Asia",
    "2,GSM,510,1,1,1,1,106.82,1.23,100,1,bad,1,2,0,Indonesia,XL,Asia",  # dropped column
    "3,GSM,510,1,1,1,1,106.82,1.23,100,1,1,1",  # missing fields
    "4,GSM,510,1,1,1,,106.82,1.23,100,1,1,1,2,0,Indonesia,XL,Asia",
    "5,GSM,xx,1,1,1,1,106.82,1.23,100,1,1,1,2,0,Laos,XL,Asia",
]


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "towers.csv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    return str(tmp_path / "towers.csv")


@pytest.mark.parametrize("columns", [["index"], ["radio", "Country"], TOWER_SCHEMA.fieldNames()])
def test_bad_rows_go_whatever_is_selected(spark, csv, columns):
    df = read_towers_csv(spark, csv)
    assert df.count() == 2
    assert len(df.select(*columns).collect()) == 2
    assert df.filter("Country = 'Indonesia'").select(columns[0]).count() == 2


def test_bad_rows_can_be_counted(spark, csv):
    df = read_towers_csv(spark, csv, on_bad="keep")
    assert df.count() == 5
    assert df.filter("_corrupt_record is not null").count() == 3
    assert df.filter("_corrupt_record is null").select("index").count() == 2
    with pytest.raises(ValueError):
        read_towers_csv(spark, csv, on_bad="ignore")


def test_filters_reach_the_csv_scan(spark, csv, plan):
    df = read_towers_csv(spark, csv).filter("Country = 'Laos'").select("index")
    assert "EqualTo(Country,Laos)" in plan(df)


def test_parquet_round_trip_by_country(spark, towers, tmp_path, plan):
    path = str(tmp_path / "t")
    write_table(towers({}, {"Country": "Laos"}, {"Country": "Laos"}), path, ["Country"])
    df = read_clean(spark, path).filter("Country = 'Laos'")
    assert df.count() == 2
    assert "PartitionFilters: [isnotnull(Country" in plan(df)
    write_table(towers({}), path)
    assert read_clean(spark, path).count() == 1


def parts(path):
    return sorted(p.name for p in path.iterdir() if p.name.endswith(".csv"))


def test_small_reports_are_one_file(spark, tmp_path):
    write_report(spark.range(100).repartition(7).orderBy("id"), str(tmp_path / "r"))
    assert len(parts(tmp_path / "r")) == 1
    lines = (tmp_path / "r" / parts(tmp_path / "r")[0]).read_text().split()
    assert lines == ["id", *map(str, range(100))]


def test_reports_can_be_written_in_parallel(spark, tmp_path):
    write_report(spark.range(100).repartition(7), str(tmp_path / "r"), single_file=False)
    assert len(parts(tmp_path / "r")) == 7
    assert read_report(spark, str(tmp_path / "r")).count() == 100


def test_missing_report_is_empty(spark, tmp_path):
    df = read_report(spark, str(tmp_path / "none"), TOWER_SCHEMA)
    assert df.count() == 0 and df.schema == TOWER_SCHEMA
    assert read_report(spark, str(tmp_path / "none")).columns == []


def test_inspection(towers):
    df = towers({}, {"SAM": None}, {"SAM": None})
    assert [row["index"] for row in preview(df, 2, ["index"]).collect()] == [1, 2]
    assert dict(row_counts(df, ["SAM", "radio"]).collect()) == {"rows": 3, "SAM": 1, "radio": 3}
    first = schema_table(df).orderBy("position").first()
    assert (first.name, first.type) == ("index", "bigint")


def test_staged_table_is_gone_after_its_block(spark):
    with staged_table(spark.range(10), "ten") as ten:
        path = ten.inputFiles()[0]
        assert ten.count() == 10 and os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))


def test_workspace_is_below_the_named_folder(spark):
    named = spark.conf.get(workspace.CHECKPOINT_KEY, None)
    one, two = workspace.new_workspace(spark, "x"), workspace.new_workspace(spark, "x")
    assert one != two
    if named:
        assert one.startswith(named)
