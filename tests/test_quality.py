import pytest

from cellscope import config
from cellscope.operators import quality

NAN = float("nan")


def test_countries_are_matched_exactly(towers, kept):
    df = towers({}, {"Country": "indonesia"}, {"Country": " Indonesia"}, {"Country": "Japan"}, {"Country": None})
    assert kept(quality.filter_in(df, "Country", config.SE_ASIA)) == [1]


def test_nan_coordinate_counts_as_null(towers, kept):
    df = towers({}, {"LAT": NAN}, {"LON": None}, {"unit": None}, {"CID": None}, {"radio": None})
    assert kept(quality.drop_nulls(df, config.CRITICAL_COLUMNS)) == [1, 4, 5]


def test_same_rows_as_the_built_in_null_filter(towers, kept):
    df = towers({}, {"LAT": NAN}, {"SAM": None}, {"Network": None}, {"updated": None})
    ours = quality.drop_nulls(df, config.CRITICAL_COLUMNS)
    assert kept(ours) == kept(df.na.drop(subset=list(config.CRITICAL_COLUMNS)))


@pytest.mark.parametrize("column", config.NONZERO_COLUMNS)
def test_zero_codes_are_dropped(towers, kept, column):
    assert kept(quality.filter_nonzero(towers({}, {column: 0}), config.NONZERO_COLUMNS)) == [1]


def test_network_names(towers, kept):
    names = ["XL_Axiata", "é tel", "AT&T", "3 (Tri)", "Smart/Sun", "X", "A.B-C+"]
    df = towers(*[{"Network": name} for name in names])
    assert kept(quality.filter_matches(df, config.NAME_PATTERNS), "Network") == [
        "3 (Tri)", "A.B-C+", "AT&T", "Smart/Sun",
    ]


def test_precision_is_that_of_the_float_text(towers, kept):
    places = [106.8, 106.82, 99.999999, 1.0e-4, 100.0, -6.12]
    df = towers(*[{"LON": place} for place in places])
    assert kept(quality.filter_decimals(df, ["LON"], 2)) == [2, 6]


def test_box_edges_are_inside(towers, kept):
    df = towers(
        {"LON": 90.0, "LAT": -11.0}, {"LON": 145.0, "LAT": 28.0},
        {"LON": 89.99}, {"LON": 145.01}, {"LAT": -11.01}, {"LAT": 28.01},
    )
    assert kept(quality.filter_bbox(df, config.BOUNDING_BOX)) == [1, 2]


def test_update_may_not_precede_creation(towers, kept):
    df = towers({}, {"updated": 1500000000}, {"updated": 1499999999}, {"updated": None})
    assert kept(quality.filter_ordered(df, "created", "updated")) == [1, 2]


@pytest.fixture
def mixed(towers):
    return towers(
        {}, {"Country": "Japan"}, {"radio": None}, {"SAM": 0}, {"Network": "Bad_Net"},
        {"LON": 106.8}, {"LAT": 30.25}, {"radio": "WIFI"}, {"unit": None}, {"Country": None},
    )


EXPECTED = [("raw", 10), ("country", 8), ("nulls", 7), ("zeros", 6), ("patterns", 5), ("decimals", 4), ("technical", 2)]


def test_cleaner_and_funnel_agree(mixed, kept):
    clean = quality.clean_towers(mixed)
    assert kept(clean) == [1, 9]
    assert not set(config.UNUSED_COLUMNS) & set(clean.columns)
    funnel = quality.quality_funnel(mixed).orderBy("step_no").collect()
    assert [(row.step, row.rows) for row in funnel] == EXPECTED


def test_rules_can_be_replaced(mixed, kept):
    rules = config.CleanRules(countries=("Japan",), unused=())
    clean = quality.clean_towers(mixed, rules)
    assert kept(clean) == [2]
    assert "Continent" in clean.columns


def test_cleaning_reaches_the_scan_and_needs_no_shuffle(spark, mixed, tmp_path, plan):
    mixed.write.parquet(str(tmp_path / "raw"))
    df = quality.clean_towers(spark.read.parquet(str(tmp_path / "raw"))).select("index")
    text = plan(df)
    assert "Exchange" not in text
    assert "In(Country" in text and "IsNotNull(radio)" in text and "Not(EqualTo(SAM,0))" in text
    assert "averageSignal" not in text.split("ReadSchema")[1].split("\n")[0]


def test_project_renames_and_casts(towers):
    df = quality.project(towers({}), {"index": "id", "RANGE": "radius"}, {"RANGE": "double"})
    assert df.dtypes == [("id", "bigint"), ("radius", "double")]
