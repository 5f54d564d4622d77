import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
TABLES = os.environ.get("TEST_TABLES", "/root/testdata")
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cellscope.session import local_session

    return local_session(folder=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def towers(spark):
    """Build raw towers from a plain good row and the fields that differ."""
    from cellscope.sources import TOWER_SCHEMA

    good = {
        "index": 1, "radio": "LTE", "MCC": 510, "MNC": 10, "TAC": 7, "CID": 99, "unit": 1,
        "LON": 106.82, "LAT": -6.17, "RANGE": 1200, "SAM": 5, "changeable": 1,
        "created": 1500000000, "updated": 1600000000, "averageSignal": 0,
        "Country": "Indonesia", "Network": "Telkomsel", "Continent": "Asia",
    }

    def build(*changes, numbered=True):
        rows = []
        for place, change in enumerate(changes, start=1):
            row = {**good, **({"index": place} if numbered else {}), **change}
            rows.append(tuple(row[name] for name in TOWER_SCHEMA.fieldNames()))
        return spark.createDataFrame(rows, TOWER_SCHEMA)

    return build


@pytest.fixture
def kept():
    """Sorted values of a column."""

    def values(df, column="index"):
        return sorted(row[0] for row in df.select(column).collect())

    return values


@pytest.fixture
def plan(spark):
    """The formatted physical plan."""

    def text(df):
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")

    return text
