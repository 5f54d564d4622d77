"""Random towers against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellscope import config
from cellscope.operators import features, quality, reports
from cellscope.sources import TOWER_SCHEMA


def random_tower(draw, number):
    def maybe(value, odds=0.03):
        return None if draw.random() < odds else value

    created = draw.randrange(1_400_000_000, 1_720_000_000)
    return {
        "index": number,
        "radio": maybe(draw.choice([*config.RADIOS, "WIFI"])),
        "MCC": maybe(draw.choice([0, 510, 502, 525, 515])),
        "MNC": maybe(draw.randrange(0, 12)),
        "TAC": maybe(draw.randrange(0, 30)),
        "CID": maybe(draw.randrange(10**9), 0.2),
        "unit": maybe(1, 0.3),
        "LON": maybe(draw.choice([float("nan"), round(draw.uniform(88, 147), draw.choice([1, 2, 3]))])
                     if draw.random() < 0.05 else round(draw.uniform(89, 146), draw.choice([1, 2, 4]))),
        "LAT": maybe(round(draw.uniform(-12, 29), draw.choice([1, 2, 4]))),
        "RANGE": maybe(draw.choice([0, 500, 999, 1000, 5000, 5001, 20000])),
        "SAM": maybe(draw.randrange(0, 25)),
        "changeable": 1,
        "created": maybe(created),
        "updated": maybe(created + draw.randrange(-10_000_000, 100_000_000)),
        "averageSignal": 0,
        "Country": maybe(draw.choices([*config.SE_ASIA, "Japan", "indonesia"], [9, *[1] * 12])[0]),
        "Network": maybe(draw.choice(["XL", "AT&T", "3 (Tri)", "Bad_Net", "é tel", "X", "Smart/Sun"])),
        "Continent": "Asia",
    }


def digits(value):
    text = str(abs(np.float32(value)))
    return len(text.split(".")[1].split("e")[0]) if "." in text else 0


def passes(row):
    """The step names a row passes before its first failure."""
    passed = []
    lon, lat = (None if row[c] is None else np.float32(row[c]) for c in ("LON", "LAT"))
    tests = [
        ("country", lambda: row["Country"] in config.SE_ASIA),
        ("nulls", lambda: all(row[c] is not None and row[c] == row[c] for c in config.CRITICAL_COLUMNS)),
        ("zeros", lambda: all(row[c] != 0 for c in config.NONZERO_COLUMNS)),
        ("patterns", lambda: all(re.search(p, row[c]) for c, p in config.NAME_PATTERNS.items())),
        ("decimals", lambda: digits(lon) >= 2 and digits(lat) >= 2),
        ("technical", lambda: 90 <= lon <= 145 and -11 <= lat <= 28
            and row["updated"] >= row["created"] and row["radio"] in config.RADIOS),
    ]
    for name, test in tests:
        if not test():
            return passed
        passed.append(name)
    return passed


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    return [random_tower(draw, number) for number in range(6000)]


@pytest.fixture(scope="module")
def raw(spark, rows):
    names = TOWER_SCHEMA.fieldNames()
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], TOWER_SCHEMA).cache()


@pytest.fixture(scope="module")
def good(rows):
    return [row for row in rows if len(passes(row)) == 6]


def test_cleaning(raw, good):
    kept = {row["index"] for row in quality.clean_towers(raw).select("index").collect()}
    assert len(kept) > 200
    assert kept == {row["index"] for row in good}


def test_funnel(raw, rows):
    left = Counter(step for row in rows for step in passes(row))
    got = {row.step: row.rows for row in quality.quality_funnel(raw).collect()}
    assert got == {"raw": len(rows), **left}
    assert len(set(got.values())) == 7


def test_top_three_and_shares(raw, good):
    counts = defaultdict(Counter)
    for row in good:
        counts[row["Country"]][row["Network"]] += 1
    clean = features.enrich(quality.clean_towers(raw))
    wanted = [
        (country, name, n, place)
        for country in sorted(counts)
        for place, (name, n) in enumerate(sorted(counts[country].items(), key=lambda x: (-x[1], x[0]))[:3], 1)
    ]
    assert [tuple(r) for r in reports.top_k_per_group(clean, "Country", "Network", 3).collect()] == wanted
    for row in reports.ownership_hierarchy(clean).collect():
        share = 100 * counts[row.Country][row.Network] / sum(counts[row.Country].values())
        assert row.percentage_share == pytest.approx(share)


def test_modernisation_and_growth(raw, good):
    clean = features.enrich(quality.clean_towers(raw))
    by_country = defaultdict(list)
    for row in good:
        by_country[row["Country"]].append(row)
    for row in reports.modernisation(clean).collect():
        group = by_country[row.Country]
        ages = [max(0.0, (config.AS_OF_EPOCH - r["updated"]) / 86400) for r in group]
        assert row.total_towers == len(group)
        assert row.modernization_percentage == pytest.approx(
            100 * sum(r["radio"] in ("LTE", "NR") for r in group) / len(group)
        )
        assert row.avg_data_age_days == pytest.approx(sum(ages) / len(ages))
    years = Counter(int(str(np.datetime64(r["created"], "s"))[:4]) for r in good)
    assert [tuple(r) for r in reports.yearly_growth(clean).collect()] == sorted(years.items())
