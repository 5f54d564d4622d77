"""Fixed values and the rule set of the tower model.

The literals in the first part are part of the data contract: results only
match when they are exactly these.  Everything that a user may want to change
is a field of :class:`CleanRules` or a keyword argument of an operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values (data contract) -------------------------------------------

SE_ASIA = (
    "Brunei", "Cambodia", "East Timor", "Indonesia", "Laos", "Malaysia",
    "Myanmar", "Philippines", "Singapore", "Thailand", "Vietnam",
)

RADIOS = ("GSM", "UMTS", "LTE", "NR", "CDMA")
MODERN_RADIOS = ("LTE", "NR")
GENERATION_OF_RADIO = {"GSM": "2G", "UMTS": "3G", "LTE": "4G", "NR": "5G", "CDMA": "2G"}

# Columns that must be filled; unit, CID and index may be null.
CRITICAL_COLUMNS = (
    "radio", "MCC", "MNC", "TAC", "LON", "LAT", "RANGE", "SAM",
    "Country", "Network", "created", "updated",
)
NONZERO_COLUMNS = ("MCC", "MNC", "TAC", "SAM", "RANGE")
UNUSED_COLUMNS = ("Continent", "averageSignal", "changeable")

NAME_PATTERNS = {
    "Country": r"^[a-zA-Z\s]{2,}$",
    "Network": r"^[a-zA-Z0-9\s\-\.\&\+\(\)\/]{2,}$",
}
BOUNDING_BOX = {"LON": (90, 145), "LAT": (-11, 28)}
MIN_DECIMALS = 2

AS_OF_EPOCH = 1715360400
SECONDS_PER_DAY = 86400

# (comparison, limit, label), first match wins; then the last label.
COVERAGE_BANDS = (("<", 1000, "Urban"), ("<=", 5000, "Suburban"))
COVERAGE_ELSE = "Rural"
RELIABILITY_BANDS = ((">=", 10, "high"), (">=", 3, "medium"))
RELIABILITY_ELSE = "low"

SPATIAL_COLUMNS = ("LON", "LAT", "RANGE")
IDENTITY_COLUMNS = ("MCC", "MNC", "unit")
RELIABILITY_COLUMNS = ("SAM", "data_age_days")

# category column -> its index column
INDEXED_COLUMNS = {
    "radio": "radio_index",
    "Country": "country_index",
    "generasi": "generasi_index",
    "jangkauan": "jangkauan_index",
}

FOREST_FEATURES = (
    "SAM", "data_age_days", "radio_index", "country_index",
    "generasi_index", "jangkauan_index", "gmm_cluster",
)

REGION_NAME = "Asia Tenggara"

SEED = 42
SWEEP_KS = (2, 3, 4, 5)
SILHOUETTE_SAMPLE = 0.1
MAP_SAMPLE_ROWS = 10_000
FOREST_TREES = 50
FOREST_DEPTH = 8
FOREST_FOLDS = 5
TRAIN_TEST_WEIGHTS = (0.8, 0.2)

# --- Tunable rules ----------------------------------------------------------


@dataclass(frozen=True)
class CleanRules:
    """What the cleaner keeps.  Replace fields to clean another region."""

    countries: tuple[str, ...] = SE_ASIA
    radios: tuple[str, ...] = RADIOS
    critical: tuple[str, ...] = CRITICAL_COLUMNS
    nonzero: tuple[str, ...] = NONZERO_COLUMNS
    unused: tuple[str, ...] = UNUSED_COLUMNS
    patterns: dict[str, str] = field(default_factory=lambda: dict(NAME_PATTERNS))
    decimal_columns: tuple[str, ...] = ("LON", "LAT")
    min_decimals: int = MIN_DECIMALS
    bounding_box: dict[str, tuple[float, float]] = field(
        default_factory=lambda: dict(BOUNDING_BOX)
    )
    as_of: int = AS_OF_EPOCH


DEFAULT_RULES = CleanRules()
