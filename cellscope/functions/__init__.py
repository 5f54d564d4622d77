"""Column expressions shared by the operators; all run inside the JVM."""

from .columns import (
    age_days,
    banded,
    fraction_digits,
    lookup,
    percent,
    ratio,
    unit_hash,
    utc_year,
)

__all__ = [
    "age_days", "banded", "fraction_digits", "lookup",
    "percent", "ratio", "unit_hash", "utc_year",
]
