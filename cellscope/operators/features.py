"""Scalar features of a tower.  All of them are narrow projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    AS_OF_EPOCH,
    COVERAGE_BANDS,
    COVERAGE_ELSE,
    DEFAULT_RULES,
    GENERATION_OF_RADIO,
    RELIABILITY_BANDS,
    RELIABILITY_ELSE,
    CleanRules,
)
from ..functions import age_days, banded, lookup, utc_year


def with_data_age(df: DataFrame, as_of: int = AS_OF_EPOCH) -> DataFrame:
    """Add ``data_age_days``, never negative."""
    return df.withColumn("data_age_days", age_days(F.col("updated"), as_of))


def with_years(df: DataFrame) -> DataFrame:
    """Add ``created_year`` and ``updated_year`` in UTC."""
    return df.withColumns({
        "created_year": utc_year(F.col("created")),
        "updated_year": utc_year(F.col("updated")),
    })


def with_generation(df: DataFrame) -> DataFrame:
    """Add ``generasi``; an unknown radio gives null."""
    return df.withColumn("generasi", lookup(F.col("radio"), GENERATION_OF_RADIO))


def with_coverage(df: DataFrame) -> DataFrame:
    """Add ``jangkauan`` from the radius."""
    return df.withColumn("jangkauan", banded(F.col("RANGE"), COVERAGE_BANDS, COVERAGE_ELSE))


def with_reliability(df: DataFrame) -> DataFrame:
    """Add ``keandalan_data`` from the number of samples."""
    return df.withColumn("keandalan_data", banded(F.col("SAM"), RELIABILITY_BANDS, RELIABILITY_ELSE))


def with_display_coords(df: DataFrame) -> DataFrame:
    """Add ``LON_VIS`` and ``LAT_VIS``, copies for display."""
    return df.withColumns({f"{name}_VIS": F.col(name) for name in ("LON", "LAT")})


def enrich(df: DataFrame, rules: CleanRules = DEFAULT_RULES) -> DataFrame:
    """All scalar features."""
    return (
        with_data_age(df, rules.as_of)
        .transform(with_years)
        .transform(with_display_coords)
        .transform(with_generation)
        .transform(with_coverage)
        .transform(with_reliability)
    )
