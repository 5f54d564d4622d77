"""Descriptive reports on cleaned towers.

Windows and sorts only see rows that were aggregated first.  Ties are ordered
by name so that a report is the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MODERN_RADIOS, REGION_NAME
from ..functions import percent
from .measures import count_by, tower_cells, tower_count, tower_mean, with_group_total

REPORT_DIMENSIONS = ("Country", "Network", "radio", "generasi", "created_year")
REPORT_MEASURES = ("data_age_days",)


def report_cells(df: DataFrame) -> DataFrame:
    """The one aggregate from which all six reports follow."""
    return tower_cells(df, REPORT_DIMENSIONS, REPORT_MEASURES)


def category_share(
    df: DataFrame, column: str, within: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Count and percent of each category, of all rows or within groups."""
    counts = count_by(df, [*within, column], weight=weight)
    return (
        with_group_total(counts, within, "count", "total")
        .select(
            *within, column, "count",
            percent(F.col("count"), F.col("total")).alias("percentage"),
        )
        .orderBy(*within, F.desc("count"), column)
    )


def top_k_per_group(
    df: DataFrame, group: str, item: str, k: int = 3, weight: str | None = None
) -> DataFrame:
    """The ``k`` largest items of each group, ranked 1..k."""
    order = Window.partitionBy(group).orderBy(F.desc("tower_count"), item)
    return (
        count_by(df, [group, item], "tower_count", weight)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .orderBy(group, "rank")
    )


def modernisation(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per country: towers, percent on a modern radio, mean data age."""
    modern = F.col("radio").isin(*MODERN_RADIOS)
    return (
        df.groupBy("Country")
        .agg(
            tower_count(weight).alias("total_towers"),
            tower_count(weight, modern).alias("modern"),
            tower_mean("data_age_days", weight).alias("avg_data_age_days"),
        )
        .select(
            "Country", "total_towers",
            percent(F.col("modern"), F.col("total_towers")).alias("modernization_percentage"),
            "avg_data_age_days",
        )
        .orderBy(F.desc("modernization_percentage"), "Country")
    )


def ownership_hierarchy(
    df: DataFrame, root: str = REGION_NAME, weight: str | None = None
) -> DataFrame:
    """Region, country and operator with the operator's percent of its country."""
    counts = count_by(df, ["Country", "Network"], "tower_count", weight)
    return (
        with_group_total(counts, ["Country"], "tower_count", "country_total")
        .select(
            F.lit(root).alias("region"), "Country", "Network", "tower_count",
            percent(F.col("tower_count"), F.col("country_total")).alias("percentage_share"),
        )
        .orderBy("Country", F.desc("tower_count"), "Network")
    )


def yearly_growth(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Towers by year of creation."""
    return count_by(df, ["created_year"], weight=weight).orderBy("created_year")


def dominant_value(df: DataFrame, group: str, value: str, weight: str | None = None) -> DataFrame:
    """The most frequent value of each group; equal values are all kept."""
    order = Window.partitionBy(group).orderBy(F.desc("cnt"))
    return (
        count_by(df, [group, value], "cnt", weight)
        .withColumn("place", F.rank().over(order))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def top_operators(df: DataFrame, n: int = 10, weight: str | None = None) -> DataFrame:
    """The ``n`` largest operators with the country in which each is strongest.

    An operator that is equally strong in several countries takes a place for
    each.  Total and strongest country are both known once the counts of an
    operator are together, so neither the towers nor the counts are read twice;
    such a group has one row per country.
    """
    operator = Window.partitionBy("Network")
    return (
        count_by(df.filter(F.col("Network").isNotNull()), ["Network", "Country"], "cnt", weight)
        .withColumns({
            "total_menara_asean": F.sum("cnt").over(operator),
            "strongest": F.max("cnt").over(operator),
        })
        .filter(F.col("cnt") == F.col("strongest"))
        .select("Network", "total_menara_asean", F.col("Country").alias("Negara_Dominan"))
        .orderBy(F.desc("total_menara_asean"), "Network", "Negara_Dominan")
        .limit(n)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column in order."""
    return df.select(column).distinct().orderBy(column)


def join_models(zones: DataFrame, reliability: DataFrame, on: str = "index") -> DataFrame:
    """Zone table with the reliability cluster of the same tower.

    Inner join: a null key drops out and duplicate keys multiply.  Only two
    columns of the right table are shuffled; the strategy and the splitting of
    skewed keys are left to adaptive execution.
    """
    return zones.join(reliability.select(on, "gmm_cluster"), on, "inner")
