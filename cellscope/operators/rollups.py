"""Aggregations behind the dashboard views.

The inputs are reports (small) or row-level tables (large); either way the
summing happens in Spark and only the final view leaves it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookup


def rollup_tree(df: DataFrame, path: Sequence[str], value: str) -> DataFrame:
    """Totals of every node of a hierarchy: root level 1, leaves ``len(path)``."""
    # grouping_id has one bit per column that is summed away, the last lowest
    depth_of_id = {(1 << (len(path) - depth)) - 1: depth for depth in range(1, len(path) + 1)}
    return (
        df.rollup(*path)
        .agg(F.sum(value).alias(value), F.grouping_id().cast("int").alias("summed"))
        .select(*path, lookup(F.col("summed"), depth_of_id).alias("level"), value)
        .filter(F.col("level").isNotNull())
        .orderBy("level", *path)
    )


def label_map(df: DataFrame, column: str, mapping: Mapping, output: str) -> DataFrame:
    """Add the label of each code; a code without label gives null."""
    return df.withColumn(output, lookup(F.col(column), mapping))


def named(df: DataFrame, column: str, labels: Mapping | None, output: str) -> DataFrame:
    """Add the label of each code, or ``Cluster <code>`` where no labels are given.

    Cluster numbers are arbitrary: labels belong to one trained model.
    """
    if labels:
        return label_map(df, column, labels, output)
    return df.withColumn(output, F.concat(F.lit("Cluster "), F.col(column).cast("int").cast("string")))


def country_reliability(df: DataFrame, labels: Mapping | None = None) -> DataFrame:
    """Country x reliability cluster totals from the operator report.

    Without ``labels`` clusters are named by their number.
    """
    totals = df.groupBy("Country", "gmm_cluster").agg(F.sum("tower_count").alias("tower_count"))
    return (
        named(totals, "gmm_cluster", labels, "gmm_cluster_short")
        .select("Country", "gmm_cluster", "gmm_cluster_short", "tower_count")
        .orderBy("Country", "gmm_cluster")
    )


def slice_report(df: DataFrame, country: str | None = None, cluster: int | None = None) -> DataFrame:
    """Rows of one country and/or cluster; ``None`` means all."""
    for column, wanted in (("Country", country), ("gmm_cluster", cluster)):
        if wanted is not None:
            df = df.filter(F.col(column) == wanted)
    return df


def heatmap(
    df: DataFrame, x: tuple[str, str], y: tuple[str, str], value: str
) -> DataFrame:
    """Sum of ``value`` per cell; ``x`` and ``y`` are (column, label prefix)."""
    cells = [
        F.concat(F.lit(prefix), F.col(column).cast("string")).alias(column)
        for column, prefix in (x, y)
    ]
    return df.groupBy(*cells).agg(F.sum(value).alias(value)).orderBy(x[0], y[0])


def display(df: DataFrame, headings: Mapping[str, str], order_by: Sequence[str]) -> DataFrame:
    """Columns under their display headings, sorted by headings."""
    return df.select(*[F.col(old).alias(new) for old, new in headings.items()]).orderBy(
        *[F.col(f"`{name}`") for name in order_by]
    )


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows by key, as a distributed top-n."""
    return df.orderBy(*order_by).limit(n)
