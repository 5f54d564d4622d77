"""Counts and means over towers, or over a table of pre-aggregated cells.

Several reports are needed from the same towers.  :func:`tower_cells` scans the
towers once and keeps one row per combination of dimensions with the number of
towers and, per measure, its sum and its count of filled values.  The report
operators accept either form: pass ``weight=CELL_WEIGHT`` with cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ratio
from ..sources import replace_partitions

CELL_WEIGHT = "towers"


def tower_cells(
    df: DataFrame, dimensions: Sequence[str], measures: Sequence[str] = (), bounds: Sequence[str] = (),
) -> DataFrame:
    """One row per combination of dimensions; partial sums are formed before the shuffle.

    ``bounds`` names columns whose least and largest value are kept too.
    """
    parts = [F.count(F.lit(1)).alias(CELL_WEIGHT)]
    for name in measures:
        value = F.col(name)
        parts += [
            F.sum(value.cast("double")).alias(f"{name}_sum"),
            F.count(value).alias(f"{name}_filled"),
        ]
    for name in bounds:
        parts += [F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max")]
    return df.groupBy(*dimensions).agg(*parts)


def merged_cells(cells: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Cells of several tables of towers as those of all of them: counts and sums add up, bounds widen."""
    widen = {"_min": F.min, "_max": F.max}
    parts = [
        widen.get(name[-4:], F.sum)(name).alias(name)
        for name in cells.columns if name not in dimensions and name != BATCH]
    return cells.groupBy(*dimensions).agg(*parts)


BATCH = "batch"


def add_batch(cells: DataFrame, path: str, batch: str) -> None:
    """Keep the cells of one delivery of towers beside those of the earlier ones.

    Only the new towers are scanned for it.  Under a name that is there already the cells
    replace the old ones, so a delivery that is processed twice counts once.
    """
    replace_partitions(cells.withColumn(BATCH, F.lit(batch)), path, [BATCH])


def stored_cells(spark: SparkSession, path: str, dimensions: Sequence[str]) -> DataFrame:
    """The cells of all deliveries together."""
    return merged_cells(spark.read.parquet(path), dimensions)


def tower_count(weight: str | None, when: Column | None = None) -> Column:
    """Number of towers, or of those for which ``when`` holds."""
    if weight is None:
        return F.count(F.lit(1)) if when is None else F.count_if(when)
    if when is None:
        return F.sum(weight)
    return F.sum(F.when(when, F.col(weight)).otherwise(F.lit(0)))


def tower_mean(name: str, weight: str | None) -> Column:
    """Mean of a measure over the towers in which it is filled."""
    if weight is None:
        return F.avg(name)
    return ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_filled"))


def count_by(
    df: DataFrame, keys: Sequence[str], name: str = "count", weight: str | None = None
) -> DataFrame:
    """Number of towers per key combination."""
    return df.groupBy(*keys).agg(tower_count(weight).alias(name))


def with_group_total(counts: DataFrame, group: Sequence[str], value: str, output: str) -> DataFrame:
    """Add the total of ``value`` per group to every row.

    With no group the total is a scalar subquery.  With one, the totals are an
    aggregate joined back on null-safe keys; both sides read the same exchange,
    the join strategy follows from the measured size, and a group is never
    brought into one task as a whole-partition window would do.
    """
    if not group:
        return counts.withColumn(output, counts.agg(F.sum(value)).scalar())
    totals = counts.groupBy(*[F.col(name).alias(f"{name}_of_total") for name in group]).agg(
        F.sum(value).alias(output)
    )
    same = [F.col(name).eqNullSafe(F.col(f"{name}_of_total")) for name in group]
    return counts.join(totals, same, "inner").drop(*[f"{name}_of_total" for name in group])
