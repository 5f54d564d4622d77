"""Samples, splits and folds that depend on the row and not on its partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAP_SAMPLE_ROWS, SEED
from ..functions import unit_hash

# Bins of the histogram by which a sample of a given size finds its last row.
SAMPLE_BINS = 4096

# Used for towers without an index, so that they too spread over the buckets.
CELL_IDENTITY = ("radio", "MCC", "MNC", "TAC", "CID", "created")


def row_key(df: DataFrame, key: str = "index") -> Column:
    """Text that identifies a row: its key, or the cell identity where that is null.

    A row without a key needs all columns of the identity, else the query fails:
    its draw must not depend on which columns happen to be selected.
    """
    missing = [name for name in CELL_IDENTITY if name not in df.columns]
    spare = (
        F.raise_error(F.lit(f"{key} is null, and the cell identity lacks {missing}")).cast("string")
        if missing else F.xxhash64(*CELL_IDENTITY).cast("string")
    )
    return F.coalesce(F.col(key).cast("string"), spare)


def row_draw(df: DataFrame, purpose: str, seed: int = SEED, key: str = "index") -> Column:
    """The row's number in [0, 1).

    ``purpose`` keeps draws independent: folds of a training part must not
    follow from the draw that made the part.
    """
    return unit_hash(row_key(df, key), f"{purpose}-{seed}")


def sample_rows(df: DataFrame, fraction: float, seed: int = SEED, key: str = "index") -> DataFrame:
    """Each row is kept with probability ``fraction``, without replacement."""
    return df.filter(row_draw(df, "sample", seed, key) < F.lit(float(fraction)))


def sample_n(
    df: DataFrame, n: int = MAP_SAMPLE_ROWS, seed: int = SEED, key: str = "index", bins: int = SAMPLE_BINS,
) -> DataFrame:
    """Exactly ``n`` rows, or all rows when there are fewer: those with the least draws.

    Equal draws are ordered by the row's key.  Nothing is sorted but the rows of one bin: a
    histogram of the draws, one row per bin, tells in which bin the n-th row lies and how many
    rows come before it; the n-th draw is then the last of the least ones of that bin.  The
    result is a filter by that draw.  Only where several rows share it (equal keys) and not all
    fit are those that do taken by a limit.
    """
    draw, name = row_draw(df, "sample", seed, key), row_key(df, key)
    at = F.floor(draw * F.lit(bins))
    earlier = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # of one row per bin
    histogram = df.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    place = (
        histogram.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .filter((F.col("before") < n) & (F.col("before") + F.col("rows") >= n)).first()
    )
    if place is None:  # fewer rows than n, or none wanted
        return df if n > 0 else df.limit(0)
    rank = F.struct(draw.alias("draw"), name.alias("name"))
    least = df.filter(at == place["bin"]).select(rank.alias("rank")).orderBy("rank").limit(n - place["before"])
    cut = least.groupBy("rank").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rank")).first()
    last = F.struct(F.lit(cut["rank"]["draw"]).alias("draw"), F.lit(cut["rank"]["name"]).alias("name"))
    sharing = df.filter((at == place["bin"]) & (rank == last))
    if sharing.count() == cut["rows"]:
        return df.filter(rank <= last)
    return df.filter(rank < last).unionByName(sharing.limit(cut["rows"]))


def split(
    df: DataFrame, weights: Sequence[float], seed: int = SEED, key: str = "index"
) -> list[DataFrame]:
    """Disjoint parts that together hold every row."""
    total = sum(weights)
    edges = [sum(weights[:i]) / total for i in range(len(weights))] + [1.0]
    draw = row_draw(df, "split", seed, key)
    return [
        df.filter((draw >= F.lit(low)) & (draw < F.lit(high)))
        for low, high in zip(edges[:-1], edges[1:], strict=True)
    ]


def with_fold(
    df: DataFrame, folds: int, seed: int = SEED, key: str = "index", output: str = "fold"
) -> DataFrame:
    """Add a fold number 0 .. folds-1."""
    return df.withColumn(output, F.floor(row_draw(df, "fold", seed, key) * F.lit(folds)).cast("int"))
