"""Shared parts of the model sweeps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.storagelevel import StorageLevel

from .sampling import row_key


@dataclass(frozen=True)
class Sweep:
    """Outcome of a sweep: one metrics row per k, the winning model, and all of them by k."""

    metrics: DataFrame
    best_k: int
    best_model: Any
    models: dict[int, Any]


@contextmanager
def training_rows(
    df: DataFrame, columns: Sequence[str], partitions: int, key: str = "index"
) -> Iterator[DataFrame]:
    """The columns that training reads, kept while the block runs.

    An iterative fit reads its input dozens of times; only the named columns are
    kept, spilling to disk.  A lost block is computed again from the source.
    One job fills them before the block starts: fits that run side by side must
    not fill the same cache at once.

    MLlib's random starts follow the partitioning, so the rows are dealt to a
    given number of partitions by their identity and ordered by it: the model
    depends neither on the cores nor on how the input is split.  Rows without
    an index spread like all others.  The number has no default, because it is
    part of the model and has to suit the rows: some 100,000 rows in each.
    """
    rows = (
        df.withColumn("__key", row_key(df, key))
        .select(*columns, "__key")
        .repartition(partitions, "__key").sortWithinPartitions("__key")
        .drop("__key").persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        rows.count()
        yield rows
    finally:
        rows.unpersist()


def feature_values(df: DataFrame, features: str) -> Column:
    """A feature column as an array of numbers, whether it is a vector or an array already."""
    kind = df.schema[features].dataType
    return F.col(features) if isinstance(kind, ArrayType) else vector_to_array(features)


def run_all(
    df: DataFrame, work: Callable[[int], Any], items: Sequence[int], parallelism: int
) -> list[Any]:
    """Run independent fits, ``parallelism`` of them side by side.

    One after the other is right for large inputs, where each fit keeps the
    cluster busy; several at once help when the jobs are tiny.
    """
    if parallelism <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(work), items)


def first_largest(scores: Sequence[float]) -> int:
    """Position of the strictly largest score; the first of equals."""
    return max(range(len(scores)), key=lambda position: (scores[position], -position))
