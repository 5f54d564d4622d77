"""Parquet tables between stages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .workspace import new_workspace, temporary_workspace


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Scan a Parquet table; the schema comes from the files."""
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write Parquet.  ``partition_by=["Country"]`` lets readers skip countries.

    No shuffle is added: every task writes its own files, so one country with a
    third of the rows is still written by all tasks.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stage_table(
    df: DataFrame, label: str, path: str | None = None, partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor without
    going back to the source, and reads only the columns it needs.  The folder
    lives as long as the application, for results that are read later; a job
    that is done with the table earlier uses :func:`staged_table`.
    """
    path = path or new_workspace(df.sparkSession, label)
    write_table(df, path, partition_by)
    # the schema is known: no look into the files
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_table(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """A staged table that is deleted when the block ends."""
    with temporary_workspace(df.sparkSession, label) as path:
        yield stage_table(df, label, path, partition_by)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Write the rows in the place of those that the table has for the same ``keys``.

    Other partitions stay.  The files of a partition are exchanged when all tasks are done, so
    writing the same rows again, as a job does that is run a second time, changes nothing.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
