"""Folders for staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, which all executors reach too.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.staged"


def _path(spark: SparkSession, name: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(name)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file, in the place of an older one."""
    path, files = _path(spark, name)
    stream = files.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, name: str) -> str | None:
    """A small file's text; none if there is no such file."""
    path, files = _path(spark, name)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def new_workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, removed when the application ends."""
    name = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    folder, files = _path(spark, name)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return name


@contextmanager
def temporary_workspace(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh folder that is removed when the block ends."""
    name = new_workspace(spark, label)
    try:
        yield name
    finally:
        folder, files = _path(spark, name)
        files.delete(folder, True)
