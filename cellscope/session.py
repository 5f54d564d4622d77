"""A local session for tests, the benchmark and trying things out."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(
    cores: int | str | None = None, app: str = "cellscope", folder: str | None = None
) -> SparkSession:
    """``folder`` is for staged tables where ``spark.checkpoint.dir`` is not set yet."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    spark = builder.getOrCreate()
    if folder and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(folder)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
