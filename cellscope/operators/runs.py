"""Run metrics as an ordinary table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import replace_partitions

RUN_SCHEMA = "run_id string, experiment string, run_name string, kind string, key string, value string"
FINAL = "Final_Best"


def run_metrics(
    spark: SparkSession, experiment: str, run_name: str,
    params: Mapping[str, object] | None = None, metrics: Mapping[str, float] | None = None,
    run_id: str = "",
) -> DataFrame:
    """Parameters and metrics of one run, one row each (RUN_SCHEMA).

    ``run_id`` tells the executions of a job apart that write to one table.
    """
    head = (run_id, experiment, run_name)
    rows = [(*head, "param", key, str(value)) for key, value in (params or {}).items()]
    rows += [(*head, "metric", key, repr(float(value))) for key, value in (metrics or {}).items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def record_runs(runs: DataFrame, path: str) -> None:
    """Put runs into the run table: they replace those of the same run id and experiment.

    A job that is run again under its run id leaves its runs once.
    """
    replace_partitions(runs, path, ["run_id", "experiment"])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table (RUN_SCHEMA)."""
    schema = StructType.fromDDL(RUN_SCHEMA)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _cell(kind: str, key: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.cast("string").alias("value"))


def sweep_runs(
    metrics: DataFrame, experiment: str, scores: list[str], run_id: str = "", params: tuple[str, ...] = ("k",)
) -> DataFrame:
    """Long form of a sweep table: one run ``<experiment>_K_<k>`` per row, with its parameters and scores."""
    cells = [_cell("param", key, F.col(key)) for key in params]
    cells += [_cell("metric", key, F.col(key)) for key in scores]
    name = F.concat_ws("_", F.lit(experiment), *(
        part for key in params for part in (F.lit(key.upper()), F.col(key).cast("string"))))
    return metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(experiment).alias("experiment"), name.alias("run_name"),
        F.inline(F.array(*cells)))


def final_run(
    metrics: DataFrame, experiment: str, scores: list[str], run_id: str = "", best: str = "is_best"
) -> DataFrame:
    """The winning row of a sweep as the run ``Final_Best_<experiment>``: ``best_k`` and its scores."""
    cells = [_cell("param", "best_k", F.col("k")), *(_cell("metric", key, F.col(key)) for key in scores)]
    return metrics.filter(F.col(best)).select(
        F.lit(run_id).alias("run_id"), F.lit(experiment).alias("experiment"),
        F.lit(f"{FINAL}_{experiment}").alias("run_name"), F.inline(F.array(*cells)))


def best_run(metrics: DataFrame, key: str, largest: bool = True) -> DataFrame:
    """The run with the best value of a metric per execution and experiment.

    (run_id, experiment, run_name, value); the first run name wins a tie.  Final
    runs repeat one of the others and are left out.
    """
    value = F.col("value").try_cast("double")
    order = F.desc("value") if largest else F.asc("value")
    best = Window.partitionBy("run_id", "experiment").orderBy(order, "run_name")
    return (
        metrics.filter((F.col("kind") == "metric") & (F.col("key") == key))
        .filter(~F.col("run_name").startswith(f"{FINAL}_"))
        .select("run_id", "experiment", "run_name", value.alias("value"))
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") == 1)
        .drop("place")
        .orderBy("run_id", "experiment")
    )
