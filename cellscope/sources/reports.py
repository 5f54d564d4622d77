"""CSV reports and table inspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_report(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Write an aggregate as headed CSV: in one file, or by all tasks.

    The layout is the caller's choice and never depends on the data.
    """
    write_rows_csv(df.coalesce(1) if single_file else df, path)


def write_rows_csv(df: DataFrame, path: str) -> None:
    """Write row-level output as headed CSV, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_report(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Read all CSV parts of a report; a missing report gives an empty table.

    With ``schema`` the files are read once and an empty table has its columns;
    without it the types are inferred and an empty table has none.  Only a path
    that is missing or holds no files counts as empty; every other error is
    raised.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    return spark.createDataFrame([], schema or T.StructType([]))


def preview(df: DataFrame, n: int = 10, order_by: Sequence = ()) -> DataFrame:
    """First ``n`` rows; with ``order_by`` a distributed top-n, not a full sort."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def row_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All rows and the filled values of each column, in one scan: (name, rows)."""
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count(F.col(name)).alias(name) for name in columns]
    cells = ", ".join(f"'{name}', `{name}`" for name in ["rows", *columns])
    return df.agg(*counts).selectExpr(f"stack({len(columns) + 1}, {cells}) AS (name, rows)")


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows (position, name, type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
