"""Tables laid out by a key, so that joins on it move no rows."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import read_text, write_text

LAYOUT = "_layout.json"  # Spark reads no file whose name begins so


def _table_name(path: str) -> str:
    return f"cellscope_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, spread: Column | None = None) -> None:
    """Write Parquet in ``buckets`` files by the hash of ``key``, each sorted by it.

    Two tables with one number of buckets and one key type join on the key without a shuffle.
    The rows are dealt by the same hash first, so that each bucket is one file.  Rows without a
    key are dealt by ``spread`` instead (a column that differs between them): they all belong
    to one bucket, but no task has to write them all.  The layout is written beside the files;
    it counts only once it is there, after all of them.
    """
    spark, name = df.sparkSession, _table_name(path)
    place = F.col(key) if spread is None else F.coalesce(F.col(key), spread.cast(df.schema[key].dataType))
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: the files stay until they are written over
    (
        df.withColumn("__place", place).repartition(buckets, "__place").drop("__place")
        .write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # sessions differ: readers declare it from the layout
    write_text(spark, f"{path.rstrip('/')}/{LAYOUT}", json.dumps(
        {"key": key, "buckets": buckets, "schema": df.schema.json()}))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; with its buckets, if :func:`write_bucketed` has written it."""
    found = read_text(spark, f"{path.rstrip('/')}/{LAYOUT}")
    if found is None:
        return spark.read.parquet(path)
    layout, name = json.loads(found), _table_name(path)
    rows = spark.read.schema(_schema(layout["schema"])).parquet(path)
    columns = ", ".join(f"`{f.name}` {_type(f)}" for f in rows.schema.fields if _type(f))
    hidden = [f for f in rows.schema.fields if not _type(f)]
    if hidden:
        raise ValueError(f"{path}: a table in buckets cannot declare {[f.name for f in hidden]}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    key = layout["key"]
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}' "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {layout['buckets']} BUCKETS")
    return spark.table(name)


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


def _type(field) -> str:
    """The SQL name of a type; none for vectors, which SQL cannot declare."""
    kind = field.dataType.simpleString()
    return "" if kind == "vector" or "udt" in kind else kind
