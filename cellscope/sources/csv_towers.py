"""CSV scan of raw towers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import TOWER_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def read_towers_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TOWER_SCHEMA,
    on_bad: str = "drop",
) -> DataFrame:
    """Read headed CSV files with an explicit schema.

    ``on_bad="drop"`` removes each row that is malformed in *any* column;
    ``on_bad="keep"`` keeps it and puts its text into ``_corrupt_record``.

    Spark parses only the columns a query uses, so by itself a bad row would
    come and go with the column list.  The row test below uses every column and
    is always true, which makes the scan parse whole rows for every query.  It
    needs no cache and no second copy of the input; filters still reach the
    scan.
    """
    reader = spark.read.option("header", True)
    if on_bad == "drop":
        rows = reader.schema(schema).option("mode", "DROPMALFORMED").csv(path)
    elif on_bad == "keep":
        wide = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        rows = (
            reader.schema(wide)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .csv(path)
        )
    else:
        raise ValueError(f"on_bad must be 'drop' or 'keep', not {on_bad!r}")
    whole_row = F.xxhash64(*[F.col(f"`{name}`") for name in schema.fieldNames()])
    return rows.filter(whole_row.bitwiseOR(F.lit(1)) != F.lit(0))
