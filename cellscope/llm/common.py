"""Expressions and steps shared by the corpus operators.

A document is known by its ``doc_id`` and its whole text: ids may be null or repeated, so
results are joined back on both, the text by its 64-bit hash.  Rows that agree in both get
the same result each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SPACE = r"[\x20\x09-\x0D]+"


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def whole_rows(docs: DataFrame, *more: Column | str) -> DataFrame:
    """The rows as one column ``_row`` beside what an operator needs, so that no names can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *more)


def unpacked(df: DataFrame, docs: DataFrame, *more: Column | str) -> DataFrame:
    """The columns of ``docs`` out of ``_row``, then ``more``, which replace columns of their names."""
    added = {c for c in df.select(*more).columns} if more else set()
    return df.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns if c not in added), *more)


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def seeded_order(seed: int, *columns: str) -> Column:
    """32 hex digits that depend on the seed and the columns only: the same in every run."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("\x00")) for name in columns]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts))


def null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[name].eqNullSafe(right[name]) for name in names))


def left_on(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join on keys that may be null; the keys of the right side are not returned."""
    found = right.select(*(F.col(name).alias(f"_r_{name}") for name in names),
                         *(c for c in right.columns if c not in names))
    same = reduce(lambda a, b: a & b,
                  (left[name].eqNullSafe(found[f"_r_{name}"]) for name in names))
    return left.join(found, same, "left").drop(*(f"_r_{name}" for name in names))


def running_before(
    df: DataFrame,
    sums: DataFrame,
    group: str,
    bucket: str,
    value: Column,
    order: Sequence[Column],
    name: str,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier rows of the row's group.

    ``sums`` has one row for each (group, bucket) with the column ``total``; it may come from
    a narrower scan than ``df``.  Buckets are ranges of the order, so that a group with a
    third of all rows is spread over many tasks: only its bucket totals meet in one.
    Further columns of ``sums`` are passed on.
    """
    earlier = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    inside = (
        Window.partitionBy(group, bucket).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.join(starts.drop("total"), [group, bucket])
        .withColumn(name, (F.col("_before") + F.sum(value).over(inside) - value).cast("long"))
        .drop("_before")
    )


def group_key(column: str) -> Column:
    """A key that is never null and keeps null apart from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def python_rows(docs: DataFrame) -> DataFrame:
    """doc_id as a string, which pandas keeps whole beside nulls, the text's hash and the text."""
    return docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("_th"),
        F.col("text").cast("string").alias("text"))


def typed_id(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The ids of ``python_rows`` in the type that they have in ``docs``."""
    return df.withColumn("doc_id", F.col("doc_id").cast(id_type(docs)))
