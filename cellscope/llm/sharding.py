"""Sharding by proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; rank r of n has the fraction
(2r + 1) / 2n.  Sorting all rows by that fraction interleaves the sources in proportion, so
equal cuts of the sorted rows all have the mixture of the whole.  Ranks and places come from
totals of hash ranges and fraction ranges: a source with a third of all rows is never sorted
in one task.  How many rows fall into a fraction range follows from the source's size alone,
so that no second pass over the rows is needed.

Defined cases: a null source is a source of its own, null texts count no bytes, repeated rows
are placed one by one, no rows give no rows.  Columns of the input with the names ``shard``,
``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import group_key, running_before, seeded_order, unpacked, whole_rows


def interleave(
    docs: DataFrame, shards: int = 40, seed: int = 42, ranges: int = 4096, stratum: str = "source",
    tie: Column | None = None,
) -> DataFrame:
    """Add ``shard`` (0 to shards - 1, row counts at most one apart) and ``slot`` (from 0).

    ``tie`` orders rows with one id; it is the text's hash unless ``docs`` has no text.
    """
    rows = whole_rows(
        docs, group_key(stratum).alias("_g"), seeded_order(seed, "doc_id").alias("_order"),
        (F.xxhash64("text") if tie is None else tie).alias("_tie"),
    ).withColumn("_bucket", F.substring("_order", 1, 3))
    totals = rows.groupBy("_g", "_bucket").agg(F.count("*").alias("total"))
    sizes = totals.groupBy("_g").agg(F.sum("total").alias("_n"))
    ranked = running_before(
        rows, totals.join(sizes, "_g"), "_g", "_bucket", F.lit(1),
        [F.col("_order"), F.col("_tie")], "_rank",
    )
    # rows of a source before the start of range b: those with (2r + 1) / 2n < b / ranges
    before = F.expr(f"(2 * _b * _n + {ranges} - 1) div {2 * ranges}")
    starts = (
        sizes.select("_n", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("_b"))
        .groupBy("_b").agg(F.sum(before).alias("_first"), F.sum("_n").alias("_all"))
    )
    place = Window.partitionBy("_b").orderBy("_part", "_g")
    placed = (
        ranked
        .withColumn("_b", F.expr(f"((2 * _rank + 1) * {ranges}) div (2 * _n)"))
        .withColumn("_part", (2 * F.col("_rank") + 1) / (2 * F.col("_n")))
        .join(starts, "_b")
        .withColumn("_p", F.col("_first") + F.row_number().over(place) - 1)
        .withColumn("shard", F.expr(f"(_p * {shards}) div _all").cast("int"))
        .withColumn("slot", F.expr(f"_p - (shard * _all + {shards} - 1) div {shards}").cast("long"))
    )
    return unpacked(placed, docs, "shard", "slot")
