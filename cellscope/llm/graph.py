"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the smallest node reachable.

    Every round hangs all neighbours of a node below the smallest of them, first the larger
    ones and then the smaller ones, so that chains halve; a round's edges are at most those of
    the one before plus its nodes.  Rounds are written to the shared folder and end when
    nothing changes.  A node with very many edges only meets its own minimum: that is a partial
    aggregate and a join that adaptive execution can split.
    """
    current = stage_table(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(smallest, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"),
        ).select("e.*").filter("a > b").distinct()
        current = stage_table(smaller, "edges")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
