"""Line dedup on content-defined chunks of lines.

A rolling hash over the hashes of the last ``window`` lines sets a boundary behind each line
where it is not divisible by ``spread``.  Boundaries depend on nearby lines only, so a block of
lines that is inserted or moved changes the boundaries at its edges and no others.  From every
boundary (and the start) a chunk goes to the first boundary at least two lines on, so chunks
overlap and none has a single line: a repeated run of lines needs but two common boundaries.
The lines of a chunk that occurs again anywhere are removed but for its first place in the order
(doc_id, null last; text hash; line).  Hashes only find the candidates: a chunk goes if its
bytes are those of the first.  A line that goes has an equal one earlier in the order, so the
earliest of them always stays, though it may have lost the neighbours of another chunk.

Defined cases: a null text has no lines and stays null; an empty text is one empty line and has
no chunk; a chunk without any word is never removed; repeated rows (equal id and text) count as
one document and get the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import HAS_WORD, left_on, unpacked, whole_rows

BASE = 1_000_003
MODULUS = 2_147_483_647


def _lines(start: Column, count: Column) -> Column:
    return F.slice("_lines", start + 1, count)


def chunked(docs: DataFrame, window: int = 2, spread: int = 4) -> DataFrame:
    """Add ``_lines`` and ``_chunks``: of each chunk the lines before it, ``place``, and its ``lines``."""
    hashes = F.transform("_lines", lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long"))

    def rolling(h, i):
        value = F.lit(0).cast("long")
        for back in range(window - 1, -1, -1):
            earlier = h if back == 0 else F.coalesce(F.get("_hash", i - back), F.lit(0).cast("long"))
            value = (value * F.lit(BASE) + earlier) % F.lit(MODULUS)
        return value

    cuts = F.filter(
        F.sequence(F.lit(0), F.size("_lines")),
        lambda i: (i == 0) | (i == F.size("_lines")) | (F.get("_roll", i - 1) % spread != 0),
    )
    following = lambda k, n: F.get("_cuts", k + n)
    spans = F.transform("_cuts", lambda cut, k: F.struct(
        cut.alias("place"),
        (F.when(following(k, 1) - cut >= 2, following(k, 1)).otherwise(following(k, 2)) - cut).alias("lines")))
    return (
        docs.withColumn("_lines", F.split("text", "\n", -1))
        .withColumn("_hash", hashes)
        .withColumn("_roll", F.transform("_hash", rolling))
        .withColumn("_cuts", cuts)
        .withColumn("_chunks", F.filter(spans, lambda c: c["lines"].isNotNull()))
        .drop("_hash", "_roll", "_cuts")
    )


def remove_repeated_chunks(docs: DataFrame, window: int = 2, spread: int = 4) -> DataFrame:
    """Replace ``text`` by what stays; add ``n_lines``, ``n_removed_lines`` and the same of chunks.

    First every chunk is a 128-bit hash and its place.  The first place of each hash that repeats
    is a minimum, formed in every task before it is shuffled.  Only chunks with such a hash are
    moved with their bytes, to be compared with those of the first place, in a join above which
    nothing needs the hash again: adaptive execution splits it where a third of the documents
    have one chunk.  Texts are cut anew after each join instead of being moved with their chunks.
    """
    rows = whole_rows(docs, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), "text")
    parts = stage_table(
        chunked(texts, window, spread)
        .select("_id", "_th", F.explode_outer(F.transform("_chunks", lambda c: F.struct(  # plain explode would add filters that repeat its input
            c["place"].alias("place"), c["lines"].alias("lines"),
            F.xxhash64(_lines(c["place"], c["lines"])).alias("h"),
            F.xxhash64(F.lit(1), _lines(c["place"], c["lines"])).alias("g"),
            F.exists(_lines(c["place"], c["lines"]), lambda x: x.rlike(HAS_WORD)).alias("worded")))).alias("_c"))
        .filter("_c.worded").select("_id", "_th", "_c.place", "_c.lines", "_c.h", "_c.g"),
        "line-chunks")
    order = F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"),
                     F.col("_th").alias("c"), F.col("place").alias("d"))
    often = stage_table(
        parts.groupBy("h", "g").agg(F.min(order).alias("first"), F.max(order).alias("last"))
        .filter("first != last").select("h", "g", "first"),
        "line-repeats")
    # the chunks of a document that may be repeats: no more than it has
    asked = parts.join(often, ["h", "g"]).groupBy("_id", "_th").agg(
        F.collect_set(F.struct("place", "lines", "h", "g", (order == F.col("first")).alias("is_first"))).alias("_asked"))
    wanted = [F.col(f"_t_{name}").eqNullSafe(F.col(name)) for name in ("_id", "_th")]
    bodies = stage_table(
        texts.select(F.col("_id").alias("_t__id"), F.col("_th").alias("_t__th"), "text")
        .join(asked, wanted[0] & wanted[1]).withColumn("_lines", F.split("text", "\n", -1))
        .select("_id", "_th", F.explode(F.transform("_asked", lambda a: F.struct(
            a.alias("a"), F.array_join(_lines(a["place"], a["lines"]), "\n").alias("body")))).alias("_b"))
        .select("_id", "_th", "_b.a.*", "_b.body"),
        "line-bodies")
    firsts = stage_table(
        bodies.filter("is_first").select("h", "g", F.col("body").alias("first_body")).dropDuplicates(["h", "g"]), "line-firsts")
    gone = (
        bodies.filter("NOT is_first").join(firsts, ["h", "g"]).filter("body = first_body")
        .groupBy("_id", "_th").agg(F.collect_set(F.struct("place", "lines")).alias("_found"))
    )
    numbers = F.flatten(F.transform("_gone", lambda c: F.sequence(c["place"] + 1, c["place"] + c["lines"])))
    cleaned = (
        chunked(left_on(rows, gone, ["_id", "_th"]).withColumn("text", F.col("_row.text")), window, spread)
        .withColumn("_gone", F.coalesce("_found", F.array().cast("array<struct<place:int,lines:int>>")))
        .withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0)).cast("long"))
        .withColumn("n_chunks", F.coalesce(F.size("_chunks"), F.lit(0)).cast("long"))
        .withColumn("_removed", F.array_distinct(numbers))
        .withColumn("n_removed_lines", F.size("_removed").cast("long"))
        .withColumn("n_removed_chunks", F.size("_gone").cast("long"))
        .withColumn("text", F.when(F.size("_gone") == 0, F.col("text")).otherwise(F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(1), F.size("_lines")), "_removed"), lambda i: F.get("_lines", i - 1)), "\n")))
    )
    return unpacked(cleaned, docs, "text", "n_lines", "n_chunks", "n_removed_lines", "n_removed_chunks")
