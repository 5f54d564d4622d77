"""Trie of conversation prefixes, screened by a count-min sketch.

Every prefix of a conversation has a digest.  A count-min sketch of all digests never counts
too little, so an estimate of one proves that a prefix occurs once; all longer prefixes of
that conversation do so too.  Such tails become nodes where they stand.  Only prefixes that
may be shared are shuffled and grouped exactly.

A digest is the XOR of two 64-bit hashes of (position, turn), so that a very long conversation
is summed in ranges of positions by many tasks.  Groups are checked: all members of a node
must have the same parent digest, hence the same last turn, hence by induction the same turns.
The sketch has a fixed size (``rows`` x ``cells``); beyond it fewer tails are found and more
prefixes are grouped, with the same result.

Sums over a subtree need no walk down the tree.  A node is counted for its smallest member;
that conversation is a member of all nodes above, so a node's subtree is the sum over its
members of what is counted for them, less what their smallest one counts above the node.

Defined cases: rows without conv_id belong to no conversation and are left out; a null role or
text is empty; turns are ordered by ``turn`` (null first), equal ones by the hash of role and
text; repeated rows are turns of their own; other columns are ignored; no rows give no nodes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import running_before, word_count

RANGE = 1024  # positions in one range of a conversation
IDS = 8192  # ids in one segment of a node's list
BLOCK = 1 << 16  # cells that travel as one row
KEY = ["i", "h1", "h2"]
NO_TURN = -(1 << 63)


# --- turns ------------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(c, pos, t, words): each turn with its place from 1, the digest of role and text, its words.

    Places are counted per range of ``turn``, so no task needs to see a whole conversation.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn"),
        F.coalesce(F.floor(F.col("turn") / RANGE).cast("long"), F.lit(NO_TURN)).alias("range"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("t"),
        word_count(text).alias("words"))
    sizes = turns.groupBy("c", "range").agg(F.count("*").alias("total"))
    order = [F.col("turn").asc_nulls_first(), F.col("t")]
    placed = running_before(turns, sizes, "c", "range", F.lit(1), order, "before")
    return stage_table(placed.select("c", (F.col("before") + 1).alias("pos"), "t", "words"), "turns")


def plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (their ids, their turns at place ``i``)."""
    return turns.select("c").distinct(), turns.select("c", F.col("pos").alias("i"), "t", "words")


def branched(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one, as branches of a common start.

    Conversation c takes its first h turns from conversation c - c % family (all if that has
    fewer, none if there is no such) and then goes on with its own after its first h, where
    h = crc32(c) % most.
    """
    head = turns.filter((F.col("pos") < most) & (F.col("c") % family == 0))
    heads = head.groupBy(F.col("c").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "t", "words"))).alias("head"))  # fewer than ``most`` turns
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("int")
    ids = (
        turns.select("c").distinct()
        .withColumn("base", F.col("c") - F.col("c") % family)
        .join(heads, "base", "left")
        .select("c", h.alias("h"), F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, h).alias("head"))
    )
    taken = ids.select("c", F.posexplode("head").alias("at", "turn")).select(
        "c", (F.col("at") + 1).cast("long").alias("i"), "turn.t", "turn.words")
    own = turns.join(ids.select("c", "h", F.size("head").alias("m")), "c").filter("pos > h").select(
        "c", (F.col("pos") - F.col("h") + F.col("m")).alias("i"), "t", "words")
    return ids.select("c"), taken.unionByName(own)


def prefixes(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per conversation and prefix, the empty one too.

    (c, i, h1, h2): conversation, length and digest; (p1, p2): digest without the last turn;
    words: of the last turn; last: whether it is the whole conversation.
    """
    lane = lambda seed: F.xxhash64(F.lit(seed), F.col("i"), F.col("t"))
    none = F.lit(0).cast("long")
    rows = (
        ids.select("c", none.alias("i"), none.alias("l1"), none.alias("l2"), none.alias("words"))
        .unionByName(turns.select("c", "i", lane(1).alias("l1"), lane(2).alias("l2"), "words"))
        .withColumn("range", F.floor(F.col("i") / RANGE))
    )
    sums = rows.groupBy("c", "range").agg(
        F.bit_xor("l1").alias("x1"), F.bit_xor("l2").alias("x2"), F.max("i").alias("top"))
    whole = Window.partitionBy("c")
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "c", "range", F.coalesce(F.bit_xor("x1").over(earlier), none).alias("x1"),
        F.coalesce(F.bit_xor("x2").over(earlier), none).alias("x2"), F.max("top").over(whole).alias("top"))
    inside = Window.partitionBy("c", "range").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    digest = lambda n: F.col(f"x{n}").bitwiseXOR(F.bit_xor(f"l{n}").over(inside))
    done = rows.join(starts, ["c", "range"]).withColumns({"h1": digest(1), "h2": digest(2)})
    return stage_table(done.select(
        "c", "i", "h1", "h2", F.col("h1").bitwiseXOR(F.col("l1")).alias("p1"), F.col("h2").bitwiseXOR(F.col("l2")).alias("p2"),
        "words", (F.col("i") == F.col("top")).alias("last")), "prefixes")


# --- screening --------------------------------------------------------------------


def _places(i, h1, h2, row: int, cells: int) -> np.ndarray:
    """The cell of each digest in one row of the sketch."""
    with np.errstate(over="ignore"):
        x = np.asarray(h1, np.int64).view(np.uint64) ^ (np.asarray(i, np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x = x + np.asarray(h2, np.int64).view(np.uint64) * np.uint64(2 * row + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(cells)).astype(np.int64)


def shared_cells(rows: DataFrame, sketch_rows: int, cells: int) -> np.ndarray:
    """For every cell of the count-min sketch, whether its count is two or more.

    More is not asked of it, so counts stop at two.  Tasks send their sketch in blocks, each
    of which is added up in one place; what reaches the driver is ``sketch_rows * cells`` bits.
    """
    blocks = cells // BLOCK

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((sketch_rows, cells), np.uint8)
        for batch in batches:
            for row in range(sketch_rows):
                at, often = np.unique(_places(batch["i"], batch["h1"], batch["h2"], row, cells), return_counts=True)
                table[row, at] = np.minimum(table[row, at] + np.minimum(often, 2), 2)
        for row in range(sketch_rows):
            for block in range(blocks):
                part = table[row, block * BLOCK : (block + 1) * BLOCK]
                if part.any():
                    yield pd.DataFrame({"row": [row], "block": [block], "counts": [zlib.compress(part.tobytes(), 1)]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}  # blocks of one partition
        for batch in batches:
            for row, block, counts in batch.itertuples(index=False):
                part = np.frombuffer(zlib.decompress(counts), np.uint8)
                known = sums.get((row, block))
                sums[row, block] = part if known is None else np.minimum(known + part, 2)
        for (row, block), part in sums.items():
            yield pd.DataFrame({"row": [row], "block": [block], "bits": [np.packbits(part > 1).tobytes()]})

    parts = rows.select("i", "h1", "h2").mapInPandas(count, "row int, block int, counts binary")
    bits = np.zeros((sketch_rows, blocks, BLOCK // 8), np.uint8)
    for row in parts.repartition("row", "block").mapInPandas(add, "row int, block int, bits binary").collect():
        bits[row["row"], row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(sketch_rows, cells // 8)


def screened(rows: DataFrame, sketch_rows: int = 4, cells: int = 1 << 22) -> DataFrame:
    """Add ``single`` and ``above_single``: the sketch proves that the prefix, or its parent, occurs once."""
    bits = rows.sparkSession.sparkContext.broadcast(shared_cells(rows, sketch_rows, cells))

    def prove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = bits.value

        def once(i, h1, h2) -> np.ndarray:
            proven = np.zeros(len(i), bool)
            for row in range(sketch_rows):
                at = _places(i, h1, h2, row, cells)
                proven |= (table[row, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 0
            return proven

        for batch in batches:
            i = batch["i"].to_numpy()
            yield batch.assign(
                single=once(i, batch["h1"], batch["h2"]), above_single=(i > 0) & once(i - 1, batch["p1"], batch["p2"]))

    schema = "c long, i long, h1 long, h2 long, p1 long, p2 long, words long, last boolean, single boolean, above_single boolean"
    return stage_table(rows.mapInPandas(prove, schema), "screened")


# --- nodes ------------------------------------------------------------------------


def list_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, c): SHA-256 of each key's ids in order, comma-joined.

    Ids are joined to segments of a bounded range first.  The segments of a key stream through
    the hash one after the other: nothing of a long list is kept.
    """
    segments = ends.groupBy(*KEY, F.floor(F.col("c") / IDS).alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            done = []
            for i, h1, h2, ids in batch.itertuples(index=False):
                if key != (i, h1, h2):
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (i, h1, h2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    return (
        segments.repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "ids")
        .mapInPandas(run, "i long, h1 long, h2 long, ends_sha256 string"))


def _exact(shared: DataFrame) -> DataFrame:
    """Nodes of the prefixes that may be shared, each checked to hold equal turns only."""
    mixed = (F.min("p1") != F.max("p1")) | (F.min("p2") != F.max("p2"))
    words = F.when(mixed, F.raise_error(F.lit("two prefixes have one digest")).cast("long")).otherwise(F.max("words"))
    return stage_table(shared.groupBy(*KEY).agg(
        F.min("c").alias("conv"), F.count("*").alias("n"), words.alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.bool_or("above_single").alias("above_single"),
        F.count_if("last").alias("n_ends")), "nodes")


def trie(ids: DataFrame, turns: DataFrame, sketch_rows: int = 4, cells: int = 1 << 22) -> DataFrame:
    """One row per node of the trie of ``turns`` (c, i, t, words) of the conversations ``ids`` (c).

    conv_id: the smallest member; depth; parent_conv_id; n_convs: members; n_children; n_leaves
    and saved_tokens over the subtree; ends_sha256: of the members that end in the node.
    """
    rows = screened(prefixes(ids, turns), sketch_rows, cells)
    shared, tails = rows.filter("NOT single"), rows.filter("single")
    nodes = _exact(shared)
    above = [(F.col("i") - 1).alias("i"), F.col("p1").alias("h1"), F.col("p2").alias("h2")]
    grouped_parent = "i > 0 AND NOT above_single"  # its parent is among ``nodes``
    children = (
        nodes.filter(grouped_parent).select(*above).unionByName(tails.filter(grouped_parent).select(*above))
        .groupBy(*KEY).agg(F.count("*").alias("n_children")))
    saving = (F.col("n") - 1) * F.col("words")
    upper = Window.partitionBy("conv").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    full = (
        nodes.withColumn("counted_above", F.coalesce(F.sum(saving).over(upper), F.lit(0)))
        .join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    counted = (
        full.select(F.col("conv").alias("c"), saving.alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf"))
        .unionByName(tails.filter("last").select("c", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaf")))
        .groupBy("c").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf")))
    below = shared.select("c", *KEY).join(counted, "c").groupBy(*KEY).agg(
        F.sum("saved").alias("counted"), F.sum("leaf").alias("n_leaves"))
    parents = nodes.select(
        (F.col("i") + 1).alias("i"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv").alias("parent"))
    no_ends = F.sha2(F.lit("").cast("binary"), 256)

    def columns(conv: Column, **more: Column) -> list[Column]:
        parent = F.when(F.col("i") == 0, F.lit(None)).when(F.col("above_single"), conv).otherwise(F.col("parent"))
        return [conv.alias("conv_id"), F.col("i").alias("depth"), parent.alias("parent_conv_id"),
                *(value.alias(name) for name, value in more.items())]

    grouped = (
        full.join(below, KEY, "left").join(list_digests(shared.filter("last").select(*KEY, "c")), KEY, "left")
        .join(parents, ["i", "p1", "p2"], "left")
        .select(*columns(
            F.col("conv"), n_convs=F.col("n"), n_children=F.col("n_children"), n_leaves=F.coalesce("n_leaves", F.lit(0)),
            saved_tokens=F.coalesce("counted", F.lit(0)) - F.col("counted_above"), ends_sha256=F.coalesce("ends_sha256", no_ends))))
    one = F.lit(1).cast("long")
    alone = columns(
        F.col("c"), n_convs=one, n_children=(~F.col("last")).cast("long"), n_leaves=one, saved_tokens=F.lit(0).cast("long"),
        ends_sha256=F.when(F.col("last"), F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(no_ends))
    first = tails.filter(grouped_parent).join(parents, ["i", "p1", "p2"]).select(*alone)
    rest = tails.filter(f"NOT ({grouped_parent})").withColumn("parent", F.lit(None).cast("long")).select(*alone)
    return grouped.unionByName(first).unionByName(rest)


def prefix_trie(
    conversations: DataFrame, arrange: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = plain, **sketch: int,
) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text); ``arrange`` may rebuild them first."""
    return trie(*arrange(numbered_turns(conversations)), **sketch)
