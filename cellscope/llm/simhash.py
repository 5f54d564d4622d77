"""Near-duplicates by SimHash, found through deletion-variant signatures.

The 64 bits of a fingerprint are cut into 3 segments.  Of two fingerprints that differ in at
most 4 bits, one segment differs in at most one, so both have the same signature: that segment
without one of its bits.  Each fingerprint has 64 signatures; equal ones bring the candidates
together (an equality join, run as a grouping so that a group yields the links that hold it
together and not all its pairs), and each candidate is verified on all 64 bits.

Documents with one fingerprint are reduced to it before, so a group of copies is one row.
Signatures shared by more than ``limit`` different fingerprints are cut again in the same way
on the bits that they do not cover yet, so no group is held whole whatever its size; this
loses no link, since any two of its members still differ in at most 4 of those bits.

For very large tables ``segments`` and ``keyed`` make signatures longer: ``keyed`` of the
segments together differ in at most one bit if ``segments >= distance + keyed - 1``.  All
valid settings find exactly the same links.

Defined cases: null, empty and wordless texts have the fingerprint zero and link like any
other; the smallest id of a component ignores null ids; repeated rows share all results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import group_key, id_type, python_rows, typed_id, unpacked, whole_rows
from .graph import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
LEVEL_BITS = 10  # of a path, for the number of a signature within a level


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles, signed."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        hashes = [digest(line, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: 1 - SHINGLE].tolist()
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)]
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):  # bounds the bits that are unpacked at once
        block = np.array(hashes[i : i + 65_536], np.uint64).astype(">u8")
        count += np.unpackbits(block.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, fp) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "_th": batch["_th"],
                "fp": np.fromiter(map(fingerprint, batch["text"]), np.int64, len(batch))})

    return typed_id(python_rows(docs).mapInPandas(run, "doc_id string, _th long, fp long"), docs)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _cuts(free: list[int], segments: int, keyed: int) -> list[tuple[int, list[int]]]:
    """(mask of the bits covered, those bits) for every choice of ``keyed`` of the segments."""
    edges = [round(i * len(free) / segments) for i in range(segments + 1)]
    parts = [free[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [sorted(sum(some, [])) for some in combinations(parts, keyed)]
    return [(sum(1 << b for b in bits), bits) for bits in chosen if bits]


class _Level:
    """The signatures of one level: numbers, masks, and the bits left after each."""

    def __init__(self, before: list[tuple[int, int, list[int]]], segments: int, keyed: int):
        self.cover, self.variants = [], []
        for path, mask, free in before:
            number = 0
            for covered, bits in _cuts(free, segments, keyed):
                rest = [b for b in free if b not in bits]
                for bit in bits:
                    number += 1
                    own = (path << LEVEL_BITS) | number
                    self.variants.append((path, own, mask | covered & ~(1 << bit), rest))
                    self.cover.append((path, own, mask | covered, mask | covered & ~(1 << bit)))


def _near(distance: int):
    """Verified links among neighbours of equal signature, in sorted rows."""

    def grown(fps: np.ndarray) -> list[tuple[int, int]]:
        links, rest = [], np.arange(len(fps))
        while len(rest):
            reached, rest = [rest[0]], rest[1:]
            while reached:
                one = reached.pop()
                close = np.bitwise_count(fps[rest] ^ fps[one]) <= distance
                found, rest = rest[close], rest[~close]
                links += [(fps[one], fps[other]) for other in found]
                reached.extend(found)
        return links

    def linked(path: np.ndarray, bits: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
        change = np.flatnonzero((path[1:] != path[:-1]) | (bits[1:] != bits[:-1])) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        group = np.repeat(np.arange(len(starts)), sizes)
        small = np.repeat(sizes <= 8, sizes)
        left, right = [], []
        for step in range(1, min(8, len(fps))):
            at = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
            at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= distance]
            left.append(fps[at]), right.append(fps[at + step])
        for start, size in zip(starts[sizes > 8], sizes[sizes > 8], strict=True):
            links = grown(fps[start : start + size])
            if links:
                a, b = np.array(links, np.uint64).T
                left.append(a), right.append(b)
        if not left:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        pairs = np.stack([np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)], 1)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [np.empty(0, np.int64)] * 3
        for batch in batches:
            now = [np.concatenate([k, batch[c].to_numpy()]) for k, c in zip(kept, ("path", "bits", "fp"), strict=True)]
            path, bits, fps = now
            if not len(fps):
                continue
            whole = np.flatnonzero((path != path[-1]) | (bits != bits[-1]))
            cut = whole[-1] + 1 if len(whole) else 0
            kept = [x[cut:] for x in now]
            if cut:
                yield linked(path[:cut], bits[:cut], fps[:cut].view(np.uint64))
        if len(kept[2]):
            yield linked(kept[0], kept[1], kept[2].view(np.uint64))

    return run


def links(
    prints: DataFrame, distance: int = DISTANCE, segments: int = 3, keyed: int = 1, limit: int = 4096
) -> DataFrame:
    """(a, b) of fingerprints that differ in at most ``distance`` bits.

    ``prints`` has different fingerprints in ``fp``.  Inside a group of more than 8 the links
    that connect its members are returned instead of all pairs: components are the same.
    """
    fits = distance // segments <= 1 if keyed == 1 else segments >= distance + keyed - 1
    if not fits:
        raise ValueError("a pair could share no signature with this many segments")
    spark = prints.sparkSession
    rows, before, found = prints.select(F.lit(0).cast("long").alias("path"), "fp"), [(0, 0, list(range(64)))], []
    while True:
        level = _Level(before, segments, keyed)
        if not level.variants:
            break
        table = [(p, own, _signed(mask)) for p, own, mask, _ in level.variants]
        if len(before) == 1:
            pick = F.explode(F.array(*(F.struct(F.lit(own).cast("long").alias("path"), F.lit(mask).cast("long").alias("mask"))
                                       for _, own, mask in table)))
            signed = rows.select("fp", pick.alias("s")).select("s.*", "fp")
        else:
            masks = spark.createDataFrame(table, "path long, own long, mask long")
            signed = rows.join(masks, "path").select(F.col("own").alias("path"), "mask", "fp")
        signed = signed.select("path", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"), "fp")
        # a signature joins two values of the bits that it covers, one for each state of the bit left out
        cover = {}
        for p, own, covered, mask in level.cover:
            cover.setdefault((p, _signed(covered)), []).append((own, _signed(mask)))
        covers = spark.createDataFrame(
            [(p, covered, own) for (p, covered), own in cover.items()],
            "path long, covered long, own array<struct<path:long,mask:long>>")
        values = rows.join(covers, "path") if len(before) > 1 else rows.select(
            "path", "fp", F.explode(F.array(*(F.lit(c).cast("long") for _, c in cover))).alias("covered"))
        often = (
            values.groupBy("path", "covered", F.col("fp").bitwiseAND(F.col("covered")).alias("value"))
            .count().filter(F.col("count") > limit // 2)
            .join(covers.select("path", "covered", F.col("own").alias("_own")), ["path", "covered"])
            .select("value", F.explode("_own").alias("o"))
            .select("o.path", F.col("value").bitwiseAND(F.col("o.mask")).alias("bits")).distinct()
        )
        hot = stage_table(often, "hot-signatures")
        deeper = None
        last = max(len(free) for *_, free in level.variants) < segments or len(before) >= 2000
        if not last and not hot.isEmpty():
            deeper = signed.join(hot, ["path", "bits"], "left_semi").select("path", "fp")
            signed = signed.join(hot, ["path", "bits"], "left_anti")
        found.append(
            signed.repartition("path", "bits").sortWithinPartitions("path", "bits")
            .mapInPandas(_near(distance), "a long, b long"))
        if deeper is None:
            break
        wanted = {row[0] for row in hot.select("path").distinct().collect()}  # at most the level's signatures
        rows = stage_table(deeper, "hot-members")
        before = [(own, mask, free) for _, own, mask, free in level.variants if own in wanted]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.distinct()


SALTS = 8


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """Per document: doc_id, _th, fp, fingerprint (16 hex digits), component_id, group ``_root``."""
    marked = stage_table(fingerprints(docs), "fingerprints")
    prints = stage_table(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = stage_table(components(links(prints.select("fp"), **settings)), "components")
    grouped = (
        prints.join(roots, prints["fp"] == roots["node"], "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("_root"), F.col("root").isNotNull().alias("_linked"),
                F.pmod(F.xxhash64("fp"), F.lit(SALTS)).alias("_salt"))
    )
    # one id for each component of several fingerprints, met by its members in SALTS places; a merge
    # join, because there are the more components the more documents there are
    smallest = (
        grouped.filter("_linked").groupBy("_root").agg(F.min("least").alias("_smallest"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    )
    named = grouped.join(smallest.hint("merge"), ["_root", "_salt"], "left").select(
        "fp", "_root", F.coalesce("_smallest", "least").alias("component_id"))
    return (
        marked.join(named, "fp")
        .withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
        .withColumn("component_id", F.col("component_id").cast(id_type(docs)))
    )


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, the one with the smallest id (null last, then text hash).

    Only the ids and text hashes of the chosen meet the documents; equal rows are reduced to
    one by the same partitioning.
    """
    key = F.concat_ws(":", group_key("doc_id"), F.col("_th").cast("string"))
    chosen = (
        near_duplicates(docs, **settings)
        .groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("a"), "doc_id", "_th")).alias("best"))
        .select("best.doc_id", "best._th").select(key.alias("_key"))
    )
    chosen = stage_table(chosen.distinct(), "chosen-documents")
    keyed = whole_rows(docs, "doc_id", F.xxhash64("text").alias("_th")).select("_row", key.alias("_key"))
    return unpacked(keyed.join(chosen, "_key", "left_semi").dropDuplicates(["_key"]), docs)
