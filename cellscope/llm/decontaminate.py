"""Benchmark decontamination by winnowing.

Words are hashed, k consecutive words give a k-gram hash, and of every ``WINDOW - K + 1``
consecutive k-grams the smallest is kept as a fingerprint.  Two texts that share WINDOW words
share that stretch's smallest k-gram, so no shared span of WINDOW words or more is missed.
Fingerprints of documents and benchmark items are joined by equality, and each hit is extended
word by word in both texts; it counts if it reaches WINDOW words.  Items shorter than that are
one window of all their words and are looked up by the hash of that window.

Before the join the documents' fingerprints pass a bit table of fixed size made from the
benchmark's; its size does not depend on the tables, only how much it lets through.

Defined cases: null texts and texts without words have nothing to hit; null item ids count as
an item without a name in the list; repeated items count once; repeated documents (equal id and
text) get the same result each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import left_on, python_rows, typed_id, unpacked, whole_rows

WINDOW = 10
K = 5
SLOTS = 1 << 22  # bits of the table that the documents' fingerprints pass: 512 KB

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or b in _KEEP else 32 for b in range(256)
)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(WINDOW)], dtype=np.uint64)


def split_words(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only); every character beyond ASCII belongs to a word."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every n consecutive words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total += hashes[i : i + count] * _POWERS[i]
    return _mixed(total + np.uint64(n))


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of the k-grams that are smallest in some stretch of ``width`` of them."""
    count = len(grams) - width + 1
    if count <= 0:
        return np.empty(0, np.int64)
    least = grams[:count].copy()
    for i in range(1, width):
        np.minimum(least, grams[i : i + count], out=least)
    most = np.zeros(len(grams), np.uint64)
    for i in range(width):
        np.maximum(most[i : i + count], least, out=most[i : i + count])
    return np.flatnonzero(most == grams)


def _fingerprints(words: list[bytes], short: list[int], known: dict) -> list[tuple[int, int, int]]:
    """(length, place, hash): winnowed k-grams, and all windows of the short lengths asked for."""
    hashes = np.fromiter((known[w] for w in words), np.uint64, len(words))
    grams = gram_hashes(hashes, K)
    found = [(K, grams, winnow(grams, WINDOW - K + 1))]
    for n in short:
        grams = gram_hashes(hashes, n)
        found.append((-n, grams, np.arange(len(grams))))
    return found


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000:
            self[word] = value
        return value


def item_fingerprints(items: DataFrame) -> DataFrame:
    """(item_id, kind, place, h, words): ``kind`` is K, or minus the length of a short item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = split_words(text)
                short = len(words) < WINDOW
                for kind, grams, places in _fingerprints(words, [len(words)] if short and words else [], known):
                    rows += [(item, kind, int(p), int(grams[p].astype(np.int64)), " ".join(
                        w.decode("utf-8", "surrogatepass") for w in words))
                        for p in places if (kind < 0) == short]
            yield pd.DataFrame(rows, columns=["item_id", "kind", "place", "h", "words"])

    narrow = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return narrow.distinct().mapInPandas(run, "item_id string, kind int, place int, h long, words string")


def scan_documents(docs: DataFrame, table: np.ndarray, short: list[int]) -> DataFrame:
    """(doc_id, _th, n_words, hits) per document; a hit has the words around its fingerprint.

    ``table`` is the bit table, ``short`` the lengths of short items (at most WINDOW - 1).
    """
    bits = np.packbits(table)

    def passing(hashes: np.ndarray) -> np.ndarray:
        slot = (hashes % np.uint64(SLOTS)).astype(np.int64)
        return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for batch in batches:
            counts, hits = [], []
            for text in batch["text"]:
                words = split_words(text)
                counts.append(len(words))
                found = []
                for kind, grams, places in _fingerprints(words, short, known):
                    length = kind if kind > 0 else -kind
                    reach = WINDOW - length if kind > 0 else 0
                    for p in places[passing(grams[places])].tolist():
                        start = max(0, p - reach)
                        around = b" ".join(words[start : p + length + reach]).decode("utf-8", "surrogatepass")
                        found.append({"kind": kind, "place": p, "start": start,
                                      "h": int(grams[p].astype(np.int64)), "around": around})
                hits.append(found)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "_th": batch["_th"], "n_words": counts, "hits": hits})

    schema = "doc_id string, _th long, n_words long, hits array<struct<kind:int,place:int,start:int,h:long,around:string>>"
    return python_rows(docs).mapInPandas(run, schema)


def _extended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Compare the words on both sides of a hit; ``length`` is 0 where they do not suffice."""
    for batch in batches:
        starts, lengths = [], []
        for kind, place, start, around, item_place, item_words in zip(
            batch["kind"], batch["place"], batch["start"], batch["around"],
            batch["item_place"], batch["words"], strict=True,
        ):
            mine, theirs = around.split(" "), item_words.split(" ")
            size = abs(kind)
            at = place - start
            low, high = at, at + size
            if mine[low:high] != theirs[item_place : item_place + size]:
                starts.append(0), lengths.append(0)
                continue
            shift = item_place - at
            while low > 0 and low + shift > 0 and mine[low - 1] == theirs[low - 1 + shift]:
                low -= 1
            while high < len(mine) and high + shift < len(theirs) and mine[high] == theirs[high + shift]:
                high += 1
            enough = kind < 0 or high - low >= WINDOW
            starts.append(start + low), lengths.append(high - low if enough else 0)
        yield pd.DataFrame({"doc_id": batch["doc_id"], "_th": batch["_th"], "item_id": batch["item_id"],
                            "first": starts, "length": lengths})


def overlaps(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit words, n_items, items_sha256, contaminated."""
    prints = stage_table(item_fingerprints(items), "benchmark-prints")
    # both results are bounded by constants: the slots of the table, and WINDOW - 1 lengths
    slots = prints.select(F.pmod("h", F.lit(SLOTS)).cast("int").alias("slot")).distinct().toPandas()["slot"]
    short = sorted(-row[0] for row in prints.filter("kind < 0").select("kind").distinct().collect())
    table = np.zeros(SLOTS, bool)
    # h is stored signed: SLOTS is a power of two, so pmod agrees with the unsigned remainder
    table[slots.to_numpy(np.int64)] = True
    scanned = stage_table(scan_documents(docs, table, short), "document-prints")
    hits = scanned.select("doc_id", "_th", F.explode("hits").alias("hit")).select("doc_id", "_th", "hit.*")
    paired = hits.join(prints.withColumnRenamed("place", "item_place"), ["kind", "h"])
    spans = paired.select(
        "doc_id", "_th", "kind", "place", "start", "around", "item_id", "item_place", "words",
    ).mapInPandas(_extended, "doc_id string, _th long, item_id string, first int, length int").filter("length > 0")
    # distinct spans of a document, sorted; the words covered are counted from one end to the other
    # repeated benchmark text gives equal spans, which the set merges before they are moved
    covered = F.aggregate(
        F.array_sort("_spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["first"] + x["length"]).alias("end"),
            (s["n"] + F.greatest(x["first"] + x["length"] - F.greatest(s["end"], x["first"]), F.lit(0))).alias("n")),
        lambda s: s["n"],
    )
    found = (
        spans.groupBy("doc_id", "_th")
        .agg(F.collect_set(F.struct("first", "length")).alias("_spans"),
             F.array_sort(F.collect_set(F.coalesce("item_id", F.lit("")))).alias("_items"))
        .select("doc_id", "_th", covered.alias("_hit"), "_items")
    )
    items_found = F.coalesce("_items", F.array().cast("array<string>"))
    judged = (
        left_on(scanned.drop("hits"), found, ["doc_id", "_th"])
        .withColumn("n_hit", F.coalesce("_hit", F.lit(0).cast("long")))
        .withColumn("n_items", F.size(items_found).cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(items_found, ","), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("_hit", "_items")
    )
    return typed_id(judged, docs)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any word of a benchmark window, with their own columns."""
    hit = stage_table(
        overlaps(docs, items).filter("contaminated").select("doc_id", "_th").distinct(), "contaminated")
    keyed = whole_rows(docs, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    marks = hit.select(F.col("doc_id").alias("_mark"), F.col("_th").alias("_mark_th"))
    same = keyed["_id"].eqNullSafe(marks["_mark"]) & (keyed["_th"] == marks["_mark_th"])
    return unpacked(keyed.join(marks, same, "left_anti"), docs)
