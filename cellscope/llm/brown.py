"""LM scoring with a class-based bigram model (Brown classes, exchange clustering).

Text probability is the product over its tokens, the words and one end, of

    mix * P(class | class before) * P(word | class) + (1 - mix) * base(word)

where the end of the text before stands at the start and base is the smoothed unigram.  Every
training word belongs to a class.  The ``classed`` most frequent words come first: they are moved
between ``classes`` classes, each to where the class-bigram likelihood is largest given all
others, half of them per round, while other words stand in further classes by shape.  Then each
other training word, however rare, moves to the one of all these classes whose transitions give
the contexts of all its occurrences the largest likelihood; transitions stand still meanwhile, so
moving all these words at once cannot crowd a class that looked good only while it was empty.
All transitions are counted anew over the final classes and smoothed towards their frequencies.

Unknown words have a shape, known from the word alone.  What words seen once do tells what
unknown words of their shape do: how often one follows a class, and what follows it.  Their share
is taken from the known words by absolute discounting, the same part of a count from each.

All counts cover all training documents.  A word meets the contexts of its occurrences, a byte
for each neighbour's class, once per chunk (``chunks``); what reaches the driver is bounded by
``classed`` words and the square of the classes.

Defined cases: null and empty texts are one end token; a null id has the remainder 0 and is
held out; without training documents every token counts as unknown; repeated rows are scored
one by one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .chunks import pack, pack_documents, unpack
from .common import id_type

END = ""  # no word is empty
SHAPES = 24
ADD = 0.1
CHUNK_WORDS = 900_000  # larger chunks meet the join with fewer words, but one has to fit a task twice over
BLOCK_TOKENS = 200_000  # of documents that are scored at once
BLOCK_WORDS = 2048  # that are placed at once
HELD_ENTRIES = 2_000_000  # of placed words in a task, before they are dealt to their chunks


@dataclass(frozen=True)
class BrownConfig:
    classed: int = 2048
    classes: int = 64
    rounds: int = 4
    mix: float = 0.95
    prior: float = 20.0
    folds: int = 10


def held_out(doc_id: str | None, folds: int = 10, fold: int = 0) -> bool:
    return zlib.crc32((doc_id or "").encode()) % folds == fold


def tokens(text: str) -> list[bytes]:
    found = text.encode("utf-8", "surrogatepass").lower().split()
    found.append(b"")
    return found


def shape(word: str) -> int:
    """0 to SHAPES - 1: from digits, signs, letters beyond ASCII, and length; SHAPES for the end."""
    if word == END:
        return SHAPES
    length = 0 if len(word) <= 4 else 1 if len(word) <= 8 else 2
    digits = any(c.isdigit() for c in word)
    return length + 3 * (2 * (2 * digits + (not word.isalnum())) + (not word.isascii()))


def _index(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each word stands in ``known``, -1 for others."""
    return pc.fill_null(pc.index_in(words, known), -1).to_numpy(zero_copy_only=False)


class Units:
    """Numbers of what bigrams are counted over: classed words, shapes, the end."""

    def __init__(self, words: list[str]):
        self.words = words
        self.end = len(words) + SHAPES  # follows the shapes, as shape() numbers it
        self.size = self.end + 1

    def of(self, vocabulary, codes: np.ndarray) -> np.ndarray:
        found = _index(pa.array(vocabulary, pa.string()), pa.array(self.words, pa.string()))
        return np.where(found >= 0, found, len(self.words) + codes)


def _previous(lengths: np.ndarray, values: np.ndarray, end: int) -> np.ndarray:
    before = np.empty_like(values)
    before[1:] = values[:-1]
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    before[starts] = end
    return before


def _bigrams(packed: DataFrame, units: Units, folds: int) -> DataFrame:
    """(a, b, n): how often unit b follows unit a in the training documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths = unpack(row.lengths).astype(np.int64)
                now = units.of(row.vocabulary, unpack(row.codes))[unpack(row.numbers)]
                trains = np.repeat([not held_out(i, folds) for i in row.ids], lengths)
                code = _previous(lengths, now, units.end) * units.size + now
                code, n = np.unique(code[trains], return_counts=True)
                yield pd.DataFrame({"a": code // units.size, "b": code % units.size, "n": n})

    parts = packed.select("ids", "lengths", "numbers", "vocabulary", "codes").mapInPandas(run, "a int, b int, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _class_table(contexts: DataFrame, of_unit: np.ndarray, k: int) -> np.ndarray:
    """Class bigrams: k x k counts, summed over the units in every task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, k))
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.right is not None:
                    total[of_unit[row.unit]] += np.bincount(of_unit[row.right], row.right_n, minlength=k)
        a, b = np.nonzero(total)
        yield pd.DataFrame({"a": a, "b": b, "n": total[a, b]})

    table = np.zeros((k, k))
    for row in contexts.mapInPandas(run, "a int, b int, n double").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        table[row.a, row.b] = row.n
    return table


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _best_moves(contexts: DataFrame, of_unit: np.ndarray, table: np.ndarray, movable: int, classes: int, turn: int):
    """The class with the largest likelihood for every second movable unit."""
    k = len(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            moved = []
            for row in batch.itertuples(index=False):
                unit = row.unit
                if unit >= movable or unit % 2 != turn % 2:
                    continue
                right, left, own, here = np.zeros(k), np.zeros(k), 0.0, of_unit[unit]
                for side, near, often in ((right, row.right, row.right_n), (left, row.left, row.left_n)):
                    if near is not None:
                        near, often = np.asarray(near), np.asarray(often, float)
                        own = often[near == unit].sum() if (near == unit).any() else own
                        side += np.bincount(of_unit[near], often * (near != unit), minlength=k)
                rest = table.copy()
                rest[here] -= right
                rest[:, here] -= left
                rest[here, here] -= own
                # the neighbours' own totals stay, wherever the unit goes
                rows, cols, cell = table.sum(1), table.sum(0), np.diag(rest)
                rows[here] -= right.sum() + own
                cols[here] -= left.sum() + own
                by_row = _h(rest + right) - _h(rest)
                by_col = _h(rest + left[:, None]) - _h(rest)
                gain = by_row.sum(1) - np.diag(by_row) + by_col.sum(0) - np.diag(by_col)
                gain += _h(cell + right + left + own) - _h(cell)
                gain -= _h(rows + right.sum() + own) - _h(rows) + _h(cols + left.sum() + own) - _h(cols)
                best = int(np.argmax(gain[:classes]))
                if gain[best] > gain[here] + 1e-9:
                    moved.append((unit, best))
            yield pd.DataFrame(moved, columns=["unit", "best"])

    return contexts.mapInPandas(run, "unit int, best int").collect()


def exchange_classes(contexts: DataFrame, units: Units, config: BrownConfig) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigrams).  Shapes and the end have classes of their own."""
    movable, classes = len(units.words), config.classes
    of_unit = np.concatenate([np.arange(movable) % classes, classes + np.arange(SHAPES + 1)])
    k = classes + SHAPES + 1
    table = _class_table(contexts, of_unit, k)
    for turn in range(2 * config.rounds):
        moves = _best_moves(contexts, of_unit, table, movable, classes, turn)
        for unit, best in moves:
            of_unit[unit] = best
        table = _class_table(contexts, of_unit, k)
        if not moves and turn % 2:
            break
    return of_unit, table


def _entries(packed: DataFrame, units: Units, of_unit: np.ndarray, folds: int) -> DataFrame:
    """(word, chunk, place, near): each chunk's words with the classes around their training occurrences.

    ``near`` has the class before and the class after each occurrence, k where the neighbour is the
    word itself.  It is empty for words that have their class already.
    """
    k, first = int(of_unit[units.end]) + 1, len(units.words)
    kind = np.min_scalar_type(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("chunk", "ids", "lengths", "numbers", "codes")}
                vocabulary = batch.column("vocabulary").slice(i, 1).flatten()
                lengths, numbers = unpack(row["lengths"]).astype(np.int64), unpack(row["numbers"])
                unit = units.of(vocabulary, unpack(row["codes"]))
                now = of_unit[unit].astype(kind)[numbers]
                before = _previous(lengths, now, k - 1)
                trains = np.repeat([not held_out(i, folds) for i in row["ids"]], lengths)
                at = np.flatnonzero(trains & ((unit >= first) & (unit < units.end))[numbers])
                at = at[np.argsort(numbers[at], kind="stable")]
                own = numbers[at]
                near = np.empty((len(at), 2), kind)
                # a document ends with its end token, so no neighbour in another one is the word itself
                near[:, 0] = np.where(numbers[at - 1] == own, k, before[at])
                near[:, 1] = np.where(numbers[at + 1] == own, k, now[at + 1])
                size = len(vocabulary)
                ends = np.cumsum(np.bincount(own, minlength=size)) * near.itemsize * 2
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    vocabulary, pa.array(np.full(size, row["chunk"])), pa.array(np.arange(size, dtype=np.int32)),
                    pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(near.tobytes())]),
                ], names=["word", "chunk", "place", "near"])

    return packed.select("chunk", "ids", "lengths", "numbers", "vocabulary", "codes").mapInArrow(
        run, "word string, chunk long, place int, near binary")


def context_scores(table: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods of a neighbour's class (rows) before and after a word of each class but the end's.

    The last row of the second is for a neighbour that is the word itself.
    """
    k, rows, cols = len(table), table.sum(1), table.sum(0)
    n = rows.sum()
    before = np.log((table + prior * ((rows + 1) / (n + k))[:, None]) / (cols + prior))
    after = np.log((table + prior * (cols + 1) / (n + k)) / (rows + prior)[:, None]).T
    itself = np.diag(after) - np.log(cols + prior)
    return np.vstack([before, np.zeros(k)])[:, :-1], np.vstack([after, itself])[:, :-1]


def best_classes(owner: np.ndarray, near: np.ndarray, words: int, scores: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The class with the largest likelihood for each of ``words`` words.

    ``owner`` has the word of each occurrence, ``near`` the classes around it as in ``_entries``.
    Of likelihoods equal to six digits the lowest class is taken.
    """
    gain = 0
    for i, score in enumerate(scores):
        size = len(score)
        gain = gain + np.bincount(owner * size + near[:, i], minlength=words * size).reshape(words, size) @ score
    return np.argmax(np.round(gain, 6), axis=1)


def _place_words(entries: DataFrame, seeds: pd.DataFrame, table: np.ndarray, prior: float) -> DataFrame:
    """(chunk, place, seen, c): training counts and classes of a chunk's words, in some packed pieces per chunk.

    ``seeds`` has word, n and c of the words that are classed already.  Words without training
    occurrence have the class -1.
    """
    kind, scores = np.min_scalar_type(len(table)), context_scores(table, prior)

    def judged(rows: pa.Table, first: np.ndarray) -> tuple[np.ndarray, ...]:
        group = np.cumsum(first) - 1
        words = rows["word"].combine_chunks().filter(pa.array(first))
        seed = _index(words, pa.array(seeds["word"], pa.string()))
        near = rows["near"].to_pylist()
        often = np.fromiter(map(len, near), np.int64, len(near)) // (2 * kind.itemsize)
        near, owner = np.frombuffer(b"".join(near), kind).reshape(-1, 2), np.repeat(group, often)
        n = np.bincount(owner, minlength=len(words))
        c = np.empty(len(words), np.int64)
        for i in range(0, len(words), BLOCK_WORDS):
            j = min(i + BLOCK_WORDS, len(words))
            inside = slice(*np.searchsorted(owner, [i, j]))
            c[i:j] = best_classes(owner[inside] - i, near[inside], j - i, scores)
        c[n == 0] = -1
        known = seed >= 0
        n[known], c[known] = seeds["n"].to_numpy()[seed[known]], seeds["c"].to_numpy()[seed[known]]
        return rows["chunk"].to_numpy(), rows["place"].to_numpy(), n[group], c[group]

    def dealt(found: list) -> pa.RecordBatch:
        chunk, place, n, c = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((place, chunk))
        chunk, place, n, c = chunk[order], place[order], n[order], c[order]
        starts = np.flatnonzero(np.diff(chunk, prepend=-1))
        cut = [slice(i, j) for i, j in zip(starts, [*starts[1:], len(chunk)], strict=True)]
        return pa.RecordBatch.from_arrays([
            pa.array(chunk[starts]), pa.array([pack(np.diff(place[i], prepend=0)) for i in cut], pa.binary()),
            pa.array([pack(n[i].view(np.int32)) for i in cut], pa.binary()), pa.array([pack(c[i]) for i in cut], pa.binary()),
        ], names=["chunk", "place", "seen", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, found, size = None, [], 0
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            if not rows.num_rows:
                continue
            word = rows["word"].combine_chunks()
            first = np.concatenate([[True], pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)])
            last = int(np.flatnonzero(first)[-1])  # the last word may go on in the next batch
            if last:
                found.append(judged(rows[:last], first[:last]))
                size += last
            rest = rows[last:]
            if size >= HELD_ENTRIES:
                yield dealt(found)
                found, size = [], 0
        if rest is not None:
            first = np.zeros(rest.num_rows, bool)
            first[0] = True
            yield dealt([*found, judged(rest, first)])

    ordered = entries.repartition("word").sortWithinPartitions("word")
    return ordered.mapInArrow(run, "chunk long, place binary, seen binary, c binary")


def _blocks(starts: np.ndarray, size: int) -> Iterator[tuple[int, int, slice]]:
    """Documents in blocks, so that no array has a number for every token of a chunk."""
    edges = np.flatnonzero(np.diff(starts // BLOCK_TOKENS, prepend=-1)).tolist() + [len(starts)]
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        yield i, j, slice(starts[i], starts[j] if j < len(starts) else size)


def _class_chunks(packed: DataFrame, placed: DataFrame, config: BrownConfig) -> DataFrame:
    """Chunks with ``seen`` and ``kinds``, the class of each word, and their training class bigrams.

    ``cells`` numbers bigrams a * k + b.  The end's class is followed by those of unknown words, one
    for each shape: a bigram with a word seen once counts for its class, and once more for its shape
    there.  ``types`` counts an n-th for each of a word's n occurrences, one for each word in all.
    """
    folds, end = config.folds, config.classes + SHAPES
    k = end + 1 + SHAPES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths, numbers, codes = unpack(row.lengths).astype(np.int64), unpack(row.numbers), unpack(row.codes)
                seen, kinds = np.zeros(len(codes), np.int64), np.empty(len(codes), np.int32)
                for place, n, c in zip(row.place, row.seen, row.c, strict=True):
                    at = np.cumsum(unpack(place))
                    seen[at], kinds[at] = unpack(n).view(np.int64), unpack(c)
                unknown = np.where(codes < SHAPES, end + 1 + codes, end).astype(np.int32)
                kinds = np.where(kinds >= 0, kinds, unknown)
                once, trains = (seen == 1) & (codes < SHAPES), np.array([not held_out(i, folds) for i in row.ids])
                starts, total = np.cumsum(lengths) - lengths, np.zeros(k * k, np.int64)
                parts, types = np.where(codes < SHAPES, 1 / np.maximum(seen, 1), 0.0), np.zeros(k)
                for i, j, inside in _blocks(starts, len(numbers)):
                    learn = np.repeat(trains[i:j], lengths[i:j])
                    own = numbers[inside]
                    now, single, odd = kinds[own], once[own], unknown[own]
                    before, after_single = _previous(lengths[i:j], now, end), _previous(lengths[i:j], single, False)
                    odd_before = _previous(lengths[i:j], odd, end)
                    for a, b, which in (
                            (before, now, learn), (before, odd, learn & single), (odd_before, now, learn & after_single),
                            (odd_before, odd, learn & single & after_single)):
                        total += np.bincount(a[which] * k + b[which], minlength=k * k)
                    types += np.bincount(now[learn], parts[own[learn]], minlength=k)
                cells = np.flatnonzero(total)
                yield pd.DataFrame({
                    "ids": [row.ids], "lengths": [row.lengths], "numbers": [row.numbers],
                    "seen": [pack(seen.view(np.int32))], "kinds": [pack(kinds)],
                    "cells": [cells.tolist()], "cell_n": [total[cells].tolist()], "types": [types[: end + 1].tolist()]})

    pieces = placed.groupBy("chunk").agg(F.collect_list(F.struct("place", "seen", "c")).alias("p"))
    return packed.select("chunk", "ids", "lengths", "numbers", "codes").join(
        pieces.select("chunk", "p.place", "p.seen", "p.c"), "chunk").drop("chunk").mapInPandas(
        run, "ids array<string>, lengths binary, numbers binary, seen binary, kinds binary, cells array<int>, cell_n array<long>, types array<double>")


def _transitions(table: np.ndarray, taken: np.ndarray, config: BrownConfig) -> tuple[np.ndarray, np.ndarray]:
    """(probability of a class, or of an unknown word of a shape, after another; tokens of each class).

    ``taken`` is what unknown words take from the tokens of each class.
    """
    k, prior = config.classes + SHAPES + 1, config.prior  # unknown words come after
    n_class = table[:k, :k].sum(0)
    n, after = n_class.sum(), table[:, :k].sum(1, keepdims=True)
    unknown = (table[:k, k:].sum(0) + 0.5) / (n + SHAPES)
    unknown = (table[:, k:] + prior * unknown) / (after + prior)
    known = (table[:, :k] + prior * (n_class + 1) / (n + k)) * (1 - taken / np.maximum(n_class, 1))
    known *= (1 - unknown.sum(1, keepdims=True)) / known.sum(1, keepdims=True)
    return np.hstack([known, unknown]), n_class - taken


def score_documents(docs: DataFrame, config: BrownConfig | None = None) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    config = config or BrownConfig()
    folds, mix = config.folds, config.mix
    packed = pack_documents(
        docs.select("doc_id", "text"), "lm-chunks", words_of=tokens, row_extra=lambda doc_id, text: 0,
        trains=lambda doc_id: not held_out(doc_id, folds), code_of=shape, max_words=CHUNK_WORDS)
    weighed = packed.select(F.explode(F.arrays_zip("vocabulary", "weights")).alias("w")).select(
        F.col("w.vocabulary").alias("word"), F.col("w.weights").alias("n"))
    counts = stage_table(
        weighed.filter("n > 0").groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    is_word = F.col("word") != END
    total, types, ends, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(~is_word, F.col("n"))), F.lit(0)),
        F.count_if(is_word & (F.col("n") == 1)), F.count_if(is_word & (F.col("n") == 2))).first()
    frequent = counts.filter(is_word).orderBy(F.desc("n"), "word").limit(config.classed).collect()
    units = Units([row.word for row in frequent])
    grams = stage_table(_bigrams(packed, units, folds), "lm-bigrams")
    entries = lambda side: F.array_sort(F.collect_list(F.struct(side, "n")))
    rights = grams.groupBy(F.col("a").alias("unit")).agg(entries("b").alias("r"))
    lefts = grams.groupBy(F.col("b").alias("unit")).agg(entries("a").alias("l"))
    contexts = stage_table(
        rights.join(lefts, "unit", "full").select(
            "unit", F.col("r.b").alias("right"), F.col("r.n").alias("right_n"),
            F.col("l.a").alias("left"), F.col("l.n").alias("left_n")), "lm-contexts")
    of_unit, table = exchange_classes(contexts, units, config)

    seeds = pd.DataFrame({"word": units.words, "n": [row.n for row in frequent], "c": of_unit[: len(frequent)]})
    if ends:
        seeds.loc[len(seeds)] = [END, ends, of_unit[units.end]]
    seeds = seeds.astype({"n": "int64", "c": "int64"})
    placed = _place_words(_entries(packed, units, of_unit, folds), seeds, table, config.prior)
    chunks = stage_table(_class_chunks(packed, placed, config), "lm-classes")
    end = config.classes + SHAPES
    k = end + 1 + SHAPES
    table = np.zeros((k, k))
    cells = chunks.select(F.explode(F.arrays_zip("cells", "cell_n")).alias("e")).groupBy("e.cells").agg(F.sum("e.cell_n").alias("n"))
    for row in cells.collect():
        table[row.cells // k, row.cells % k] = row.n
    words = chunks.select(F.posexplode("types").alias("c", "types")).groupBy("c").agg(F.sum("types").alias("types"))
    types_of = np.zeros(end + 1)
    for row in words.collect():
        types_of[row.c] = round(row.types)
    discount = once / max(once + 2 * twice, 1)
    follows, left = _transitions(table, discount * types_of, config)
    floor = total + ADD * (types + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths, numbers = unpack(row.lengths).astype(np.int64), unpack(row.numbers)
                seen, kind = unpack(row.seen).view(np.int64), unpack(row.kinds)
                base = (seen + ADD) / floor
                less, of_class = np.where(kind < end, discount, 0), left[np.minimum(kind, end)]
                inside = np.where(seen > 0, (seen - less) / np.maximum(of_class, 1e-9), 1.0)
                starts = np.cumsum(lengths) - lengths  # every document has its end token
                kind, logs, known_word = kind.astype(np.int16), np.log10(base), seen > 0
                scores, plain, n_known = np.empty(len(starts)), np.empty(len(starts)), np.empty(len(starts), np.int64)
                for i, j, block in _blocks(starts, len(numbers)):
                    own = numbers[block]
                    now, at = kind[own], starts[i:j] - starts[i]
                    before = _previous(lengths[i:j], now, end)
                    each = follows[before, now]
                    each *= inside[own]
                    each *= mix
                    each += (1 - mix) * base[own]
                    scores[i:j] = np.add.reduceat(np.log10(each, out=each), at)
                    plain[i:j] = np.add.reduceat(logs[own], at)
                    n_known[i:j] = np.add.reduceat(known_word[own].astype(np.int64), at)
                yield pd.DataFrame({
                    "doc_id": row.ids, "held_out": [held_out(i, folds) for i in row.ids], "n_tokens": lengths,
                    "n_known": n_known, "train_tokens": total, "base_score": plain, "score": scores})

    scored = chunks.select("ids", "lengths", "numbers", "seen", "kinds").mapInPandas(
        run, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("doc_id", F.col("doc_id").cast(id_type(docs))).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
