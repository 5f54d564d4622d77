"""Which tokens of two tokenizers stand for the same bytes, counted over the corpus.

Both tokenizers encode a text; byte offsets at which tokens of both end cut it into groups, and
within a group every token of one side is linked to every token of the other.  The number of
documents that hold an id pair is counted over the whole corpus by external spill counting:

1. Documents are packed into chunks.  A chunk keeps, per document, its pairs as numbers into
   the chunk's sorted list of pairs.  That list, with the number of documents of each pair in
   the chunk, leaves as zstd runs, one per radix of the first side's id.
2. The runs of a radix meet in one task.  A heap merges them by the first side's id; all pairs
   of an id are counted together, so its highest count is known when it leaves the heap, and
   each run gets its pairs' counts back in its own order, as a zstd run again.
3. Those contributions return to the chunks, where they are summed over the documents' links.

A document's pair never moves by itself: a pair that all documents have is one entry per
chunk.  Spark's shuffle files are the spill, so a lost executor costs what it had to do and no
more.  A merge task holds (chunks x pairs of a chunk) / ``radixes`` entries: ``radixes`` is to
grow with the corpus, up to one per id of the first side.

Long texts are encoded in pieces that end where both tokenizers always cut: between a
character that is not white space and a single space with such a character behind it.  Groups
of many tokens are counted by their different ids, not link by link.

Defined cases: null and empty texts, and texts whose tokens do not give back their bytes on
both sides, have no tokens and no groups; repeated rows are documents of their own, null ids
stay null; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import id_type, python_rows

CHUNK_TOKENS = 1_500_000
RADIXES = 256
PIECE_CHARS = 1 << 16  # longer texts are encoded in pieces
BATCH_CHARS = 1 << 18  # of text that is encoded at once
LARGE_GROUP = 4096  # links from which a group is counted by its different ids

CHUNK = (
    "chunk long, ids array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, lengths binary, pairs binary, often binary, runs array<struct<radix: int, data: binary>>")
RESULT = (
    "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

CUT = re.compile(r"(?<=\S) (?=\S)")
# Characters for which two regular expression libraries cannot differ: assigned long ago, and no odd white space.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏΑ-ΡΣ-ώА-я‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]*")


# --- numbers ----------------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """zstd of whole numbers that are not negative: all lowest bytes first, as many planes as needed."""
    import zstandard

    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def stretch(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(np.int64).reshape(-1)


def differences(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rising numbers as steps; those at ``starts`` stay whole."""
    steps = np.diff(values, prepend=0)
    steps[starts] = values[starts]
    return steps


def from_differences(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.cumsum(steps)
    starts = np.cumsum(lengths) - lengths
    before = np.where(starts > 0, total[np.maximum(starts, 1) - 1], 0) if len(total) else np.zeros(len(starts), np.int64)
    return total - np.repeat(before, lengths)


# --- tokenizers -------------------------------------------------------------------


class Bytewise:
    """A byte-level BPE file of the tokenizers library, for texts with a space before them.

    Where its merges are in the order of their ids, texts of ordinary characters are encoded by
    tiktoken, which makes the same tokens faster; others by the library itself.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.tokens = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for piece, number in vocabulary.items():
            self.tokens[number] = bytes(letters[letter] for letter in piece)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]
        singles = len(vocabulary) - len(merges)
        in_order = singles == 256 and all(vocabulary["".join(m)] == singles + k for k, m in enumerate(merges))
        splits = parts["pre_tokenizer"] or {}
        if in_order and splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not parts["normalizer"]:
            assert isinstance(self.library.pre_tokenizer, pre_tokenizers.ByteLevel)
            # fixed value: the split pattern that the library's ByteLevel has built in
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            ranks = {token: number for number, token in enumerate(self.tokens) if token}
            self.quick = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        else:
            self.quick = None

    def encode(self, texts: list[str]) -> list[Sequence[int]]:
        texts = [f" {text}" for text in texts]
        plain = [self.quick is not None and PLAIN.fullmatch(text) is not None for text in texts]
        rest = iter(self.library.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [self.quick.encode_ordinary(t) if p else next(rest).ids for t, p in zip(texts, plain, strict=True)]


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level files write for each byte: itself if it prints, else one from 256 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printing]
    return {chr(byte): byte for byte in printing} | {chr(256 + k): byte for k, byte in enumerate(others)}


class Piecewise:
    """A sentencepiece file; it puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(number) for number in range(self.library.get_piece_size())]
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.library.is_byte(number) else piece.replace("▁", " ").encode()
            for number, piece in enumerate(pieces)]
        # a piece with a space behind another character could reach over the end of a piece of text
        self.cuts = not any("▁" in piece.lstrip("▁") for piece in pieces)

    def encode(self, texts: list[str]) -> list[Sequence[int]]:
        return self.library.encode(texts, num_threads=1)


_loaded: dict = {}  # filled in tasks only: what the driver holds would travel with the functions


def _sides(path_a: str, path_b: str):
    """Both tokenizers, the bytes of their tokens, and the texts of their ids with what may follow them."""
    if (path_a, path_b) not in _loaded:
        a, b = Bytewise(path_a), Piecewise(path_b)
        sizes = [np.array([len(token) for token in side.tokens], np.int64) for side in (a, b)]
        names = [
            [[f"{number}{end}" for number in range(len(side.tokens))] for end in ends]
            for side, ends in ((a, ",|"), (b, ",;"))]
        _loaded[path_a, path_b] = a, b, sizes, names
    return _loaded[path_a, path_b]


def pieces_of(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text cut at single spaces after every ``size`` characters or more, without those spaces."""
    pieces, start = [], 0
    while len(text) - start > size:
        cut = CUT.search(text, start + size)
        if not cut:
            break
        pieces.append(text[start : cut.start()])
        start = cut.end()
    return [*pieces, text[start:]]


def encoded(texts: list[str], path_a: str, path_b: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Both sides' ids of each text; none where the bytes of either side are not those of the text."""
    a, b, _, _ = _sides(path_a, path_b)
    parts = [pieces_of(text) if a.quick and b.cuts else [text] for text in texts]
    flat = [part for own in parts for part in own]
    none = np.empty(0, np.int64)
    sides = (iter(a.encode(flat)), iter(b.encode(flat)))
    found = []
    for text, own in zip(texts, parts, strict=True):
        wanted = f" {text}".encode()
        ids = [np.concatenate([np.asarray(next(side), np.int64) for _ in own]) for side in sides]
        whole = all(b"".join(map(side.tokens.__getitem__, part.tolist())) == wanted for side, part in zip((a, b), ids, strict=True))
        found.append(tuple(ids) if whole and text else (none, none))
    return found


# --- one document -----------------------------------------------------------------


def align(a: np.ndarray, b: np.ndarray, sizes) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of both sides, and how many groups there are."""
    ends_a, ends_b = np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b])
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(common, ends_a), np.searchsorted(common, ends_b), len(common)


def linked(a, b, of_a, of_b, n_groups: int, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(different pairs as a * width + b in rising order, their links, all links) of a document."""
    in_a, in_b = np.bincount(of_a, minlength=n_groups), np.bincount(of_b, minlength=n_groups)
    large = np.flatnonzero(in_a * in_b > LARGE_GROUP)
    each = np.where(np.isin(of_a, large), 0, in_b[of_a]) if len(large) else in_b[of_a]
    first_b = (np.cumsum(in_b) - in_b)[of_a]
    rows = np.repeat(np.arange(len(a)), each)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(each) - each, each)
    codes, links = np.unique(a[rows] * width + b[first_b[rows] + place], return_counts=True)
    parts = [(codes, links)]
    for group in large:
        (ids_a, n_a), (ids_b, n_b) = (
            np.unique(side[np.searchsorted(of, group) : np.searchsorted(of, group, "right")], return_counts=True)
            for side, of in ((a, of_a), (b, of_b)))
        parts.append(((ids_a[:, None] * width + ids_b).ravel(), (n_a[:, None] * n_b).ravel()))
    if len(parts) > 1:
        codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        links = np.zeros(len(codes), np.int64)
        np.add.at(links, inverse, np.concatenate([n for _, n in parts]))
    return codes, links, int((in_a * in_b).sum())


def groups_text(a, b, of_a, of_b, names) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
    end_a, end_b = (np.append(of[1:] != of[:-1], True) for of in (of_a, of_b))
    side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
    order = np.lexsort((side, np.concatenate([of_a, of_b])))
    ids, ends = np.concatenate([a, b])[order].tolist(), np.concatenate([end_a, end_b])[order].tolist()
    return "".join([names[s][e][i] for s, e, i in zip(side[order].tolist(), ends, ids, strict=True)])[:-1]


# --- chunks, merge, contributions -------------------------------------------------


def radix_order(codes: np.ndarray, width: int, radixes: int) -> np.ndarray:
    """Pairs with the radix of their first id in front, so that they sort by it."""
    a, b = np.divmod(codes, width)
    return (((a % radixes) << 32) + a // radixes) * width + b


def packed_chunks(docs: DataFrame, path_a: str, path_b: str, radixes: int, chunk_tokens: int) -> DataFrame:
    """Chunks of documents (CHUNK), staged in the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, side_b, sizes, names = _sides(path_a, path_b)
        width = len(side_b.tokens)
        part, serial, total, rows = TaskContext.get().partitionId(), 0, 0, []

        def finished() -> pd.DataFrame:
            codes = np.concatenate([row[7] for row in rows])
            known, numbers, docs_with = np.unique(codes, return_inverse=True, return_counts=True)
            lengths = np.array([len(row[7]) for row in rows], np.int64)
            starts = (np.cumsum(lengths) - lengths)[lengths > 0]
            high = known // (width << 32)
            edges = np.append(np.flatnonzero(np.diff(high, prepend=-1)), len(known))
            runs = [
                {"radix": int(high[i]), "data": _run(known[i:j], docs_with[i:j])}
                for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            columns = {
                name: [[row[k] for row in rows]] for k, name in enumerate(("ids", "n_a", "n_b", "n_groups", "n_links", "groups"))}
            return pd.DataFrame({
                "chunk": [(part << 32) + serial], **columns, "lengths": [squeeze(lengths)],
                "pairs": [squeeze(differences(numbers.reshape(-1), starts))],
                "often": [squeeze(np.concatenate([row[6] for row in rows]))], "runs": [runs]})

        def add(ids: list, texts: list[str]) -> int:
            tokens = 0
            for doc_id, (a, b) in zip(ids, encoded(texts, path_a, path_b), strict=True):
                of_a, of_b, n_groups = align(a, b, sizes)
                codes, links, n_links = linked(a, b, of_a, of_b, n_groups, width)
                codes = radix_order(codes, width, radixes)
                order = np.argsort(codes)
                digest = hashlib.sha256(groups_text(a, b, of_a, of_b, names).encode()).hexdigest() if len(a) else ""
                rows.append((doc_id, len(a), len(b), n_groups, n_links, digest, links[order], codes[order]))
                tokens += len(a)
            return tokens

        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(doc_id if isinstance(doc_id, str) else None)
                texts.append(text if isinstance(text, str) else "")
                chars += len(texts[-1])
                if chars >= BATCH_CHARS:
                    total += add(ids, texts)
                    ids, texts, chars = [], [], 0
                    if total >= chunk_tokens:
                        yield finished()
                        serial, total = serial + 1, 0
                        rows.clear()
        add(ids, texts)
        if rows:
            yield finished()

    return stage_table(python_rows(docs).drop("_th").mapInPandas(run, CHUNK), "alignment-chunks")


def _run(codes: np.ndarray, docs_with: np.ndarray) -> bytes:
    first, second = squeeze(differences(codes, np.array([0]))), squeeze(docs_with)
    return len(first).to_bytes(4, "big") + first + second


def _from_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    middle = 4 + int.from_bytes(data[:4], "big")
    return np.cumsum(stretch(data[4:middle])), stretch(data[middle:])


def merged(runs: list[tuple[np.ndarray, np.ndarray]], width: int) -> list[np.ndarray]:
    """Per run, for each of its pairs: twice the pair's count, plus one if no pair of its first id has more.

    A heap holds the next first id of each run.
    """
    back = [np.empty(len(codes), np.int64) for codes, _ in runs]
    edges = []
    for codes, _ in runs:
        first = codes // width
        edges.append(np.append(np.flatnonzero(np.diff(first, prepend=-1)), len(codes)).tolist())
    heap = [(int(codes[0]) // width, run, 0) for run, (codes, _) in enumerate(runs) if len(codes)]
    heapq.heapify(heap)
    while heap:
        first, parts = heap[0][0], []
        while heap and heap[0][0] == first:
            _, run, place = heap[0]
            start, end = edges[run][place], edges[run][place + 1]
            parts.append((run, start, end))
            if end < len(runs[run][0]):
                heapq.heapreplace(heap, (int(runs[run][0][end]) // width, run, place + 1))
            else:
                heapq.heappop(heap)
        pairs, inverse = np.unique(np.concatenate([runs[r][0][i:j] for r, i, j in parts]), return_inverse=True)
        counts = np.bincount(inverse.reshape(-1), np.concatenate([runs[r][1][i:j] for r, i, j in parts]), len(pairs)).astype(np.int64)
        answers = (2 * counts + (counts == counts.max()))[inverse.reshape(-1)]
        at = 0
        for run, start, end in parts:
            back[run][start:end] = answers[at : at + end - start]
            at += end - start
    return back


def count_runs(runs: DataFrame, width: int) -> DataFrame:
    """(chunk, radix, counts) for the runs (chunk, radix, data)."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        back = merged([_from_run(data) for data in frame["data"]], width)
        return pd.DataFrame({"chunk": frame["chunk"], "radix": frame["radix"], "counts": [squeeze(values) for values in back]})

    return runs.groupBy("radix").applyInPandas(run, "chunk long, radix int, counts binary")


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, radixes: int = RADIXES, chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """Per row of ``docs``: doc_id and RESULT.

    ``path_a`` is a byte-level BPE file of the tokenizers library, ``path_b`` a sentencepiece model.
    """
    chunks = packed_chunks(docs, path_a, path_b, radixes, chunk_tokens)
    width = len(Piecewise(path_b).tokens)
    counted = count_runs(chunks.select("chunk", F.inline("runs")), width)
    answers = counted.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("radix", "counts"))).alias("answers"))
    rows = chunks.drop("runs").join(answers, "chunk", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths = stretch(row.lengths)
                known = [stretch(x["counts"]) for x in row.answers] if row.answers is not None else []
                values = np.concatenate(known)[from_differences(stretch(row.pairs), lengths)] if known else np.empty(0, np.int64)
                often = stretch(row.often)
                ends = np.cumsum(lengths)
                sums = lambda each: np.diff(np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], ends])])  # noqa: E731, B023
                yield pd.DataFrame({
                    "doc_id": row.ids, "n_a": row.n_a, "n_b": row.n_b, "n_groups": row.n_groups, "n_links": row.n_links,
                    "n_best": sums(often * (values & 1)), "count_sum": sums(often * (values >> 1)), "groups_sha256": row.groups})

    return rows.mapInPandas(run, RESULT).withColumn("doc_id", F.col("doc_id").cast(id_type(docs)))
