"""Documents packed into chunks with a vocabulary each, for joins on words.

A join of every word of every document would move the corpus several times, and its frequent
words would be hot keys.  A chunk is some thousand documents; its documents are stored as
numbers into the chunk's own list of words.  Joins then meet a word once per chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cellscope.sources import stage_table

from .common import python_rows

SCHEMA = "chunk long, ids array<string>, extra array<long>, lengths binary, numbers binary, counts binary, vocabulary array<string>, weights array<long>, codes binary"


def pack(values: np.ndarray) -> bytes:
    """Small numbers have the same high bytes, so all first bytes come first, then all second ones."""
    planes = np.ascontiguousarray(values, np.int32).view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.int32).reshape(-1)


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def pack_documents(
    docs: DataFrame,
    label: str,
    words_of: Callable[[str], list],
    row_extra: Callable[[str | None, str], int],
    trains: Callable[[str], bool] | None = None,
    counted: bool = False,
    code_of: Callable[[str], int] | None = None,
    max_words: int = 1_500_000,
) -> DataFrame:
    """Write the chunks to the shared folder and read them back.

    ``words_of`` makes a document's words, ``row_extra`` one whole number of (doc_id, text).
    With ``counted`` a document is its different words and their frequencies, else its words in
    order.  ``weights`` counts each word of the vocabulary in the documents that ``trains``
    accepts, ``codes`` has ``code_of`` of each.  A chunk ends with the document that brings it to ``max_words``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, serial = TaskContext.get().partitionId(), 0

        def empty():
            return _Numbers(), [], [], [], [], [], [], 0

        known, ids, extra, lengths, numbers, counts, trained, total = empty()

        def finished() -> pd.DataFrame:
            vocabulary = [w if isinstance(w, str) else w.decode("utf-8", "surrogatepass") for w in known]
            codes = np.fromiter(map(code_of, vocabulary), np.int32, len(vocabulary)) if code_of else []
            rows = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
            seen = np.concatenate(trained) if trained else np.empty(0, np.int32)
            return pd.DataFrame({
                "chunk": [(part << 32) + serial], "ids": [ids], "extra": [extra],
                "lengths": [pack(np.array(lengths, np.int32))], "numbers": [pack(rows)],
                "counts": [pack(np.concatenate(counts)) if counts else b""],
                "vocabulary": [vocabulary], "codes": [pack(np.array(codes, np.int32))],
                "weights": [np.bincount(seen, minlength=len(known)).tolist()],
            })

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                text = text if isinstance(text, str) else ""
                words = words_of(text)
                own = np.fromiter((known[w] for w in words), np.int32, len(words))
                if trains and trains(doc_id):
                    trained.append(own)
                total += len(own)
                if counted:
                    own, often = np.unique(own, return_counts=True)
                    counts.append(often.astype(np.int32))
                ids.append(doc_id), extra.append(row_extra(doc_id, text)), lengths.append(len(own))
                numbers.append(own)
                if total >= max_words:
                    yield finished()
                    serial += 1
                    known, ids, extra, lengths, numbers, counts, trained, total = empty()
        if ids:
            yield finished()

    return stage_table(python_rows(docs).drop("_th").mapInPandas(run, SCHEMA), label)
