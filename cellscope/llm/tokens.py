"""Token counts from the pieces of different pre-tokens.

Every document is split into pre-tokens by the pattern of the tokenizer's file; the number of
pieces of a pre-token does not depend on its neighbours.  The different pre-tokens of the
corpus are encoded once, joined to the frequencies in the documents, and summed; no list of
token ids is ever kept.  Frequencies are packed by chunk (``chunks``), so that a pre-token
meets the join once per chunk.

Special strings inside a text are one token each, as is the library's default; they split the
text before it is normalized.  A null text counts as empty; repeated rows are counted one by
one; texts of any length are processed whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .chunks import pack_documents, unpack
from .common import id_type

# Larger chunks meet the join with fewer words; one takes some 100 MB of a task's memory.
CHUNK_WORDS = 6_000_000
SPECIAL = "\x00"  # stands for a special string; no pre-token starts with it and goes on

_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        special = [t["content"] for t in parts["added_tokens"]]
        kinds = [n["type"] for n in parts["normalizer"]["normalizers"]]
        splitter = parts["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or not (splitter["behavior"] == "Removed" and splitter["invert"]):
            raise ValueError(f"{path}: not a lower-case tokenizer that drops white space")
        _loaded[path] = (
            Tokenizer.from_file(path),
            re.compile("|".join(map(re.escape, special))) if special else None,
            regex.compile(splitter["pattern"]["Regex"]))
    return _loaded[path]


def _normal(tokenizer, text: str) -> str:
    """What the tokenizer's normalizer makes of a text, but for the kind of white space.

    Composed text without a capital sigma, the one letter whose small form depends on its
    place for Python but not for the tokenizer, needs no call of the library.
    """
    if "\u03a3" not in text and is_normalized("NFC", text):
        return text.lower()
    return tokenizer.normalizer.normalize_str(text)


def pre_tokens(path: str, text: str) -> list[str]:
    """The pre-tokens of a whole text, SPECIAL for each special string."""
    tokenizer, special, pattern = _tokenizer(path)
    if special is None or not special.search(text):
        return pattern.findall(_normal(tokenizer, text))
    found, start = [], 0
    for match in special.finditer(text):
        found += pattern.findall(_normal(tokenizer, text[start : match.start()]))
        found.append(SPECIAL)
        start = match.end()
    return found + pattern.findall(_normal(tokenizer, text[start:]))


def piece_counts(words: DataFrame, path: str) -> DataFrame:
    """(word, pieces) of different pre-tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(path)[0]
        split, pieces = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        for batch in batches:
            yield pd.DataFrame({
                "word": batch["word"],
                "pieces": [1 if w == SPECIAL else sum(len(pieces(p)) for p, _ in split(w)) for w in batch["word"]]})

    return words.mapInPandas(run, "word string, pieces int")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""
    packed = pack_documents(
        docs.select("doc_id", "text"), "token-chunks",
        words_of=lambda text: pre_tokens(path, text),
        row_extra=lambda doc_id, text: len(text.encode("utf-8", "surrogatepass")), counted=True,
        max_words=CHUNK_WORDS)
    places = packed.select("chunk", F.posexplode("vocabulary").alias("place", "word"))
    pieces = stage_table(piece_counts(places.select("word").distinct(), path), "pieces")
    per_chunk = (
        places.join(pieces, "word").groupBy("chunk")
        .agg(F.collect_list(F.struct("place", "pieces")).alias("found"))
        .select("chunk", F.transform(F.sort_array("found"), lambda x: x["pieces"]).alias("pieces"))
    )
    rows = packed.select("chunk", "ids", "extra", "lengths", "numbers", "counts").join(per_chunk, "chunk", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                pieces = np.asarray(row.pieces if row.pieces is not None else [], np.int64)
                ends = np.concatenate([[0], np.cumsum(unpack(row.lengths))])
                each = pieces[unpack(row.numbers)] * unpack(row.counts) if len(pieces) else np.empty(0, np.int64)
                sums = np.concatenate([[0], np.cumsum(each)])
                n_tokens = sums[ends[1:]] - sums[ends[:-1]]
                yield pd.DataFrame({"doc_id": row.ids, "n_bytes": row.extra, "n_tokens": n_tokens,
                                    "over_limit": n_tokens > limit})

    counted = rows.mapInPandas(run, "doc_id string, n_bytes long, n_tokens long, over_limit boolean")
    return counted.withColumn("doc_id", F.col("doc_id").cast(id_type(docs)))
