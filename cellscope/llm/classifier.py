"""Quality classifier on random-indexing word vectors.

Every token has a sparse random index vector that follows from its hash; a token's context
vector is the sum of the index vectors of its neighbours over all whole texts, which need no labels
for that.  A document is the mean of both over all its tokens, and a network of two layers, trained in numpy and
calibrated by one temperature, makes a probability of that.

The network is trained on at most ``sample`` labelled rows, the smallest by a hash of their id:
the one bounded sample, and a documented parameter.  The context sums are whole numbers, so that
they do not depend on the order in which tasks end.  Everything that is learnt has a fixed size
(``buckets`` x ``dims``), and every text is scored whole.  Labels, language, source and id
are never inputs of a score.

Defined cases: null and empty texts have the zero vector and a score all the same; labels that
are null or contradict each other are not used; without labels of both kinds every document
gets the share of label 1 (0.5 if there are none); repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

from .common import python_rows, typed_id

BLOCK = 1 << 16  # tokens whose neighbours are summed at once
PARTS = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")


@dataclass(frozen=True)
class ClassifierConfig:
    sample: int = 20_000
    buckets: int = 1 << 14
    dims: int = 32
    nonzero: int = 4
    reach: int = 2
    hidden: int = 32
    epochs: int = 60
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 42
    folds: int = 3
    fold: int = 1


def held_out(doc_id: str | None, folds: int = 3, fold: int = 1) -> bool:
    return zlib.crc32((doc_id or "").encode()) % folds == fold


def index_vectors(config: ClassifierConfig) -> np.ndarray:
    """buckets x dims: ``nonzero`` entries of +1 or -1 in each row, the same everywhere."""
    draw = np.random.default_rng(config.seed)
    vectors = np.zeros((config.buckets, config.dims), np.float32)
    rows = np.arange(config.buckets)
    for _ in range(config.nonzero):
        vectors[rows, draw.integers(0, config.dims, config.buckets)] = draw.choice([-1.0, 1.0], config.buckets)
    return vectors


class _Buckets(dict):
    """The bucket of a token; ``buckets`` more where a token in capitals comes before it."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.capitals = self.bucket("\x01")

    def bucket(self, part: str) -> int:
        return xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass")) % self.buckets

    def __missing__(self, part: str) -> int:
        value = self.bucket(part.lower()) + (self.buckets if len(part) > 1 and part.isupper() else 0)
        if len(self) < 500_000:
            self[part] = value
        return value


def token_buckets(text: str | None, known: _Buckets) -> np.ndarray:
    """Buckets of the letter runs, digit runs and sign runs; capitals are a token of their own."""
    if not text:
        return np.empty(0, np.int64)
    parts = PARTS.findall(text)
    found = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
    upper = np.flatnonzero(found >= known.buckets)
    if len(upper):
        found[upper] -= known.buckets
        found = np.insert(found, upper, known.capitals)
    return found


def add_contexts(total: np.ndarray, texts: list[np.ndarray], vectors: np.ndarray, reach: int) -> None:
    """Add to each token's column of ``total`` the index vectors (columns) of its neighbours.

    The last column of both tables is a gap between texts.  One dimension at a time, so that a
    block of it stays in the processor's cache.
    """
    gap = np.full(reach, vectors.shape[1] - 1)
    ids = np.concatenate([part for text in texts for part in (text, gap)])
    for start in range(0, len(ids), BLOCK):
        first = max(0, start - reach)
        some, around = ids[start : start + BLOCK], ids[first : start + BLOCK + reach]
        for dim, of_dim in zip(total, vectors, strict=True):
            own = of_dim[around]
            near = np.zeros(len(own))
            for step in range(1, reach + 1):
                near[step:] += own[:-step]
                near[:-step] += own[step:]
            dim += np.bincount(some, near[start - first :][: len(some)], len(dim))


def word_vectors(docs: DataFrame, config: ClassifierConfig) -> np.ndarray:
    """buckets x dims context vectors, length 1; summed in the tasks, then by bucket."""
    dims = config.dims

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, known = np.zeros((dims, config.buckets + 1)), _Buckets(config.buckets)
        vectors[:, :-1] = index_vectors(config).T
        total, waiting, size = np.zeros((dims, config.buckets + 1)), [], 0
        for batch in batches:
            for text in batch["text"]:
                ids = token_buckets(text, known)
                if len(ids) > 1:
                    waiting.append(ids)
                    size += len(ids)
                if size >= BLOCK:
                    add_contexts(total, waiting, vectors, config.reach)
                    waiting, size = [], 0
        if waiting:
            add_contexts(total, waiting, vectors, config.reach)
        used = np.flatnonzero(total[:, :-1].any(axis=0))
        yield pd.DataFrame({"bucket": used, **{f"d{d}": total[d, used] for d in range(dims)}})

    schema = "bucket int, " + ", ".join(f"d{d} double" for d in range(dims))
    sums = docs.select("text").mapInPandas(run, schema).groupBy("bucket").agg(*(F.sum(f"d{d}").alias(f"d{d}") for d in range(dims)))
    rows = sums.toPandas()  # at most one row per bucket
    result = np.zeros((config.buckets, dims))
    result[rows["bucket"].to_numpy(np.int64)] = rows[[f"d{d}" for d in range(dims)]].to_numpy(float)
    return (result / np.maximum(np.linalg.norm(result, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: str | None, known: dict, table: np.ndarray) -> np.ndarray:
    """The mean vector of all tokens of a text; blocks bound the memory of a very long one."""
    ids = token_buckets(text, known)
    total = np.zeros(table.shape[1])
    for i in range(0, len(ids), 65_536):
        total += table[ids[i : i + 65_536]].sum(0, dtype=np.float64)
    return total / max(1, len(ids))


@dataclass(frozen=True)
class Network:
    """Standardised input, one hidden layer, temperature; 0.5 is label 1."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train_network(x: np.ndarray, y: np.ndarray, calibrates: np.ndarray, config: ClassifierConfig) -> Network:
    """Adam on the cross entropy; the temperature is the best of a grid on the rows set apart."""
    size, hidden = x.shape[1], config.hidden
    fits = ~calibrates if (~calibrates).any() else np.ones(len(x), bool)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    mean = x[fits].mean(0) if len(x) else np.zeros(size)
    scale = x[fits].std(0) + 1e-6 if len(x) else np.ones(size)
    draw = np.random.default_rng(config.seed)
    w = [draw.normal(0, np.sqrt(2 / size), (size, hidden)), np.zeros(hidden), np.zeros(hidden),
         np.array(np.log(share / (1 - share)))]
    if not len(y) or y.min() == y.max():
        return Network(mean, scale, w[0], w[1], w[2], float(w[3]), 1.0)
    w[2] = draw.normal(0, np.sqrt(1 / hidden), hidden)
    z, t = (x[fits] - mean) / scale, y[fits]
    moments, step = [(np.zeros_like(p), np.zeros_like(p)) for p in w], 0
    for _ in range(config.epochs):
        order = draw.permutation(len(z))
        for start in range(0, len(z), 256):
            some = order[start : start + 256]
            inside = z[some] @ w[0] + w[1]
            active = np.maximum(inside, 0)
            error = (1 / (1 + np.exp(-np.clip(active @ w[2] + w[3], -50, 50))) - t[some]) / len(some)
            back = np.outer(error, w[2]) * (inside > 0)
            slopes = [z[some].T @ back + config.decay * w[0], back.sum(0),
                      active.T @ error + config.decay * w[2], np.array(error.sum())]
            step += 1
            for i, slope in enumerate(slopes):
                m, v = moments[i]
                m = 0.9 * m + 0.1 * slope
                v = 0.999 * v + 0.001 * slope**2
                moments[i] = m, v
                w[i] = w[i] - config.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, w[0], w[1], w[2], float(w[3]), 1.0)
    apart = calibrates if calibrates.any() else fits
    logits, truth = network.logits(x[apart]), y[apart]

    def loss(temperature: float) -> float:
        a = logits / temperature
        return float(np.mean(np.logaddexp(0, a) - truth * a))

    best = min(np.geomspace(0.25, 10, 60), key=loss)
    return Network(mean, scale, w[0], w[1], w[2], float(w[3]), float(best))


def fit(docs: DataFrame, labels: DataFrame, config: ClassifierConfig) -> tuple[np.ndarray, Network]:
    """(token table of all texts, network from the sample of labelled rows that are not held out)."""
    text_id = F.col("doc_id").cast("string")
    usable = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .filter("quality = _most").select("doc_id", "quality")
        .filter(F.crc32(text_id.cast("binary")) % config.folds != config.fold)
        .orderBy(F.xxhash64(text_id), "doc_id").limit(config.sample)
    )
    usable = stage_table(usable, "quality-labels")
    sample = stage_table(
        docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")  # at most ``sample`` pairs of numbers
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality")),
        "quality-sample")
    context = word_vectors(docs, config)
    table = np.concatenate([context, index_vectors(config)], axis=1)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Buckets(config.buckets)
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "quality": batch["quality"],
                "x": [pooled(text, known, table).tolist() for text in batch["text"]]})

    rows = (
        sample.select(text_id.alias("doc_id"), "text", F.col("quality").cast("int").alias("quality"))
        .mapInPandas(vectors, "doc_id string, quality int, x array<double>").orderBy("doc_id").toPandas())
    x = np.array(rows["x"].tolist()).reshape(len(rows), table.shape[1])
    y = (rows["quality"].to_numpy() == 1).astype(float)
    apart = np.array([xxhash.xxh3_64_intdigest(i) % 5 == 0 for i in rows["doc_id"]], bool)
    return table, train_network(x, y, apart, config)


def score_quality(docs: DataFrame, labels: DataFrame, config: ClassifierConfig | None = None) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on)."""
    config = config or ClassifierConfig()
    table, network = fit(docs, labels, config)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Buckets(config.buckets)
        for batch in batches:
            x = np.array([pooled(text, known, table) for text in batch["text"]]).reshape(len(batch), table.shape[1])
            score = network.probabilities(x)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": [held_out(i, config.folds, config.fold) for i in batch["doc_id"]],
                "score": score, "predicted": (score >= 0.5).astype(np.int32)})

    scored = python_rows(docs).mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int")
    return typed_id(scored, docs)
