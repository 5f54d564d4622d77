"""Data reliability: Gaussian mixture, information criteria and profiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SEED, SWEEP_KS
from .measures import count_by, tower_cells, tower_count, tower_mean
from .sweeps import Sweep, feature_values, first_largest, run_all, training_rows

RELIABILITY_FEATURES = "reliability_metrics"

# Fixed value: MLlib adds the double-precision epsilon to every weighted density.
DENSITY_FLOOR = 2.220446049250313e-16


@dataclass(frozen=True)
class Component:
    """One Gaussian of a mixture."""

    weight: float
    mean: tuple[float, ...]
    covariance: tuple[tuple[float, ...], ...]


# --- training -----------------------------------------------------------------


def reliability_estimator(k: int, features: str = RELIABILITY_FEATURES, seed: int = SEED) -> GaussianMixture:
    return GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol="gmm_cluster")


def fit_reliability(
    df: DataFrame, k: int, features: str = RELIABILITY_FEATURES, seed: int = SEED, *, partitions: int,
) -> GaussianMixtureModel:
    with training_rows(df, [features], partitions) as rows:
        return reliability_estimator(k, features, seed).fit(rows)


def gmm_reliability(
    df: DataFrame, k: int, features: str = RELIABILITY_FEATURES, seed: int = SEED, *, partitions: int,
) -> DataFrame:
    """Fit on ``df`` and add ``probability`` (vector) and ``gmm_cluster`` (int)."""
    return fit_reliability(df, k, features, seed, partitions=partitions).transform(df)


def model_components(model: GaussianMixtureModel) -> list[Component]:
    """Parameters of a trained model, for scoring with column expressions."""
    return [
        Component(
            float(weight),
            tuple(map(float, gaussian.mean.toArray())),
            tuple(tuple(map(float, row)) for row in gaussian.cov.toArray()),
        )
        for weight, gaussian in zip(model.weights, model.gaussians, strict=True)
    ]


SELECT_BY = ("log_likelihood", "bic", "bic_full")


def gmm_sweep(
    df: DataFrame, ks: Sequence[int] = SWEEP_KS, select_by: str = "log_likelihood",
    features: str = RELIABILITY_FEATURES, seed: int = SEED, parallelism: int = 2, *, partitions: int,
) -> Sweep:
    """Fit every k and keep the largest log-likelihood, or the least criterion.

    Metrics: (k, log_likelihood, bic, bic_full, is_best), those of the mixtures that are
    returned; all come from one scan.  The first k wins a tie.
    """
    if select_by not in SELECT_BY:
        raise ValueError(f"select_by must be one of {SELECT_BY}")
    with training_rows(df, [features], partitions) as rows:
        fitted = run_all(df, lambda k: reliability_estimator(k, features, seed).fit(rows), list(ks), parallelism)
        models = dict(zip(ks, fitted, strict=True))
        d = len(fitted[0].gaussians[0].mean)
        fitness = mixture_fitness(rows, features, {k: model_components(model) for k, model in models.items()})
        scored = {row["k"]: row for row in with_criteria(fitness, d).collect()}  # one row per k
    spark = df.sparkSession
    scores = [scored[k][select_by] if select_by == "log_likelihood" else -scored[k][select_by] for k in ks]
    best = first_largest(scores)
    metrics = spark.createDataFrame(
        [
            (k, scored[k]["log_likelihood"], scored[k]["bic"], scored[k]["bic_full"], place == best)
            for place, k in enumerate(ks)
        ],
        "k int, log_likelihood double, bic double, bic_full double, is_best boolean",
    )
    return Sweep(metrics, ks[best], fitted[best], models)


# --- scoring with given parameters ----------------------------------------------


def precision_of(covariance: Sequence[Sequence[float]]) -> tuple[np.ndarray, float]:
    """(inverse, logarithm of the determinant), both over the directions in which there is any variance.

    A direction counts if its variance is above the rounding error of the largest, so a mixture
    trained on a constant column still has densities.
    """
    values, vectors = np.linalg.eigh(np.array(covariance, dtype=float))
    used = values > np.finfo(float).eps * values.max() * len(values)
    if not used.any():
        raise ValueError("a covariance without any variance has no density")
    return (vectors[:, used] / values[used]) @ vectors[:, used].T, float(np.log(values[used]).sum())


def weighted_density(columns: Sequence[str | Column], part: Component) -> Column:
    """Weight times Gaussian density, from the inverse covariance as literals."""
    precision, log_determinant = precision_of(part.covariance)
    d = len(columns)
    norm = part.weight * math.exp(-0.5 * (d * math.log(2 * math.pi) + log_determinant))
    values = [F.col(name) if isinstance(name, str) else name for name in columns]
    offset = [value - F.lit(float(at)) for value, at in zip(values, part.mean, strict=True)]
    terms = []
    for i in range(d):
        terms.append(F.lit(float(precision[i, i])) * offset[i] * offset[i])
        for j in range(i + 1, d):
            terms.append(F.lit(float(precision[i, j] + precision[j, i])) * offset[i] * offset[j])
    distance = reduce(Column.__add__, terms)
    return F.lit(DENSITY_FLOOR) + F.lit(norm) * F.exp(F.lit(-0.5) * distance)


def gmm_responsibilities(
    df: DataFrame, columns: Sequence[str], parts: Sequence[Component],
    prefix: str = "p", prediction: str = "gmm_cluster",
) -> DataFrame:
    """Add the membership probability of each component and the most likely one."""
    names = [f"{prefix}{number}" for number in range(len(parts))]
    densities = {
        f"__{name}": weighted_density(columns, part) for name, part in zip(names, parts, strict=True)
    }
    total = reduce(Column.__add__, [F.col(name) for name in densities])
    shares = {name: F.col(f"__{name}") / total for name in names}
    ranked = [
        F.struct(F.col(f"__{name}").alias("density"), F.lit(-number).alias("order"))
        for number, name in enumerate(names)
    ]
    top = F.greatest(*ranked) if len(ranked) > 1 else ranked[0]
    filled = F.lit(True)
    for name in columns:
        filled = filled & F.col(name).isNotNull()
    label = F.when(filled, -top.getField("order"))
    return df.withColumns(densities).withColumns({**shares, prediction: label}).drop(*densities)


def mixture_log_density(columns: Sequence[str | Column], parts: Sequence[Component]) -> Column:
    return F.log(reduce(Column.__add__, [weighted_density(columns, part) for part in parts]))


def log_likelihood(df: DataFrame, columns: Sequence[str], parts: Sequence[Component]) -> DataFrame:
    """Log-likelihood of the rows under given parameters: (log_likelihood)."""
    return df.agg(F.sum(mixture_log_density(columns, parts)).alias("log_likelihood"))


def mixture_fitness(df: DataFrame, features: str, mixtures: Mapping[int, Sequence[Component]]) -> DataFrame:
    """(k, log_likelihood, n) of several mixtures on the same rows, from one scan."""
    x = F.col("__x")
    size = len(next(iter(mixtures.values()))[0].mean)
    fits = [
        F.coalesce(F.sum(mixture_log_density([x[i] for i in range(size)], parts)), F.lit(0.0)).alias(f"fit_{k}")
        for k, parts in mixtures.items()]
    cells = ", ".join(f"{k}, fit_{k}" for k in mixtures)
    return df.select(feature_values(df, features).alias("__x")).agg(F.count(F.lit(1)).alias("n"), *fits).selectExpr(
        f"stack({len(mixtures)}, {cells}) AS (k, log_likelihood)", "n")


def with_criteria(metrics: DataFrame, d: int, rows: str = "n") -> DataFrame:
    """Add ``bic`` and ``bic_full`` to a table of (k, log_likelihood, n).

    ``bic`` counts the means and weights but not the covariances, ``bic_full``
    every free parameter.
    """
    k, fitness, size = F.col("k"), F.col("log_likelihood"), F.log(F.col(rows).cast("double"))
    return metrics.withColumns({
        "bic": (k * d + k - 1) * size - 2 * fitness,
        "bic_full": (k * d + k * (d * (d + 1) // 2) + k - 1) * size - 2 * fitness,
    })


def sweep_summary(metrics: DataFrame, score: str = "log_likelihood") -> DataFrame:
    """Mark the k with the largest score; the smallest k of equals."""
    winner = metrics.agg(F.max(F.struct(F.col(score), -F.col("k"))).alias("top")).select(
        -F.col("top.col2")
    )
    return metrics.withColumn("is_best", F.col("k") == winner.scalar()).orderBy("k")


# --- profiles -------------------------------------------------------------------


def reliability_cells(df: DataFrame) -> DataFrame:
    """The towers per country, operator and cluster, for both profiles below."""
    return tower_cells(df, ["Country", "Network", "gmm_cluster"], ["SAM", "data_age_days"])


def reliability_profile(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean samples, mean age and size per cluster, most samples first."""
    return (
        df.groupBy("gmm_cluster")
        .agg(
            tower_mean("SAM", weight).alias("avg_sam"),
            tower_mean("data_age_days", weight).alias("avg_days_old"),
            tower_count(weight).alias("tower_count"),
        )
        .orderBy(F.desc("avg_sam"), "gmm_cluster")
    )


def operator_reliability(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Country x operator x cluster counts."""
    keys = ["Country", "Network", "gmm_cluster"]
    return count_by(df, keys, "tower_count", weight).orderBy(*keys)
