"""Spatial zones: K-Means, its quality measures and cluster profiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SEED, SILHOUETTE_SAMPLE, SWEEP_KS
from .measures import count_by, tower_cells, tower_count, tower_mean
from .sampling import row_draw
from .sweeps import Sweep, feature_values, first_largest, run_all, training_rows

ZONE_FEATURES = "prediction_features"
PROFILE_DIMENSIONS = ("prediction", "Country", "Network", "generasi", "jangkauan")
PROFILE_MEASURES = ("LAT", "LON", "RANGE", "SAM")


# --- training -----------------------------------------------------------------


def zone_estimator(k: int, features: str = ZONE_FEATURES, seed: int = SEED) -> KMeans:
    """Euclidean K-Means, k-means|| start, at most 20 rounds, tolerance 1e-4."""
    return KMeans(
        k=k, seed=seed, featuresCol=features, predictionCol="prediction",
        maxIter=20, tol=1e-4, initMode="k-means||", initSteps=2,
    )


def fit_zones(
    df: DataFrame, k: int, features: str = ZONE_FEATURES, seed: int = SEED, *, partitions: int,
) -> KMeansModel:
    with training_rows(df, [features], partitions) as rows:
        return zone_estimator(k, features, seed).fit(rows)


def kmeans_zones(
    df: DataFrame, k: int, features: str = ZONE_FEATURES, seed: int = SEED, *, partitions: int,
) -> DataFrame:
    """Fit on ``df`` and add the zone as ``prediction`` (int)."""
    return fit_zones(df, k, features, seed, partitions=partitions).transform(df)


def silhouette_score(df: DataFrame, features: str = ZONE_FEATURES, prediction: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance; needs two clusters or more.

    Linear: one pass for the sums per cluster, one for the rows.
    """
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=prediction,
        metricName="silhouette", distanceMeasure="squaredEuclidean",
    ).evaluate(df)


def silhouette(df: DataFrame, features: str = ZONE_FEATURES, prediction: str = "prediction") -> DataFrame:
    """:func:`silhouette_score` as a table of one row."""
    score = silhouette_score(df, features, prediction)
    return df.sparkSession.createDataFrame([(score,)], "silhouette double")


Centers = Sequence[Sequence[float]]


def centre_tallies(df: DataFrame, features: str, centers: Mapping[int, Centers], sample: Column | None = None) -> DataFrame:
    """What the measures of several sets of centres need of the rows, from one scan.

    One row per set ``k`` and ``cluster`` in use: ``towers`` and ``cost`` (sum of squared
    distances) of all rows; ``n``, ``norms`` (sum of squared lengths) and ``sums`` (of the
    vectors) of the rows that ``sample`` accepts.  Every task keeps one such row per cluster.
    """
    x = F.col("__x")
    chosen = F.lit(True) if sample is None else F.coalesce(sample, F.lit(False))
    size = len(next(iter(centers.values()))[0])
    points = df.select(feature_values(df, features).alias("__x"), chosen.alias("__in"))

    def nearest(at: Centers) -> Column:
        pairs = [
            F.struct(distance.alias("distance"), F.lit(number).alias("cluster"))
            for number, distance in enumerate(squared_distances([x[i] for i in range(size)], at))]
        return F.least(*pairs) if len(pairs) > 1 else pairs[0]

    sides = points.select("__x", "__in", F.inline(F.array(*(
        F.struct(F.lit(k).alias("k"), nearest(at).alias("__at")) for k, at in centers.items()))))
    inside = lambda value: F.coalesce(F.sum(F.when(F.col("__in"), value)), F.lit(0.0))
    return sides.groupBy("k", F.col("__at.cluster").alias("cluster")).agg(
        F.count(F.lit(1)).alias("towers"), F.sum("__at.distance").alias("cost"), F.count_if("__in").alias("n"),
        inside(sum((x[i] * x[i] for i in range(1, size)), x[0] * x[0])).alias("norms"),
        F.array(*(inside(x[i]) for i in range(size))).alias("sums"))


def centre_silhouettes(df: DataFrame, features: str, centers: Mapping[int, Centers], tallies: Sequence) -> DataFrame:
    """Mean silhouette of ``df`` under several sets of centres in one scan: one column ``k<k>`` each.

    ``tallies`` are the rows of :func:`centre_tallies` whose ``n`` is not 0, one per cluster.  The
    mean squared distance to a cluster follows from its size, sum of squares and sum of vectors;
    a tower alone in its cluster scores 0.
    """
    x, size = F.col("__x"), len(next(iter(centers.values()))[0])
    points = df.select(feature_values(df, features).alias("__x"))
    length = sum((x[i] * x[i] for i in range(1, size)), x[0] * x[0])
    scores = []
    for k, at in centers.items():
        used = {row["cluster"]: row for row in tallies if row["k"] == k and row["n"]}
        if len(used) < 2:
            raise ValueError(f"k={k}: the sample has towers of fewer than two clusters")
        pairs = [
            F.struct(distance.alias("distance"), F.lit(number).alias("cluster"))
            for number, distance in enumerate(squared_distances([x[i] for i in range(size)], at))]
        own = F.least(*pairs)["cluster"]
        mean = {}
        for number, row in used.items():
            dot = sum((x[i] * F.lit(row["sums"][i]) for i in range(1, size)), x[0] * F.lit(row["sums"][0]))
            mean[number] = length + F.lit(row["norms"] / row["n"]) - dot * F.lit(2.0 / row["n"])
        score = F.lit(0.0)
        for number, row in used.items():
            others = [value for other, value in mean.items() if other != number]
            outer = F.least(*others) if len(others) > 1 else others[0]
            inner = mean[number] * F.lit(row["n"] / max(row["n"] - 1, 1))
            ratio = F.when(inner == outer, F.lit(0.0)).otherwise((outer - inner) / F.greatest(inner, outer))
            if row["n"] > 1:
                score = F.when(own == number, ratio).otherwise(score)
        scores.append(F.avg(score).alias(f"k{k}"))
    return points.agg(*scores)


def kmeans_sweep(
    df: DataFrame, ks: Sequence[int] = SWEEP_KS, features: str = ZONE_FEATURES, seed: int = SEED,
    fraction: float = SILHOUETTE_SAMPLE, parallelism: int = 2, *, partitions: int,
) -> Sweep:
    """Fit every k and keep the best silhouette, measured on a sample of the rows.

    Metrics: (k, silhouette_score, wssse, is_best), those of the centres that are returned.  All
    costs and the sums behind all silhouettes come from one scan, the silhouettes from one more.
    The first k wins a tie.
    """
    marked = df.withColumn("in_sample", row_draw(df, "sample", seed) < F.lit(float(fraction)))
    with training_rows(marked, [features, "in_sample"], partitions) as rows:
        models = run_all(df, lambda k: zone_estimator(k, features, seed).fit(rows), list(ks), parallelism)
        centers = {k: [tuple(map(float, at)) for at in model.clusterCenters()] for k, model in zip(ks, models, strict=True)}
        tallies = centre_tallies(rows, features, centers, F.col("in_sample")).collect()  # one row per k and cluster
        scores = centre_silhouettes(rows.filter("in_sample"), features, centers, tallies).first()
    best = first_largest([scores[f"k{k}"] for k in ks])
    cost = {k: math.fsum(row["cost"] for row in tallies if row["k"] == k) for k in ks}
    metrics = df.sparkSession.createDataFrame(
        [(k, scores[f"k{k}"], cost[k], place == best) for place, k in enumerate(ks)],
        "k int, silhouette_score double, wssse double, is_best boolean",
    )
    return Sweep(metrics, ks[best], models[best], dict(zip(ks, models, strict=True)))


# --- scoring with given centres -------------------------------------------------


def squared_distances(columns: Sequence[str | Column], centers: Sequence[Sequence[float]]) -> list[Column]:
    """Squared distance to each centre, in centre order."""
    distances, values = [], [F.col(name) if isinstance(name, str) else name for name in columns]
    for center in centers:
        terms = [(value - F.lit(float(at))) for value, at in zip(values, center, strict=True)]
        total = terms[0] * terms[0]
        for term in terms[1:]:
            total = total + term * term
        distances.append(total)
    return distances


def assign_nearest(
    df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]],
    prediction: str = "prediction", distance: str | None = None,
) -> DataFrame:
    """Add the number of the nearest centre; equal distances go to the lowest number.

    A plain expression over number columns.  A row with a null gets no centre.
    ``distance`` names a column for the squared distance to the centre.
    """
    pairs = [
        F.struct(value.alias("distance"), F.lit(number).alias("center"))
        for number, value in enumerate(squared_distances(columns, centers))
    ]
    nearest = F.least(*pairs) if len(pairs) > 1 else pairs[0]
    filled = F.lit(True)
    for name in columns:
        filled = filled & F.col(name).isNotNull()
    out = df.withColumn("__nearest", F.when(filled, nearest))
    out = out.withColumn(prediction, F.col("__nearest.center"))
    if distance:
        out = out.withColumn(distance, F.col("__nearest.distance"))
    return out.drop("__nearest")


def wssse(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Sum of squared distances to the nearest centre: (wssse)."""
    return df.agg(F.sum(F.least(*squared_distances(columns, centers))).alias("wssse"))


def lloyd_step(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """One K-Means round: (prediction, mean of each column, towers)."""
    return (
        assign_nearest(df, columns, centers)
        .groupBy("prediction")
        .agg(*[F.avg(name).alias(name) for name in columns], F.count(F.lit(1)).alias("towers"))
        .orderBy("prediction")
    )


# --- profiles -------------------------------------------------------------------


def profile_cells(df: DataFrame) -> DataFrame:
    """The one aggregate from which all cluster profiles follow."""
    return tower_cells(df, PROFILE_DIMENSIONS, PROFILE_MEASURES)


def cluster_sizes(df: DataFrame, weight: str | None = None) -> DataFrame:
    return count_by(df, ["prediction"], weight=weight).orderBy("prediction")


def cluster_stats(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean position, radius and samples of each cluster, and its size."""
    return (
        df.groupBy("prediction")
        .agg(
            tower_mean("LAT", weight).alias("avg_lat"),
            tower_mean("LON", weight).alias("avg_lon"),
            tower_mean("RANGE", weight).alias("avg_range_radius"),
            tower_mean("SAM", weight).alias("avg_sample_count"),
            tower_count(weight).alias("total_tower"),
        )
        .orderBy("prediction")
    )


def cluster_hierarchy(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Cluster, country, operator counts, the largest operators first."""
    return count_by(df, ["prediction", "Country", "Network"], weight=weight).orderBy(
        "prediction", "Country", F.desc("count"), "Network"
    )


def cluster_mix(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Cluster x category counts, the largest category first."""
    return count_by(df, ["prediction", column], weight=weight).orderBy(
        "prediction", F.desc("count"), column
    )
