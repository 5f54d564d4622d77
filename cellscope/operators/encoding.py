"""Category indexes and min-max scaling.

Both need whole-table statistics: how often each label occurs, and the least
and greatest value of each number.  :func:`fit_encoding` counts the labels of
each column by itself, all columns in one pass, and takes all bounds from one
aggregate of a single row.  Any number of labels can be indexed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    IDENTITY_COLUMNS,
    INDEXED_COLUMNS,
    RELIABILITY_COLUMNS,
    SPATIAL_COLUMNS,
)

@dataclass(frozen=True)
class Encoding:
    """Fitted statistics: labels by falling frequency, and (least, greatest)."""

    labels: dict[str, list[str]] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)


def _number(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    return value.cast("double")


def fit_encoding(df: DataFrame, categories: Sequence[str], numbers: Sequence[str] = ()) -> Encoding:
    """Labels of every category by falling frequency, ties by label, and bounds of every number."""
    labels = {}
    if categories:
        outputs = [f"__{name}" for name in categories]
        fitted = StringIndexer(
            inputCols=list(categories), outputCols=outputs, stringOrderType="frequencyDesc", handleInvalid="skip"
        ).fit(df.select(*categories))
        labels = {name: list(found) for name, found in zip(categories, fitted.labelsArray, strict=True)}
    bounds = {}
    if numbers:
        measures = []
        for position, name in enumerate(numbers):
            value = _number(df, name)
            measures += [F.min(value).alias(f"min_{position}"), F.max(value).alias(f"max_{position}")]
        row = df.agg(*measures).first()
        for position, name in enumerate(numbers):
            if row[f"min_{position}"] is not None:
                bounds[name] = (row[f"min_{position}"], row[f"max_{position}"])
    return Encoding(labels, bounds)


def index_labels(df: DataFrame, encoding: Encoding, outputs: Mapping[str, str]) -> DataFrame:
    """Replace labels by their frequency rank; rows with a null label are skipped.

    The result columns carry nominal metadata, which tells tree learners that
    they are categories.
    """
    # one model per column: a joint one pads the shorter label lists with nulls
    for name, output in outputs.items():
        df = StringIndexerModel.from_labels(
            encoding.labels[name], inputCol=name, outputCol=output, handleInvalid="skip"
        ).transform(df)
    return df


def frequency_index(df: DataFrame, column: str, output: str) -> DataFrame:
    """Index one column: 0.0 for the most frequent label, ties by label."""
    return index_labels(df, fit_encoding(df, [column]), {column: output})


def assemble(df: DataFrame, columns: Sequence[str], output: str, on_invalid: str = "error") -> DataFrame:
    """One vector column; ``on_invalid`` is ``error``, ``skip`` or ``keep`` for nulls."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid=on_invalid
    ).transform(df)


def scaled(df: DataFrame, name: str, bounds: tuple[float, float]) -> Column:
    """``name`` mapped to [0, 1]; a constant column gives 0.5."""
    low, high = bounds
    value = F.col(name).cast("double")
    if high == low:
        return F.when(value.isNotNull(), F.lit(0.5))
    return (value - F.lit(low)) / F.lit(high - low)


def scale(
    df: DataFrame, encoding: Encoding, columns: Sequence[str], output: str, on_invalid: str = "error"
) -> DataFrame:
    """Min-max vector from fitted bounds."""
    parts = {
        f"__{output}_{name}": scaled(df, name, encoding.bounds.get(name, (0.0, 0.0)))
        for name in columns
    }
    return assemble(df.withColumns(parts), list(parts), output, on_invalid).drop(*parts)


def minmax(df: DataFrame, columns: Sequence[str], output: str, on_invalid: str = "error") -> DataFrame:
    """Fit and apply min-max scaling.

    Bounds come from the rows that reach the output: with ``on_invalid="skip"``
    a row with a null does not widen them.
    """
    rows = df.dropna(subset=list(columns)) if on_invalid == "skip" else df
    return scale(rows, fit_encoding(rows, [], columns), columns, output, on_invalid)


def spatial_features(df: DataFrame, encoding: Encoding | None = None) -> DataFrame:
    """Add ``features_spatial`` and the equal ``prediction_features``."""
    encoding = encoding or fit_encoding(df, [], SPATIAL_COLUMNS)
    out = scale(df, encoding, SPATIAL_COLUMNS, "features_spatial")
    return assemble(out, ["features_spatial"], "prediction_features")


def identity_features(df: DataFrame, on_invalid: str = "error") -> DataFrame:
    """Add ``mcc_mnc_scaled``.  ``unit`` may be null: then error, or skip the row."""
    return minmax(df, IDENTITY_COLUMNS, "mcc_mnc_scaled", on_invalid)


def reliability_features(df: DataFrame, encoding: Encoding | None = None) -> DataFrame:
    """Add ``reliability_metrics``."""
    encoding = encoding or fit_encoding(df, [], RELIABILITY_COLUMNS)
    return scale(df, encoding, RELIABILITY_COLUMNS, "reliability_metrics")


def fit_tower_encoding(df: DataFrame) -> Encoding:
    """Everything that :func:`encode_towers` needs."""
    return fit_encoding(df, list(INDEXED_COLUMNS), [*SPATIAL_COLUMNS, *RELIABILITY_COLUMNS])


def encode_towers(df: DataFrame, encoding: Encoding | None = None) -> DataFrame:
    """Add the four label indexes and the feature vectors."""
    encoding = encoding or fit_tower_encoding(df)
    out = index_labels(df, encoding, INDEXED_COLUMNS)
    return reliability_features(spatial_features(out, encoding), encoding)
