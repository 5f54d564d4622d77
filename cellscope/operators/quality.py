"""Data quality: row filters, the composite cleaner and the quality funnel.

Every filter is a narrow transformation.  Catalyst merges a chain of them into
one predicate and passes the source-evaluable parts to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_RULES, CleanRules
from ..functions import fraction_digits
from ..sources.csv_towers import CORRUPT_COLUMN


def _all(tests: Iterable[Column]) -> Column:
    return reduce(Column.__and__, tests, F.lit(True))


# --- predicates ---------------------------------------------------------------


def is_present(df: DataFrame, columns: Sequence[str]) -> Column:
    """No listed column is null; in float and double columns NaN counts as null."""
    tests = []
    for name in columns:
        tests.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            tests.append(~F.isnan(name))
    return _all(tests)


def is_nonzero(columns: Sequence[str]) -> Column:
    return _all(F.col(name) != 0 for name in columns)


def is_matching(patterns: Mapping[str, str]) -> Column:
    return _all(F.col(name).rlike(pattern) for name, pattern in patterns.items())


def is_precise(columns: Sequence[str], digits: int) -> Column:
    return _all(fraction_digits(F.col(name)) >= digits for name in columns)


def is_inside(box: Mapping[str, tuple[float, float]]) -> Column:
    return _all(F.col(name).between(low, high) for name, (low, high) in box.items())


def is_ordered(earlier: str, later: str) -> Column:
    return F.col(later) >= F.col(earlier)


# --- filters ------------------------------------------------------------------


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Keep rows whose value is listed; exact and case-sensitive."""
    return df.filter(F.col(column).isin(*values))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(is_present(df, columns))


def filter_nonzero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(is_nonzero(columns))


def filter_matches(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    return df.filter(is_matching(patterns))


def filter_decimals(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    """Keep coordinates written with at least ``digits`` digits after the point."""
    return df.filter(is_precise(columns, digits))


def filter_bbox(df: DataFrame, box: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Keep rows inside the box, edges included."""
    return df.filter(is_inside(box))


def filter_ordered(df: DataFrame, earlier: str, later: str) -> DataFrame:
    return df.filter(is_ordered(earlier, later))


def project(df: DataFrame, columns: Mapping[str, str], casts: Mapping[str, str] | None = None) -> DataFrame:
    """Select, rename and cast in one projection: ``columns`` maps old to new names."""
    casts = casts or {}
    return df.select(*[
        (F.col(old).cast(casts[old]) if old in casts else F.col(old)).alias(new)
        for old, new in columns.items()
    ])


# --- composites ---------------------------------------------------------------


def quality_steps(df: DataFrame, rules: CleanRules = DEFAULT_RULES) -> list[tuple[str, Column]]:
    """The cleaning steps in order, as (name, predicate).

    Where the reader has kept malformed rows, they fail the first step.
    """
    readable = [("malformed", F.col(CORRUPT_COLUMN).isNull())] if CORRUPT_COLUMN in df.columns else []
    return readable + [
        ("country", F.col("Country").isin(*rules.countries)),
        ("nulls", is_present(df, rules.critical)),
        ("zeros", is_nonzero(rules.nonzero)),
        ("patterns", is_matching(rules.patterns)),
        ("decimals", is_precise(rules.decimal_columns, rules.min_decimals)),
        ("technical", is_inside(rules.bounding_box)
            & is_ordered("created", "updated")
            & F.col("radio").isin(*rules.radios)),
    ]


def clean_towers(df: DataFrame, rules: CleanRules = DEFAULT_RULES) -> DataFrame:
    """All quality filters at once, without the unused columns.  No shuffle."""
    keep = _all(test for _, test in quality_steps(df, rules))
    return drop_columns(df.filter(keep), [*rules.unused, CORRUPT_COLUMN])


def failed_step(df: DataFrame, rules: CleanRules = DEFAULT_RULES) -> Column:
    """Number of the first step that a row fails, or the number of steps plus one.

    Later predicates are not evaluated for a failed row; an unknown (null)
    predicate is a failure.
    """
    steps = quality_steps(df, rules)
    failed_at = F.lit(len(steps) + 1)
    for number, (_, test) in reversed(list(enumerate(steps, start=1))):
        failed_at = F.when(F.coalesce(test, F.lit(False)), failed_at).otherwise(F.lit(number))
    return failed_at


def funnel_of(failed: DataFrame, names: Sequence[str], column: str = "failed_at") -> DataFrame:
    """The funnel (step_no, step, rows) from a column made by :func:`failed_step`."""
    names = ["raw", *names]
    counts = [F.count_if(F.col(column) > number).alias(name) for number, name in enumerate(names)]
    cells = ", ".join(f"{number}, '{name}', `{name}`" for number, name in enumerate(names))
    return failed.agg(*counts).selectExpr(f"stack({len(names)}, {cells}) AS (step_no, step, rows)")


def quality_funnel(df: DataFrame, rules: CleanRules = DEFAULT_RULES) -> DataFrame:
    """Rows left after each step: (step_no, step, rows), from a single scan."""
    names = [name for name, _ in quality_steps(df, rules)]
    return funnel_of(df.select(failed_step(df, rules).alias("failed_at")), names)


def cleaned_with_steps(df: DataFrame, rules: CleanRules = DEFAULT_RULES) -> DataFrame:
    """``failed_at`` of every row; the other columns only of rows that pass all steps.

    Rows that fail keep nothing but their step, malformed ones also their text,
    so a written copy is little larger than the cleaned rows, and serves the
    funnel, the quarantine and the cleaning alike.
    """
    kept = drop_columns(df, [*rules.unused, CORRUPT_COLUMN])
    last = len(quality_steps(df, rules)) + 1
    marked = drop_columns(df, rules.unused).withColumn("failed_at", failed_step(df, rules))
    passed = F.col("failed_at") == last
    text = [F.col(CORRUPT_COLUMN)] if CORRUPT_COLUMN in df.columns else []
    return marked.select(
        "failed_at", *text, *[F.when(passed, F.col(name)).alias(name) for name in kept.columns])
