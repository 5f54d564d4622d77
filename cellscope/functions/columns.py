"""Scalar column expressions.

Each function takes and returns ``Column`` objects.  There is no Python UDF
here, so a projection that uses them stays inside whole-stage code generation.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AS_OF_EPOCH, SECONDS_PER_DAY

HASH_DIGITS = 13

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def lookup(key: Column, mapping: Mapping) -> Column:
    """Dictionary lookup; a key that is null or not listed gives null."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def banded(value: Column, bands: Iterable[tuple[str, float, str]], otherwise: str) -> Column:
    """Label of the first band whose comparison holds; null falls to the last label."""
    case = None
    for sign, limit, label in bands:
        test = _COMPARE[sign](value, F.lit(limit))
        case = F.when(test, F.lit(label)) if case is None else case.when(test, F.lit(label))
    return F.lit(otherwise) if case is None else case.otherwise(F.lit(otherwise))


def age_days(updated: Column, as_of: int = AS_OF_EPOCH) -> Column:
    """Days from ``updated`` (epoch seconds) to ``as_of``; the future counts as 0.

    The subtraction is done in doubles so that an absurd epoch cannot raise an
    overflow under ANSI mode.  ``greatest`` ignores nulls, hence the guard.
    """
    days = (F.lit(float(as_of)) - updated.cast("double")) / F.lit(float(SECONDS_PER_DAY))
    return F.when(updated.isNotNull(), F.greatest(F.lit(0.0), days))


def utc_year(epoch: Column) -> Column:
    """Calendar year (UTC) of epoch seconds, whatever the session time zone is."""
    day = F.floor(epoch.cast("double") / F.lit(float(SECONDS_PER_DAY)))
    return F.year(F.date_from_unix_date(day.try_cast("int")))


def fraction_digits(number: Column) -> Column:
    """Digits after the point in the shortest text form of ``number``.

    The column type matters: a float prints as ``106.82`` where the same value
    widened to double prints sixteen digits.  ``1.0E-4`` has one digit.
    """
    return F.length(F.regexp_extract(F.abs(number).cast("string"), r"\.(\d+)", 1))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` in doubles, null when ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, null when ``whole`` is zero."""
    return ratio(part, whole) * F.lit(100.0)


def unit_hash(key: Column, salt: str) -> Column:
    """Number in [0, 1) drawn from ``md5('<salt>:<key>')``.

    Depends on the row only, so a sample or split does not change with the
    number of partitions, a task retry or a lost executor.  Thirteen hex digits
    are 52 bits: exact in a double, and fine enough to draw thousands of rows
    out of trillions.
    """
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
    return bits / F.lit(float(16**HASH_DIGITS))
