"""Labels, ratios and quality rules as expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cases(branches: Iterable[tuple[Column, object]], otherwise=None) -> Column:
    """``CASE WHEN … THEN … ELSE … END`` from (condition, value) pairs."""
    chain = F
    for condition, value in branches:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def bands(value: Column, above: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first threshold that ``value`` exceeds."""
    return cases(((value > threshold, label) for threshold, label in above), otherwise)


def at_least(value: Column, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first floor that ``value`` reaches."""
    return cases(((value >= floor, label) for floor, label in floors), otherwise)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage as a double; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def first_broken(rules: Sequence[tuple[str, Column]], otherwise: str = "VALID") -> Column:
    """Name of the first rule whose condition holds; an unknown condition does not hold."""
    return cases(((condition, name) for name, condition in rules), otherwise)


def or_default(defaults: Mapping[str, object]) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()]


def jitter(key: Sequence[str], spread: int, seed: int = 0) -> Column:
    """A whole number from 0 to ``spread`` - 1 for test changes.

    It follows from the key and the seed, so a repeated task makes the same change.
    """
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(spread))
