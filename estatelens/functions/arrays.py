"""Null-safe array predicates."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _holds(array: Column, token: str) -> Column:
    """A short array is looked through; overlaps and intersections build a set for every row."""
    return F.coalesce(F.array_contains(array, token), F.lit(False))


def has_any(array: ColumnLike, *tokens: str) -> Column:
    """True when the array holds one of the tokens; null arrays and null elements give false."""
    return reduce(or_, [_holds(_c(array), token) for token in tokens], F.lit(False))


def count_in(array: ColumnLike, tokens) -> Column:
    """How many of the tokens the array holds; null for a null array."""
    array = _c(array)
    held = [F.when(_holds(array, token), 1).otherwise(0) for token in dict.fromkeys(tokens)]
    return F.when(array.isNotNull(), reduce(add, held, F.lit(0)))


def or_empty(array: ColumnLike) -> Column:
    array = _c(array)
    return F.coalesce(array, F.array().cast("array<string>"))


def first(array: ColumnLike) -> Column:
    return F.get(_c(array), F.lit(0))


def matching(condition: Column) -> Column:
    """Count of rows where the condition holds (nulls do not count)."""
    return F.count(F.when(condition, F.lit(1)))
