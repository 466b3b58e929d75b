"""Price and cache-floor lookups by model-name prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from estatelens.config import (CACHE_FLOORS, CACHE_WRITE_MULTIPLIER, DEFAULT_CACHE_FLOOR,
                               TOKEN_RATES)
from estatelens.functions.arrays import ColumnLike, _c


def by_prefix(model: ColumnLike, table: dict, default) -> Column:
    """Value of the first listed prefix the model name starts with."""
    model = _c(model)
    chain = reduce(lambda acc, kv: acc.when(model.startswith(kv[0]), F.lit(kv[1])),
                   table.items(), F.when(F.lit(False), F.lit(default)))
    return chain.otherwise(F.lit(default))


def price_call(model: ColumnLike, fresh: ColumnLike, cached: ColumnLike, written: ColumnLike,
               output: ColumnLike, rates: dict = TOKEN_RATES,
               write_multiplier: float = CACHE_WRITE_MULTIPLIER) -> Column:
    """USD for one call; an unknown model prices at zero."""
    def rate(kind: str) -> Column:
        return by_prefix(model, {prefix: float(r[kind]) for prefix, r in rates.items()}, 0.0)

    def tokens(col: ColumnLike) -> Column:
        return F.coalesce(_c(col), F.lit(0))

    million = F.lit(1_000_000)
    return (tokens(fresh) * rate("input") / million
            + tokens(cached) * rate("cached_input") / million
            + tokens(written) * rate("input") * F.lit(write_multiplier) / million
            + tokens(output) * rate("output") / million)


def cache_floor(model: ColumnLike, floors: dict = CACHE_FLOORS,
                default: int = DEFAULT_CACHE_FLOOR) -> Column:
    """Smallest prompt prefix the model caches; the strictest known floor when unknown."""
    return by_prefix(model, floors, default)
