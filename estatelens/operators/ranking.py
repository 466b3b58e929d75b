"""Global order over any number of rows: positions, running totals, percentiles.

A window without PARTITION BY pulls the table into one task. Here the table is range-partitioned
on the order, written once with its place inside its partition, and each partition gets an offset
from the partition totals (one row per partition). Give a unique order key and no partition can be
made hot by ties.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from estatelens.session import written

INDEX_BITS = 33     # monotonically_increasing_id: partition above, row below


def _free(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def _ordered(df: DataFrame, order, place: str) -> DataFrame:
    placed = df.orderBy(*order).withColumn(place, F.monotonically_increasing_id())
    return written(placed, "ordered")


def _partition(place: str) -> Column:
    return F.shiftright(place, INDEX_BITS)


def _offsets(ordered: DataFrame, place: str, amounts: list[Column]) -> DataFrame:
    """(part, before): totals before each partition, in the order of ``amounts``. The only
    unpartitioned window: one row per task."""
    totals = ordered.groupBy(_partition(place).alias("part")).agg(
        *[F.sum(amount).alias(f"n{i}") for i, amount in enumerate(amounts)])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.struct(*[
        F.coalesce(F.sum(f"n{i}").over(before), F.lit(0)).alias(f"n{i}")
        for i in range(len(amounts))]).alias("before"))


def _with_offsets(ordered: DataFrame, place: str, amounts: list[Column], part: str, before: str) -> DataFrame:
    offsets = _offsets(ordered, place, amounts).select(F.col("part").alias(part), F.col("before").alias(before))
    return ordered.withColumn(part, _partition(place)).join(F.broadcast(offsets), part)


def with_position(df: DataFrame, order, name: str = "rank", start: int = 1) -> DataFrame:
    """Dense position in the global order, counted from ``start``."""
    place, part, before = (_free(df, c) for c in ("_place", "_part", "_before"))
    ordered = _ordered(df, order, place)
    inside = F.col(place).bitwiseAND((1 << INDEX_BITS) - 1)
    return (_with_offsets(ordered, place, [F.lit(1).cast("bigint")], part, before)
            .withColumn(name, F.col(f"{before}.n0") + inside + start).drop(part, place, before))


def with_running_totals(df: DataFrame, order, amounts: dict[str, Column]) -> DataFrame:
    """For each name the sum of its amount over this row and all before it: one sort for all."""
    place, part, before, own, inside = (_free(df, c) for c in (
        "_place", "_part", "_before", "_amounts", "_inside"))
    each = range(len(amounts))
    ordered = _ordered(df.withColumn(own, F.struct(
        *[amount.alias(f"n{i}") for i, amount in enumerate(amounts.values())])), order, place)
    so_far = Window.partitionBy(part).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    placed = _with_offsets(ordered, place, [F.col(f"{own}.n{i}") for i in each], part, before)
    summed = placed.withColumn(inside, F.struct(
        *[F.sum(F.col(f"{own}.n{i}")).over(so_far).alias(f"n{i}") for i in each]))
    total = {name: F.col(f"{before}.n{i}") + F.col(f"{inside}.n{i}") for i, name in enumerate(amounts)}
    return summed.withColumns(total).drop(part, place, own, inside, before)


def with_running_total(df: DataFrame, order, amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over this row and all before it in the global order."""
    return with_running_totals(df, order, {name: amount})


BINS = 1 << 10


def value_at(df: DataFrame, column: str, fractions: dict[str, float]) -> DataFrame:
    """Exact percentiles by sorted index: element floor(n * fraction), counted from 0, nulls first.

    Nothing is sorted. Whole numbers are selected by refinement: every pass counts the values of
    each wanted range in ``BINS`` bins and goes on with the bin that holds the wanted place, until it
    has one value. A pass is one aggregate of at most BINS rows per percentile; 64-bit
    numbers need at most seven.
    """
    if not isinstance(df.schema[column].dataType, T.IntegralType):
        return _value_at_sorted(df, column, fractions)
    values = df.select(F.col(column).cast("bigint").alias("v"))
    n, filled, low, high = values.agg(F.count(F.lit(1)), F.count("v"), F.min("v"), F.max("v")).first()
    done: dict[str, int | None] = dict.fromkeys(fractions)
    # name -> (place among the values from low to high, low, high)
    open_: dict[str, tuple[int, int, int]] = {}
    for name, fraction in fractions.items():
        place = math.floor(n * float(fraction)) - (n - filled)
        if 0 <= place < filled:
            open_[name] = (place, low, high)
    while open_:
        for name, (place, low, high) in list(open_.items()):
            if low == high:
                done[name] = low
                del open_[name]
        if not open_:
            break
        bins = [F.struct(F.lit(name).alias("name"), _bin(F.col("v"), low, high).alias("bin"))
                for name, (_, low, high) in open_.items()]
        counted = (values.select("v", F.inline(F.array(*bins))).where("bin is not null")
                   .groupBy("name", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"),
                                               F.max("v").alias("high")).collect())
        for name, (place, _, _) in list(open_.items()):
            for r in sorted((r for r in counted if r.name == name), key=lambda r: r.bin):
                if place < r.n:
                    open_[name] = (place, r.low, r.high)
                    break
                place -= r.n
    kind = df.schema[column].dataType
    return df.sparkSession.createDataFrame([tuple(done[name] for name in fractions)], T.StructType(
        [T.StructField(name, T.LongType()) for name in fractions])).select(
        *[F.col(f"`{name}`").cast(kind).alias(name) for name in fractions])


def _bin(value: Column, low: int, high: int) -> Column:
    """Bin of a value from low to high, else null: 0 for low, BINS - 1 for high, never falling. Half
    values where the range is wider than a long."""
    wide = high - low >= 1 << 62
    part = (value.cast("double") / 2 - F.lit(low / 2.0)) / (high / 2.0 - low / 2.0) if wide else (
        (value - F.lit(low)).cast("double") / float(high - low))
    inside = F.least(F.floor(part * BINS), F.lit(BINS - 1))
    return F.when((value >= F.lit(low)) & (value <= F.lit(high)), inside)


def _value_at_sorted(df: DataFrame, column: str, fractions: dict[str, float]) -> DataFrame:
    """The same of values of any kind, over their histogram in order."""
    histogram = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    running = with_running_total(histogram, [column], F.col("n"), "up_to")
    size = running.agg(F.max("up_to").alias("size"))
    located = running.withColumn("size", size.scalar())
    picks = []
    for name, fraction in fractions.items():
        index = F.floor(F.col("size") * F.lit(float(fraction)))
        here = (index < F.col("up_to")) & (index >= F.col("up_to") - F.col("n"))
        picks.append(F.max(F.when(here, F.col(column))).alias(name))
    return located.agg(*picks)
