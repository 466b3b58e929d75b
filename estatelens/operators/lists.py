"""Distinct values of an entity as numbered chunks of bounded size.

The joined texts and arrays of the account tables are one value per entity, as published. An entity
with very many names is better read from here: it is many rows, written by many tasks, and a reader
takes the chunks that it needs. Values of ordinary entities are shuffled once. Those of an entity with
more than ``HOT_ROWS`` are placed in a global order, so the place of a value within its entity is a
difference of two places and no task sees a whole hot entity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from estatelens.operators.entities import HOT_ROWS, of_interest
from estatelens.operators.ranking import with_position

CHUNK = 1_000
LISTED = ("org", "technology", "product", "country_code", "waf")
LISTS = "entity_domain string, facet string, chunk bigint, n int, values array<string>"


def entity_lists(facets: DataFrame, names=LISTED, size: int = CHUNK) -> DataFrame:
    """(entity_domain, facet, chunk, n, values): the values of each facet in order, ``size`` a row,
    chunks counted from 0."""
    key = ["entity_domain", "facet"]
    rows = of_interest(facets, names).select(*key, "value").where("entity_domain is not null")
    hot = F.broadcast(rows.groupBy("entity_domain").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > HOT_ROWS).select("entity_domain"))
    # Values of ordinary entities are numbered where they meet; those of hot ones over all tasks.
    place = F.row_number().over(Window.partitionBy(*key).orderBy("value"))
    ordinary = rows.join(hot, "entity_domain", "left_anti").select(
        *key, F.floor((place - 1) / size).alias("chunk"), "value")
    placed = with_position(rows.join(hot, "entity_domain", "left_semi"), [*key, "value"], "place", start=0)
    first = placed.groupBy(*key).agg(F.min("place").alias("first"))
    chunked = placed.join(first, key).select(
        *key, F.floor((F.col("place") - F.col("first")) / size).alias("chunk"), "value")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a chunk follow each other; a chunk may go on in the next batch."""
        held = []

        def chunks(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            ends = np.append(starts[1:], len(rows))
            entity, facet, number = (rows[c].combine_chunks().take(pa.array(starts))
                                     for c in ("entity_domain", "facet", "chunk"))
            listed = pa.ListArray.from_arrays(pa.array(np.append(starts, len(rows)), pa.int32()),
                                              rows["value"].combine_chunks())
            return pa.RecordBatch.from_arrays(
                [entity, facet, number, pa.array(ends - starts, pa.int32()), listed],
                ["entity_domain", "facet", "chunk", "n", "values"])

        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([*held, batch])
            new = np.zeros(len(rows), bool)
            new[0] = True
            for c in ("chunk", "facet", "entity_domain"):
                column = rows[c].combine_chunks()
                differs = pc.invert(pc.fill_null(pc.equal(column[1:], column[:-1]), False))
                both_null = pc.and_(pc.is_null(column[1:]), pc.is_null(column[:-1]))
                new[1:] |= pc.and_not(differs, both_null).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            if starts[-1]:
                yield chunks(rows.slice(0, starts[-1]), starts[:-1])
            held = rows.slice(starts[-1]).to_batches()
        if held:
            yield chunks(pa.Table.from_batches(held), np.zeros(1, np.int64))

    dealt = chunked.repartition(*key, "chunk").sortWithinPartitions(*key, "chunk", "value")
    return ordinary.mapInArrow(cut, LISTS).unionByName(dealt.mapInArrow(cut, LISTS))


def leading(lists: DataFrame, facet: str, items: int, size: int = CHUNK) -> DataFrame:
    """(entity_domain, values): at most the first ``items`` values, from the chunks that hold them."""
    chunks = -(-items // size)
    needed = lists.where((F.col("facet") == facet) & (F.col("chunk") < chunks))
    if chunks == 1:
        return needed.select("entity_domain", F.slice("values", 1, items).alias("values"))
    together: Column = F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("chunk", "values"))), lambda c: c["values"]))
    return needed.groupBy("entity_domain").agg(F.slice(together, 1, items).alias("values"))
