"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Hierarchical residual packing. Every document becomes its token ids and one end id; only a document
longer than a sequence is cut, into full pieces and a last, shorter one. Pieces (lengths, not
texts) are dealt to partitions by hash, so that each partition sees the same mix of lengths, and
best fit in falling order of length fills bins there. Bins that are nearly full leave at once. The
others become items themselves: the partitions form a tree, and on each level the underfull bins
of ``fan_in`` neighbours are packed by best fit again. A bin that no remaining bin fits into
leaves too, so a level carries only bins that can still be joined.

What a task holds: the lengths of its partition; on a level, the underfull bins of its group.

Nulls: null text is an empty document, of the end id alone. A null doc_id is kept as it is; rows
with equal doc_id, and repeated rows, are packed one by one. An empty table gives no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from estatelens.llm import tokens, words
from estatelens.session import written

CAPACITY, END_ID, FAN_IN = 4096, 1, 8
NEARLY_FULL = 16            # a bin with at most so many free tokens is not packed further
PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PART_BITS = 32              # a bin's number: level, partition or group, number inside


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           tokenizer: str | None = None) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32."""
    path = tokenizer or tokens.default_path()

    def run(batches):
        encoder = tokens.Words.of(path)
        for batch in words.slices(batches, nbytes=tokens.SLICE_BYTES):
            ids, offsets = encoder.encode(batch.column("text"), end_id)
            n = np.diff(offsets)
            count = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(n[doc] - start, capacity)
            at = offsets[doc] + start
            crc = words.crc32(np.append(at, at[-1] + length[-1]), ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                 pa.array(start), pa.array(length), pa.array(crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, PIECE)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item, taken in falling order of size: each goes to the bin
    with the least room that still holds it."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]     # bins by free room
    rooms = 0                                                        # bit r: a bin has room r
    n_bins = 0
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = waiting[room]
            at = own.pop()
            if not own:
                rooms ^= 1 << room
        else:
            room, at = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = at, capacity - room
        room -= size
        if room:
            if not waiting[room]:
                rooms |= 1 << room
            waiting[room].append(at)
    return bins, offsets


def _pack_partitions(table: DataFrame, capacity: int) -> DataFrame:
    """First level: pieces with their bin, the bin's size, and their offset in it."""
    def run(frames):
        part = TaskContext.get().partitionId()
        rows = [f for f in frames if len(f)]
        if not rows:
            return
        rows = pd.concat(rows).sort_values(["length", "doc_id", "piece", "ids_crc32"],
                                           ascending=[False, True, True, True])
        bins, offset = best_fit(rows["length"].to_numpy(), capacity)
        size = np.bincount(bins, weights=rows["length"]).astype(np.int64)
        yield rows.assign(bin=bins + (part << PART_BITS), offset=offset, bin_size=size[bins],
                          part=part)

    return table.mapInPandas(run, PIECE + ", bin bigint, offset bigint, bin_size bigint, part int")


def _pack_groups(bins: DataFrame, level: int, fan_in: int, capacity: int) -> DataFrame:
    """One level up: (bin, parent, offset, size of the parent, group)."""
    def run(frame):
        frame = frame.sort_values(["size", "bin"], ascending=[False, True])
        parent, offset = best_fit(frame["size"].to_numpy(), capacity)
        size = np.bincount(parent, weights=frame["size"]).astype(np.int64)
        group = int(frame["part"].iloc[0])
        base = (level << 56) | (group << PART_BITS)
        return pd.DataFrame({"bin": frame["bin"], "parent": base + parent, "offset": offset,
                             "size": size[parent], "part": group})

    grouped = bins.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
    return grouped.groupBy("part").applyInPandas(
        run, "bin bigint, parent bigint, offset bigint, size bigint, part int")


def _open(bins: DataFrame, capacity: int) -> DataFrame:
    """Underfull bins that the smallest underfull bin still fits into, and that one itself."""
    under = bins.where(F.col("size") < capacity - NEARLY_FULL)
    least = under.agg(F.min("size")).first()[0]
    return under.where(F.col("size") + F.lit(least or 0) <= capacity)


def pack(table: DataFrame, capacity: int = CAPACITY, fan_in: int = FAN_IN) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (``pieces``)."""
    dealt = table.repartition("doc_id", "piece", "ids_crc32")
    first = written(_pack_partitions(dealt, capacity), "packed")
    n_parts = (first.agg(F.max("part")).first()[0] or 0) + 1
    bins = first.groupBy("bin").agg(F.first("bin_size").alias("size"), F.first("part").alias("part"))
    levels: list[DataFrame] = []
    while n_parts > 1:
        opened = _open(bins, capacity)
        level = written(_pack_groups(opened, len(levels) + 1, fan_in, capacity), "packed-level")
        levels.append(level)
        bins = level.select(F.col("parent").alias("bin"), "size", "part").distinct()
        n_parts = -(-n_parts // fan_in)
    moved = None                # every bin that moved up -> its last parent, offset there
    for level in reversed(levels):
        step = level.select("bin", "parent", F.col("offset").alias("inner"))
        if moved is None:
            moved = step
            continue
        above = moved.select(F.col("bin").alias("parent"), F.col("parent").alias("top"),
                             F.col("inner").alias("more"))
        moved = step.join(above, "parent", "left").select(
            "bin", F.coalesce("top", "parent").alias("parent"),
            (F.col("inner") + F.coalesce("more", F.lit(0))).alias("inner"))
    out = first
    if moved is not None:
        out = out.join(moved, "bin", "left")
    else:
        out = out.withColumns({"parent": F.lit(None).cast("bigint"), "inner": F.lit(0)})
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("parent", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("inner", F.lit(0))).cast("bigint").alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                   fan_in: int = FAN_IN, tokenizer: str | None = None) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its sequence and place."""
    table = written(pieces(docs, capacity, end_id, tokenizer), "pieces")
    return pack(table, capacity, fan_in)
