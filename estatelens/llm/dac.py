"""Token ids in binary files of directly addressable codes (DACs).

Ids are split into chunks of ``CHUNK_BITS`` bits, the lowest first. Level 0 holds the lowest chunk
of every id, level 1 the next chunk of those ids that have one, and so on. A continuation bitmap
per level says which ids go on, and a rank directory (ones before each block of bits) tells where
in the next level. So any id is read by one lookup per level, without decoding its neighbours.

A file holds whole documents in ascending doc_id order, about ``FILE_TOKENS`` ids, and is written
as one binary value of a Parquet table: Spark's commit protocol covers it, a lost executor's task
is repeated, and any store that Spark writes can hold it.

Layout, little endian: magic ``DAC1``; uint32 chunk bits, levels; uint64 documents, ids; int64
doc_id and uint8 presence per document; uint64 end of each document; per level uint64 length,
chunks, bitmap bytes (padded to a block), uint32 ones before each block.

Nulls: null text is an empty document, of the end id alone. Rows without doc_id come first. Rows
with equal doc_id follow each other in the order of their text's hash. An empty table gives no file.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from estatelens.llm import tokens, words
from estatelens.session import written

END_ID, FILE_TOKENS, CHUNK_BITS, BLOCK_BITS = 2, 1 << 20, 8, 512
_CHUNK = np.dtype("<u1")
_HEAD = struct.Struct("<4sIIQQ")


# ------------------------------------------------------------------------------ one file
def encode(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of these documents; ``ends`` are the ids up to and with each document."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> np.uint32(CHUNK_BITS)
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        blocks = -(-max(len(rest), 1) // BLOCK_BITS)
        bitmap = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
        bitmap[:len(bits)] = bits
        ones = np.bitwise_count(bitmap).reshape(blocks, -1).sum(axis=1, dtype=np.int64)
        before = (np.cumsum(ones) - ones).astype("<u4")
        levels.append((len(rest), (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(_CHUNK),
                       bitmap, before))
        rest = more[goes_on]
        if not len(rest):
            break
    out = [_HEAD.pack(b"DAC1", CHUNK_BITS, len(levels), len(doc_ids), len(ids)),
           np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
           np.array([d is not None for d in doc_ids], "u1").tobytes(), ends.astype("<u8").tobytes()]
    for n, chunks, bitmap, before in levels:
        out += [struct.pack("<Q", n), chunks.tobytes(), bitmap.tobytes(), before.tobytes()]
    return b"".join(out)


class File:
    """Reads a file: ``token(i)`` at random, ``tokens()`` all at once."""

    def __init__(self, data: bytes):
        magic, self.bits, n_levels, self.n_docs, self.n_tokens = _HEAD.unpack_from(data)
        if magic != b"DAC1":
            raise ValueError("not a file of directly addressable codes")
        at = _HEAD.size

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, n, at)
            at += out.nbytes
            return out

        ids, there = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.doc_ids = [int(d) if t else None for d, t in zip(ids, there)]
        self.ends = take("<u8", self.n_docs).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-max(n, 1) // BLOCK_BITS)
            self.levels.append((take("u1", n), take("u1", blocks * BLOCK_BITS // 8),
                                take("<u4", blocks)))

    def token(self, i: int) -> int:
        """Id number ``i``: one chunk, one bit and one rank per level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        out = 0
        for k, (chunks, bitmap, before) in enumerate(self.levels):
            out |= int(chunks[i]) << (self.bits * k)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK_BITS
            inside = bitmap[block * BLOCK_BITS // 8:(i >> 3) + 1].copy()
            inside[-1] &= (1 << (i & 7)) - 1
            i = int(before[block]) + int(np.bitwise_count(inside).sum())
        return out

    def tokens(self) -> np.ndarray:
        out = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            whole = chunks.astype(np.uint32)
            goes_on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)
            whole[goes_on] |= out << np.uint32(self.bits)
            out = whole
        return out


# ------------------------------------------------------------------------------ tables of files
FILES = "part int, number int, first_doc bigint, last_doc bigint, n_docs bigint, n_tokens bigint, data binary"


def write_files(docs: DataFrame, end_id: int = END_ID, tokenizer: str | None = None,
                file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode all texts in ascending doc_id order; returns the written table of files, in the
    order (part, number). Texts are shuffled once, by range of doc_id; a task holds one file."""
    path = tokenizer or tokens.default_path()

    def run(batches):
        encoder, part, number = tokens.Words.of(path), TaskContext.get().partitionId(), 0
        names, lengths, held, n_held = [], [], [], 0

        def close():
            nonlocal number, names, lengths, held, n_held
            ids = np.concatenate(held)
            data = encode(names, np.cumsum(np.concatenate(lengths)), ids)
            row = [part, number, names[0], names[-1], len(names), len(ids), data]
            number += 1
            names, lengths, held, n_held = [], [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (
                    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                    pa.binary()))],
                ["part", "number", "first_doc", "last_doc", "n_docs", "n_tokens", "data"])

        for batch in words.slices(batches, nbytes=file_tokens * 4):
            ids, offsets = encoder.encode(batch.column("text"), end_id)
            names += batch.column("doc_id").to_pylist()
            lengths.append(np.diff(offsets))
            held.append(ids)
            n_held += len(ids)
            if n_held >= file_tokens:
                yield close()
        if names:
            yield close()

    ordered = (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
               .withColumn("_tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
               .drop("_tie"))
    return written(ordered.mapInArrow(run, FILES), "token-files")


def with_base(files: DataFrame) -> DataFrame:
    """Add ``base``, the ids before each file. Within a part by a window over its files; between
    parts by the totals of the parts, one row per write task."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
              .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_parts")))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
                         .alias("_files")).join(totals, "part")
    return bases.select("part", "number", (F.col("_files") + F.col("_parts")).alias("base"))


def read_documents(files: DataFrame) -> DataFrame:
    """Decode every file: doc_id, start, n_tokens, ids_crc32 of each document."""
    def run(batches):
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("data")):
                file = File(data.as_buffer())
                begins = np.concatenate([[0], file.ends])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(base + begins[:-1]),
                     pa.array(np.diff(begins)), pa.array(words.crc32(begins, file.tokens()))],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    bases = with_base(files)
    placed = files.select("part", "number", "data").join(bases, ["part", "number"])
    return placed.select("base", "data").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def lookup(files: DataFrame, positions: DataFrame) -> DataFrame:
    """The id at each global ``position`` (bigint): random access, without decoding the files.
    Positions outside the table get no row."""
    def run(batches):
        for batch in batches:
            file, data = None, None
            out = []
            for place, base, blob in zip(*(batch.column(c) for c in ("position", "base", "data"))):
                if blob is not data:
                    file, data = File(blob.as_buffer()), blob
                out.append((place.as_py(), file.token(place.as_py() - base.as_py())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], pa.int64()), pa.array([t for _, t in out], pa.int64())],
                ["position", "token"])

    spans = files.join(with_base(files), ["part", "number"]).select("base", "n_tokens", "data")
    wanted = positions.select(F.col("position").cast("bigint"))
    inside = (wanted.position >= spans.base) & (wanted.position < spans.base + spans.n_tokens)
    return wanted.join(spans, inside).select("position", "base", "data").mapInArrow(
        run, "position bigint, token bigint")
