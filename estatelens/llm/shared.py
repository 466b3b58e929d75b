"""Windows of n items (words or bytes) that also occur in a document with a smaller doc_id.

Two equal windows have equal grams, so the smallest gram hash of a window (its minimizer) is the
same wherever the window stands. A document is cut into runs of consecutive windows with the same
minimizer; a run and the n - 1 items behind it are its segment. Only equal minimizers have to meet:

1. of equal texts the one with the smallest doc_id goes on; the others lose all they have;
2. minimizers are counted (per slice of text first, then over all); those of one document only are
   done with, and with them most of the text: a Bloom filter of the others goes to every task;
3. segments with a shared minimizer are dealt to blocks by minimizer. Within a block equal segments
   become one, with the smallest doc_id that has it: every other holder loses all its windows. The
   different segments are compared by the operator's own method, which says which of their windows
   occur in a smaller document;
4. a minimizer with very many segments would make a block too large. Its segments and windows are
   aggregated one by one instead, with partial sums in every task, and joined back.

No step gathers the holders of a text, a frequent minimizer or a frequent window in one place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from estatelens.llm import words
from estatelens.llm.rules import fresh_name
from estatelens.session import written

BROADCAST_LONGS = 4_000_000      # a list of this many longs (32 MB) at most is broadcast
FILTER_LOG, SLICE_LOG = 26, 15   # a filter has at most 64 MB, its slices have 256 KB
HOT_SEGMENTS = 20_000            # segments of one minimizer dealt to one block
WHOLE = -1                       # as the end of a span: the whole text
RESULT = T.StructType([
    T.StructField("n_items", T.LongType(), False), T.StructField("n_removed", T.LongType(), False),
    T.StructField("n_spans", T.LongType(), False), T.StructField("kept", T.BinaryType(), False)])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and the place of each."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data else np.zeros(0, np.uint8)
    return buf, ends - ends[0]


class WordItems:
    """Items are words; a segment is the text from its first to its last word."""
    gram = 8
    _space = np.zeros(256, bool)
    _space[[32, 9, 10, 11, 12, 13]] = True

    def grams(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes, offsets = words.hashes(texts)
        return words.windows(hashes, self.gram), offsets

    def segments(self, texts: pa.Array, first: np.ndarray, count: np.ndarray) -> list[bytes]:
        buf, at = text_bytes(texts)
        inside = ~self._space[buf]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        starts_doc = at[:-1][(at[:-1] < len(buf)) & (np.diff(at) > 0)]
        begins[starts_doc] = inside[starts_doc]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        ends_doc = at[1:][np.diff(at) > 0] - 1
        ends[ends_doc] = inside[ends_doc]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        data = buf.tobytes()
        return [data[a:b] for a, b in zip(begins[first].tolist(), ends[first + count - 1].tolist())]

    def windows_of(self, segment: bytes, n: int) -> list[bytes]:
        items = segment.split()
        return [b" ".join(items[i:i + n]) for i in range(len(items) - n + 1)]

    def count(self, text: str) -> int:
        return len(text.encode().split())

    def keep(self, text: str, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
        items = text.encode().split()
        kept, at = [], 0
        for a, b in spans:
            kept += items[at:a]
            at = b
        kept += items[at:]
        return len(items), len(items) - len(kept), b" ".join(kept)


class ByteItems:
    """Items are bytes of the UTF-8 text; a segment is those bytes."""
    gram = 16

    def grams(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        buf, at = text_bytes(texts)
        if len(buf) < self.gram:
            return np.zeros(0, np.uint64), at
        eight = np.empty(len(buf) - 7, np.uint64)       # the 8 bytes from each place on
        for k in range(8):
            n = (len(buf) - k) // 8
            eight[k::8][:n] = np.frombuffer(buf[k:k + 8 * n].tobytes(), "<u8")
        with np.errstate(over="ignore"):
            return words.mix(words.mix(eight[:-8] + np.uint64(0x9E3779B97F4A7C15))
                             * np.uint64(0xD6E8FEB86659FD93) + eight[8:]), at

    def segments(self, texts: pa.Array, first: np.ndarray, count: np.ndarray) -> list[bytes]:
        data = text_bytes(texts)[0].tobytes()
        return [data[a:b] for a, b in zip(first.tolist(), (first + count).tolist())]

    def windows_of(self, segment: bytes, n: int) -> list[bytes]:
        return [segment[i:i + n] for i in range(len(segment) - n + 1)]

    def count(self, text: str) -> int:
        return len(text.encode())

    def keep(self, text: str, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
        data = text.encode()
        kept, at = [], 0
        for a, b in spans:
            kept.append(data[at:a])
            at = b
        kept.append(data[at:])
        out = b"".join(kept)
        return len(data), len(data) - len(out), out


# Segments and their smallest doc_id -> for each, its windows that a smaller document has.
Compare = Callable[[list[bytes], np.ndarray], list[list[int]]]


@dataclass(frozen=True)
class Search:
    items: WordItems | ByteItems
    n: int                      # items per window
    compare: Compare
    block_segments: int         # segments per block, about
    hot_segments: int = HOT_SEGMENTS


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from each place on."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - (width - done)], values[width - done:])


def runs(search: Search, texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(document, minimizer, first item in the slice, first item in the document, windows)."""
    grams, offsets = search.items.grams(texts)
    width = search.n - search.items.gram + 1
    places = words.inside(offsets, search.n)
    if not len(places):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none
    least = _least(grams, width)[places]
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1] + 1) | (least[1:] != least[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(places)))
    # Repetitive text has long runs; they are cut so that segments stay short.
    pieces = -(-length // width)
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin, length = np.repeat(begin, pieces) + nth * width, np.repeat(length, pieces) - nth * width
    count = np.minimum(length, width)
    first = places[begin]
    doc = np.searchsorted(offsets, first, side="right") - 1
    return doc, least[begin], first, first - offsets[doc], count


def _minimizers(docs: DataFrame, search: Search) -> DataFrame:
    """(m, docs, runs) per minimizer and slice of text."""
    def run(batches):
        for batch in words.slices(batches):
            doc, least, *_ = runs(search, batch.column("text"))
            if not len(doc):
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[doc]
            order = np.lexsort((ids, least))
            least, ids = least[order], ids[order]
            new = np.append(True, least[1:] != least[:-1])
            other = np.append(True, ids[1:] != ids[:-1]) | new
            first = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(least[first].view(np.int64)),
                 pa.array(np.add.reduceat(other.astype(np.int64), first)),
                 pa.array(np.diff(np.append(first, len(least))))], ["m", "docs", "runs"])

    return docs.mapInArrow(run, "m bigint, docs bigint, runs bigint")


def _bits(keys: np.ndarray, log: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key the word of a filter of 1 << ``log`` bytes, and its three bits in that word."""
    h = words.mix(keys.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15))
    one, low = np.uint64(1), np.uint64(63)
    mask = (one << (h & low)) | (one << (h >> np.uint64(6) & low)) | (one << (h >> np.uint64(12) & low))
    return (h >> np.uint64(64 - (log - 3))).astype(np.int64), mask


def _filter(keys: DataFrame, n: int) -> tuple[int, bytes]:
    """(log, bits): a Bloom filter of the ``n`` keys ``m``, with 2 to 4 bytes a key, at most
    1 << ``FILTER_LOG``. It holds every key; others that it lets through cost room and nothing else."""
    log = min(max(10, (2 * n - 1).bit_length()), FILTER_LOG)
    inner = min(log - 3, SLICE_LOG)      # words of a slice, which one task fills

    def placed(batches):
        for batch in batches:
            at, mask = _bits(batch.column("m").to_numpy(zero_copy_only=False), log)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> inner).astype(np.int32)), pa.array((at & ((1 << inner) - 1)).astype(np.int32)),
                 pa.array(mask.view(np.int64))], ["part", "at", "mask"])

    def filled(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << inner, np.uint64)
        np.bitwise_or.at(bits, table["at"].to_numpy(), table["mask"].to_numpy().view(np.uint64))
        return pa.table({"part": table["part"].slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    slices = (keys.select("m").mapInArrow(placed, "part int, at int, mask bigint").groupBy("part")
              .applyInArrow(filled, "part int, bits binary"))
    out = bytearray(1 << log)
    for r in slices.collect():           # bounded by the size of the filter
        out[r.part << inner + 3:r.part + 1 << inner + 3] = r.bits
    return log, bytes(out)


def _segments(docs: DataFrame, search: Search, known=None) -> DataFrame:
    """Segments; with ``known``, a broadcast filter, those whose minimizer it lets through."""
    def run(batches):
        if known is not None:
            log, bits = known.value
            bits = np.frombuffer(bits, np.uint64)
        for batch in words.slices(batches, nbytes=2 << 20):
            texts = batch.column("text")
            doc, least, first, start, count = runs(search, texts)
            if known is not None and len(doc):
                at, mask = _bits(least, log)
                through = bits[at] & mask == mask
                doc, least, first, start, count = (x[through] for x in (doc, least, first, start, count))
            if not len(doc):
                continue
            segment = search.items.segments(texts, first, count + search.n - 1)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(least.view(np.int64)), batch.column("doc_id").take(at),
                 batch.column("tie").take(at), pa.array(start), pa.array(count.astype(np.int32)),
                 pa.array(segment, pa.binary())],
                ["m", "doc_id", "tie", "start", "windows", "segment"])

    return docs.mapInArrow(
        run, "m bigint, doc_id bigint, tie bigint, start bigint, windows int, segment binary")


def _among(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (or is not) in ``keys``, a written table of bigint columns: broadcast if
    it is short by its row count, else a shuffled join."""
    short = keys.count() * len(keys.columns) <= BROADCAST_LONGS
    return rows.join(F.broadcast(keys) if short else keys, keys.columns, how)


def _in_blocks(held: DataFrame, search: Search, n_blocks: int) -> DataFrame:
    """(doc_id, tie, b, e): spans to remove, found block by block."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        m, doc, start, count = (table[c].to_numpy() for c in ("m", "doc_id", "start", "windows"))
        coded = pc.dictionary_encode(table["segment"]).combine_chunks()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(first, which, doc)
        own = np.zeros(len(first), np.int64)
        own[which] = m
        _, group, sizes = np.unique(own, return_inverse=True, return_counts=True)
        several = np.flatnonzero(sizes[group] > 1)
        places: dict[int, list[int]] = {}
        if len(several):
            found = search.compare(coded.dictionary.take(pa.array(several)).to_pylist(),
                                   first[several])
            places = {u: p for u, p in zip(several.tolist(), found) if p}
        every = np.flatnonzero(doc > first[which])
        begin, end, row = [start[every]], [start[every] + count[every] + search.n - 1], [every]
        partly = np.zeros(len(first), bool)
        partly[list(places)] = True
        for i in np.flatnonzero(partly[which] & (doc == first[which])).tolist():
            for a, b in merged([(p, p + search.n) for p in places[which[i]]]):
                begin.append([start[i] + a])
                end.append([start[i] + b])
                row.append([i])
        at = pa.array(np.concatenate(row).astype(np.int64))
        return pa.table({"doc_id": table["doc_id"].take(at), "tie": table["tie"].take(at),
                         "b": np.concatenate(begin).astype(np.int64),
                         "e": np.concatenate(end).astype(np.int64)})

    block = F.pmod(F.xxhash64("m"), F.lit(n_blocks))
    return held.withColumn("block", block).groupBy("block").applyInArrow(
        run, "doc_id bigint, tie bigint, b bigint, e bigint")


def _one_by_one(held: DataFrame, search: Search) -> DataFrame:
    """The same for minimizers with very many segments: segments, then windows, aggregated."""
    def run(batches):
        for batch in batches:
            out = [(i, k, xxhash.xxh3_128_digest(w))
                   for i, segment in enumerate(batch.column("segment").to_pylist())
                   for k, w in enumerate(search.items.windows_of(segment, search.n))]
            at = pa.array([i for i, _, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("segment").take(at), batch.column("first").take(at),
                 pa.array([k for _, k, _ in out], pa.int32()),
                 pa.array([w for _, _, w in out], pa.binary())],
                ["segment", "first", "place", "window"])

    held = written(held, "hot-segments")
    unique = written(held.groupBy("segment").agg(F.min("doc_id").alias("first")), "hot-unique")
    spread = unique.mapInArrow(run, "segment binary, first bigint, place int, window binary")
    owner = spread.groupBy("window").agg(F.min("first").alias("owner"))
    answers = (spread.join(owner, "window").where("owner < first").groupBy("segment")
               .agg(F.collect_list("place").alias("places")))       # at most a segment's windows
    known = written(unique.join(answers, "segment", "left"), "hot-answers")
    begin, n = F.col("start"), search.n
    every = F.array(F.struct(begin.alias("b"), (begin + F.col("windows") + (n - 1)).alias("e")))
    some = F.transform(F.coalesce("places", F.array().cast("array<int>")),
                       lambda p: F.struct((begin + p).alias("b"), (begin + p + n).alias("e")))
    return (held.join(known, "segment").select("doc_id", "tie", F.inline(
        F.when(F.col("doc_id") > F.col("first"), every).otherwise(some))))


def spans(docs: DataFrame, search: Search) -> DataFrame:
    """(doc_id, tie, spans): items to remove, as unordered, overlapping (b, e) pairs. ``docs`` has
    doc_id, text and tie, a hash of the text that tells rows of equal doc_id apart."""
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text", "tie")
    texts = docs.select("doc_id", "tie", F.xxhash64(F.lit(7), "text").alias("again"))
    least = texts.groupBy("tie", "again").agg(F.min("doc_id").alias("first"))
    copies = written(texts.join(least, ["tie", "again"]).where("doc_id > first")
                     .select("doc_id", "tie").distinct(), "copies")
    docs = _among(docs, copies, "left_anti")
    shared = written(_minimizers(docs, search).groupBy("m")
                     .agg(F.sum("docs").alias("docs"), F.sum("runs").alias("runs"))
                     .where("docs > 1").select("m", "runs"), "shared-minimizers")
    cool = shared.where(F.col("runs") <= search.hot_segments)
    n_segments = cool.agg(F.sum("runs")).first()[0] or 0
    n_blocks = max(1, -(-n_segments // search.block_segments))
    # A segment that nobody shares meets nothing equal, so a filter may stand for the list: it is small
    # enough to look things up before a segment is cut, however long the list.
    known = docs.sparkSession.sparkContext.broadcast(_filter(shared, shared.count()))
    segments = _segments(docs, search, known)
    hot = shared.where(F.col("runs") > search.hot_segments).select("m")
    if hot.isEmpty():
        found = _in_blocks(segments, search, n_blocks)
    else:
        found = _in_blocks(_among(segments, hot, "left_anti"), search, n_blocks).unionByName(
            _one_by_one(_among(segments, hot), search))
    whole = copies.select("doc_id", "tie", F.lit(0).cast("bigint").alias("b"),
                          F.lit(WHOLE).cast("bigint").alias("e"))
    return (found.unionByName(whole).groupBy("doc_id", "tie")
            .agg(F.collect_list(F.struct("b", "e")).alias("spans")))    # at most a text's segments


def merged(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def mark(docs: DataFrame, search: Search, name: str) -> DataFrame:
    """All columns and struct ``name``: n_items, n_removed, n_spans and the kept bytes."""
    tie, found = fresh_name(docs, "_tie"), fresh_name(docs, "_spans")
    text = F.col("text").cast("string")
    keyed = docs.withColumn(tie, F.xxhash64(text))
    table = spans(keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                               text.alias("text"), F.col(tie).alias("tie")), search)
    its_id, its_tie = fresh_name(docs, "_shared_id"), fresh_name(docs, "_shared_tie")
    table = table.select(F.col("doc_id").alias(its_id), F.col("tie").alias(its_tie),
                         F.col("spans").alias(found))
    both = (F.col("doc_id").cast("bigint") == F.col(its_id)) & (F.col(tie) == F.col(its_tie))
    joined = keyed.join(table, both, "left").drop(its_id, its_tie, tie)

    def run(batches):
        for batch in words.slices(batches):
            out = []
            for value, pairs in zip(batch.column("text").cast(pa.string()).to_pylist(),
                                    batch.column(found).to_pylist()):
                text, ends = value or "", [(p["b"], p["e"]) for p in pairs or ()]
                if any(e == WHOLE for _, e in ends):
                    n = search.items.count(text)
                    ends = [(0, n)] if n >= search.n else []
                ends = merged(ends)
                out.append((*search.items.keep(text, ends), len(ends)))
            result = pa.StructArray.from_arrays(
                [pa.array([r[i] for r in out], pa.int64()) for i in (0, 1, 3)]
                + [pa.array([r[2] for r in out], pa.binary())],
                ["n_items", "n_removed", "n_spans", "kept"])
            names = [c for c in batch.schema.names if c != found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), result],
                                             [*names, name])

    return joined.mapInArrow(run, T.StructType([*docs.schema.fields,
                                                T.StructField(name, RESULT, False)]))
