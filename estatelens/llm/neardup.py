"""Near-duplicate documents by DartMinHash signatures, banding and exact verification.

Similarity is the weighted Jaccard similarity of the ``SHINGLE``-word shingles, the weight of a
shingle being how often its document has it: the sum of lesser counts over the sum of greater ones.
Documents at ``THRESHOLD`` or more are linked, and a class is a connected component of links. So a
text and the same text with a passage many times over are different documents.

Signature: every shingle throws darts at the plane of weight and rank, as many in a region as a
Poisson variable from the shingle's hash says (one per unit of area), each with a place in the
region and one of ``ROWS * BANDS`` coordinates. Darts below the shingle's weight count, and each
coordinate keeps the one with the least rank. Regions are thrown in ascending rank, doubling, until
every coordinate of a document has a dart, so a document with many shingles throws few from each:
time goes with shingles plus darts, not with their product. Two documents agree in a coordinate
with the probability of their weighted Jaccard similarity.

Steps: equal word sequences become one document. Signatures are cut into bands; documents with an
equal band are candidates. In each bucket all are first checked against its smallest doc_id, which
joins nearly everything that is alike; buckets that still hold several components are then compared
pair by pair on sketches of the signatures, in cells of about ``CELL`` by ``CELL`` documents, and
only pairs of different components whose sketches allow the threshold go on. Every pair is verified
on the shingles of the whole texts, and only links leave a task. So a pair of similar documents in
one bucket is linked or already connected.

A pair at similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 28 = 1.5e-5, and a
sketch of 140 coordinates falls below ``SKETCH_LEAST`` at similarity 0.8 with less than 1e-7.

Nulls: a null doc_id has no class and no links. Null and wordless texts are similar to nothing; a
text of fewer than five words only to the same words. Rows of equal doc_id are one document: the
classes of their texts are joined. Empty
tables give no rows; other columns are not read, and are kept by ``keep_one``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from estatelens.llm import words
from estatelens.llm.components import components
from estatelens.session import written

SHINGLE, THRESHOLD, ROWS, BANDS = 5, 0.8, 5, 28
SKETCH_LEAST, CELL, BLOCK_ROWS = 0.62, 2_048, 4_000
BROADCAST_LONGS = 4_000_000      # a list of this many longs (32 MB) at most is broadcast
SLICE_DOCS = 1_000               # documents that throw darts at a time
BLOCK_SHINGLES = 2_000_000       # shingles compared in one block, about (16 MB)
BASE_RANK = 0.25                 # the first region's upper rank
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


# ------------------------------------------------------------------------------ signatures
def _poisson_cdf(mean: float) -> np.ndarray:
    top = int(mean + 12 * mean ** 0.5 + 12)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, top + 1)))])
    return np.cumsum(np.exp(np.arange(top + 1) * np.log(mean) - mean - logs))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def signatures(element: np.ndarray, doc: np.ndarray, n_docs: int, k: int,
               weight: np.ndarray | None = None) -> np.ndarray:
    """n_docs x k uint64; rows of documents without elements stay at the largest value. Repeated
    elements of a document throw the same darts; with ``weight`` elements must be distinct."""
    out = np.full(n_docs * k, _EMPTY)
    has = np.bincount(doc, minlength=n_docs) > 0
    weight_cells = [(0.0, 1.0)]
    while weight is not None and len(weight) and weight.max() > weight_cells[-1][1]:
        weight_cells.append((weight_cells[-1][1], 2 * weight_cells[-1][1]))
    low, high, layer = 0.0, BASE_RANK, 0
    active, owner = element, doc
    heavy = weight
    with np.errstate(over="ignore"):
        while len(active):
            for cell, (w_low, w_high) in enumerate(weight_cells):
                reach = np.arange(len(active)) if heavy is None or cell == 0 else (
                    np.flatnonzero(heavy > w_low))
                seed = words.mix(active[reach] + np.uint64(0x9E3779B97F4A7C15 * (64 * layer + cell + 1)
                                                           & 0xFFFFFFFFFFFFFFFF))
                cdf = _poisson_cdf((high - low) * (w_high - w_low))
                count = np.searchsorted(cdf, _unit(seed), side="right")
                thrower = np.repeat(np.arange(len(reach)), count)
                nth = np.arange(len(thrower)) - np.repeat(np.cumsum(count) - count, count)
                dart = words.mix(seed[thrower] + (nth.astype(np.uint64) + np.uint64(1))
                                 * np.uint64(0xD6E8FEB86659FD93))
                thrower = reach[thrower]
                if heavy is not None:
                    at = w_low + (w_high - w_low) * _unit(words.mix(dart ^ np.uint64(0xA5A5A5A5)))
                    hit = at < heavy[thrower]
                    thrower, dart = thrower[hit], dart[hit]
                rank = low + (high - low) * _unit(words.mix(dart + np.uint64(0x5851F42D4C957F2D)))
                # Rank first, then bits of the dart: the least value is the earliest dart.
                value = (rank.view(np.uint64) & np.uint64(0xFFFFFFFFFFF00000)) | (
                    dart & np.uint64(0xFFFFF))
                slot = owner[thrower] * k + ((dart >> np.uint64(20)) % np.uint64(k)).astype(np.int64)
                np.minimum.at(out, slot, value)
            open_docs = has & (out.reshape(n_docs, k) == _EMPTY).any(axis=1)
            left = open_docs[owner]
            active, owner = active[left], owner[left]
            heavy = heavy[left] if heavy is not None else None
            low, high, layer = high, 2 * high, layer + 1
    return out.reshape(n_docs, k)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    n, k = signature.shape
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64), (n, k // rows)).copy()
        for i in range(rows):
            key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, i::rows])
    return key


def sketch(signature: np.ndarray) -> np.ndarray:
    """A byte per coordinate."""
    return (words.mix(signature) & np.uint64(0xFF)).astype(np.uint8)


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle of n words."""
    hashed, offsets = words.hashes(texts)
    places = words.inside(offsets, n)
    doc = np.searchsorted(offsets, places, side="right") - 1
    return doc, words.windows(hashed, n)[places] if len(places) else np.zeros(0, np.uint64)


def counted(doc: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, element), ascending, and how often each occurs."""
    order = np.lexsort((element, doc))
    doc, element = doc[order], element[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (element[1:] != element[:-1])
    at = np.flatnonzero(new)
    return doc[at], element[at], np.diff(np.append(at, len(doc)))


def numbered(doc: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of every occurrence: the nth occurrence of an element in its document has a
    key of its own, so the plain overlap of such keys is the sum of the lesser counts."""
    doc, element, count = counted(doc, element)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    key = np.repeat(element, count)
    again = np.flatnonzero(nth)
    with np.errstate(over="ignore"):
        key[again] = words.mix(key[again] + nth[again].astype(np.uint64)
                               * np.uint64(0x9E3779B97F4A7C15))
    return np.repeat(doc, count), key


def _profiles(docs: DataFrame, shingle: int, rows: int, bands: int) -> DataFrame:
    """doc_id, 128-bit hash of the word sequence (null: no words), sketch and band keys."""
    k = rows * bands

    def run(batches):
        for batch in words.slices(batches, rows=SLICE_DOCS):
            texts = batch.column("text")
            flat, offsets = words.split(texts)
            hashed = words.of_words(flat).tobytes()
            digest = [xxhash.xxh3_128_digest(hashed[8 * a:8 * b]) if b > a else None
                      for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            doc, element, count = counted(*shingles(texts, shingle))
            signature = signatures(element, doc, batch.num_rows, k, count.astype(np.float64))
            has = np.bincount(doc, minlength=batch.num_rows) > 0
            drawn = sketch(signature)
            keys = band_keys(signature, rows).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digest, pa.binary()),
                 pa.array([s.tobytes() if h else None for s, h in zip(drawn, has)], pa.binary()),
                 pa.array([b if h else None for b, h in zip(keys, has)], pa.list_(pa.int64()))],
                ["doc_id", "digest", "sketch", "bands"])

    return docs.mapInArrow(run, "doc_id bigint, digest binary, sketch binary, bands array<bigint>")


# ------------------------------------------------------------------------------ pairs
def _among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is in ``keys`` (a written table of one bigint column of that name):
    broadcast if the list is short by its row count, else a shuffled join."""
    short = keys.count() <= BROADCAST_LONGS
    return rows.join(F.broadcast(keys) if short else keys, column, "left_semi")


def _plausible(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose sketches agree in a share of ``least``."""
    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
                    .reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= least))

    one = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"))
    two = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Pairs (a, b) with an exact similarity of ``threshold`` or more."""
    def run(batches):
        for batch in words.slices(words.slices(batches, "text_a", 4 << 20), "text_b", 4 << 20):
            keyed, sizes, owners = [], [], []
            for column in ("text_a", "text_b"):
                pair, element = numbered(*shingles(batch.column(column), shingle))
                with np.errstate(over="ignore"):
                    key = words.mix(element + words.mix(pair.astype(np.uint64) + np.uint64(1)))
                key, at = np.unique(key, return_index=True)
                keyed.append(key)
                owners.append(pair[at])
                sizes.append(np.bincount(pair[at], minlength=batch.num_rows))
            _, at, _ = np.intersect1d(*keyed, assume_unique=True, return_indices=True)
            common = np.bincount(owners[0][at], minlength=batch.num_rows)
            union = np.maximum(sizes[0] + sizes[1] - common, 1)
            yield batch.select(["a", "b"]).filter(pa.array(common >= threshold * union - 1e-9))

    pairs = written(pairs, "pairs")
    ids = written(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct(),
                  "pair-ids")
    texts = written(_among(docs, ids, "doc_id").distinct(), "pair-texts")
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return written(pairs.join(one, "a").join(two, "b").mapInArrow(run, "a bigint, b bigint")
                   .distinct(), "verified")


def _shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles): the sorted, distinct keys of every row's shingles, one per occurrence."""
    def run(batches):
        for batch in words.slices(batches):
            doc, element = numbered(*shingles(batch.column("text"), shingle))
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            sets = [np.unique(element[x:y]).view(np.int64) for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return docs.mapInArrow(run, "id bigint, shingles array<bigint>")


def _linked_in_cells(buckets: DataFrame, n_blocks: int, cell: int, least: float,
                     threshold: float) -> DataFrame:
    """Links (a, b) between different components within each bucket. A bucket's documents are
    dealt to chunks by hash; each pair of chunks is a cell of its own, with its documents'
    sketches, band keys and shingles. Pairs whose sketches allow the threshold are verified on the
    spot, in the first band they share, unless a link found before has joined their components."""
    chunks = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("id"), chunks).cast("int")
    spread = buckets.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), chunks - 1))})
    where = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    spread = spread.select(where.alias("cell"), "key", "id", "component", "sketch", "bands",
                           "shingles", (F.col("own") < F.col("other")).alias("left"),
                           (F.col("own") == F.col("other")).alias("same"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cells, ids, component, key = (table[c].to_numpy() for c in ("cell", "id", "component", "key"))
        left, same = table["left"].to_numpy(), table["same"].to_numpy()
        drawn = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(ids), -1)
        bands = pa.concat_arrays(table["bands"].chunks).flatten().to_numpy().reshape(len(ids), -1)
        lists = pa.concat_arrays(table["shingles"].chunks)
        hashes, ends = lists.flatten().to_numpy(), np.cumsum(
            np.append(0, pc.list_value_length(lists).to_numpy()))
        order = np.argsort(cells, kind="stable")
        found = set()
        for rows in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1):
            one, two = (rows, rows) if same[rows[0]] else (rows[left[rows]], rows[~left[rows]])
            label = dict(zip(rows.tolist(), component[rows].tolist()))
            of_two = component[two].copy()
            for at, i in enumerate(one.tolist()):
                open_ = of_two != label[i]
                if same[i]:
                    open_[:at + 1] = False              # each pair once
                other = np.flatnonzero(open_)
                alike = (drawn[two[other]] == drawn[i]).mean(axis=1) >= least
                for k in other[alike].tolist():
                    j = int(two[k])
                    if of_two[k] == label[i] or bands[i][np.argmax(bands[i] == bands[j])] != key[i]:
                        continue
                    x, y = hashes[ends[i]:ends[i + 1]], hashes[ends[j]:ends[j + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common >= threshold * (len(x) + len(y) - common) - 1e-9:
                        found.add((max(ids[i], ids[j]), min(ids[i], ids[j])))
                        gone, stays = of_two[k], label[i]
                        of_two[of_two == gone] = stays
                        label = {r: stays if c == gone else c for r, c in label.items()}
        links = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    return spread.withColumn("block", F.pmod("cell", F.lit(n_blocks))).groupBy("block").applyInArrow(
        run, "a bigint, b bigint").distinct()


# ------------------------------------------------------------------------------ classes
def classes(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD,
            rows: int = ROWS, bands: int = BANDS, cell: int = CELL) -> DataFrame:
    """One row per row of ``docs``: doc_id and class_id, the smallest doc_id of its class."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    profiles = written(_profiles(docs, shingle, rows, bands), "profiles")
    known = profiles.where("doc_id is not null and digest is not null")
    equal = written(known.groupBy("digest").agg(F.min("doc_id").alias("id")), "equal-texts")
    chosen = known.where("sketch is not null").join(
        equal.withColumnRenamed("id", "doc_id"), ["doc_id", "digest"], "left_semi")
    chosen = chosen.select(F.col("doc_id").alias("id"), "sketch", "bands")
    placed = chosen.select("id", F.explode("bands").alias("key"))
    full = (placed.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last"),
                                      F.count("*").alias("n")).where("lead < last").drop("last"))
    buckets = written(placed.join(full, "key"), "buckets")
    members = written(buckets.select("id").distinct(), "bucket-ids")
    sketches = written(_among(chosen.select("id", "sketch"), members, "id").distinct(), "sketches")

    first = buckets.where("id > lead").select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct()
    links = _verified(_plausible(first, sketches, SKETCH_LEAST), docs, shingle, threshold)
    joined = components(links)
    labelled = buckets.join(joined, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    mixed = (labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("key"))
    rest = written(labelled.join(mixed, "key", "left_semi"), "mixed-buckets")
    ids = written(rest.select("id").distinct(), "mixed-ids")
    sets = written(_shingle_sets(_among(docs, ids.withColumnRenamed("id", "doc_id"), "doc_id")
                                 .distinct(), shingle), "shingle-sets")
    own = _among(chosen.select("id", "sketch", "bands"), ids, "id").distinct().join(sets, "id")
    shingles_each = sets.agg(F.avg(F.size("shingles"))).first()[0] or 1
    n_rows = rest.count()
    n_blocks = max(1, -(-n_rows // BLOCK_ROWS), math.ceil(n_rows * shingles_each / BLOCK_SHINGLES))
    more = written(_linked_in_cells(rest.join(written(own, "mixed-documents"), "id"), n_blocks, cell,
                                    SKETCH_LEAST, threshold), "links-in-cells")
    named = known.select("doc_id", "digest").join(equal, "digest")
    several = named.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("last"))
    same = (named.join(several.where("b < last"), "doc_id").where("id > b")
            .select(F.col("id").alias("a"), "b"))             # texts of one doc_id
    top = components(links.unionAll(more).unionAll(same))

    by_text = equal.join(top, "id", "left").select(
        "digest", F.coalesce("component", "id").alias("text_class"))
    found = profiles.select("doc_id", "digest").join(by_text, "digest", "left")
    return found.select("doc_id", F.when(F.col("doc_id").isNotNull(),
                                         F.coalesce("text_class", "doc_id")).alias("class_id"))


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of one document of each class, that with the smallest doc_id, once. Rows without
    doc_id stay."""
    found = written(classes(docs, **parameters), "classes")
    alone = written(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("class_id").alias("c"))
                    .where("doc_id is not null and (n > 1 or c < doc_id)"), "classes-to-drop")
    gone = alone.where("c < doc_id").select("doc_id")
    again = alone.where("c = doc_id").select("doc_id")
    short = alone.count() <= BROADCAST_LONGS
    hint = F.broadcast if short else (lambda df: df)
    key = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    kept = key.join(hint(gone), "doc_id", "left_anti").select(docs.columns)
    if again.isEmpty():
        return kept
    once = kept.join(hint(again), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(hint(again), "doc_id", "left_anti").unionByName(once)
