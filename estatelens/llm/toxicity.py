"""Toxicity by a factorization machine over hashed terms.

A term is a lower-case word without punctuation at its ends, hashed to one of ``BUCKETS`` buckets.
The machine scores the set of a text's selected terms with a weight per term and, for every pair
of terms, the inner product of their factors: a pair such as an insult and the mention of a group
can count for more, or less, than its two terms. Terms are selected by how far their share among
toxic texts lies from that among others (z-score), and, once a first machine is fitted, by how far
the toxic share of the rows of every pair of terms lies from what that machine expects, so that
pairs of terms count whose shares are balanced one by one. The rest cannot be told from chance.

Bounded: the machine is fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the smallest
hash, and at most ``MAX_TERMS`` terms by share; pairs add all of theirs. Scoring reads every whole text; term counts of the sample
are made on Spark.

Nulls: null and empty texts have no terms and get the machine's bias as score. A null doc_id is
scored but never learned from, a null label is no label, and a document with several labels is
toxic if one says so. Without labels of both kinds every score is the labelled share (0 if none).
Repeated rows get equal scores; other columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from estatelens.llm import words
from estatelens.session import written

BUCKETS = 1 << 18
SAMPLE_ROWS, MAX_TERMS, MIN_ROWS, MIN_Z = 20_000, 2_000, 5, 5.0
FACTORS, EPOCHS, RATE, L2 = 4, 60, 0.1, 2e-4
THRESHOLD, CHANCE = 0.3, 0.01
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def term_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word (-1: punctuation only) and document offsets."""
    flat, offsets = words.split(texts)
    coded = pc.dictionary_encode(flat)
    terms = pc.utf8_trim(pc.utf8_lower(coded.dictionary), characters=PUNCTUATION)
    bucket = (words.of_words(terms) % np.uint64(BUCKETS)).astype(np.int64)
    bucket[pc.equal(terms, "").to_numpy(zero_copy_only=False)] = -1
    return bucket[coded.indices.to_numpy(zero_copy_only=False)], offsets


@dataclass(frozen=True)
class Machine:
    """place: bucket -> row of the weights, or -1."""
    place: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, row: np.ndarray, term: np.ndarray, n_rows: int) -> np.ndarray:
        """Scores before the sigmoid, of pairs (row, term) that are distinct."""
        linear = np.bincount(row, weights=self.weight[term], minlength=n_rows)
        pairs = np.zeros(n_rows)
        for k in range(self.factor.shape[1]):
            v = self.factor[term, k]
            total = np.bincount(row, weights=v, minlength=n_rows)
            pairs += 0.5 * (total * total - np.bincount(row, weights=v * v, minlength=n_rows))
        return self.bias + linear + pairs

    def score(self, texts: pa.Array) -> np.ndarray:
        bucket, offsets = term_buckets(texts)
        n_rows, n_terms = len(offsets) - 1, max(len(self.weight), 1)
        place = np.where(bucket >= 0, self.place[bucket], -1)
        used = place >= 0
        both = np.unique(words.owners(offsets)[used] * n_terms + place[used])
        raw = self.raw(both // n_terms, both % n_terms, n_rows)
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30)))


def fit(rows: pd.DataFrame, terms: np.ndarray, seed: int = 7) -> Machine:
    """Train on rows (places: list of selected terms, toxic) by full-batch AdaGrad on log loss."""
    place = np.full(BUCKETS, -1, np.int64)
    place[terms] = np.arange(len(terms))
    y = rows["toxic"].to_numpy(float)
    prior = float(y.mean()) if len(y) else 0.0
    edge = 1e-6
    bias = math.log(max(prior, edge) / max(1 - prior, edge))
    rng = np.random.default_rng(seed)
    weight = np.zeros(len(terms))
    factor = rng.normal(0, 0.05, (len(terms), FACTORS))
    if not len(terms) or prior in (0.0, 1.0):
        return Machine(place, bias, weight, factor * 0)
    row = np.repeat(np.arange(len(rows)), rows["places"].str.len())
    term = np.concatenate([*rows["places"].to_list(), []]).astype(np.int64)
    n, m = len(y), len(terms)
    sums = [1e-8, np.full(m, 1e-8), np.full((m, FACTORS), 1e-8)]
    for _ in range(EPOCHS):
        now = Machine(place, bias, weight, factor)
        p = 1.0 / (1.0 + np.exp(-np.clip(now.raw(row, term, n), -30, 30)))
        error = (p - y) / n
        g_bias = error.sum()
        g_weight = np.bincount(term, weights=error[row], minlength=m) + L2 * weight
        g_factor = L2 * factor
        for k in range(FACTORS):
            v = factor[term, k]
            total = np.bincount(row, weights=v, minlength=n)
            g_factor[:, k] += np.bincount(term, weights=error[row] * (total[row] - v), minlength=m)
        for i, g in enumerate((g_bias, g_weight, g_factor)):
            sums[i] = sums[i] + g * g
        bias -= RATE * g_bias / math.sqrt(sums[0])
        weight = weight - RATE * 3 * g_weight / np.sqrt(sums[1])
        factor = factor - RATE * g_factor / np.sqrt(sums[2])
    return Machine(place, bias, weight, factor)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on ``labels`` (doc_id, toxic), without rows that are held out."""
    marked = (labels.where("doc_id is not null and toxic is not null")
              .where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    one = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id")                   # at most sample_rows rows

    def run(batches):
        for batch in words.slices(batches):
            bucket, offsets = term_buckets(batch.column("text"))
            lists = [np.unique(b[b >= 0]).astype(np.int32)
                     for b in np.split(bucket, offsets[1:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic").cast(pa.int32()),
                 pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "toxic", "buckets"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("toxic", T.IntegerType()),
                           T.StructField("buckets", T.ArrayType(T.IntegerType()))])
    sample = written(one.mapInArrow(run, schema).dropDuplicates(["doc_id"]), "toxic-sample")
    n_rows, n_toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    n_toxic = n_toxic or 0
    counted = (sample.select("toxic", F.explode("buckets").alias("bucket")).groupBy("bucket")
               .agg(F.count("*").alias("rows"), F.sum("toxic").alias("hits")))
    counted = counted.where(F.col("rows") >= MIN_ROWS).toPandas()        # at most BUCKETS rows
    share = counted["rows"] / max(n_rows, 1)
    others = n_rows - n_toxic
    spread = np.sqrt(share * (1 - share) * (1 / max(n_toxic, 1) + 1 / max(others, 1))) + 1e-12
    z = ((counted["hits"] / max(n_toxic, 1) - (counted["rows"] - counted["hits"]) / max(others, 1))
         .abs() / spread)
    best = counted.assign(z=z)[z >= MIN_Z].sort_values(["z", "bucket"], ascending=[False, True])
    terms = np.sort(best["bucket"].to_numpy()[:MAX_TERMS]).astype(np.int64)
    held = sample.select("doc_id", "toxic", "buckets").toArrow().sort_by("doc_id")
    lists = pa.concat_arrays(held.column("buckets").chunks) if len(held) else pa.array([], pa.list_(pa.int32()))
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    bucket = lists.flatten().to_numpy(zero_copy_only=False)
    toxic = held.column("toxic").to_numpy()
    machine = fitted(row, bucket, toxic, terms)
    if 0 < n_toxic < n_rows:
        more = joint_terms(docs.sparkSession, row, bucket, toxic, machine)
        if len(np.setdiff1d(more, terms)):
            machine = fitted(row, bucket, toxic, np.union1d(more, terms))
    return machine


def fitted(row: np.ndarray, bucket: np.ndarray, toxic: np.ndarray, terms: np.ndarray) -> Machine:
    """Machine over ``terms`` from the pairs (row, bucket) of the sample."""
    used = np.isin(bucket, terms)
    place = np.searchsorted(terms, bucket[used])
    ends = np.searchsorted(row[used], np.arange(1, len(toxic)))
    return fit(pd.DataFrame({"places": [x.tolist() for x in np.split(place, ends)][:len(toxic)],
                             "toxic": toxic}), terms)


def joint_terms(spark: SparkSession, row: np.ndarray, bucket: np.ndarray, toxic: np.ndarray,
                machine: Machine) -> np.ndarray:
    """Terms of the pairs whose rows are toxic more, or less, often than ``machine`` expects, by
    Bernstein's bound at ``CHANCE`` over all pairs. Every pair of terms with ``MIN_ROWS`` rows is
    counted exactly: tasks share the terms, and each has the sample (``SAMPLE_ROWS`` rows)."""
    place = machine.place[bucket]
    raw = machine.raw(row[place >= 0], place[place >= 0], len(toxic))
    expected = 1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30)))
    known, count = np.unique(bucket, return_counts=True)
    known = known[count >= MIN_ROWS]
    if len(known) < 2:
        return np.zeros(0, np.int64)
    kept = np.isin(bucket, known)
    term, row = np.searchsorted(known, bucket[kept]).astype(np.int32), row[kept].astype(np.int32)
    begin = np.searchsorted(row, np.arange(len(toxic) + 1))
    by_term = np.argsort(term, kind="stable")
    rows_of, first = row[by_term], np.searchsorted(term[by_term], np.arange(len(known) + 1))
    error, spread = toxic - expected, expected * (1 - expected)
    least = math.log(len(known) * (len(known) - 1) / 2 / CHANCE)
    shared = spark.sparkContext.broadcast((term, begin, rows_of, first, error, spread, least))

    def run(batches):
        term, begin, rows_of, first, error, spread, least = shared.value
        for batch in batches:
            found = set()
            for a in batch.column("id").to_pylist():
                rows = rows_of[first[a]:first[a + 1]]
                size = begin[rows + 1] - begin[rows]
                at = np.arange(size.sum()) + np.repeat(begin[rows] - np.cumsum(size) + size, size)
                others = term[at]
                s = np.abs(np.bincount(others, weights=np.repeat(error[rows], size)))
                v = np.bincount(others, weights=np.repeat(spread[rows], size))
                far = s * s >= 2 * least * (v + s / 3) + 1e-9
                far[a] = False
                if far.any():
                    found.update([a, *np.flatnonzero(far).tolist()])
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["id"])

    tasks = 4 * spark.sparkContext.defaultParallelism
    found = spark.range(0, len(known), 1, tasks).mapInArrow(run, "id bigint").distinct().toPandas()
    shared.unpersist()
    return known[np.sort(found["id"].to_numpy())].astype(np.int64)


def score(docs: DataFrame, machine: Machine, name: str) -> DataFrame:
    """All columns and ``name``, the score from 0 to 1 of ``text``."""
    def run(batches):
        for batch in words.slices(batches):
            got = machine.score(batch.column("text").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)],
                                             [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields,
                                              T.StructField(name, T.DoubleType(), False)]))
