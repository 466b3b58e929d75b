"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key, -ln(u) / weight, with u from a hash of its doc_id and the
seed and the weight from the quality of its text; ascending keys are the order in which weighted
sampling without replacement would draw (Efraimidis and Spirakis). A source whose target is above
its size gives complete epochs first; what is left of the target is drawn in that order, by prefix
sums of the sizes, and the document at the edge is cut there, so that a source takes exactly its
target, rounded to whole words.

Targets: all sizes together are shared by weight, at most ``max_epochs`` times a source's size;
the excess goes to the others by weight. With sources sorted by cap / weight, the level at which
this ends is the largest of (total - caps of the first k) / weights of the rest.

Order and prefix sums are global (range partitions and one offset each), so a source that holds
most rows spreads over all tasks.

Nulls: null text has size 0, null source is a source of its own (last), a null doc_id hashes as
the empty string. Rows that agree in doc_id are ordered by their text's hash; identical rows share
a place in any order. Empty tables give no rows. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from estatelens.llm import words
from estatelens.llm.rules import fresh_name
from estatelens.operators import ranking

WEIGHTS, MAX_EPOCHS, SEED = (1, 2, 3), 3, "mix-1"
MIN_QUALITY = 0.1           # weight of a text of symbols only
PLAN = "size bigint, source_size bigint, target double, taken bigint"


def quality_weight(text: Column) -> Column:
    """1 for text without symbols, falling with their share to ``MIN_QUALITY``."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.coalesce(F.greatest(F.lit(MIN_QUALITY), F.lit(1.0) - F.lit(4.0) * symbols
                                 / F.greatest(F.length(text), F.lit(1))), F.lit(1.0))


def exponential_key(doc_id: Column, weight: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 1.0) / float(1 << 48)
    return -F.log(u) / weight


def with_size(docs: DataFrame, name: str) -> DataFrame:
    """All columns and ``name``: the words of ``text``."""
    def run(batches):
        for batch in words.slices(batches):
            _, offsets = words.split(batch.column("text").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(offsets))],
                                             [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields,
                                              T.StructField(name, T.LongType(), False)]))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From (source, source_size), one row per source: target, and words of sources before."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    share = F.array(*[F.lit(float(w)) for w in weights])[F.pmod(place, F.lit(len(weights)))]
    rows = sizes.select(
        "source", "source_size", share.alias("weight"), place.alias("place"),
        F.coalesce(F.sum("source_size").over(by_name.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("words_before"),
        (F.col("source_size") * max_epochs).alias("cap"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    capped = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy()
    rows = rows.withColumn("level", (F.sum("source_size").over(every) - capped) / rest)
    level = F.max("level").over(every)
    return rows.select("source", "source_size", "words_before",
                       F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def plan(docs: DataFrame, name: str, weights: tuple[int, ...] = WEIGHTS,
         max_epochs: int = MAX_EPOCHS, seed: str = SEED, carry_text: bool = True) -> DataFrame:
    """All columns (on request without the text, which then is not shuffled) and struct ``name``:
    size, source_size, target, taken."""
    work = fresh_name(docs, "_work")
    size = fresh_name(docs, "_size")
    sized = with_size(docs, size)
    text = F.col("text").cast("string")
    key = exponential_key(F.col("doc_id"), quality_weight(text), seed)
    keyed = sized.withColumn(work, F.struct(key.alias("key"), F.xxhash64(text).alias("tie")))
    if not carry_text:
        keyed = keyed.drop("text")
    order = [F.col("source").asc_nulls_last(), F.col(f"{work}.key"), F.col("doc_id"),
             F.col(f"{work}.tie")]
    total = fresh_name(docs, "_up_to")
    run = ranking.with_running_total(keyed, order, F.col(size), total)
    per_source = targets(run.groupBy("source").agg(F.sum(size).alias("source_size")), weights,
                         max_epochs)
    of, its = fresh_name(docs, "_mix_source"), fresh_name(docs, "_mix")
    per_source = per_source.select(F.col("source").alias(of),
                                   F.struct("source_size", "words_before", "target").alias(its))
    joined = run.join(per_source, F.col("source").eqNullSafe(F.col(of)))
    own, whole = F.col(size), F.col(f"{its}.source_size")
    budget = F.floor(F.col(f"{its}.target") + 0.5)
    epochs = F.when(whole > 0, F.floor(budget / F.greatest(whole, F.lit(1)))).otherwise(F.lit(0))
    ahead = F.col(total) - own - F.col(f"{its}.words_before")
    drawn = F.greatest(F.lit(0), F.least(own, budget - epochs * whole - ahead))
    return joined.withColumn(name, F.struct(
        own.alias("size"), whole.alias("source_size"), F.col(f"{its}.target").alias("target"),
        (epochs * own + drawn).cast("bigint").alias("taken"))).drop(
        its, of, work, size, total)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: a row for each complete take of a document,
    and one with its first words where it is cut. Documents without words are not taken."""
    name = fresh_name(docs, "_plan")
    planned = plan(docs, name, weights, max_epochs, seed).where(F.col(f"{name}.taken") > 0)

    def run(batches):
        for batch in words.slices(batches):
            got = batch.column(name)
            size, taken = (got.field(k).to_numpy() for k in ("size", "taken"))
            whole, part = taken // size, taken % size
            texts = batch.column("text")
            cut = pa.array([first_words(texts[i].as_py(), int(part[i]))
                            for i in np.flatnonzero(part).tolist()], texts.type)
            names = batch.schema.names
            full = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), whole)))
            some = batch.take(pa.array(np.flatnonzero(part)))
            some = some.set_column(names.index("text"), "text", cut)
            for out in (full, some):
                if out.num_rows:
                    yield out.drop_columns([name])

    return planned.mapInArrow(run, docs.schema)


def first_words(text: str, n: int) -> str:
    """The text up to the end of its n-th word."""
    data, seen, inside = text.encode(), 0, False
    for i, byte in enumerate(data):
        space = byte == 32 or 9 <= byte <= 13
        if not space and not inside:
            seen += 1
        elif space and inside and seen == n:
            return data[:i].decode()
        inside = not space
    return text
