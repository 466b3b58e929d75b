"""Incremental refresh: new scan files update only the entities they touch.

Measures add or take extremes, facet counts add, headline records take the maximum. So the state
of an entity is the merge of partial rows, one set per micro-batch. Partials and signals are stored
by a hash bucket of the entity, and a refresh reads the buckets that its new files touch, never the
old scan. Distinct counts and modes stay exact because the facet table keeps the values.

Sets of partials fold as they grow in number: batch b, counted from 1, also stores the merge of the
last s batches, s the largest power of two that divides b. So the state up to any batch is the merge
of at most log2(b) + 1 sets, each row is rewritten log2(b) times in all, and every set belongs to one
batch, which overwrites it on replay.

Nothing stored depends on a reporting date: the earliest certificate expiry is kept as a date (days
since 1970, which merges by minimum), and scores are a projection of the stored signals for the
reporting date asked for. So entities that no new file touches age like the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from estatelens import schemas
from estatelens.config import DEFAULTS, Settings
from estatelens.operators import entities as E
from estatelens.operators import scoring, signals as S, staging
from estatelens.plans.layers import HOST_COLUMNS
from estatelens.session import written

PARTS = ("measures", "facets", "headlines")
EPOCH = "1970-01-01"            # expiry days counted from here are a date
BUCKETS = 256
EXPIRY = "soonest_cert_expiry_days"


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("entity_domain"), F.lit(buckets)).cast("int"))


def partials(hosts: DataFrame, settings: Settings = DEFAULTS, rows: int | None = None) -> dict[str, DataFrame]:
    return {"measures": E.entity_measures(hosts), "facets": E.entity_facets(hosts, rows=rows),
            "headlines": S.headline_best(hosts, settings)}


def dealt(facets: DataFrame, measures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facet rows of hot entities, as they lie, and of all others, those of an entity together: what
    reads them next, or counts them by entity, combines an entity's rows before it shuffles."""
    hot = F.broadcast(measures.groupBy("entity_domain").agg(F.sum("n_services").alias("n"))
                      .filter(F.col("n") > E.HOT_ROWS).select("entity_domain"))
    return (facets.join(hot, "entity_domain", "left_semi"),
            facets.join(hot, "entity_domain", "left_anti").repartition("entity_domain"))


def merged(parts: dict[str, DataFrame], one_set: bool = False) -> dict[str, DataFrame]:
    """One row per key from any number of partial rows; ``one_set`` if each key has one row already."""
    def how(name: str):
        if name in E.MERGE_MAX:
            return F.max(name)
        return F.min(name) if name in E.MERGE_MIN else F.sum(name)

    def counted(facets: DataFrame) -> DataFrame:
        key = ("entity_domain", "facet", "value")
        if one_set:
            return facets.select(*key, "n", "n_with_ip")
        return facets.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("n_with_ip").alias("n_with_ip"))

    best = [c for c in parts["headlines"].columns
            if c not in ("entity_domain", "batch_id", "span", "bucket")]
    hot, ordinary = dealt(parts["facets"], parts["measures"])
    facets = counted(hot).unionByName(counted(ordinary))
    if one_set:
        return {"measures": parts["measures"].select("entity_domain", *E.MEASURES), "facets": facets,
                "headlines": parts["headlines"].select("entity_domain", *best)}
    return {
        "measures": parts["measures"].groupBy("entity_domain").agg(
            *[how(m).alias(m) for m in E.MEASURES]),
        "facets": facets,
        "headlines": parts["headlines"].groupBy("entity_domain").agg(
            *[F.max(c).alias(c) for c in best]),
    }


def signals_from(parts: dict[str, DataFrame], providers: DataFrame,
                 settings: Settings = DEFAULTS) -> DataFrame:
    """Signals of the entities in merged partials."""
    rollup = E.entity_rollup(None, parts["measures"], parts["facets"])
    classification = E.classify_by_rule(rollup, providers, settings, parts["facets"])
    return S.company_signals(None, classification, parts["measures"], parts["facets"],
                             settings, S.headline_columns(parts["headlines"]))


def scored_at(signals: DataFrame, as_of, settings: Settings = DEFAULTS) -> DataFrame:
    """Scores of stored signals on a reporting date."""
    date = F.date_add(F.lit(EPOCH).cast("date"), F.col(EXPIRY))
    return scoring.score(signals.withColumn(EXPIRY, F.datediff(date, staging.date_column(as_of))),
                         settings)


def _write(df: DataFrame, path: str, buckets: int, mode: str = "overwrite") -> None:
    # Rebalanced by bucket: few files per bucket, and a large bucket is still split over tasks.
    (bucketed(df, buckets).hint("rebalance", "bucket").write.mode(mode)
     .option("compression", "zstd").partitionBy("bucket").parquet(path))


def span_of(batch_id: int) -> int:
    """How many batches the folded set of a batch covers: its own and those right before it."""
    return (batch_id + 1) & -(batch_id + 1)


def sets_up_to(batch_id: int) -> list[tuple[int, int]]:
    """(batch_id, span) of the sets that hold all batches up to this one, each batch once."""
    out, n = [], batch_id + 1
    while n > 0:
        out.append((n - 1, n & -n))
        n -= n & -n
    return out


def part_schema(spark: SparkSession, name: str, settings: Settings) -> T.StructType:
    """Of a stored part: a batch without findings writes no file that could tell."""
    none = E.entity_hosts(staging.stage(spark.createDataFrame([], schemas.SCAN), EPOCH))
    return T.StructType([*partials(none, settings)[name].schema.fields, *[
        T.StructField(c, T.IntegerType()) for c in ("batch_id", "span", "bucket")]])


def _sets(spark: SparkSession, state: str, name: str, wanted: list[tuple[int, int]],
          settings: Settings) -> DataFrame:
    """These sets of a part; a compacted base (batch -1) has one."""
    chosen = [(F.col("batch_id") == b) & (F.col("span") == s) for b, s in wanted]
    condition = chosen[0]
    for other in chosen[1:]:
        condition = condition | other
    return spark.read.schema(part_schema(spark, name, settings)).parquet(f"{state}/{name}").filter(condition)


def _fold(spark: SparkSession, state: str, batch_id: int, buckets: int, settings: Settings) -> None:
    """The folded set of a batch from its own and the folded sets inside its span."""
    span = span_of(batch_id)
    if span == 1:
        return                                       # its own set is the fold
    first = batch_id + 1 - span
    inside = [(b, s) for b, s in sets_up_to(batch_id - 1) if b >= first]
    parts = {name: _sets(spark, state, name, [(batch_id, 1), *inside], settings) for name in PARTS}
    for name, df in merged(parts).items():
        _write(df, f"{state}/{name}/batch_id={batch_id}/span={span}", buckets)


def touched_buckets(spark: SparkSession, state: str, batch_id: int) -> list[int]:
    """Numbers of the buckets that a batch wrote to: at most their count."""
    rows = spark.read.parquet(f"{state}/measures/batch_id={batch_id}/span=1").select("bucket").distinct()
    return sorted(r.bucket for r in rows.collect())


def known_partials(spark: SparkSession, state: str, batch_id: int,
                   settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Partials up to this batch of the entities it touched, from their buckets alone."""
    chosen = F.col("bucket").isin(touched_buckets(spark, state, batch_id))
    own = _sets(spark, state, "measures", [(batch_id, 1)], settings).filter(chosen).select("entity_domain")
    known = [*sets_up_to(batch_id), (-1, 1)]
    return {name: _sets(spark, state, name, known, settings).filter(chosen)
            .join(own, "entity_domain", "left_semi") for name in PARTS}


def refresh(source: DataFrame, state: str, checkpoint: str, providers: DataFrame,
            settings: Settings = DEFAULTS, buckets: int = BUCKETS,
            on_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Apply new scan rows and stop. ``on_batch`` sees the signals of each micro-batch's entities.

    Everything a batch writes lies under its own ``batch_id`` and is overwritten on replay.
    """
    spark = source.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Once: each of the partials reads them.
        hosts = written(E.entity_hosts(staging.stage(batch, EPOCH)).select(*HOST_COLUMNS), "hosts")
        for name, part in partials(hosts, settings, hosts.count()).items():
            _write(part, f"{state}/{name}/batch_id={batch_id}/span=1", buckets)
        _fold(spark, state, batch_id, buckets, settings)
        known = known_partials(spark, state, batch_id, settings)
        based = not _sets(spark, state, "measures", [(-1, 1)], settings).isEmpty()
        parts = merged(known, one_set=len(sets_up_to(batch_id)) == 1 and not based)
        for name in ("measures", "facets"):                 # signals read them two and three times
            parts[name] = written(parts[name], f"known-{name}")
        target = f"{state}/signals/batch_id={batch_id}"
        _write(signals_from(parts, providers, settings), target, buckets)
        if on_batch:
            on_batch(spark.read.parquet(target).drop("bucket"), batch_id)

    return (source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def scan_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schemas.SCAN).option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", True).parquet(path))


def current_signals(spark: SparkSession, state: str) -> DataFrame:
    """Latest row of every entity over all refreshes; expiry as days since 1970."""
    last = Window.partitionBy("entity_domain").orderBy(F.desc("batch_id"))
    return (spark.read.parquet(f"{state}/signals")
            .withColumn("_n", F.row_number().over(last)).filter("_n = 1")
            .drop("_n", "batch_id", "bucket"))


def current_scores(spark: SparkSession, state: str, as_of,
                   settings: Settings = DEFAULTS) -> DataFrame:
    """Scores of every entity on a reporting date, whenever its files came."""
    return scored_at(current_signals(spark, state), as_of, settings)


def compact(spark: SparkSession, state: str, into: str, buckets: int = BUCKETS,
            settings: Settings = DEFAULTS) -> None:
    """Fold all partials into one batch under a new state folder, to keep merges short."""
    last = spark.read.parquet(f"{state}/measures").agg(F.max("batch_id")).first()[0]
    parts = {name: _sets(spark, state, name, [*sets_up_to(last), (-1, 1)], settings) for name in PARTS}
    for name, df in merged(parts).items():
        _write(df, f"{into}/{name}/batch_id=-1/span=1", buckets, "errorifexists")
    _write(current_signals(spark, state), f"{into}/signals/batch_id=-1", buckets, "errorifexists")
