"""External classifier as a pluggable function, and its append-only verdict and trace logs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from estatelens import schemas
from estatelens.config import CLASS_ALIASES, ENTITY_CLASSES, TOKEN_RATES
from estatelens.functions.pricing import price_call
from estatelens.functions.text import one_record
from estatelens.operators.ranking import value_at
from estatelens.session import shared_dir, written
from estatelens.sources.ledger import Ledger

MAX_ATTEMPTS = 3
WORKERS = 4                 # calls in flight per task
CHUNK_ROWS = 100_000        # calls between two commits, about
CHUNK = "_chunk_of_run"
FIELDS = ("entity_class", "canonical_name", "confidence", "reasoning")

_CALL = """
    entity_domain STRING, entity_class STRING, canonical_name STRING, confidence DOUBLE,
    reasoning STRING, input_tokens BIGINT, output_tokens BIGINT, cached_tokens BIGINT,
    cache_write_tokens BIGINT, latency_ms BIGINT, attempt INT, error STRING, prompt_chars BIGINT,
    ts DOUBLE
"""


class UnknownClass(ValueError):
    """A verdict carries a class the tier logic cannot interpret."""


class NoVerdicts(ValueError):
    """Nothing was classified by the requested configuration."""


# ------------------------------------------------------------------------------------ calling
def _checked(answer: dict) -> dict:
    missing = [f for f in FIELDS if answer.get(f) is None]
    if missing:
        raise ValueError(f"missing {', '.join(missing)}")
    if answer["entity_class"] not in ENTITY_CLASSES:
        raise ValueError(f"entity_class {answer['entity_class']!r} is not permitted")
    confidence = float(answer["confidence"])
    if not 0.0 <= confidence <= 1.0:
        raise ValueError(f"confidence {confidence} outside 0..1")
    return {**answer, "confidence": confidence}


def _call(fn: Callable[[dict], dict], row: dict, max_attempts: int, retry_wait: float) -> dict:
    started, error = time.time(), None
    for attempt in range(1, max_attempts + 1):
        try:
            answer = _checked(fn(row))
            usage = {k: int(answer.get(k) or 0) for k in
                     ("input_tokens", "output_tokens", "cached_tokens", "cache_write_tokens")}
            return {**{f: answer[f] for f in FIELDS}, **usage, "attempt": attempt, "error": None,
                    "latency_ms": int((time.time() - started) * 1000)}
        except Exception as exc:          # a user function may raise anything: record and retry
            error = f"{type(exc).__name__}: {exc}"
            if attempt < max_attempts and retry_wait:
                time.sleep(retry_wait ** attempt)
    return {**dict.fromkeys(FIELDS), "input_tokens": 0, "output_tokens": 0, "cached_tokens": 0,
            "cache_write_tokens": 0, "attempt": max_attempts, "error": error,
            "latency_ms": int((time.time() - started) * 1000)}


def classify(rows: DataFrame, fn: Callable[[dict], dict], version: str, model: str,
             parallelism: int | None = None, workers: int = WORKERS,
             max_attempts: int = MAX_ATTEMPTS, retry_wait: float = 0.0,
             ledger: Ledger | None = None) -> DataFrame:
    """One result row per input row: the verdict when it is valid, and the trace always.

    ``fn`` takes a row as a dict and returns the four verdict fields, plus token counts if it has
    them. ``parallelism`` tasks (the cluster's cores if not given) run at once, each with
    ``workers`` calls in flight. Write the result before using it twice, or the calls are made
    twice: see ``run``. With a ``ledger`` each valid answer is stored when it comes and asked for
    only once; failed calls are asked again.
    """
    prompt = "prompt" in rows.columns
    parallelism = parallelism or rows.sparkSession.sparkContext.defaultParallelism

    def one(row: dict, answered: Ledger | None) -> dict:
        key = (version, model, str(row["entity_domain"]))
        known = answered.get(*key) if answered else None
        if known:
            return known
        result = {"entity_domain": row["entity_domain"], "ts": time.time(),
                  "prompt_chars": len(row["prompt"]) if prompt else None,
                  **_call(fn, row, max_attempts, retry_wait)}
        if answered and result["error"] is None:
            answered.put(result, *key)
        return result

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # An entity is dealt to the same partition each time, so its answer is there.
        answered = ledger.of_partition(TaskContext.get().partitionId()) if ledger else None
        try:
            with ThreadPoolExecutor(workers) as pool:
                for batch in batches:
                    out = list(pool.map(lambda row: one(row, answered), batch.to_dict("records")))
                    yield pd.DataFrame(out, columns=schemas.names(_CALL))
        finally:
            if answered:
                answered.close()

    return (rows.repartition(parallelism, "entity_domain").mapInPandas(calls, _CALL)
            .withColumns({"prompt_version": F.lit(version), "model": F.lit(model)}))


def verdicts_of(results: DataFrame) -> DataFrame:
    """Valid verdicts only; a failed entity gets none and stays pending."""
    return results.filter("error is null").select(*schemas.names(schemas.VERDICT))


def traces_of(results: DataFrame, task: str = "entity_classification",
              rates: dict = TOKEN_RATES) -> DataFrame:
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return results.select(
        F.lit(task).alias("task"), "prompt_version", "model",
        F.col("entity_domain").alias("subject"), F.col("entity_class").alias("decision"),
        "confidence", "input_tokens", "output_tokens", "cached_tokens", "cache_write_tokens",
        price_call("model", "input_tokens", "cached_tokens", "cache_write_tokens",
                   "output_tokens", rates).alias("cost_usd"),
        "latency_ms", "attempt", "error",
        F.when(F.col("prompt_chars").isNotNull(),
               F.create_map(F.lit("prompt_chars"), as_text("prompt_chars")))
         .otherwise(nothing).alias("request"),
        F.when(F.col("error").isNull(),
               F.map_from_arrays(F.array(*[F.lit(f) for f in FIELDS]),
                                 F.array(*[as_text(f) for f in FIELDS])))
         .otherwise(nothing).alias("response"), "ts")


def run(rows: DataFrame, fn: Callable[[dict], dict], version: str, model: str,
        results_path: str, chunk_rows: int = CHUNK_ROWS,
        on_chunk: Callable[[int], None] | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Call for every row that this (version, model) has no verdict for yet, and return its
    (verdicts, traces) from the stored results.

    Rows are called in chunks of about ``chunk_rows``, dealt by hash; each chunk is appended when it
    is done, verdict and trace of a call together. Until then its answers are in a ledger next to the
    table, so neither a run that dies nor a task that Spark repeats pays for an answer twice. A ledger
    goes when its chunk is appended. What is left to call is dealt to a folder per chunk first, so no
    chunk reads the rows or the results of the others.
    """
    spark = rows.sparkSession
    n_chunks = max(1, -(-rows.count() // chunk_rows))
    chunk = F.pmod(F.xxhash64("entity_domain"), F.lit(n_chunks))
    results = classify(rows, fn, version, model, **options)

    def stored() -> DataFrame:
        known = spark.read.schema(results.schema).parquet(results_path)
        return configuration(known, version, model)

    results.limit(0).write.mode("append").parquet(results_path)       # so that there is a table
    done = stored().where("error is null").select("entity_domain")
    todo = f"{shared_dir(spark)}/todo-{uuid.uuid4().hex}"
    (rows.join(done, "entity_domain", "left_anti").select(*rows.columns, chunk.cast("int").alias(CHUNK))
     .hint("rebalance", CHUNK).write.partitionBy(CHUNK).parquet(todo))
    dealt = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(CHUNK, T.IntegerType())])).parquet(todo)
    for i in range(n_chunks):
        left = dealt.where(F.col(CHUNK) == i).drop(CHUNK)
        ledger = Ledger(f"{results_path.rstrip('/')}_ledger/{n_chunks}-{i}").resumed()
        (classify(left, fn, version, model, ledger=ledger, **options).write.mode("append")
         .option("compression", "zstd").parquet(results_path))
        ledger.clear()
        if on_chunk:
            on_chunk(i)
    return verdicts_of(stored()), traces_of(stored())


# -------------------------------------------------------------------------------------- logs
def line_order() -> Column:
    """Order of lines in an append-only set of text files: older file first, then position."""
    m = F.col("_metadata")
    return F.struct(m["file_modification_time"], m["file_path"], m["file_block_start"],
                    F.monotonically_increasing_id().alias("line"))


SEQ = ("STRUCT<file_modification_time: TIMESTAMP, file_path: STRING, file_block_start: BIGINT, "
       "line: BIGINT>")


def read_log(spark: SparkSession, path: str, ddl: str, missing_ok: bool = False) -> DataFrame:
    """JSON-lines log plus ``seq``; lines that are not JSON objects are skipped.

    With ``missing_ok`` an absent log is an empty typed table.
    """
    if missing_ok:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = fs.globStatus(jvm_path)
        if found is None or len(found) == 0:
            return spark.createDataFrame([], f"{ddl}, seq {SEQ}")
    lines = spark.read.text(path).withColumn("seq", line_order().cast(SEQ))
    parsed = lines.select(F.explode(one_record("value", T.StructType.fromDDL(ddl))).alias("r"), "seq")
    return parsed.where("r is not null").select("r.*", "seq")


def read_verdicts(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.VERDICT)


def read_traces(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    return read_log(spark, path, schemas.TRACE, missing_ok)


def configuration(log: DataFrame, version: str, model: str) -> DataFrame:
    return log.filter((F.col("prompt_version") == version) & (F.col("model") == model))


def latest(log: DataFrame, key: str = "entity_domain", seq: str = "seq") -> DataFrame:
    """Last row per key: later lines win. Spark prunes to one row per key before the shuffle."""
    last = Window.partitionBy(key).orderBy(F.desc(seq))
    return log.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def accepted_classes(verdicts: DataFrame, aliases: dict[str, str] = CLASS_ALIASES) -> DataFrame:
    """Known aliases replaced by the class they stand for."""
    fixed = F.col("entity_class")
    for alias, target in aliases.items():
        fixed = F.when(F.col("entity_class") == alias, target).otherwise(fixed)
    return verdicts.withColumn("entity_class", fixed)


def unknown_classes(verdicts: DataFrame) -> DataFrame:
    """Offending classes with their count and up to three examples."""
    first_three = Window.partitionBy("entity_class").orderBy("entity_domain")
    known = F.coalesce(F.col("entity_class").isin(*ENTITY_CLASSES), F.lit(False))
    bad = accepted_classes(verdicts).filter(~known)
    examples = (bad.withColumn("n", F.row_number().over(first_three)).filter("n <= 3")
                .groupBy("entity_class")
                .agg(F.array_sort(F.collect_list("entity_domain")).alias("examples")))
    counted = bad.groupBy("entity_class").agg(F.count(F.lit(1)).alias("n"))
    same = counted["entity_class"].eqNullSafe(examples["entity_class"])
    return counted.join(examples, same).select(counted["entity_class"], "n", "examples")


def configurations(log: DataFrame) -> DataFrame:
    return log.select("prompt_version", "model").distinct()


def publishable(log: DataFrame, version: str, model: str) -> DataFrame:
    """The verdicts of one configuration, ready to merge.

    Refuses to go on when that configuration is absent, or when a class is neither known nor an
    alias: a stray class would silently drop a real company.
    """
    chosen = written(latest(configuration(log, version, model)), "latest-verdicts")
    # One row per class, and one per configuration: neither grows with the log's rows.
    bad = unknown_classes(chosen).collect()
    if bad:
        raise UnknownClass("; ".join(f"{r.entity_class!r}: {r.n}, e.g. {r.examples}"
                                     for r in bad))
    if chosen.isEmpty():
        known = [f"{r[0]} / {r[1]}" for r in
                 configurations(log).orderBy("prompt_version", "model").collect()]
        raise NoVerdicts(f"no rows for {version} / {model}; available: {', '.join(known)}")
    return accepted_classes(chosen).select(*schemas.names(schemas.VERDICT))


def class_traces(log: DataFrame, version: str, model: str) -> DataFrame:
    """Telemetry of the call behind each verdict: successful calls only, last per subject."""
    ok = configuration(log, version, model).filter(
        (F.coalesce("error", F.lit("")) == "") & (F.coalesce("subject", F.lit("")) != ""))
    zero = F.lit(0).cast("bigint")
    return latest(ok, "subject").select(
        F.col("subject").alias("entity_domain"), F.col("model").alias("class_model"),
        F.col("prompt_version").alias("class_prompt_version"),
        F.col("latency_ms").alias("class_latency_ms"), F.col("cost_usd").alias("class_cost_usd"),
        F.coalesce("cached_tokens", zero).alias("class_cached_tokens"),
        F.coalesce("input_tokens", zero).alias("class_input_tokens"),
        F.coalesce("output_tokens", zero).alias("class_output_tokens"))


# ------------------------------------------------------------------------------------ summary
def trace_totals(traces: DataFrame) -> DataFrame:
    """Calls, errors, spend, and p50/p95 latency by sorted index; failed calls count."""
    totals = traces.agg(
        F.count(F.lit(1)).alias("calls"),
        F.count(F.when(F.coalesce("error", F.lit("")) != "", 1)).alias("errors"),
        F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 4).alias("cost_usd"))
    latency = traces.select(F.coalesce("latency_ms", F.lit(0)).alias("latency_ms"))
    picked = value_at(latency, "latency_ms", {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95})
    return totals.select("*", *[picked.select(c).scalar().alias(c) for c in picked.columns])


def decision_histogram(traces: DataFrame) -> DataFrame:
    return (traces.filter(F.coalesce("decision", F.lit("")) != "")
            .groupBy("decision").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "decision"))
