"""Classifier quality against hand labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from estatelens import schemas
from estatelens.config import ENTITY_CLASSES, LABEL_WORDS
from estatelens.functions.arrays import literals
from estatelens.functions.text import fixed_point, stripped
from estatelens.operators.verdicts import SEQ, UnknownClass, latest, line_order

METRICS = ("precision", "recall", "f1")


class LabelProblem(ValueError):
    """A worksheet or label set that must not be used as it is."""


def labelled_only(labels: DataFrame, classes=ENTITY_CLASSES) -> DataFrame:
    """Rows with a label; raises on a label outside the permitted classes."""
    rows = labels.filter(F.coalesce("true_class", F.lit("")) != "")
    bad = (rows.filter(~F.col("true_class").isin(*classes)).groupBy("true_class")
           .agg(F.count("*").alias("n"), F.min("entity_domain").alias("example"))
           .orderBy("true_class").collect())            # one row per wrong class
    if bad:
        raise UnknownClass("; ".join(f"invalid label {r.true_class!r} on {r.n} rows, e.g. {r.example}"
                                     for r in bad))
    return rows.withColumn("batch", F.coalesce("batch", F.lit(1)))


def pairs(labels: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Truth next to prediction, joined on the entity: a failed call drops only its own row."""
    return labels.select("entity_domain", "true_class", "batch").join(
        verdicts.select("entity_domain", F.col("entity_class").alias("predicted"),
                        "confidence", "reasoning"), "entity_domain").withColumn(
        "correct", F.col("true_class") == F.col("predicted"))


def _grouping(df: DataFrame, keys: list[str], by_batch: bool):
    """All rows together, and per batch as well, in one pass over the data."""
    if not by_batch:
        return df.withColumn("batch", F.lit(None).cast("int")).groupBy(*keys, "batch")
    return df.groupingSets([[*map(F.col, keys)], [*map(F.col, keys), F.col("batch")]],
                           *map(F.col, keys), F.col("batch"))


def confusion(pairs_df: DataFrame, classes=ENTITY_CLASSES, by_batch: bool = True) -> DataFrame:
    """support, tp, fp, fn, precision, recall, f1 per class; ``batch`` null means all rows.

    Every permitted class appears, also with no row. A ratio with denominator zero is null, and
    f1 is null when precision or recall is null or zero.
    """
    hit = F.col("true_class") == F.col("predicted")
    counts = lambda cls, tp, fp, fn: F.struct(
        F.col(cls).alias("class"), F.lit(tp).alias("tp"), F.lit(fp).alias("fp"),
        F.lit(fn).alias("fn"))
    long = pairs_df.select("batch", F.inline(
        F.when(hit, F.array(counts("true_class", 1, 0, 0)))
         .otherwise(F.array(counts("true_class", 0, 0, 1), counts("predicted", 0, 1, 0)))))
    found = _grouping(long, ["class"], by_batch).agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    groups = _grouping(pairs_df, [], by_batch).agg(F.count(F.lit(1)).alias("n"))
    frame = groups.select("batch", F.explode(literals(classes)).alias("class"))
    zero = F.lit(0).cast("bigint")
    filled = (frame.alias("w").join(
        found.alias("c"), (F.col("w.class") == F.col("c.class"))
        & F.col("w.batch").eqNullSafe(F.col("c.batch")), "left")
        .select("w.class", "w.batch",
                *[F.coalesce(f"c.{c}", zero).alias(c) for c in ("tp", "fp", "fn")]))
    return with_ratios(filled)


def with_ratios(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratio = lambda top, bottom: F.try_divide(top.cast("double"), bottom.cast("double"))
    p, r = F.col("precision"), F.col("recall")
    return (counts.withColumns({"support": tp + fn, "precision": ratio(tp, tp + fp),
                                "recall": ratio(tp, tp + fn)})
            .withColumn("f1", F.when((p > 0) & (r > 0), F.lit(2.0) * p * r / (p + r)))
            .select("class", "batch", "support", "tp", "fp", "fn", *METRICS))


def accuracy(pairs_df: DataFrame, by_batch: bool = True) -> DataFrame:
    """n and accuracy, for all rows (batch null) and per batch."""
    return _grouping(pairs_df, [], by_batch).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("correct").cast("double")).alias("accuracy")).select("batch", "n", "accuracy")


def delta_column(now: Column, before: Column) -> Column:
    diff = now - before
    signed = F.concat(F.when(diff < 0, "-").otherwise("+"), fixed_point(F.abs(diff), 2))
    return (F.when(diff.isNull(), "").when(F.abs(diff) < 0.005, "=").otherwise(signed))


def delta(now: DataFrame, baseline: DataFrame) -> DataFrame:
    """Metrics next to a baseline's, with the change as a number and as text."""
    base = baseline.select("class", *[F.col(m).alias(f"{m}_before") for m in METRICS])
    return now.join(base, "class", "left").select(
        "class", "support", *METRICS,
        *[(F.col(m) - F.col(f"{m}_before")).alias(f"{m}_change") for m in METRICS],
        *[delta_column(F.col(m), F.col(f"{m}_before")).alias(f"{m}_delta") for m in METRICS])


def misclassified(pairs_df: DataFrame) -> DataFrame:
    return pairs_df.filter(~F.col("correct"))


# ------------------------------------------------------------------------------- result store
def result_rows(metrics: DataFrame, version: str, model: str, run_at: str) -> DataFrame:
    """Metrics of one run in the shape of the append-only result table."""
    return metrics.withColumns({"prompt_version": F.lit(version), "model": F.lit(model),
                                "run_at": F.lit(run_at)})


def append_run(pairs_df: DataFrame, path: str, version: str, model: str, run_at: str) -> None:
    """Append a run: ``details`` (one row per entity) first, then ``metrics`` over all rows."""
    runs = {"details": pairs_df, "metrics": confusion(pairs_df, by_batch=False)}
    for name, rows in runs.items():
        (result_rows(rows, version, model, run_at).write.mode("append")
         .option("compression", "zstd").parquet(f"{path}/{name}"))


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/metrics")


def stored_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/details")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A labelled set as JSON lines."""
    return spark.read.schema(schemas.LABEL).json(path)


def baseline_run(results: DataFrame, version: str, model: str,
                 compare: str | None = None) -> DataFrame:
    """Rows of the run to compare with: an explicit ``version:model`` (its newest run), or else
    the newest run of any other configuration."""
    if compare:
        wanted_version, _, wanted_model = compare.partition(":")
        pool = results.filter((F.col("prompt_version") == wanted_version)
                              & (F.col("model") == wanted_model))
    else:
        pool = results.filter(~((F.col("prompt_version") == version)
                                & (F.col("model") == model)))
    newest = pool.agg(F.max(F.struct("run_at", "prompt_version", "model")).alias("r")).select("r.*")
    return pool.join(F.broadcast(newest), ["run_at", "prompt_version", "model"])


# --------------------------------------------------------------------------------- worksheets
def parse_worksheet(lines: DataFrame, words: dict[str, str] = LABEL_WORDS) -> DataFrame:
    """``N. domain -> word # note`` lines to (entity_domain, true_class, note, problem).

    ``seq``, a column that orders the lines, is kept if there is one.

    Comment lines and lines without an arrow are skipped; a missing or unknown word becomes a
    problem text and no label.
    """
    value = F.col("value")
    right = F.substring(value, F.instr(value, "->") + 2, F.length(value))
    left = F.substring_index(value, "->", 1)
    answer = F.lower(stripped(F.substring_index(right, "#", 1)))
    note = F.when(F.instr(right, "#") > 0,
                  stripped(F.substring(right, F.instr(right, "#") + 1, F.length(right))))
    label = F.lit(None).cast("string")
    for word, cls in words.items():
        label = F.when(F.col("answer") == word, cls).otherwise(label)
    rows = (lines.filter(~stripped("value").startswith("#") & value.contains("->"))
            .select(F.regexp_extract(left, r"\d+\.\s*(\S+)", 1).alias("entity_domain"),
                    answer.alias("answer"), F.coalesce(note, F.lit("")).alias("note"),
                    *(["seq"] if "seq" in lines.columns else []))
            .filter("entity_domain <> ''").withColumn("true_class", label))
    problem = F.when(F.col("answer") == "", "no label").when(
        F.col("true_class").isNull(), F.concat(F.lit("unknown word "), F.col("answer")))
    return rows.select("entity_domain", "true_class", "note", problem.alias("problem"),
                       *(["seq"] if "seq" in lines.columns else []))


def worksheet_labels(lines: DataFrame) -> DataFrame:
    """Parsed labels, the last line of a domain; raises when any line has a problem, so nothing is
    written (``parse_worksheet`` lists the problems). ``seq`` orders the lines."""
    if "seq" not in lines.columns:
        raise LabelProblem("worksheet lines need a seq column: a later label replaces an earlier one")
    parsed = parse_worksheet(lines)
    bad = parsed.filter("problem is not null").agg(F.count("*"), F.min("entity_domain")).first()
    if bad[0]:
        raise LabelProblem(f"{bad[0]} lines without a usable label, e.g. of {bad[1]}")
    return latest(parsed).select("entity_domain", "true_class", "note")


def read_worksheet(spark: SparkSession, path: str) -> DataFrame:
    """Lines of worksheet files with their order."""
    return spark.read.text(path).withColumn("seq", line_order().cast(SEQ))


def merge_labels(existing: DataFrame, incoming: DataFrame, labels: DataFrame) -> DataFrame:
    """Existing rows plus unknown incoming ones, with new labels applied.

    A new label overrides the old one; a note replaces the old note only when it is not empty.
    """
    fresh = incoming.join(existing.select("entity_domain"), "entity_domain", "left_anti")
    rows = existing.unionByName(fresh, allowMissingColumns=True)
    new = labels.select("entity_domain", F.col("true_class").alias("new_class"), "note")
    note = F.when(F.col("note") != "", F.col("note")).otherwise(F.col("labeller_note"))
    return rows.join(new, "entity_domain", "left").withColumns({
        "true_class": F.coalesce("new_class", "true_class"),
        "labeller_note": note}).drop("new_class", "note")


def complete(merged: DataFrame) -> DataFrame:
    """The merged set, refused while a row has no label."""
    n, example = unlabelled(merged).agg(F.count("*"), F.min("entity_domain")).first()
    if n:
        raise LabelProblem(f"{n} rows are still unlabelled, e.g. {example}")
    return merged


def unlabelled(merged: DataFrame) -> DataFrame:
    """Rows that still have no label; must be empty before the set is written."""
    return merged.filter(F.coalesce("true_class", F.lit("")) == "")


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("true_class").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "true_class")


def too_few_classes(labels: DataFrame, minimum: int = 3) -> bool:
    return labels.select("true_class").distinct().limit(minimum).count() < minimum
