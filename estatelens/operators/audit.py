"""Analyses over finished layers: funnel, rule audit, run consistency, thresholds, cost drift."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from estatelens.config import DEFAULTS, Settings
from estatelens.functions.arrays import matching
from estatelens.operators.entities import apply_rules, rule_cascade, seed_match
from estatelens.operators.ranking import with_running_totals, with_position
from estatelens.operators.sampling import shuffle_key


def funnel(staged: DataFrame, scores: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """records -> entities -> unresolved -> queued, with what each step removed."""
    open_ = F.col("rule_class") == "unresolved"
    queued = open_ & (F.col("n_signal_categories") >= 1) & (F.col("n_hosts") >= settings.min_hosts)
    records = staged.agg(F.count(F.lit(1)).alias("records"))
    counted = scores.agg(F.count(F.lit(1)).alias("entities"),
                         matching(open_).alias("unresolved"), matching(queued).alias("queued"))
    stages = ("records", "entities", "unresolved", "queued")
    steps = [F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("n"),
                      ((F.col(stages[i - 1]) - F.col(s)) if i > 1 else
                       F.lit(None).cast("bigint")).alias("removed"))
             for i, s in enumerate(stages)]
    return counted.withColumn("records", records.scalar()).select(F.inline(F.array(*steps)))


def rule_evidence_split(classification: DataFrame) -> DataFrame:
    return classification.groupBy("rule_evidence").agg(F.count(F.lit(1)).alias("n"))


def denylist_audit(rollup: DataFrame, providers: DataFrame,
                   settings: Settings = DEFAULTS) -> DataFrame:
    """One row: entities excluded by the provider list only because of an organisation name, and
    how many of those another rule catches as well."""
    by_org = apply_rules(rollup, seed_match(rollup, providers, replace(settings, match_orgs=True)),
                         settings)
    by_domain = seed_match(rollup, providers, replace(settings, match_orgs=False)).select(
        "entity_domain", F.lit(True).alias("domain_match"))
    other = F.lit(False)
    for name, _, condition in rule_cascade(settings.rules):
        if name != "seed_list":
            other = other | condition
    joined = by_org.join(by_domain, "entity_domain", "left")
    only_org = F.col("matched_provider_class").isNotNull() & F.col("domain_match").isNull() & (
        F.col("is_reverse_dns_zone") == 0)
    return joined.agg(
        F.count(F.lit(1)).alias("entities"),
        matching(F.col("matched_provider_class").isNotNull()).alias("seed_matched"),
        matching(only_org).alias("org_match_only"),
        matching(only_org & other).alias("also_other_rule"),
        F.round(F.lit(100.0) * matching(only_org) / F.count(F.lit(1)), 4).alias("share_percent"))


def threshold_band(classification_inputs: DataFrame, low: float, high: float,
                   settings: Settings = DEFAULTS) -> DataFrame:
    """Rule class at two sequential-name thresholds: (at_low, at_high, n).

    ``classification_inputs`` is the rollup joined with its provider match.
    """
    def at(ratio: float):
        rules = replace(settings.rules, sequential_ratio=ratio)
        chain = F.lit("unresolved")
        for _, kind, condition in reversed(rule_cascade(rules)):
            chain = F.when(condition, kind).otherwise(chain)
        return chain

    return (classification_inputs.select(at(low).alias("at_low"), at(high).alias("at_high"))
            .groupBy("at_low", "at_high").agg(F.count(F.lit(1)).alias("n")))


def self_consistency(first: DataFrame, second: DataFrame) -> DataFrame:
    """Flip matrix of two runs: (class_1, class_2, n, tier_changes, mean_confidence_move).

    Inputs carry entity_domain, entity_class, confidence and tier.
    """
    side = lambda df, i: df.select("entity_domain", F.col("entity_class").alias(f"class_{i}"),
                                   F.col("confidence").alias(f"confidence_{i}"),
                                   F.col("tier").alias(f"tier_{i}"))
    joined = side(first, 1).join(side(second, 2), "entity_domain")
    return joined.groupBy("class_1", "class_2").agg(
        F.count(F.lit(1)).alias("n"),
        matching(F.col("tier_1") != F.col("tier_2")).alias("tier_changes"),
        F.avg(F.abs(F.col("confidence_1") - F.col("confidence_2"))).alias("mean_confidence_move"))


def consistency_summary(matrix: DataFrame) -> DataFrame:
    """Agreement, flips and tier changes over all entities of the flip matrix."""
    flipped = F.col("class_1") != F.col("class_2")
    return matrix.agg(
        F.sum("n").alias("entities"), F.sum(F.when(flipped, F.col("n")).otherwise(0)).alias("flips"),
        F.sum("tier_changes").alias("tier_changes"),
        (F.sum(F.when(~flipped, F.col("n")).otherwise(0)) / F.sum("n")).alias("agreement"),
        (F.sum(F.col("mean_confidence_move") * F.col("n")) / F.sum("n"))
        .alias("mean_confidence_move"))


def exclusion_sample(classification: DataFrame, per_family: int = 50,
                     seed: str = "audit") -> DataFrame:
    """Random entities per rule family, to check what the rules removed."""
    ranked = Window.partitionBy("rule_evidence").orderBy("_h", "entity_domain")
    return (classification.filter("rule_evidence is not null")
            .withColumn("_h", shuffle_key(seed)).withColumn("_rn", F.row_number().over(ranked))
            .filter(F.col("_rn") <= per_family).drop("_h", "_rn"))


def exclusion_precision(sample: DataFrame, labels: DataFrame, prospects) -> DataFrame:
    """Per rule family: of the labelled exclusions, how many were right to exclude."""
    right = ~F.col("true_class").isin(*prospects)
    return (sample.select("entity_domain", "rule_evidence")
            .join(labels.select("entity_domain", "true_class"), "entity_domain")
            .groupBy("rule_evidence")
            .agg(F.count(F.lit(1)).alias("labelled"), matching(right).alias("right"),
                 F.avg(right.cast("double")).alias("precision")))


def cost_drift(traces: DataFrame, estimate_per_call: float, tolerance: float = 0.25,
               order=("ts", "subject")) -> DataFrame:
    """Running mean cost per call against the estimate; ``alarm`` once it leaves the tolerance.
    Calls that agree in ``order`` are told apart by a hash of the rest, so that both totals follow
    one order."""
    plain = [f.name for f in traces.schema.fields if not isinstance(f.dataType, T.MapType)]
    counted = with_running_totals(traces, [*order, F.xxhash64(*plain)], {
        "spent": F.col("cost_usd"), "call_no": F.lit(1).cast("bigint")})
    mean = F.col("spent") / F.col("call_no")
    return counted.withColumns({
        "mean_cost": mean,
        "alarm": F.abs(mean - F.lit(estimate_per_call)) > F.lit(estimate_per_call * tolerance)})


def percentile_tiers(scores: DataFrame, column: str = "intent_score", tiles: int = 4,
                     tie_break: str = "entity_domain") -> DataFrame:
    """Tile number of every entity by score, highest first, without a single-task window.

    Tiles have equal size; the first ``count % tiles`` of them take one row more.
    """
    placed = with_position(scores, [F.desc(column), F.asc(tie_break)], "place", start=0)
    size = placed.agg(F.count(F.lit(1)).alias("total"))
    small, extra = F.floor(F.col("total") / tiles), F.col("total") % tiles
    big_rows = extra * (small + 1)
    tile = F.when(F.col("place") < big_rows, F.floor(F.col("place") / (small + 1))).otherwise(
        extra + F.floor((F.col("place") - big_rows) / F.greatest(small, F.lit(1))))
    return (placed.withColumn("total", size.scalar()).withColumn("tile", tile + 1)
            .drop("total", "place"))
