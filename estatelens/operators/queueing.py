"""The candidate set for an external classifier: who, in which order, at what price."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from estatelens.config import (ASSUMED_OUTPUT_TOKENS, CHARS_PER_TOKEN, DEFAULTS, Settings)
from estatelens.functions.pricing import cache_floor, price_call
from estatelens.functions.text import template_value
from estatelens.operators.ranking import with_position

QUEUE_COLUMNS = ("entity_domain", "orgs_seen", "primary_country", "n_hosts", "n_ports",
                 "n_products", "products", "technologies", "cloud_host_ratio", "waf_vendors",
                 "fit_score", "intent_score", "n_signal_categories", "max_epss", "headline_cve",
                 "headline_cve_product", "rule_class")


def queue_order() -> list[Column]:
    return [F.desc("fit_score"), F.desc("intent_score"), F.asc("entity_domain")]


def candidates(scores: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Unresolved entities with something to sell. Filters run before any call is paid for."""
    return scores.filter((F.col("rule_class") == "unresolved")
                         & (F.col("n_signal_categories") >= 1)
                         & (F.col("n_hosts") >= settings.min_hosts)).select(*QUEUE_COLUMNS)


def queue(scores: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Candidates with their place in line; a stored table carries no order of its own."""
    return with_position(candidates(scores, settings), queue_order(), "rank")


def take(queued: DataFrame, n: int) -> DataFrame:
    """The first n: by stored rank when there is one, else a top-n sort."""
    if "rank" in queued.columns:
        return queued.filter(F.col("rank") <= n)
    return queued.orderBy(*queue_order()).limit(n)


def pending(queued: DataFrame, verdict_log: DataFrame, version: str, model: str) -> DataFrame:
    """Queue minus entities this exact (version, model) pair already decided."""
    done = (verdict_log.filter((F.col("prompt_version") == version) & (F.col("model") == model))
            .select("entity_domain"))
    return queued.join(done, "entity_domain", "left_anti")


def render_prompt(rows: DataFrame, template: str, name: str = "prompt",
                  max_items: int | None = None) -> DataFrame:
    """Fill ``{field}`` slots; the template is split once, here, into literals and columns.
    A slot without a column renders as ``none``; ``max_items`` cuts lists."""
    arrays = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType)}
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        slot = re.fullmatch(r"\{(\w+)\}", piece)
        if not slot:
            parts.append(F.lit(piece))
        elif slot[1] in rows.columns:
            parts.append(template_value(slot[1], slot[1] in arrays, max_items))
        else:
            parts.append(F.lit("none"))
    return rows.withColumn(name, F.concat(*parts))


def estimate(queued: DataFrame, template: str, system: str, model: str,
             tool_schema: dict | str = "", chars_per_token: float = CHARS_PER_TOKEN,
             output_tokens: int = ASSUMED_OUTPUT_TOKENS) -> DataFrame:
    """Price of a run without making a call: one row.

    Mean prompt length and count come from the whole queue. If the fixed block clears the model's cache floor it is written once and read afterwards.
    """
    tool = tool_schema if isinstance(tool_schema, str) else json.dumps(tool_schema)
    sizes = render_prompt(queued, template).agg(
        F.count(F.lit(1)).alias("entities"),
        (F.avg(F.length("prompt")) / F.lit(chars_per_token)).alias("user_tokens"))
    block = F.lit(len(system) / chars_per_token + len(tool) / chars_per_token)
    n, user = F.col("entities"), F.col("user_tokens")
    zero = F.lit(0)
    name = F.lit(model)
    uncached = price_call(name, n * (block + user), zero, zero, n * output_tokens)
    cached = price_call(name, n * user, F.greatest(zero, n - 1) * block, block, n * output_tokens)
    fits = block >= cache_floor(name)
    return (sizes.filter("entities > 0")
            .select("entities", F.lit(len(system) / chars_per_token).alias("system_tokens"),
                    F.lit(len(tool) / chars_per_token).alias("tool_tokens"),
                    "user_tokens", cache_floor(name).alias("cache_floor"),
                    fits.alias("cached"), F.when(fits, cached).otherwise(uncached).alias("cost"),
                    uncached.alias("cost_uncached"))
            .withColumn("cost_per_call", F.col("cost") / F.col("entities")))
