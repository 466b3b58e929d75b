"""Repeatable samples for labelling. Random order is a seeded hash of the key, so a sample can be
drawn again, on any number of executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from estatelens.functions.text import rounded

EVIDENCE = ("entity_domain", "orgs_seen", "primary_country", "n_hosts", "n_ports", "n_products",
            "products", "technologies", "waf_vendors", "cloud_host_ratio")
NEAR_MISS = (0.4, 0.79)
EXAMPLE = r"(?im)^\*\*`([a-z0-9][a-z0-9.-]*\.[a-z]{2,})`\*\*"


def shuffle_key(seed: str, key: str = "entity_domain") -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(key)))


def random_rows(df: DataFrame, n: int, seed: str, where: Column | None = None,
                key: str = "entity_domain") -> DataFrame:
    """n random rows under a predicate: a top-n sort on the hash."""
    pool = df if where is None else df.filter(where)
    return pool.orderBy(shuffle_key(seed, key), key).limit(n)


def bands() -> list[tuple[str, Column]]:
    hosts = F.col("n_hosts")
    return [("single host", hosts == 1), ("2-10 hosts", hosts.between(2, 10)),
            ("11-100 hosts", hosts.between(11, 100)), ("over 100 hosts", hosts > 100),
            ("near-miss on hosting heuristic", F.col("sequential_name_ratio").between(*NEAR_MISS))]


def stratified(pool: DataFrame, n: int, seed: str) -> DataFrame:
    """n rows spread over the size bands and the near-miss band.

    Each band draws n//5 rows of its own; a row drawn twice counts for the first band; what is
    missing is filled from the rest. Adds ``band`` and ``pick_order``. Ranks are pruned to the
    quota before the shuffle, so a band that holds most rows costs no more than a small one.
    """
    per_band = max(1, n // 5)
    member = F.filter(F.array(*[
        F.struct(F.lit(i).alias("band_no"), F.lit(name).alias("band"), cond.alias("holds"))
        for i, (name, cond) in enumerate(bands())]), lambda b: b["holds"])
    by_hash = Window.partitionBy("band_no").orderBy("_h", "entity_domain")
    drawn = (pool.select("*", F.inline(member)).drop("holds")
             .withColumn("_h", F.md5(F.concat(F.lit(seed), F.col("band"), F.col("entity_domain"))))
             .withColumn("_rn", F.row_number().over(by_hash)).filter(F.col("_rn") <= per_band))
    first = Window.partitionBy("entity_domain").orderBy("band_no")
    picked = (drawn.withColumn("_f", F.row_number().over(first)).filter("_f = 1").drop("_f"))
    rest = random_rows(pool.join(picked.select("entity_domain"), "entity_domain", "left_anti"),
                       n, seed + "rest")
    topped = rest.withColumns({"band_no": F.lit(len(bands())), "band": F.lit("topped up"),
                               "_h": shuffle_key(seed + "rest"), "_rn": F.lit(0)})
    chosen = (picked.unionByName(topped)
              .orderBy("band_no", "_h", "entity_domain").limit(n))      # n rows from here on
    return chosen.withColumn("pick_order", F.row_number().over(
        Window.orderBy("band_no", "_h", "entity_domain"))).drop("_h", "_rn", "band_no")



def exclusions(*domain_sets: DataFrame) -> DataFrame:
    """Set union of domains not to sample."""
    out = domain_sets[0].select("entity_domain")
    for other in domain_sets[1:]:
        out = out.union(other.select("entity_domain"))
    return out.distinct()


def eligible(queue: DataFrame, classification: DataFrame, exclude: DataFrame) -> DataFrame:
    """Queue with its classification evidence, minus the excluded domains."""
    extra = classification.select("entity_domain", "sequential_name_ratio", "rule_evidence")
    return (queue.select(*EVIDENCE).join(extra, "entity_domain")
            .join(exclude, "entity_domain", "left_anti"))


def example_domains(documents: DataFrame, text: str = "value") -> DataFrame:
    """Domains used as worked examples in prompt texts: they must not leak into a label set."""
    hits = F.regexp_extract_all(text, F.lit(EXAMPLE), 1)
    return documents.select(F.explode(hits).alias("d")).select(
        F.lower("d").alias("entity_domain")).distinct()


def next_batch(labels: DataFrame) -> DataFrame:
    """One row: the number of the next labelling batch; a row without a batch is batch 1."""
    return labels.agg((F.coalesce(F.max(F.coalesce("batch", F.lit(1))), F.lit(0)) + 1)
                      .alias("batch"))


def worksheet_rows(sample: DataFrame, batch: int, max_items: int | None = None) -> DataFrame:
    """Evidence with lists of non-null items (on request only the first ``max_items``), a blank
    label and a note field."""
    def clean(name: str) -> Column:
        if dict(sample.dtypes)[name].startswith("array"):
            items = F.filter(name, lambda v: v.isNotNull())
            return (items if max_items is None else F.slice(items, 1, max_items)).alias(name)
        return F.col(name)

    return sample.select(
        *[clean(c) for c in EVIDENCE],
        rounded(F.coalesce("sequential_name_ratio", F.lit(0.0)), 2).alias("sequential_name_ratio"),
        F.lit(batch).alias("batch"), F.lit("").alias("true_class"), F.lit("").alias("labeller_note"))
