"""Verdicts merged into the scores: the account table, its filters and its exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estatelens.config import (COMPANY, DEFAULTS, PROSPECT_CLASSES, PUBLIC_SECTOR, QUADRANT,
                               SIZE_BANDS, TIER_A, TIER_R, TIER_U, TIER_X, Settings)
from estatelens.functions.arrays import matching
from estatelens.operators.scoring import FIT_POINTS, INTENT_POINTS, quadrant, retier

# The published columns. An explicit list is the privacy rule: no address can get in.
SCORE_COLUMNS = (
    "fit_score", "intent_score", "primary_country", "primary_country_name", "primary_region",
    "primary_city", "n_hosts", "n_ports", "n_products", "n_countries", "max_epss", "max_cvss",
    "n_cves_critical", "n_cves_high", "n_cve_findings", "headline_cve", "headline_cve_epss",
    "headline_cve_cvss", "headline_cve_summary", "headline_cve_product", "headline_cve_version",
    "n_eol_services", "n_expired_certs", "soonest_cert_expiry_days", "n_deprecated_tls",
    "n_dead_ssl", "n_self_signed", "n_weak_cert_sig", "n_exposed_datastores", "n_remote_access",
    "n_exposed_cameras", "n_open_directories", "n_iot_devices", "heartbleed_vulnerable",
    "no_waf_anywhere", "waf_vendors", "publishes_securitytxt", "technologies", "products",
    "n_signal_categories", *INTENT_POINTS, *FIT_POINTS, "last_seen_at")
TRACE_COLUMNS = ("class_model", "class_prompt_version", "class_latency_ms", "class_cost_usd",
                 "class_cached_tokens", "class_input_tokens", "class_output_tokens")
PRIVATE_COLUMNS = {"ip", "hostnames"}

CRM_COLUMNS = {
    "company": "Company", "entity_domain": "Domain", "tier": "Tier", "intent_score": "Urgency",
    "fit_score": "Fit", "primary_country_name": "Market", "primary_city": "City",
    "n_hosts": "Hosts", "n_ports": "Open ports", "max_epss": "Exploit probability",
    "headline_cve": "Top CVE", "no_waf_anywhere": "Whitespace",
    "entity_class": "Classification", "class_confidence": "Classification confidence",
}
LIST_COLUMNS = {
    "company": "Company", "tier": "Tier", "intent_score": "Urgency", "fit_score": "Fit",
    "primary_country_name": "Market", "n_hosts": "Hosts", "max_epss": "Exploit prob.",
    "headline_cve": "Top CVE", "no_waf_anywhere": "Whitespace",
}
SCORE_DRIVERS = (
    ("Exploitation probability", "pts_epss"), ("Critical CVE", "pts_critical_cve"),
    ("Exposed datastore", "pts_datastore"), ("Remote access", "pts_remote_access"),
    ("End-of-life software", "pts_eol"), ("Certificate expired", "pts_expired_cert"),
    ("Estate size band", "pts_size_band"), ("No incumbent vendor", "pts_whitespace"),
    ("Multi-market", "pts_multi_country"),
)


def final_tier(settings: Settings = DEFAULTS) -> Column:
    cls = F.col("entity_class")
    return (F.when(cls.isNull(), TIER_U)
             .when(~cls.isin(*PROSPECT_CLASSES), TIER_X)
             .when(F.col("class_confidence") < settings.min_confidence, TIER_R)
             .otherwise(quadrant(settings.fit_min, settings.intent_min)))


def curate(scores: DataFrame, verdicts: DataFrame, traces: DataFrame | None = None,
           settings: Settings = DEFAULTS) -> DataFrame:
    """One row per classified entity. Whether a side is broadcast is left to its measured bytes."""
    decided = verdicts.filter("entity_class is not null").select(
        "entity_domain", "entity_class", "canonical_name",
        F.col("confidence").alias("class_confidence"), F.col("reasoning").alias("class_reasoning"))
    joined = scores.join(decided, "entity_domain")
    telemetry = [F.lit(None).cast(kind).alias(name) for name, kind in
                 zip(TRACE_COLUMNS, ("string", "string", "bigint", "double", "bigint", "bigint",
                                     "bigint"))]
    if traces is not None:
        joined = joined.join(traces, "entity_domain", "left")
        telemetry = [F.col(c) for c in TRACE_COLUMNS]
    return joined.select(
        "entity_domain", F.coalesce("canonical_name", "entity_domain").alias("company"),
        "entity_class", "class_confidence", "class_reasoning",
        final_tier(settings).alias("tier"), *SCORE_COLUMNS, *telemetry)


def assert_private(df: DataFrame) -> DataFrame:
    leaked = PRIVATE_COLUMNS & set(df.columns)
    if leaked:
        raise ValueError(f"account table must not carry {sorted(leaked)}")
    return df


def write_curated(curated: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    assert_private(curated)
    (curated.write.mode("overwrite").option("compression", "zstd")
     .option("maxRecordsPerFile", rows_per_file).parquet(path))


def table_bytes(spark, path: str) -> int:
    """Size on storage, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def tier_histogram(accounts: DataFrame, tier: str = "tier") -> DataFrame:
    return accounts.groupBy(tier).agg(F.count(F.lit(1)).alias("n")).orderBy(tier)


# -------------------------------------------------------------------------------------- views
def visible_tiers(tier: str = "tier") -> Column:
    return ~F.col(tier).rlike("^[XU]")


def account_order() -> list[Column]:
    return [F.desc("intent_score"), F.desc("fit_score"), F.asc("entity_domain")]


def is_exploited(settings: Settings = DEFAULTS) -> Column:
    floor = F.lit(settings.exploited_epss).cast("float")
    return F.coalesce(F.col("max_epss"), F.lit(0.0).cast("float")) > floor


SEGMENTS = {"all": None, "commercial": COMPANY, "public": PUBLIC_SECTOR}


def accounts_view(accounts: DataFrame, tiers=None, segment: str = "commercial", markets=None,
                  size_band: str = "Any", min_intent: int = 0, whitespace_only: bool = False,
                  exploited_only: bool = False, settings: Settings = DEFAULTS) -> DataFrame:
    """Filtered accounts, unsorted. All filters are optional and combine with AND."""
    view = accounts
    if tiers:
        view = view.filter(F.col("tier").isin(*tiers))
    if SEGMENTS[segment]:
        view = view.filter(F.col("entity_class") == SEGMENTS[segment])
    if markets:
        view = view.filter(F.col("primary_country_name").isin(*markets))
    low, high = SIZE_BANDS[size_band]
    if low is not None:
        view = view.filter(F.col("n_hosts") >= low)
    if high is not None:
        view = view.filter(F.col("n_hosts") <= high)
    view = view.filter(F.col("intent_score") >= min_intent)
    if whitespace_only:
        view = view.filter("no_waf_anywhere")
    if exploited_only:
        view = view.filter(is_exploited(settings))
    return view


def default_tiers(accounts: DataFrame) -> list[str]:
    """Opening selection: the A tiers, or every visible tier when there is no A. The tier
    column has seven values."""
    shown = sorted(r[0] for r in accounts.filter(visible_tiers()).select("tier").distinct()
                   .collect())
    return [t for t in shown if t.startswith("A")] or shown


def kpis(view: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return view.agg(F.count(F.lit(1)).alias("accounts"),
                    matching(F.col("tier") == TIER_A).alias("call_now"),
                    matching(F.col("no_waf_anywhere")).alias("whitespace"),
                    matching(is_exploited(settings)).alias("exploited"))


def renamed(view: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return view.select(*[F.col(c).alias(mapping[c]) for c in mapping if c in view.columns])


def crm_columns(view: DataFrame) -> DataFrame:
    return renamed(view, CRM_COLUMNS)


def prospect_list(view: DataFrame) -> DataFrame:
    return renamed(view.orderBy(*account_order()), LIST_COLUMNS)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, in as many files as the data needs."""
    df.write.mode("overwrite").csv(path, header=True)


# ------------------------------------------------------------------------- threshold changes
def with_shipped(accounts: DataFrame, fit_min: int, intent_min: int) -> DataFrame:
    """Adds ``shipped`` and re-tiers ``tier``: both states on one row, no join."""
    return retier(accounts.withColumn("shipped", F.col("tier")), fit_min, intent_min)


def tier_sensitivity(retiered: DataFrame) -> DataFrame:
    """tier, shipped count, count now, change."""
    both = retiered.select(F.inline(F.array(
        F.struct(F.col("shipped").alias("tier"), F.lit(1).alias("was"), F.lit(0).alias("now")),
        F.struct(F.col("tier").alias("tier"), F.lit(0).alias("was"), F.lit(1).alias("now")))))
    return (both.groupBy("tier").agg(F.sum("was").alias("n_shipped"), F.sum("now").alias("n_now"))
            .withColumn("change", F.col("n_now") - F.col("n_shipped")).orderBy("tier"))


def movers(retiered: DataFrame) -> DataFrame:
    return retiered.filter(F.col("shipped").isin(*QUADRANT) & (F.col("tier") != F.col("shipped")))


def movers_list(retiered: DataFrame) -> DataFrame:
    return (movers(retiered)
            .orderBy("shipped", "tier", F.desc("intent_score"), "entity_domain")
            .select(F.col("company").alias("Company"), F.col("entity_domain").alias("Domain"),
                    F.col("fit_score").alias("Fit"), F.col("intent_score").alias("Urgency"),
                    F.col("shipped").alias("Shipped"), F.col("tier").alias("Now")))


def score_drivers(accounts: DataFrame) -> DataFrame:
    """Adds ``drivers``: the non-zero components in fixed order, and additive token totals."""
    listed = F.array(*[F.struct(F.lit(label).alias("label"), F.col(c).alias("points"))
                       for label, c in SCORE_DRIVERS])
    zero = F.lit(0).cast("bigint")
    return accounts.withColumns({
        "drivers": F.filter(listed, lambda d: d["points"] != 0),
        # input_tokens excludes cache reads, so the two add up
        "tokens_in": F.coalesce("class_input_tokens", zero)
                     + F.coalesce("class_cached_tokens", zero)})
