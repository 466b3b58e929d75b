"""One row per entity with every observable finding; unscored, so weights stay cheap to change."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from estatelens.config import DEFAULTS, Settings
from estatelens.operators.entities import (CLASSIFICATION_MEASURES, MEASURES, SIGNAL_FACETS,
                                           distinct_count, entity_facets, entity_measures,
                                           most_common, of_interest, sorted_values)

SIGNAL_MEASURES = tuple(m for m in MEASURES if m not in CLASSIFICATION_MEASURES[1:])
HEADLINE = {"headline_cve": "top_cve", "headline_cve_cvss": "top_cve_cvss",
            "headline_cve_summary": "top_cve_summary", "headline_cve_product": "product",
            "headline_cve_version": "version"}


def facet_profile(facets: DataFrame) -> DataFrame:
    """Distinct counts, modes and value lists per entity."""
    return of_interest(facets, SIGNAL_FACETS).groupBy("entity_domain").agg(
        distinct_count("host").alias("n_hosts"), distinct_count("port").alias("n_ports"),
        distinct_count("product").alias("n_products"),
        distinct_count("country_code").alias("n_countries"),
        most_common("country_code").alias("primary_country"),
        most_common("country_name").alias("primary_country_name"),
        most_common("region_code").alias("primary_region"),
        most_common("city").alias("primary_city"),
        sorted_values("country_code").alias("countries"),
        sorted_values("waf").alias("waf_vendors"),
        sorted_values("technology").alias("technologies"),
        sorted_values("product").alias("products"))


def headline_best(hosts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The winning record per entity as comparable structs: partial results merge by maximum.

    Fixed: all five columns come from one record, chosen among the records that carry a finding
    by (epss, cvss, id) with the remaining columns as last tie-break. Parity: each column is the
    maximum's own, so they may come from different records.
    """
    epss = F.coalesce(F.col("top_cve_epss"), F.lit(0.0).cast("float"))
    if settings.parity:
        def best(column: str):
            c = F.col(column)
            return F.max(F.when(c.isNotNull(), F.struct(epss.alias("k"), c.alias("x"))))

        return hosts.groupBy("entity_domain").agg(
            *[best(source).alias(name) for name, source in HEADLINE.items()])
    cvss = F.coalesce(F.col("top_cve_cvss"), F.lit(0.0).cast("float"))
    row = F.struct(epss.alias("epss_key"), cvss.alias("cvss_key"), F.col("top_cve"),
                   *[F.col(c) for c in ("product", "version", "top_cve_summary",
                                        "top_cve_cvss")])
    return (hosts.filter("top_cve is not null").groupBy("entity_domain")
            .agg(F.max(row).alias("best")))


def headline_columns(best: DataFrame) -> DataFrame:
    if "best" in best.columns:
        picked = [F.col(f"best.{source}").alias(name) for name, source in HEADLINE.items()]
    else:
        picked = [F.col(f"{name}.x").alias(name) for name in HEADLINE]
    return best.select("entity_domain", *picked)


def headline(hosts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The most urgent finding by exploitation probability."""
    return headline_columns(headline_best(hosts, settings))


def entity_signals(hosts: DataFrame, measures: DataFrame | None = None,
                   facets: DataFrame | None = None, settings: Settings = DEFAULTS,
                   headlines: DataFrame | None = None) -> DataFrame:
    """Signals without the classification columns. All three parts are hash-partitioned by
    entity when they meet, so the joins add no shuffle."""
    if measures is None:
        measures = entity_measures(hosts, SIGNAL_MEASURES)
    if facets is None:
        facets = entity_facets(hosts, SIGNAL_FACETS)
    if headlines is None:
        headlines = headline(hosts, settings)
    zero, empty = F.lit(0).cast("bigint"), F.array().cast("array<string>")
    joined = (measures.select("entity_domain", *SIGNAL_MEASURES)
              .join(facet_profile(facets), "entity_domain", "left")
              .join(headlines, "entity_domain", "left"))
    filled = {c: F.coalesce(F.col(c), zero)
              for c in ("n_hosts", "n_ports", "n_products", "n_countries")}
    filled |= {c: F.coalesce(F.col(c), empty)
               for c in ("countries", "waf_vendors", "technologies", "products")}
    return joined.withColumns({**filled, "no_waf_anywhere": F.col("n_hosts_with_waf") == 0})


CLASSIFICATION_COLUMNS = ("rule_class", "rule_evidence", "matched_provider",
                          "matched_provider_class", "cloud_host_ratio", "orgs_seen")


def company_signals(hosts: DataFrame, classification: DataFrame, measures: DataFrame | None = None,
                    facets: DataFrame | None = None, settings: Settings = DEFAULTS,
                    headlines: DataFrame | None = None) -> DataFrame:
    return entity_signals(hosts, measures, facets, settings, headlines).join(
        classification.select("entity_domain", *CLASSIFICATION_COLUMNS), "entity_domain", "left")
