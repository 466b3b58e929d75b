"""Fit and urgency as two scores, every component kept. Row-local throughout."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from estatelens.config import (DEFAULTS, QUADRANT, SECURITY_WAF_VENDORS, TIER_A, TIER_B, TIER_C,
                               TIER_D, TIER_U, TIER_X, ScoreWeights, Settings)

INTENT_POINTS = ("pts_epss", "pts_critical_cve", "pts_datastore", "pts_heartbleed",
                 "pts_remote_access", "pts_eol", "pts_expired_cert", "pts_open_dir",
                 "pts_cameras", "pts_dead_ssl", "pts_cert_expiring", "pts_deprecated_tls")
FIT_POINTS = ("pts_size_band", "pts_whitespace", "pts_real_estate", "pts_multi_country",
              "pts_low_maturity")
SIGNAL_CATEGORIES = ("max_epss", "n_eol_services", "n_exposed_datastores", "n_remote_access",
                     "n_expired_certs", "n_self_signed", "n_open_directories",
                     "n_deprecated_tls", "n_exposed_cameras")


def waf_posture(settings: Settings = DEFAULTS) -> Column:
    """none / security_vendor / cdn_basic.

    Parity treats the percent signs around the vendor list as literal characters, as the
    published SQL does, so a real vendor name never matches.
    """
    names = "(" + "|".join(SECURITY_WAF_VENDORS) + ")"
    pattern = f"^%{names}%$" if settings.parity else names
    specialist = F.exists("waf_vendors", lambda v: F.coalesce(F.lower(v), F.lit("")).rlike(pattern))
    return (F.when(F.col("n_hosts_with_waf") == 0, "none")
             .when(F.coalesce(specialist, F.lit(False)), "security_vendor")
             .otherwise("cdn_basic"))


def points(weights: ScoreWeights) -> dict[str, Column]:
    def positive(signal: str, pts: int) -> Column:
        return F.when(F.col(signal) > 0, pts).otherwise(0)

    def threshold(x: float) -> Column:
        return F.lit(x).cast("float")      # epss is a float: compare at its own precision

    epss = F.col("max_epss")
    top, mid, low = weights.pts_epss
    size = reduce(lambda acc, band: acc.when(F.col("n_hosts").between(band[0], band[1]), band[2]),
                  weights.size_bands, F.when(F.lit(False), 0)).otherwise(weights.size_other)
    posture = reduce(lambda acc, kv: acc.when(F.col("waf_posture") == kv[0], kv[1]),
                     weights.whitespace.items(), F.when(F.lit(False), 0)).otherwise(0)
    return {
        "pts_epss": F.when(epss >= threshold(weights.epss_critical), top)
                     .when(epss >= threshold(weights.epss_urgent), mid)
                     .when(epss > 0, low).otherwise(0),
        **{name: positive(signal, pts) for name, (signal, pts) in weights.intent.items()},
        "pts_cert_expiring": F.when(F.col("soonest_cert_expiry_days")
                                    .between(*weights.cert_expiring_days),
                                    weights.pts_cert_expiring).otherwise(0),
        "pts_size_band": size,
        "pts_whitespace": posture,
        "pts_real_estate": F.when(F.col("n_products") >= 2, weights.pts_real_estate).otherwise(0),
        "pts_multi_country": F.when(F.col("n_countries") >= 2,
                                    weights.pts_multi_country).otherwise(0),
        "pts_low_maturity": F.when(F.col("publishes_securitytxt") == 0,
                                   weights.pts_low_maturity).otherwise(0),
    }


def total(names, cap: int) -> Column:
    return F.least(F.lit(cap), reduce(add, [F.col(n) for n in names]))


def signal_categories() -> Column:
    return reduce(add, [F.when(F.col(s) > 0, 1).otherwise(0) for s in SIGNAL_CATEGORIES])


def quadrant(fit_min: int, intent_min: int) -> Column:
    fits, urgent = F.col("fit_score") >= fit_min, F.col("intent_score") >= intent_min
    return (F.when(fits & urgent, TIER_A).when(fits, TIER_B).when(urgent, TIER_C)
             .otherwise(TIER_D))


def rule_tier(settings: Settings = DEFAULTS) -> Column:
    """Tier before any verdict. Rules never confirm a company, so the quadrant is reached only
    by a rule class this library does not produce."""
    return (F.when(F.col("rule_class").isin("infrastructure", "likely_infrastructure"), TIER_X)
             .when(F.col("rule_class") == "unresolved", TIER_U)
             .otherwise(quadrant(settings.fit_min, settings.intent_min)))


def score(signals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    cap = settings.weights.cap
    return (signals.withColumn("waf_posture", waf_posture(settings))
            .withColumns(points(settings.weights))
            .withColumns({"intent_score": total(INTENT_POINTS, cap),
                          "fit_score": total(FIT_POINTS, cap),
                          "n_signal_categories": signal_categories()})
            .withColumn("tier", rule_tier(settings)))


def retier(accounts: DataFrame, fit_min: int, intent_min: int, tier: str = "tier") -> DataFrame:
    """Move the quadrant tiers to new thresholds; U, X and R were decided earlier and stay."""
    return accounts.withColumn(tier, F.when(F.col(tier).isin(*QUADRANT),
                                            quadrant(fit_min, intent_min))
                               .otherwise(F.col(tier)))
