"""Data-quality checks: all row-level checks of a table in one aggregate, with severities."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, functions as F

from estatelens import config
from estatelens.functions.arrays import matching
from estatelens.functions.text import is_address


@dataclass(frozen=True)
class Check:
    """``kind`` row: rows where ``condition`` holds are offending. ``kind`` unique: values of
    ``column`` that occur more than once. ``group_by`` counts offending groups, not rows."""

    name: str
    condition: Column | None = None
    column: str | None = None
    kind: str = "row"
    group_by: str | None = None
    warn_above: int | None = None      # warn when more than this many fail
    error_above: int = 0

    def offending(self, df: DataFrame) -> DataFrame:
        if self.kind == "unique":
            return (df.filter(F.col(self.column).isNotNull()).groupBy(self.column)
                    .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        rows = df.filter(self.condition)
        if self.group_by:
            return rows.groupBy(self.group_by).agg(F.count(F.lit(1)).alias("n"))
        return rows


class QualityError(RuntimeError):
    """A check failed at error level; the layers downstream must not be built."""


def not_null(*columns: str) -> list[Check]:
    return [Check(f"not_null_{c}", F.col(c).isNull(), c) for c in columns]


def unique(column: str) -> Check:
    return Check(f"unique_{column}", column=column, kind="unique")


def accepted_values(column: str, values) -> Check:
    """Nulls pass."""
    return Check(f"accepted_values_{column}", ~F.col(column).isin(*values), column)


def checks() -> dict[str, list[Check]]:
    """The contract of every layer."""
    infra = F.col("rule_class").isin("infrastructure", "likely_infrastructure")
    unidentified = (F.col("ip").isNull() & F.col("cert_domain").isNull()
                    & (F.coalesce(F.size("hostnames"), F.lit(0)) <= 0))
    bounds = ~F.col("fit_score").between(0, 100) | ~F.col("intent_score").between(0, 100)
    return {
        "staged": [
            *not_null("port", "supports_deprecated_tls", "is_honeypot", "is_malicious_infra"),
            accepted_values("transport", ("tcp", "udp")),
            Check("hosts_identifiable", unidentified, warn_above=0, error_above=100_000)],
        "hosts": [
            *not_null("entity_domain", "entity_source"),
            accepted_values("entity_source", ("hostname", "certificate")),
            Check("entities_are_not_addresses", is_address("entity_domain"),
                  group_by="entity_domain"),
            Check("no_unsellable_entities", F.col("is_honeypot") | F.col("is_malicious_infra"),
                  group_by="entity_domain")],
        "classification": [
            *not_null("entity_domain", "rule_class"), unique("entity_domain"),
            accepted_values("rule_class", config.RULE_CLASSES)],
        "signals": [*not_null("entity_domain", "n_hosts", "no_waf_anywhere"),
                    unique("entity_domain")],
        "scores": [
            *not_null("entity_domain", "fit_score", "intent_score", "tier"),
            unique("entity_domain"), accepted_values("tier", config.RULE_STAGE_TIERS),
            Check("infrastructure_never_tiered", infra & (F.col("tier") != config.TIER_X)),
            Check("unclassified_never_tiered", (F.col("rule_class") == "unresolved")
                  & (F.col("tier") != config.TIER_U)),
            Check("scores_within_bounds", bounds)],
        "queue": [*not_null("entity_domain"), unique("entity_domain")],
        "providers": [*not_null("pattern"), unique("pattern"),
                      accepted_values("provider_class", config.PROVIDER_CLASSES)],
    }


def _status(failed: Column, error_above: Column, warn_above: Column) -> Column:
    return F.when(failed > error_above, "error").when(failed > warn_above, "warn").otherwise("pass")


def _limits(check: Check) -> list[Column]:
    return [F.lit(check.error_above).cast("bigint").alias("error_above"),
            F.lit(check.warn_above).cast("bigint").alias("warn_above")]


def report(df: DataFrame, table: str, checks_: list[Check]) -> DataFrame:
    """(table, check, failed, status) with status pass, warn or error."""
    parts = []
    flat = [c for c in checks_ if c.kind == "row" and not c.group_by]
    if flat:
        counts = df.agg(*[matching(c.condition).alias(f"c{i}") for i, c in enumerate(flat)])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failed"), *_limits(c))
            for i, c in enumerate(flat)]))))
    for c in checks_:
        if c not in flat:
            parts.append(c.offending(df).agg(F.count(F.lit(1)).alias("failed")).select(
                F.lit(c.name).alias("check"), "failed", *_limits(c)))
    rows = reduce(DataFrame.unionByName, parts)
    status = _status(F.col("failed"), F.col("error_above"), F.col("warn_above"))
    return rows.select(F.lit(table).alias("table"), "check", "failed", status.alias("status"))


def watch(df: DataFrame, checks_: list[Check]) -> tuple[DataFrame, Observation | None]:
    """Count the failing rows of every row check while the table is written, at no extra scan."""
    rows = [(i, c) for i, c in enumerate(checks_) if c.kind == "row"]
    if not rows:
        return df, None
    seen = Observation()
    return df.observe(seen, *[matching(c.condition).alias(f"c{i}") for i, c in rows]), seen


def watched_report(seen: Observation | None, df: DataFrame, table: str,
                   checks_: list[Check]) -> list[Row]:
    """Report from the counts taken during the write. A second look at the table is needed for
    uniqueness, and for grouped checks that found anything."""
    counts = seen.get if seen is not None else {}
    done, open_ = [], []
    for i, c in enumerate(checks_):
        failed = counts.get(f"c{i}")
        if failed is None or (c.group_by and failed):
            open_.append(c)
            continue
        status = ("error" if failed > c.error_above else
                  "warn" if c.warn_above is not None and failed > c.warn_above else "pass")
        done.append(Row(table=table, check=c.name, failed=failed, status=status))
    return done + (report(df, table, open_).collect() if open_ else [])      # one row per check


def refuse_errors(rows: list[Row]) -> list[Row]:
    failed = [r for r in rows if r.status == "error"]
    if failed:
        raise QualityError("; ".join(f"{r.table}.{r.check}: {r.failed}" for r in failed))
    return rows


def enforce(df: DataFrame, table: str, checks_: list[Check]) -> list[Row]:
    """Check a stored table; raise when any check is in error."""
    return refuse_errors(report(df, table, checks_).collect())               # one row per check
