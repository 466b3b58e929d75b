"""The layer runner: build, write, check, stop on error.

Staged hosts are row-local, so they stay a view. Entity hosts are written once, with the columns that
the aggregates read: a scan may be a view of joins itself, and each aggregate would run them again.
Every layer from there on is a Parquet table, checked before the next one is built, so a failing check
blocks everything downstream. Row checks are counted while rows pass and cost no scan of their own.
Re-scoring starts from the signals table and never reads the scan again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from estatelens.config import DEFAULTS, Settings
from estatelens.operators import entities, quality, queueing, scoring, signals, staging

# A host table carries what the aggregates read. The rest stays in the scan table.
HOST_COLUMNS = (
    "entity_domain", "entity_source", "ip", "hostnames", "asn", "port", "org_normalised",
    "country_code", "country_name", "region_code", "city", "product", "version",
    "http_waf", "http_components", "has_securitytxt", "max_epss", "max_cvss", "n_cves",
    "n_cves_critical", "n_cves_high", "n_cves_verified", "top_cve", "top_cve_cvss",
    "top_cve_epss", "top_cve_summary", "ssl_expired", "heartbleed", "scanned_at",
    "supports_deprecated_tls", "supports_dead_ssl", "weak_cert_signature",
    "days_to_cert_expiry", "runs_eol_software", "self_signed_cert", "open_directory",
    "iot_device", "vpn_endpoint", "is_cloud_or_cdn", "is_honeypot", "is_malicious_infra",
    "n_remote_access_services", "n_datastore_services", "n_exposed_cameras",
    "sequential_hostname", "is_reverse_dns_zone")


@dataclass
class Layers:
    """Paths and reports of one run under ``root``, a folder all executors share."""

    spark: SparkSession
    root: str
    enforce: bool = True
    reports: list = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a layer and check it."""
        checks = quality.checks().get(name, [])
        watched, seen = quality.watch(df, checks)
        stored = self._store(name, watched)
        self.judge(quality.watched_report(seen, stored, name, checks))
        return stored

    def judge(self, rows: list) -> None:
        self.reports += quality.refuse_errors(rows) if self.enforce else rows

    def check(self, name: str, df: DataFrame) -> None:
        """Check a table somebody else stored."""
        self.judge(quality.report(df, name, quality.checks()[name]).collect())   # few rows

    # ------------------------------------------------------------------------- the pipeline
    def host_view(self, scan: DataFrame, as_of) -> tuple[DataFrame, Callable[..., None]]:
        """Entity hosts with their checks attached; call the second value after the first write
        that reads them. Given what was written, checks that need a second look read that and not the
        scan again."""
        contract = quality.checks()
        staged, on_staged = quality.watch(staging.stage(scan, as_of), contract["staged"])
        plain_hosts = entities.entity_hosts(staging.stage(scan, as_of))
        hosts, on_hosts = quality.watch(entities.entity_hosts(staged), contract["hosts"])

        def judge(stored: DataFrame | None = None) -> None:
            self.judge(quality.watched_report(on_staged, staging.stage(scan, as_of), "staged",
                                              contract["staged"]))
            self.judge(quality.watched_report(on_hosts, plain_hosts if stored is None else stored,
                                              "hosts", contract["hosts"]))

        return hosts, judge

    def store_hosts(self, scan: DataFrame, as_of) -> tuple[DataFrame, Callable[..., None]]:
        hosts, judge = self.host_view(scan, as_of)
        return self._store("hosts", hosts.select(*HOST_COLUMNS)), judge

    def write_hosts(self, scan: DataFrame, as_of) -> DataFrame:
        """The entity hosts as a table: what the aggregates read, and users who query them directly."""
        stored, judge = self.store_hosts(scan, as_of)
        judge(stored)
        return stored

    def build_partials(self, scan: DataFrame, as_of, settings: Settings = DEFAULTS):
        """The three entity aggregates everything else is made of."""
        hosts, judge = self.store_hosts(scan, as_of)
        measures = self.write("measures", entities.entity_measures(hosts))
        judge(hosts)
        return (measures, self.write("facets", entities.entity_facets(hosts, rows=hosts.count())),
                self.write("headlines", signals.headline(hosts, settings)))

    def build(self, scan: DataFrame, providers: DataFrame, as_of,
              settings: Settings = DEFAULTS) -> DataFrame:
        """Scan table to ordered queue."""
        self.check("providers", providers)
        measures, facets, headlines = self.build_partials(scan, as_of, settings)
        rollup = self.write("rollup", entities.entity_rollup(None, measures, facets))
        classification = self.write(
            "classification", entities.classify_by_rule(rollup, providers, settings, facets))
        self.write("signals", signals.company_signals(None, classification, measures, facets,
                                                      settings, headlines))
        return self.rescore(settings)

    def rescore(self, settings: Settings = DEFAULTS) -> DataFrame:
        """Scores and queue from the stored signals."""
        scores = self.write("scores", scoring.score(self.read("signals"), settings))
        return self.write("queue", queueing.queue(scores, settings))
