"""Casts, normalised anchors and per-record flags. Row-local: the layer stays a lazy view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from estatelens.config import CAMERA_SERVICES, DATASTORE_SERVICES, REMOTE_ACCESS_SERVICES
from estatelens.functions.arrays import count_in, first, has_any
from estatelens.functions.text import (cert_domain, org_normalised, reverse_dns_zone,
                                       sequential_name, timestamp_or_null)


def date_column(as_of) -> Column:
    """The reporting date is an argument, never the clock."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def malicious(scan_module: str = "scan_module", tags: str = "tags") -> Column:
    module = F.coalesce(F.lower(F.col(scan_module)), F.lit(""))
    return (module.contains("-rat") | module.contains("rat-") | module.contains("malware")
            | module.contains("botnet") | has_any(tags, "c2", "compromised"))


def flag_columns(as_of) -> dict[str, Column]:
    return {
        "supports_deprecated_tls": has_any("ssl_versions", "TLSv1", "TLSv1.1"),
        "supports_dead_ssl": has_any("ssl_versions", "SSLv2", "SSLv3"),
        "weak_cert_signature": F.coalesce(F.lower("ssl_sig_alg").contains("sha1"), F.lit(False)),
        "days_to_cert_expiry": F.datediff(F.col("cert_expires_at").cast("date"),
                                          date_column(as_of)),
        "runs_eol_software": has_any("tags", "eol-product", "eol-os"),
        "self_signed_cert": has_any("tags", "self-signed"),
        "exposes_database_tag": has_any("tags", "database"),
        "open_directory": has_any("tags", "open-dir"),
        "iot_device": has_any("tags", "iot"),
        "vpn_endpoint": has_any("tags", "vpn"),
        "is_cloud_or_cdn": has_any("tags", "cloud", "cdn"),
        "is_honeypot": has_any("tags", "honeypot"),
        "is_malicious_infra": malicious(),
        "n_remote_access_services": count_in("services", REMOTE_ACCESS_SERVICES),
        "n_datastore_services": count_in("services", DATASTORE_SERVICES),
        "n_exposed_cameras": count_in("services", CAMERA_SERVICES),
        "has_waf": F.col("http_waf").isNotNull(),
        "sequential_hostname": sequential_name(first("hostnames")),
        "is_reverse_dns_zone": reverse_dns_zone("primary_domain"),
    }


def stage(scan: DataFrame, as_of) -> DataFrame:
    """Scan table -> staged hosts: same grain, nothing filtered."""
    typed = scan.withColumns({
        "scanned_at": timestamp_or_null("scanned_at"),
        "cert_domain": cert_domain("ssl_cert_cn"),
        "org_normalised": org_normalised("org"),
        "cert_issued_at": timestamp_or_null("ssl_issued"),
        "cert_expires_at": timestamp_or_null("ssl_expires"),
    }).drop("domains", "ssl_cert_cn", "ssl_issued", "ssl_expires")
    return typed.withColumns(flag_columns(as_of))
