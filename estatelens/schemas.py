"""Explicit schemas as DDL: nothing on the data path is inferred."""

# Raw record. The open-ended parts are MAP<STRING,STRING>: one value that is not an object must
# not null the whole map, so each value keeps its JSON text and is parsed on its own.
RAW = """
    ip_str STRING, port INT, transport STRING, timestamp STRING, asn STRING,
    org STRING, isp STRING, hostnames ARRAY<STRING>, domains ARRAY<STRING>,
    location STRUCT<country_code: STRING, country_name: STRING, region_code: STRING, city: STRING>,
    product STRING, version STRING, os STRING, devicetype STRING, info STRING,
    cpe23 ARRAY<STRING>, tags ARRAY<STRING>, vulns MAP<STRING, STRING>,
    cloud STRUCT<provider: STRING, service: STRING>, _shodan STRUCT<module: STRING>,
    http STRUCT<status: INT, title: STRING, server: STRING, waf: STRING,
                components: MAP<STRING, STRING>, securitytxt: STRING>,
    ssl STRUCT<versions: ARRAY<STRING>,
               cert: STRUCT<issuer: STRUCT<O: STRING>, subject: STRUCT<CN: STRING>,
                            sig_alg: STRING, issued: STRING, expires: STRING, expired: STRING>>,
    opts STRUCT<heartbleed: STRING>
"""

VULN = "cvss DOUBLE, epss DOUBLE, verified STRING, summary STRING"

# Projected scan table, one row per exposed service.
SCAN = """
    ip STRING, port INT, transport STRING, scanned_at STRING, asn STRING, org STRING, isp STRING,
    hostnames ARRAY<STRING>, domains ARRAY<STRING>, primary_domain STRING,
    country_code STRING, country_name STRING, region_code STRING, city STRING,
    product STRING, version STRING, os STRING, devicetype STRING, info STRING,
    cpe23 ARRAY<STRING>, tags ARRAY<STRING>, cves ARRAY<STRING>, n_cves INT,
    max_cvss FLOAT, max_epss FLOAT, n_cves_critical INT, n_cves_high INT, n_cves_verified INT,
    top_cve STRING, top_cve_cvss FLOAT, top_cve_epss FLOAT, top_cve_summary STRING,
    cloud_provider STRING, cloud_service STRING, scan_module STRING,
    http_status INT, http_title STRING, http_server STRING, http_waf STRING,
    http_components ARRAY<STRING>, has_securitytxt BOOLEAN,
    ssl_versions ARRAY<STRING>, ssl_issuer STRING, ssl_cert_cn STRING, ssl_sig_alg STRING,
    ssl_issued STRING, ssl_expires STRING, ssl_expired BOOLEAN,
    heartbleed STRING, services ARRAY<STRING>
"""

PROVIDERS = "pattern STRING, provider STRING, provider_class STRING"

VERDICT = """
    entity_domain STRING, prompt_version STRING, model STRING, entity_class STRING,
    canonical_name STRING, confidence DOUBLE, reasoning STRING
"""

TRACE = """
    task STRING, prompt_version STRING, model STRING, subject STRING, decision STRING,
    confidence DOUBLE, input_tokens BIGINT, output_tokens BIGINT, cached_tokens BIGINT,
    cache_write_tokens BIGINT, cost_usd DOUBLE, latency_ms BIGINT, attempt INT, error STRING,
    request MAP<STRING, STRING>, response MAP<STRING, STRING>, ts DOUBLE
"""

# Call telemetry as it is attached to a curated account.
CLASS_TRACE = """
    entity_domain STRING, class_model STRING, class_prompt_version STRING,
    class_latency_ms BIGINT, class_cost_usd DOUBLE, class_cached_tokens BIGINT,
    class_input_tokens BIGINT, class_output_tokens BIGINT
"""

LABEL = """
    entity_domain STRING, orgs_seen STRING, primary_country STRING, n_hosts BIGINT,
    n_ports BIGINT, n_products BIGINT, products ARRAY<STRING>, technologies ARRAY<STRING>,
    waf_vendors ARRAY<STRING>, cloud_host_ratio DOUBLE, sequential_name_ratio DOUBLE,
    batch INT, true_class STRING, labeller_note STRING
"""


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL, in order (no struct members at top level)."""
    out, depth, word = [], 0, ""
    for ch in ddl + ",":
        depth += ch in "<(" 
        depth -= ch in ">)"
        if ch == "," and depth == 0:
            out.append(word.split()[0])
            word = ""
        else:
            word += ch
    return out
