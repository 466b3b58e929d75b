"""The scan table, and raw scan records, derived from a star schema of orders.

One order line plays one exposed service. The scalar expressions are SQL text that Spark and
other engines read alike, so a second engine can be given the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from estatelens import schemas

AS_OF = "1998-06-01"
TABLES = ("lineitem", "orders", "supplier", "nation", "region", "part")

FROM = """
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
    join supplier s on l.l_suppkey = s.s_suppkey
    join nation n on s.s_nationkey = n.n_nationkey
    join region r on n.n_regionkey = r.r_regionkey
    join part p on l.l_partkey = p.p_partkey
"""
# The same join as Spark runs it, which keeps the order of the text: rows are shuffled while they are
# narrow, and get the columns of the small tables last.
JOINED = """
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
    join part p on l.l_partkey = p.p_partkey
    join supplier s on l.l_suppkey = s.s_suppkey
    join nation n on s.s_nationkey = n.n_nationkey
    join region r on n.n_regionkey = r.r_regionkey
"""
FOUND = "(l.l_discount > 0 and l.l_linenumber = 1)"
SECOND = f"({FOUND} and l.l_partkey % 3 = 0)"

SCALARS = {
    "ip": "case when l.l_linenumber <> 7 then concat('h', l.l_suppkey, '-', l.l_linenumber) end",
    "port": "cast(l.l_partkey % (case when o.o_custkey % 2 = 0 then 5 else 40 end) as int)",
    "transport": "case when l.l_linenumber % 2 = 0 then 'udp' else 'tcp' end",
    "scanned_at": "cast(l.l_shipdate as string)",
    "asn": "concat('AS', l.l_suppkey % 10)",
    "org": """case when l.l_partkey % 17 = 1 then null when l.l_partkey % 19 = 2 then '...'
        when l.l_partkey % 211 = 3 then 'Google LLC'
        when l.l_partkey % 211 = 4 then 'Amazon.com, Inc.'
        when l.l_partkey % 211 = 5 then 'AT&T Corp.' else concat(s.s_name, ' Ltd.') end""",
    "isp": "s.s_name",
    "primary_domain": """case when l.l_orderkey % 997 = 5 then concat(o.o_custkey % 7, '.in-addr.arpa')
        when l.l_orderkey % 991 = 6 then '192.0.2.9'
        when l.l_orderkey % 13 = 0 then null
        when o.o_custkey % 5 = 0 then concat('c', o.o_custkey, '.example')
        when o.o_custkey % 50 = 1 then 'big.example'
        when o.o_custkey % 50 = 3 then concat('mid', o.o_custkey % 7, '.example')
        when o.o_custkey % 50 = 9 then concat('render', o.o_custkey % 4, '.example')
        else concat('o', l.l_orderkey, '.example') end""",
    "country_code": "case when l.l_linenumber <> 5 then concat('N', n.n_nationkey) end",
    "country_name": "n.n_name",
    "region_code": "r.r_name",
    "city": "p.p_name",
    "product": "case when l.l_partkey % 4 <> 0 then p.p_type end",
    "version": "p.p_brand",
    "os": "case when l.l_partkey % 6 = 0 then 'Linux' end",
    "devicetype": "case when l.l_partkey % 41 = 0 then 'webcam' end",
    "info": "cast(null as string)",
    "n_cves": f"case when {SECOND} then 2 when {FOUND} then 1 else 0 end",
    "max_cvss": f"cast(case when {FOUND} then round(l.l_tax * 125, 2) end as float)",
    "max_epss": f"cast(case when {FOUND} then round(l.l_discount * 10, 2) end as float)",
    "n_cves_critical": f"case when {FOUND} and round(l.l_tax * 125, 2) >= 9 then 1 else 0 end",
    "n_cves_high": f"""case when {FOUND} and round(l.l_tax * 125, 2) >= 7
        and round(l.l_tax * 125, 2) < 9 then 1 else 0 end""",
    "n_cves_verified": f"case when {FOUND} and l.l_partkey % 5 = 0 then 1 else 0 end",
    "top_cve": f"case when {FOUND} then concat('CVE-', l.l_partkey) end",
    "top_cve_cvss": f"cast(case when {FOUND} then round(l.l_tax * 125, 2) end as float)",
    "top_cve_epss": f"cast(case when {FOUND} then round(l.l_discount * 10, 2) end as float)",
    "top_cve_summary": f"case when {FOUND} then concat('Flaw in ', p.p_type) end",
    "cloud_provider": "case when o.o_custkey % 20 = 0 then 'Amazon' end",
    "cloud_service": "case when o.o_custkey % 40 = 0 then 'EC2' end",
    "scan_module": """case when l.l_partkey % 107 = 0 then 'remcos-pro-rat'
        when l.l_partkey % 109 = 0 then 'rat-x' else 'http-simple' end""",
    "http_status": "200 + l.l_linenumber",
    "http_title": "p.p_name",
    "http_server": "p.p_brand",
    "http_waf": """case when o.o_orderpriority = '1-URGENT' and l.l_linenumber = 2 then
        case when l.l_partkey % 9 = 0 then 'FortiWeb (Fortinet)'
             when l.l_partkey % 9 = 1 then 'Cloudflare' else p.p_brand end end""",
    "has_securitytxt": "o.o_custkey % 9 = 0 and l.l_linenumber = 1",
    "ssl_issuer": "case when l.l_linenumber <> 6 then s.s_name end",
    "ssl_cert_cn": """case when o.o_custkey % 3 = 0 then
        case when l.l_partkey % 11 = 0 then '155.0.2.1' when l.l_partkey % 13 = 0 then '2001:db8::1'
             when l.l_partkey % 5 = 0 then concat('*.x', o.o_custkey % 97, '.example')
             else concat('x', o.o_custkey % 97, '.example') end end""",
    "ssl_sig_alg": """case when l.l_linenumber <> 6 then case when l.l_partkey % 59 = 0
        then 'sha1WithRSAEncryption' else 'sha256WithRSAEncryption' end end""",
    "ssl_issued": "cast(o.o_orderdate as string)",
    "ssl_expires": """case when l.l_linenumber = 3 then cast(l.l_shipdate as string)
        when l.l_linenumber = 4 then '20260101000000Z' end""",
    "ssl_expired": "l.l_partkey % 61 = 0",
    "heartbleed": """case when l.l_partkey % 67 = 0 then 'VULNERABLE'
        when l.l_partkey % 3 = 0 then 'SAFE' end""",
}
# Arrays as lists of elements; a null element is left out.
ARRAYS = {
    "hostnames": ["""case when l.l_linenumber = 7 and l.l_orderkey % 3 = 0 then null
        when o.o_custkey % 15 = 0 and l.l_suppkey % 10 <> 0
        then concat('srv', l.l_suppkey, '.', lower(n.n_name))
        when l.l_orderkey % 4 = 0 then concat('www.', lower(n.n_name))
        else concat('mail-', lower(n.n_name), '.example') end""",
                  "case when l.l_orderkey % 8 = 0 and l.l_linenumber <> 7 then 'cdn.example' end"],
    "domains": [],
    "cpe23": ["case when l.l_partkey % 4 <> 0 then concat('cpe:2.3:a:', lower(p.p_type)) end"],
    "tags": ["case when l.l_returnflag = 'R' and l.l_linenumber = 1 then 'eol-product' end",
             "case when l.l_linestatus = 'F' and l.l_linenumber = 2 then 'self-signed' end",
             "case when l.l_partkey % 101 = 0 then 'honeypot' end",
             "case when l.l_partkey % 103 = 0 then 'c2' end",
             "case when o.o_custkey % 20 = 0 then 'cloud' end",
             "case when l.l_partkey % 37 = 0 then 'open-dir' end",
             "case when l.l_partkey % 41 = 0 then 'iot' end",
             "case when l.l_partkey % 43 = 0 then 'vpn' end",
             "case when l.l_partkey % 47 = 0 then 'database' end"],
    "cves": [f"case when {FOUND} then concat('CVE-', l.l_partkey) end",
             f"case when {SECOND} then concat('CVE-', l.l_partkey, '-b') end"],
    "http_components": ["case when l.l_linenumber <= 3 then p.p_brand end",
                        "case when l.l_linenumber <= 3 then concat('z', lower(p.p_type)) end"],
    "ssl_versions": ["case when l.l_linenumber <> 6 then 'TLSv1.2' end",
                     "case when l.l_partkey % 31 = 0 then 'TLSv1' else '-TLSv1' end",
                     "case when l.l_partkey % 53 = 0 then 'SSLv3' end"],
    "services": ["case when l.l_partkey % 17 = 0 then 'redis' end",
                 "case when l.l_partkey % 23 = 0 then 'mysql' end",
                 "case when l.l_partkey % 7 = 0 then 'ssh' end",
                 "case when l.l_partkey % 29 = 0 then 'ftp' end",
                 "case when l.l_partkey % 19 = 0 then 'telnet' end",
                 "case when l.l_partkey % 31 = 0 then 'hikvision' end"],
}


def spark_array(items: list[str]) -> str:
    """Joined from arrays of one item or none: array_compact filters with a lambda, which is not
    compiled, nor is what it reads."""
    none = "cast(array() as array<string>)"
    return f"concat({', '.join([none, *[f'nvl2({i}, array({i}), {none})' for i in items]])})"


def select_list(array) -> str:
    """All 50 columns in schema order; ``array`` renders a list of element expressions."""
    return ",\n".join(f"{SCALARS.get(c) or array(ARRAYS[c])} as {c}"
                      for c in schemas.names(schemas.SCAN))


def _view(spark: SparkSession, sf_dir: str, columns: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    sql = f"select {columns} {JOINED}"
    for t in TABLES:                       # from lineitem l -> from {lineitem} l
        sql = sql.replace(f" {t} {t[0]} ", f" {{{t}}} {t[0]} ")
    return spark.sql(sql, **tables)


def scan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, in the shape of the projected scan table."""
    return _view(spark, sf_dir, select_list(spark_array))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same services as raw JSON lines (``value``), before any projection."""
    extra = {"found": FOUND, "second": SECOND, "verified": "l.l_partkey % 5 = 0",
             "cvss": "round(l.l_tax * 125, 2)", "epss": "round(l.l_discount * 10, 2)"}
    flat = _view(spark, sf_dir, select_list(spark_array) + ",\n"
                 + ",\n".join(f"{e} as _{n}" for n, e in extra.items()))
    c = F.col

    def vuln(cvss, epss, verified, summary):
        return F.struct(cvss.alias("cvss"), epss.alias("epss"), verified.alias("verified"),
                        summary.alias("summary"))

    worst = F.struct(c("top_cve").alias("key"),
                     vuln(c("_cvss"), c("_epss"), c("_verified"), c("top_cve_summary")).alias("value"))
    lesser = F.struct(F.concat("top_cve", F.lit("-b")).alias("key"),
                      vuln(F.lit(0.0).cast("double"), F.lit(0.0).cast("double"), F.lit(False),
                           F.lit("minor")).alias("value"))
    # Without lambdas, which are not compiled. The second finding comes with the first.
    vulns = (F.when(c("_second"), F.map_from_entries(F.array(lesser, worst)))
             .when(c("_found"), F.map_from_entries(F.array(worst)))
             .otherwise(F.map_from_entries(F.slice(F.array(worst), 1, 0))))
    parts = F.map_from_arrays("http_components", F.array_repeat(
        F.struct(F.lit(1).alias("seen")), F.size("http_components")))
    present = [F.when(F.array_contains("services", key), F.struct(F.lit(1).alias("up"))).alias(key)
               for key in ("redis", "mysql", "ssh", "ftp", "telnet", "hikvision")]
    # A domain is read back from the hostnames, so they carry it: short and long form.
    zone = c("primary_domain")
    names = F.when(zone.isNull(), F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("a.b."), zone), zone))
    record = F.struct(
        c("ip").alias("ip_str"), "port", "transport", c("scanned_at").alias("timestamp"), "asn",
        "org", "isp", names.alias("hostnames"), "domains",
        F.struct("country_code", "country_name", "region_code", "city").alias("location"),
        "product", "version", "os", "devicetype", "info", "cpe23", "tags",
        vulns.alias("vulns"),
        F.struct(c("cloud_provider").alias("provider"), c("cloud_service").alias("service"))
        .alias("cloud"),
        F.struct(c("scan_module").alias("module")).alias("_shodan"),
        F.struct(c("http_status").alias("status"), c("http_title").alias("title"),
                 c("http_server").alias("server"), c("http_waf").alias("waf"),
                 parts.alias("components"),
                 F.when(c("has_securitytxt"), "Contact: x").otherwise("").alias("securitytxt"))
        .alias("http"),
        F.struct(c("ssl_versions").alias("versions"), F.struct(
            F.struct(c("ssl_issuer").alias("O")).alias("issuer"),
            F.struct(c("ssl_cert_cn").alias("CN")).alias("subject"),
            c("ssl_sig_alg").alias("sig_alg"), c("ssl_issued").alias("issued"),
            c("ssl_expires").alias("expires"), c("ssl_expired").alias("expired")).alias("cert"))
        .alias("ssl"),
        F.struct(F.concat(F.lit("2026/09/14 09:59:55 192.0.2.1:443 - "), "heartbleed")
                 .alias("heartbleed")).alias("opts"),
        *present)
    return flat.select(F.to_json(record).alias("value"))
