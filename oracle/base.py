"""The pipeline layers as CTEs for a second SQL engine, written independently of the Spark code.

Only the input view (``star_view``) is shared text.
"""

from __future__ import annotations

from estatelens.plans.star_view import FROM, select_list
from estatelens.sources.providers import builtin_rows


def duck_array(items: list[str]) -> str:
    if not items:
        return "cast([] as varchar[])"
    return f"list_filter(cast([{', '.join(items)}] as varchar[]), lambda x: x is not null)"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LEGAL = "inc|llc|ltd|limited|corp|corporation|co|gmbh|sa|bv|pte|pty|plc|lp|ag|as|oy|ab"
VENDORS = ("fortinet|fortiweb|imperva|incapsula|akamai|kona|zscaler|sonicwall|citrix|netscaler|"
           "radware|sucuri|barracuda|f5")


def norm_org(col: str) -> str:
    return (f"nullif(trim(regexp_replace(regexp_replace(lower({col}), '[^a-z0-9 ]', ' ', 'g'), "
            f"'\\b({LEGAL})\\b', ' ', 'g')), '')")


def cert(col: str) -> str:
    return (f"case when regexp_full_match({col}, '[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}') "
            f"or position(':' in {col}) > 0 then null "
            f"else regexp_replace({col}, '^\\*\\.', '') end")


def tagged(*tags: str) -> str:
    return "list_has_any(tags, [" + ", ".join(map(quote, tags)) + "])"


def held(*names: str) -> str:
    inner = ", ".join(map(quote, names))
    return f"cast(len(list_filter([{inner}], lambda s: list_contains(services, s))) as integer)"


RAW = f"raw as (select {select_list(duck_array)} {FROM})"
STAGED = f"""staged as (
  select * exclude (scanned_at),
    try_cast(scanned_at as timestamp) as scanned_at,
    try_cast(ssl_issued as timestamp) as cert_issued_at,
    try_cast(ssl_expires as timestamp) as cert_expires_at,
    date_diff('day', date '1998-06-01', cast(try_cast(ssl_expires as timestamp) as date))
      as days_left,
    {cert('ssl_cert_cn')} as cert_domain,
    {norm_org('org')} as org_normalised,
    list_has_any(ssl_versions, ['TLSv1', 'TLSv1.1']) as old_tls,
    list_has_any(ssl_versions, ['SSLv2', 'SSLv3']) as dead_ssl,
    coalesce(ssl_sig_alg like '%sha1%', false) as weak_sig,
    {tagged('eol-product', 'eol-os')} as eol, {tagged('self-signed')} as self_signed,
    {tagged('database')} as db_tag, {tagged('open-dir')} as open_dir, {tagged('iot')} as iot,
    {tagged('vpn')} as vpn, {tagged('cloud', 'cdn')} as cloud,
    {tagged('honeypot')} as honeypot,
    (scan_module ilike '%-rat%' or scan_module ilike '%rat-%' or scan_module ilike '%malware%'
      or scan_module ilike '%botnet%' or {tagged('c2', 'compromised')}) as malicious,
    {held('telnet', 'vnc', 'rdp_encryption', 'ftp', 'smb')} as remote,
    {held('redis', 'mysql', 'mysqlx', 'mongodb', 'elastic', 'postgres', 'ldap')} as datastores,
    {held('hikvision', 'dahua_dvr_web')} as cameras,
    regexp_matches(coalesce(hostnames[1], ''), '^[a-z-]*[0-9]{{1,4}}[.-]') as sequential,
    coalesce(regexp_matches(primary_domain, '(^|\\.)(in-addr|ip6)\\.arpa$'), false) as reverse_zone
  from raw)"""
HOSTS = """hosts as (
  select coalesce(primary_domain, cert_domain) as entity_domain,
    if(primary_domain is null, 'certificate', 'hostname') as entity_source, *
  from staged
  where (primary_domain is not null or cert_domain is not null) and not honeypot
    and not malicious)"""
ROLLUP = """rollup_ as (
  select entity_domain, count(*) as n_services, count(distinct ip) as n_ips,
    count(distinct asn) as n_asns, count(distinct port) as n_ports,
    coalesce(string_agg(distinct org_normalised, ' | ' order by org_normalised), '') as orgs_seen,
    count(*) filter (where cloud) / count(*) as cloud_host_ratio,
    count(*) filter (where sequential) / count(*) as sequential_name_ratio,
    cast(bool_or(reverse_zone) as integer) as is_reverse_dns_zone,
    cast(bool_or(primary_domain is not null) as integer) as has_hostname_anchor
  from hosts group by entity_domain)"""
SEED = "seed(pattern, provider, provider_class) as (values " + ", ".join(
    f"({quote(a)}, {quote(b)}, {quote(c)})" for a, b, c in builtin_rows()) + ")"


def matched(mode: str = "fixed", orgs: bool = True, name: str = "matched") -> str:
    arm = "position(s.pattern in r.orgs_seen) > 0 or" if orgs else ""
    hits = f"""select r.entity_domain, s.provider, s.provider_class from rollup_ r, seed s
      where {arm} position(replace(s.pattern, ' ', '') in r.entity_domain) > 0"""
    if mode == "parity":
        return f"""{name} as (select entity_domain, min(provider) as matched_provider,
          min(provider_class) as matched_provider_class from ({hits}) group by 1)"""
    return f"""{name} as (select entity_domain, provider as matched_provider,
      provider_class as matched_provider_class from ({hits})
      qualify row_number() over (partition by entity_domain order by provider, provider_class) = 1)"""


def evidence(sequential: float = 0.8) -> str:
    return f"""case when is_reverse_dns_zone = 1 then 'reverse_dns_zone'
      when matched_provider_class is not null then 'seed_list'
      when cloud_host_ratio >= 0.9 and n_services >= 50 then 'cloud_tag_volume'
      when sequential_name_ratio >= {sequential} and n_services >= 10 then 'sequential_hostnames'
      when n_services >= 20 and n_ports >= 20 then 'port_diversity' end"""


def class_of(ev: str) -> str:
    return f"""case when {ev} is null then 'unresolved'
      when {ev} in ('reverse_dns_zone', 'seed_list') then 'infrastructure'
      else 'likely_infrastructure' end"""


CLASSIFIED = f"""ruled as (
  select r.*, m.matched_provider, m.matched_provider_class, {evidence()} as rule_evidence
  from rollup_ r left join matched m using (entity_domain)),
classification as (select *, {class_of('rule_evidence')} as rule_class from ruled)"""


def mode_of(col: str) -> str:
    return f"""(select entity_domain, {col} as v from hosts where {col} is not null
      group by entity_domain, {col}
      qualify row_number() over (partition by entity_domain order by count(*) desc, {col}) = 1)"""


def distinct_list(col: str) -> str:
    return (f"coalesce(list_sort(list(distinct {col}) filter (where {col} is not null)), "
            "cast([] as varchar[]))")


SUMS = """sums as (
  select entity_domain, count(*) as n_services,
    count(distinct coalesce(ip, hostnames[1])) as n_hosts, count(distinct port) as n_ports,
    count(distinct product) as n_products, count(distinct country_code) as n_countries,
    max(max_epss) as max_epss, max(max_cvss) as max_cvss,
    cast(sum(n_cves_critical) as bigint) as n_cves_critical,
    cast(sum(n_cves_high) as bigint) as n_cves_high,
    cast(sum(n_cves_verified) as bigint) as n_cves_verified,
    cast(sum(n_cves) as bigint) as n_cve_findings,
    count(*) filter (where eol) as n_eol_services, count(*) filter (where old_tls) as n_deprecated_tls,
    count(*) filter (where dead_ssl) as n_dead_ssl, count(*) filter (where weak_sig) as n_weak_cert_sig,
    count(*) filter (where self_signed) as n_self_signed,
    count(*) filter (where ssl_expired) as n_expired_certs,
    cast(min(days_left) as integer) as soonest_cert_expiry_days,
    cast(sum(datastores) as bigint) as n_exposed_datastores,
    cast(sum(remote) as bigint) as n_remote_access, cast(sum(cameras) as bigint) as n_exposed_cameras,
    count(*) filter (where open_dir) as n_open_directories,
    count(*) filter (where iot) as n_iot_devices, count(*) filter (where vpn) as n_vpn_endpoints,
    cast(count(*) filter (where heartbleed = 'VULNERABLE') > 0 as integer) as heartbleed_vulnerable,
    count(http_waf) as n_hosts_with_waf,
    cast(bool_or(has_securitytxt) as integer) as publishes_securitytxt,
    max(top_cve_epss) as headline_cve_epss, max(scanned_at) as last_seen_at,
    count(http_waf) = 0 as no_waf_anywhere
  from hosts group by entity_domain)"""
LISTS = f"""lists as (
  select entity_domain, {distinct_list('country_code')} as countries,
    {distinct_list('http_waf')} as waf_vendors, {distinct_list('product')} as products
  from hosts group by entity_domain),
techs as (
  select entity_domain, list_sort(list(distinct t)) as technologies
  from (select entity_domain, unnest(http_components) as t from hosts) group by entity_domain)"""
MODES = f"""modes as (
  select e.entity_domain, a.v as primary_country, b.v as primary_country_name,
    c.v as primary_region, d.v as primary_city
  from (select distinct entity_domain from hosts) e
  left join {mode_of('country_code')} a using (entity_domain)
  left join {mode_of('country_name')} b using (entity_domain)
  left join {mode_of('region_code')} c using (entity_domain)
  left join {mode_of('city')} d using (entity_domain))"""
HEAD_FIXED = """headline as (
  select entity_domain, top_cve as headline_cve, top_cve_cvss as headline_cve_cvss,
    top_cve_summary as headline_cve_summary, product as headline_cve_product,
    version as headline_cve_version
  from hosts where top_cve is not null
  qualify row_number() over (partition by entity_domain order by coalesce(top_cve_epss, 0) desc,
    coalesce(top_cve_cvss, 0) desc, top_cve desc, product desc nulls last,
    version desc nulls last, top_cve_summary desc nulls last, top_cve_cvss desc nulls last) = 1)"""


def _own_max(col: str) -> str:
    return f"""(select entity_domain, {col} as x from hosts where {col} is not null
      qualify row_number() over (partition by entity_domain
        order by coalesce(top_cve_epss, 0) desc, {col} desc) = 1)"""


HEAD_PARITY = f"""headline as (
  select e.entity_domain, a.x as headline_cve, b.x as headline_cve_cvss,
    c.x as headline_cve_summary, d.x as headline_cve_product, f.x as headline_cve_version
  from (select distinct entity_domain from hosts) e
  left join {_own_max('top_cve')} a using (entity_domain)
  left join {_own_max('top_cve_cvss')} b using (entity_domain)
  left join {_own_max('top_cve_summary')} c using (entity_domain)
  left join {_own_max('product')} d using (entity_domain)
  left join {_own_max('version')} f using (entity_domain))"""
SIGNALS = """signals as (
  select s.*, m.* exclude (entity_domain), l.* exclude (entity_domain),
    coalesce(t.technologies, cast([] as varchar[])) as technologies,
    h.* exclude (entity_domain), c.rule_class, c.rule_evidence, c.matched_provider,
    c.matched_provider_class, c.cloud_host_ratio, c.orgs_seen
  from sums s join modes m using (entity_domain) join lists l using (entity_domain)
  left join techs t using (entity_domain) left join headline h using (entity_domain)
  left join classification c using (entity_domain))"""


def flag(cond: str, pts: int) -> str:
    return f"if({cond}, {pts}, 0)"


INTENT = {
    "pts_epss": "if(max_epss >= 0.5, 40, if(max_epss >= 0.1, 25, if(max_epss > 0, 10, 0)))",
    "pts_critical_cve": flag("n_cves_critical > 0", 15),
    "pts_datastore": flag("n_exposed_datastores > 0", 20),
    "pts_heartbleed": flag("heartbleed_vulnerable = 1", 15),
    "pts_remote_access": flag("n_remote_access > 0", 12), "pts_eol": flag("n_eol_services > 0", 10),
    "pts_expired_cert": flag("n_expired_certs > 0", 10),
    "pts_open_dir": flag("n_open_directories > 0", 8),
    "pts_cameras": flag("n_exposed_cameras > 0", 8), "pts_dead_ssl": flag("n_dead_ssl > 0", 8),
    "pts_cert_expiring": flag("soonest_cert_expiry_days >= 0 and soonest_cert_expiry_days <= 30", 8),
    "pts_deprecated_tls": flag("n_deprecated_tls > 0", 5),
}
FIT = {
    "pts_size_band": """case when n_hosts = 1 then 5 when n_hosts >= 2 and n_hosts <= 10 then 25
      when n_hosts >= 11 and n_hosts <= 100 then 40 when n_hosts >= 101 and n_hosts <= 500 then 30
      else 15 end""",
    "pts_whitespace": "if(waf_posture = 'none', 25, if(waf_posture = 'cdn_basic', 12, 0))",
    "pts_real_estate": flag("n_products >= 2", 10), "pts_multi_country": flag("n_countries >= 2", 10),
    "pts_low_maturity": flag("publishes_securitytxt = 0", 5),
}
CATEGORIES = ("max_epss", "n_eol_services", "n_exposed_datastores", "n_remote_access",
              "n_expired_certs", "n_self_signed", "n_open_directories", "n_deprecated_tls",
              "n_exposed_cameras")


def scored(mode: str = "fixed") -> str:
    test = (f"len(list_filter(waf_vendors, lambda v: lower(v) similar to '%({VENDORS})%')) > 0"
            if mode == "parity" else
            f"regexp_matches(lower(array_to_string(waf_vendors, ' ')), '{VENDORS}')")
    points = ", ".join(f"{sql} as {name}" for name, sql in {**INTENT, **FIT}.items())
    cats = " + ".join(f"if({c} > 0, 1, 0)" for c in CATEGORIES)
    return f"""postured as (select *, case when n_hosts_with_waf = 0 then 'none'
      when {test} then 'security_vendor' else 'cdn_basic' end as waf_posture from signals),
    pointed as (select *, {points}, {cats} as n_signal_categories from postured),
    scores as (select *, cast(least(100, {' + '.join(INTENT)}) as integer) as intent_score,
      cast(least(100, {' + '.join(FIT)}) as integer) as fit_score,
      case rule_class when 'unresolved' then 'U - unclassified' else 'X - not a prospect' end
        as tier from pointed)"""


QUEUE = """queue as (
  select * from scores where rule_class = 'unresolved' and n_signal_categories > 0
    and n_hosts >= 1)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


AT_RAW = _with(RAW)
AT_STAGED = _with(RAW, STAGED)
AT_HOSTS = _with(RAW, STAGED, HOSTS)
AT_ROLLUP = _with(RAW, STAGED, HOSTS, ROLLUP, SEED)


def upto_classes(mode: str = "fixed") -> tuple[str, ...]:
    return RAW, STAGED, HOSTS, ROLLUP, SEED, matched(mode), CLASSIFIED


AT_CLASSES = _with(*upto_classes())


def at_signals(mode: str = "fixed") -> str:
    head = HEAD_PARITY if mode == "parity" else HEAD_FIXED
    return _with(*upto_classes(mode), SUMS, LISTS, MODES, head, SIGNALS)


def at_scores(mode: str = "fixed") -> str:
    head = HEAD_PARITY if mode == "parity" else HEAD_FIXED
    return _with(*upto_classes(mode), SUMS, LISTS, MODES, head, SIGNALS, scored(mode), QUEUE)
