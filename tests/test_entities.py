import pytest
from pyspark.sql import functions as F

from estatelens import schemas
from estatelens.config import DEFAULTS, PARITY, Settings
from estatelens.operators import entities, lists, scoring, signals, staging
from estatelens.sources import providers
from tests.scans import scan

AS_OF = "2026-01-01"


def hosts(spark, rows):
    return entities.entity_hosts(staging.stage(scan(spark, rows), AS_OF))


def classify(spark, rows, settings=DEFAULTS):
    rollup = entities.entity_rollup(hosts(spark, rows))
    got = entities.classify_by_rule(rollup, providers.builtin(spark), settings).collect()
    return {r.entity_domain: r for r in got}


def test_staging_flags(spark):
    row = staging.stage(scan(spark, [{
        "ssl_versions": ["-TLSv1", "TLSv1.2"], "tags": ["eol-os", "self-signed", "c2"],
        "services": ["redis", "telnet", "vnc", "hikvision"], "ssl_sig_alg": "SHA1WithRSA",
        "ssl_expires": "2026-01-31 10:00:00", "http_waf": "x", "hostnames": ["srv12.h.net"]}]),
        AS_OF).first()
    assert not row.supports_deprecated_tls and not row.supports_dead_ssl
    assert row.runs_eol_software and row.self_signed_cert and row.is_malicious_infra
    assert (row.n_datastore_services, row.n_remote_access_services, row.n_exposed_cameras) == (1, 2, 1)
    assert row.weak_cert_signature and row.days_to_cert_expiry == 30 and row.has_waf
    assert row.sequential_hostname


@pytest.mark.parametrize("module,bad", [("remcos-pro-rat", True), ("rat-x", True),
                                        ("http-simple", False), ("a-Malware", True), (None, False)])
def test_malicious_modules(spark, module, bad):
    row = staging.stage(scan(spark, [{"scan_module": module}]), AS_OF).first()
    assert row.is_malicious_infra is bad


@pytest.mark.parametrize("versions,deprecated,dead", [
    (["TLSv1.1"], True, False), (["SSLv3"], False, True), ([], False, False), (None, False, False)])
def test_tls_tokens(spark, versions, deprecated, dead):
    row = staging.stage(scan(spark, [{"ssl_versions": versions}]), AS_OF).first()
    assert (row.supports_deprecated_tls, row.supports_dead_ssl) == (deprecated, dead)


def test_entity_key_and_exclusions(spark):
    got = hosts(spark, [
        {"primary_domain": "a.com", "ssl_cert_cn": "b.com"}, {"ssl_cert_cn": "*.c.com"},
        {"ssl_cert_cn": "10.0.0.1"}, {"primary_domain": "h.com", "tags": ["honeypot"]},
        {"primary_domain": "m.com", "tags": ["compromised"]}, {}]).collect()
    assert {(r.entity_domain, r.entity_source) for r in got} == {
        ("a.com", "hostname"), ("c.com", "certificate")}


def test_rollup_counts(spark):
    rows = [{"primary_domain": "a.com", "ip": "1", "asn": "x", "port": 1, "org": "B Inc"},
            {"primary_domain": "a.com", "ip": "1", "asn": "y", "port": 2, "org": "A Ltd"},
            {"primary_domain": "a.com", "hostnames": ["h1.a.com"], "port": 2, "tags": ["cdn"]}]
    r = entities.entity_rollup(hosts(spark, rows)).first()
    assert (r.n_services, r.n_ips, r.n_asns, r.n_ports, r.orgs_seen) == (3, 1, 2, 2, "a | b")
    assert r.cloud_host_ratio == pytest.approx(1 / 3)


def test_rules_in_order(spark):
    rows = [{"primary_domain": "64.in-addr.arpa"}, {"primary_domain": "x.com", "org": "Google LLC"},
            {"primary_domain": "flyio.net"}, {"primary_domain": "plain.com"}]
    rows += [{"primary_domain": "cloud.com", "ip": str(i), "tags": ["cloud"] if i else []}
             for i in range(50)]
    rows += [{"primary_domain": "seq.com", "ip": str(i), "hostnames": [f"srv{i}.x"]} for i in range(10)]
    rows += [{"primary_domain": "ports.com", "port": i} for i in range(20)]
    got = classify(spark, rows)
    assert {k: (v.rule_class, v.rule_evidence) for k, v in got.items()} == {
        "64.in-addr.arpa": ("infrastructure", "reverse_dns_zone"),
        "x.com": ("infrastructure", "seed_list"), "flyio.net": ("infrastructure", "seed_list"),
        "plain.com": ("unresolved", None),
        "cloud.com": ("likely_infrastructure", "cloud_tag_volume"),
        "seq.com": ("likely_infrastructure", "sequential_hostnames"),
        "ports.com": ("likely_infrastructure", "port_diversity")}


def test_provider_and_class_stay_together(spark):
    rows = [{"primary_domain": "x.com", "org": "GitHub"}, {"primary_domain": "x.com", "org": "OVH"}]
    fixed, parity = classify(spark, rows)["x.com"], classify(spark, rows, PARITY)["x.com"]
    assert (fixed.matched_provider, fixed.matched_provider_class) == ("GitHub", "other")
    assert (parity.matched_provider, parity.matched_provider_class) == ("GitHub", "hosting")
    alone = classify(spark, rows, Settings(match_orgs=False))["x.com"]
    assert alone.matched_provider is None


@pytest.mark.parametrize("settings", [DEFAULTS, PARITY, Settings(match_orgs=False)])
def test_long_provider_lists_match_the_same(spark, settings):
    orgs = ["google cloud", "at t corp", "jio", "", "fly io fly", "x aws y", "wi x", "nothing", "ov"]
    names = ["a.com", "att.net", "google.com", "flyio.dev", "orange", "w.com", "wix", "q", "z"]
    rollup = spark.createDataFrame(list(zip(names, orgs)), "entity_domain string, orgs_seen string")
    seed = providers.builtin(spark)
    loop = entities.seed_match(rollup, seed, settings).collect()
    grams = entities.seed_match_by_gram(rollup, seed, settings).collect()
    assert sorted(loop) == sorted(grams) and loop
    facets = spark.createDataFrame([(n, "org", o, 1, 1) for n, o in zip(names, orgs) if o],
                                   "entity_domain string, facet string, value string, n int, n_with_ip int")
    apart = entities.seed_match(rollup, seed, settings, names=entities.names_of(facets)).collect()
    assert sorted(apart) == sorted(loop)


def test_patterns_of_every_kind(spark):
    """Overlapping, nested, equal, empty and null patterns; a hundred thousand others."""
    rows = [("ab", "p1", "k1"), ("abc", "p2", "k2"), ("b c", "p3", "k3"), ("b c", "p4", None), (None, "p5", "k5"),
            ("é", "p6", "k6")] + [(f"zz{i}zz", "p7", "k7") for i in range(100_000)]
    seed = spark.createDataFrame(rows, "pattern string, provider string, provider_class string")
    texts = ["xabcx", "ab c", "abc", "bc", "é", "", "zz99999zz", "zz100000zz", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int")
    for compact in (False, True):
        got = sorted((r.i, r.provider, str(r.provider_class)) for r in entities._named(df, "t", seed, compact).collect())
        assert got == sorted({(i, p, str(k)) for i, t in enumerate(texts) for q, p, k in rows if t is not None
                              and q is not None and (q.replace(" ", "") if compact else q) in t})
    everything = spark.createDataFrame([("", "all", "k")], seed.schema)
    assert entities._named(df, "t", everything, False).count() == 8
    assert entities._named(df, "t", seed.limit(0), False).count() == 0


def test_lists_of_a_hot_entity_are_many_rows(spark):
    """One entity of a million names, others of few; chunks are full, in order and bounded."""
    facets = spark.range(1_000_000).selectExpr(
        "'hot.com' as entity_domain", "'org' as facet", "concat('name ', lpad(id, 7, '0')) as value",
        "1L as n", "1L as n_with_ip").unionAll(spark.createDataFrame(
            [("a.com", "org", v, 1, 1) for v in "cab"] + [("a.com", "waf", "w", 1, 1), ("a.com", "port", "80", 1, 1)],
            "entity_domain string, facet string, value string, n long, n_with_ip long"))
    chunked = lists.entity_lists(facets)
    assert "collect_list" not in chunked._jdf.queryExecution().executedPlan().toString()
    rows = chunked.orderBy("entity_domain", "facet", "chunk").collect()
    assert [(r.entity_domain, r.facet, r.chunk, r.n, r["values"]) for r in rows[:2]] == [
        ("a.com", "org", 0, 3, ["a", "b", "c"]), ("a.com", "waf", 0, 1, ["w"])]
    hot = rows[2:]
    assert [r.chunk for r in hot] == list(range(1000)) and {r.n for r in hot} == {1000}
    assert [v for r in hot for v in r["values"]] == [f"name {i:07d}" for i in range(1_000_000)]
    for items in (2, 1500):
        got = {r.entity_domain: r["values"] for r in lists.leading(chunked, "org", items).collect()}
        assert got == {"a.com": ["a", "b", "c"][:items], "hot.com": [f"name {i:07d}" for i in range(items)]}


def test_only_hot_entities_are_placed_in_a_global_order(spark, monkeypatch):
    placed = []
    monkeypatch.setattr(lists, "HOT_ROWS", 5, raising=False)
    monkeypatch.setattr(lists, "with_position", lambda df, *a, real=lists.with_position, **k: (
        placed.extend(r.entity_domain for r in df.collect()), real(df, *a, **k))[1])
    facets = spark.createDataFrame(
        [(e, "org", f"{e}{i}", 1, 1) for e, n in (("a", 4), ("b", 9), (None, 2)) for i in range(n)],
        "entity_domain string, facet string, value string, n long, n_with_ip long")
    got = {(r.entity_domain, r.chunk): r["values"] for r in lists.entity_lists(facets, size=3).collect()}
    assert got == {("a", 0): ["a0", "a1", "a2"], ("a", 1): ["a3"],
                   **{("b", k): [f"b{i}" for i in range(3 * k, 3 * k + 3)] for k in range(3)}}
    assert set(placed) == {"b"}


def test_hosts_are_dealt_with_values_alone(spark):
    """Neither the hostnames nor an address beside its value are shuffled to count facets."""
    found = hosts(spark, [
        {"primary_domain": "a.com", "ip": None, "hostnames": ["x.a.com", "y"], "port": 8},
        {"primary_domain": "a.com", "ip": "1", "hostnames": ["z"]}])
    facets = entities.entity_facets(found)
    assert {(r.value, r.n, r.n_with_ip) for r in facets.where("facet = 'host'").collect()} == {
        ("x.a.com", 1, 0), ("1", 1, 1)}
    assert {r.value for r in facets.where("facet = 'port'").collect()} == {"8", "80"}
    plan = facets._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.split("\n") if "RepartitionByExpression" in line]
    below = plan.split("\n")[plan.split("\n").index(dealt[0]):]
    assert any("Project" in line and "AS host" in line and "hostnames" in line for line in below)


def test_chunks_are_cut_without_python_values(spark):
    """Chunks that start and end anywhere in a batch, also over several batches."""
    import inspect
    assert "to_pylist" not in inspect.getsource(lists.entity_lists)
    per_batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    facets = spark.createDataFrame(
        [(e, f, f"{e}{i:02d}", 1, 1) for e, n in (("a", 1), ("b", 8), ("c", 3)) for f in ("org", "waf")
         for i in range(n)], "entity_domain string, facet string, value string, n long, n_with_ip long")
    want = [(e, f, k, min(3, n - 3 * k), [f"{e}{i:02d}" for i in range(3 * k, min(n, 3 * k + 3))])
            for e, n in (("a", 1), ("b", 8), ("c", 3)) for f in ("org", "waf") for k in range(-(-n // 3))]
    before = spark.conf.get(per_batch)
    try:
        for rows in ("1", "2", "5", "100"):
            spark.conf.set(per_batch, rows)
            got = sorted(tuple(r) for r in lists.entity_lists(facets, size=3).collect())
            assert got == want
    finally:
        spark.conf.set(per_batch, before)


def test_hot_entity_is_exact(spark):
    """A third of the rows in one entity: results equal a brute-force count."""
    rows = [{"primary_domain": "hot.com" if i % 3 == 0 else f"d{i % 50}.com", "ip": f"h{i % 700}",
             "port": i % 90, "product": f"p{i % 13}" if i % 2 else None,
             "country_code": "AB"[i % 2], "http_components": [f"t{i % 7}", f"t{i % 5}"]}
            for i in range(3000)]
    sig = signals.entity_signals(hosts(spark, rows))
    got = {r.entity_domain: r for r in sig.collect()}
    for name in ("hot.com", "d7.com"):
        mine = [r for r in rows if r["primary_domain"] == name]
        r = got[name]
        assert r.n_services == len(mine)
        assert r.n_hosts == len({m["ip"] for m in mine})
        assert r.n_ports == len({m["port"] for m in mine})
        assert r.products == sorted({m["product"] for m in mine if m["product"]})
        assert r.technologies == sorted({t for m in mine for t in m["http_components"]})


def test_ipv6_hosts_fall_back_to_the_hostname(spark):
    rows = [{"primary_domain": "a.com", "hostnames": ["h1"]}, {"primary_domain": "a.com", "hostnames": ["h1"]},
            {"primary_domain": "a.com", "hostnames": ["h2"]}, {"primary_domain": "a.com", "ip": "1"},
            {"primary_domain": "a.com"}]
    assert signals.entity_signals(hosts(spark, rows)).first().n_hosts == 3


def test_mode_breaks_ties_by_value(spark):
    rows = [{"primary_domain": "a.com", "country_code": c} for c in ("Z", "B", "B", "Z", None, None, None)]
    r = signals.entity_signals(hosts(spark, rows)).first()
    assert r.primary_country == "B" and r.countries == ["B", "Z"] and r.n_countries == 2


def test_headline_from_one_record(spark):
    base = {"primary_domain": "a.com"}
    rows = [{**base, "top_cve": "C1", "top_cve_epss": 0.9, "top_cve_cvss": 5.0},
            {**base, "top_cve": "C2", "top_cve_epss": 0.9, "top_cve_cvss": 9.0, "version": "2"},
            {**base, "product": "p", "version": "9"}]
    fixed = signals.headline(hosts(spark, rows)).first()
    assert (fixed.headline_cve, fixed.headline_cve_product, fixed.headline_cve_version) == (
        "C2", None, "2")
    parity = signals.headline(hosts(spark, rows), PARITY).first()
    assert (parity.headline_cve, parity.headline_cve_product, parity.headline_cve_version) == (
        "C2", "p", "2")


def test_expired_certificate_hides_a_soon_expiring_one(spark):
    rows = [{"primary_domain": "a.com", "ssl_expires": d} for d in ("2025-12-31", "2026-01-11")]
    assert signals.entity_signals(hosts(spark, rows)).first().soonest_cert_expiry_days == -1


SIGNALS = """entity_domain string, max_epss float, n_cves_critical bigint, n_exposed_datastores bigint,
 heartbleed_vulnerable int, n_remote_access bigint, n_eol_services bigint, n_expired_certs bigint,
 n_open_directories bigint, n_exposed_cameras bigint, n_dead_ssl bigint, n_deprecated_tls bigint,
 n_self_signed bigint, soonest_cert_expiry_days int, n_hosts bigint, n_products bigint,
 n_countries bigint, publishes_securitytxt int, n_hosts_with_waf bigint, waf_vendors array<string>,
 rule_class string"""


def scored(spark, settings=DEFAULTS, **values):
    names = schemas.names(SIGNALS)
    base = {n: 0 for n in names} | {"entity_domain": "a", "max_epss": None, "n_hosts": 1,
                                    "soonest_cert_expiry_days": None, "waf_vendors": [],
                                    "rule_class": "unresolved"}
    row = tuple({**base, **values}[n] for n in names)
    return scoring.score(spark.createDataFrame([row], SIGNALS), settings).first()


@pytest.mark.parametrize("epss,points", [(None, 0), (0.0, 0), (0.05, 10), (0.1, 25), (0.49, 25),
                                         (0.5, 40), (1.0, 40)])
def test_epss_points(spark, epss, points):
    assert scored(spark, max_epss=epss).pts_epss == points


@pytest.mark.parametrize("n,points", [(0, 15), (1, 5), (2, 25), (10, 25), (11, 40), (100, 40),
                                      (101, 30), (500, 30), (501, 15)])
def test_size_bands(spark, n, points):
    assert scored(spark, n_hosts=n).pts_size_band == points


@pytest.mark.parametrize("days,points", [(None, 0), (-1, 0), (0, 8), (30, 8), (31, 0)])
def test_expiring_certificate(spark, days, points):
    assert scored(spark, soonest_cert_expiry_days=days).pts_cert_expiring == points


def test_intent_is_capped_and_fit_is_not(spark):
    everything = dict(max_epss=1.0, n_cves_critical=1, n_exposed_datastores=1, heartbleed_vulnerable=1,
                      n_remote_access=1, n_eol_services=1, n_expired_certs=1, n_open_directories=1,
                      n_exposed_cameras=1, n_dead_ssl=1, n_deprecated_tls=1, n_self_signed=1,
                      soonest_cert_expiry_days=5, n_hosts=50, n_products=2, n_countries=2)
    row = scored(spark, **everything)
    assert (row.intent_score, row.fit_score, row.n_signal_categories) == (100, 90, 9)
    assert sum(row[p] for p in scoring.INTENT_POINTS) == 159


@pytest.mark.parametrize("vendors,fixed,parity", [
    (["Fortinet FortiWeb"], "security_vendor", "cdn_basic"), (["Cloudflare"], "cdn_basic", "cdn_basic"),
    (["%f5%"], "security_vendor", "security_vendor")])
def test_waf_posture_modes(spark, vendors, fixed, parity):
    assert scored(spark, n_hosts_with_waf=1, waf_vendors=vendors).waf_posture == fixed
    assert scored(spark, PARITY, n_hosts_with_waf=1, waf_vendors=vendors).waf_posture == parity


def test_retier_moves_only_the_quadrant(spark):
    df = spark.createDataFrame([("A - call now", 40, 70), ("B - nurture", 60, 10),
                                ("R - needs review", 90, 90), ("D - deprioritise", 45, 65)],
                               "tier string, fit_score int, intent_score int")
    got = [r.tier for r in scoring.retier(df, 50, 60).collect()]
    assert got == ["C - opportunistic", "B - nurture", "R - needs review", "C - opportunistic"]
    assert df.select(F.col("tier")).count() == 4


def test_tokens_are_found_without_sets(spark):
    """Null arrays, null elements, repeated elements and tokens; no set is built for a row."""
    from estatelens.functions.arrays import count_in, has_any
    values = [None, [], [None], ["a"], ["a", "a", None], ["x", "b", "a"], ["x"], ["ab", None]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<string>")
    out = df.select("i", has_any("v", "a", "b").alias("hit"), count_in("v", ("a", "b", "a")).alias("n"))
    assert [(r.hit, r.n) for r in out.orderBy("i").collect()] == [
        (False, None), (False, 0), (False, 0), (True, 1), (True, 1), (True, 2), (False, 0), (False, 0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "arrays_overlap" not in plan and "array_intersect" not in plan
    assert out.schema["n"].dataType.simpleString() == "int"


def test_scan_arrays_are_compiled(spark):
    """Elements of a view's array: nulls are left out, places and repeats kept, and no lambda runs."""
    from estatelens.plans.star_view import spark_array
    df = spark.createDataFrame([("a", None, "c"), (None, None, None), ("a", "a", ""), (None, "b", None)],
                               "x string, y string, z string")
    out = df.selectExpr(f"{spark_array(['x', 'y', 'z'])} as v", f"{spark_array([])} as e")
    assert sorted((r.v, r.e) for r in out.collect()) == [([], []), (["a", "a", ""], []), (["a", "c"], []), (["b"], [])]
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
