import datetime
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from estatelens.config import DEFAULTS, PARITY
from estatelens.functions.domains import SuffixRules
from estatelens.operators import audit, curated, findings, profiling, quality, scoring, signals
from estatelens.operators import entities as E, staging
from estatelens.operators.quality import Check, QualityError
from estatelens.plans import queries as Q
from estatelens.plans.layers import Layers
from estatelens.plans.star_view import raw_records
from estatelens.sources import providers
from estatelens.streaming import ingest as stream_ingest, refresh as stream_refresh
from tests.scans import scan

AS_OF = "2026-01-01"


def sample_rows(n=400):
    return [{"primary_domain": "hot.com" if i % 3 == 0 else f"d{i % 40}.com", "ip": f"h{i % 90}",
             "port": i % 30, "org": ["Google LLC", "Acme Inc", None][i % 3 if i % 40 == 1 else 1],
             "product": f"p{i % 4}" if i % 5 else None, "version": str(i % 3),
             "country_code": "ABC"[i % 3], "country_name": "Aa Bb Cc".split()[i % 3],
             "tags": ["eol-os"] if i % 7 == 0 else [], "services": ["redis"] if i % 11 == 0 else [],
             "max_epss": (i % 10) / 10 if i % 2 else None, "n_cves": i % 2,
             "top_cve": f"CVE-{i}" if i % 2 else None, "top_cve_epss": (i % 10) / 10 if i % 2 else None,
             "top_cve_cvss": float(i % 9) if i % 2 else None, "http_waf": "Imperva" if i % 50 == 0 else None,
             "http_components": [f"t{i % 6}"], "ssl_expires": f"2026-01-{1 + i % 28:02d}",
             "scanned_at": f"2026-01-{1 + i % 5:02d} 00:00:00"} for i in range(n)]


def batch_scores(spark, rows, settings=DEFAULTS, as_of=AS_OF):
    hosts = E.entity_hosts(staging.stage(scan(spark, rows), as_of))
    classes = E.classify_by_rule(E.entity_rollup(hosts), providers.builtin(spark), settings)
    return scoring.score(signals.company_signals(hosts, classes, settings=settings), settings)


def as_rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))


def test_layers_equal_one_lazy_plan(spark, tmp_path):
    rows = sample_rows()
    layers = Layers(spark, str(tmp_path))
    queued = layers.build(scan(spark, rows), providers.builtin(spark), AS_OF)
    assert as_rows(layers.read("scores")) == as_rows(batch_scores(spark, rows))
    assert queued.count() > 0 and all(r.status == "pass" for r in layers.reports)
    assert {r.table for r in layers.reports} >= {"staged", "hosts", "scores", "queue", "providers"}
    hosts = layers.write_hosts(scan(spark, rows), AS_OF)
    assert as_rows(E.entity_measures(hosts)) == as_rows(layers.read("measures"))


def test_rescoring_reads_only_signals(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.build(scan(spark, sample_rows()), providers.builtin(spark), AS_OF)
    scores = layers.rescore(DEFAULTS)
    assert all("/signals/" in f for f in scoring.score(layers.read("signals")).inputFiles())
    assert scores.count() > 0


def test_bad_row_stops_the_run(spark, tmp_path):
    rows = sample_rows(20) + [{"primary_domain": "192.0.2.7", "ip": "x"}]
    layers = Layers(spark, str(tmp_path))
    with pytest.raises(QualityError, match="entities_are_not_addresses: 1"):
        layers.build(scan(spark, rows), providers.builtin(spark), AS_OF)
    assert os.path.exists(tmp_path / "measures") and not os.path.exists(tmp_path / "classification")


def test_warning_threshold(spark):
    df = spark.createDataFrame([(None,), (1,), (None,)], "x int")
    is_null = F.col("x").isNull()
    checks = [Check("a", is_null, warn_above=0, error_above=5), Check("b", is_null),
              Check("c", is_null, error_above=2), quality.unique("x")]
    got = {r.check: (r.failed, r.status) for r in quality.report(df, "t", checks).collect()}
    assert got == {"a": (2, "warn"), "b": (2, "error"), "c": (2, "pass"), "unique_x": (0, "pass")}


RULES = SuffixRules.parse(["com"])


def ingest(spark, home, source=None, **options):
    source = source or stream_ingest.stream_source(spark, str(home / "in"))
    stream_ingest.ingest(source, str(home / "out"), str(home / "checkpoint"), RULES,
                         **options).awaitTermination()
    return sorted(r.org for r in stream_ingest.ingested(spark, str(home / "out")).collect())


def test_stream_ingest_resumes_without_loss_or_repeats(spark, tmp_path):
    os.mkdir(tmp_path / "in")
    (tmp_path / "in" / "1.json").write_text('{"org": "a", "timestamp": "2026-01-01"}\n{broken\n')
    assert ingest(spark, tmp_path) == ["a"]
    (tmp_path / "in" / "2.json").write_text('{"org": "b"}\n')
    assert ingest(spark, tmp_path) == ["a", "b"] and ingest(spark, tmp_path) == ["a", "b"]
    out = str(tmp_path / "out")
    assert [r.line for r in stream_ingest.quarantined(spark, out).collect()] == ["{broken"]
    assert sorted((r.batch_id, r.records, r.malformed)
                  for r in stream_ingest.totals(spark, out).collect()) == [(0, 2, 1), (1, 1, 0)]


@pytest.mark.parametrize("line", ['{"a":1} {"b":2}', '{"a":1}}', '{"a":1},{}', "{'a':1}",
                                  '{"port":1}x}', "[1]", "null", "{}],[{}", ""])
def test_near_misses_are_refused(spark, tmp_path, line):
    os.mkdir(tmp_path / "in")
    (tmp_path / "in" / "1.json").write_text(line + '\n {"org": "a"} \n')
    assert ingest(spark, tmp_path, by_date=False) == ["a"]
    assert [r.line for r in stream_ingest.quarantined(spark, str(tmp_path / "out")).collect()] == [line]


def test_replayed_batch_is_not_counted_twice(spark, tmp_path):
    """The last commit is lost, as when a run dies after its write: the batch runs again."""
    os.mkdir(tmp_path / "in")
    (tmp_path / "in" / "1.json").write_text('{"org": "a"}\n{"org": "b"}\n')
    for _ in range(2):
        assert ingest(spark, tmp_path) == ["a", "b"]
        for f in (tmp_path / "checkpoint" / "commits").iterdir():
            f.unlink()


def test_stream_of_zstd_files(spark, tmp_path):
    import zstandard
    os.mkdir(tmp_path / "in")
    (tmp_path / "in" / "a.json.zst").write_bytes(zstandard.compress(b'{"org": "a"}\n{"org": "b"}\n'))
    source = stream_ingest.stream_source(spark, str(tmp_path / "in"), compressed=True)
    assert ingest(spark, tmp_path, source) == ["a", "b"]


@pytest.mark.parametrize("settings", [DEFAULTS, PARITY])
def test_refresh_equals_full_run(spark, tmp_path, settings):
    """Four batches; scores on any later date equal a full run on it, also of entities that the
    last batches did not touch."""
    rows, state = sample_rows(), str(tmp_path / "state")
    seen = []
    for part in range(4):
        scan(spark, rows[part::4]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_refresh.refresh(
            stream_refresh.scan_stream(spark, str(tmp_path / "in")), state,
            str(tmp_path / "checkpoint"), providers.builtin(spark), settings, 4,
            lambda df, i: seen.append((i, df.count()))).awaitTermination()
    assert [i for i, _ in seen] == [0, 1, 2, 3]
    assert os.path.isdir(f"{state}/facets/batch_id=3/span=4")
    small = str(tmp_path / "compacted")
    stream_refresh.compact(spark, state, small, 4, settings)
    for days in (0, 10, 400):
        date = datetime.date.fromisoformat(str(AS_OF)) + datetime.timedelta(days)
        want = as_rows(batch_scores(spark, rows, settings, date))
        assert as_rows(stream_refresh.current_scores(spark, state, date, settings)) == want
        assert as_rows(stream_refresh.current_scores(spark, small, date, settings)) == want
    parts = {n: spark.read.parquet(f"{small}/{n}") for n in stream_refresh.PARTS}
    again = stream_refresh.signals_from(stream_refresh.merged(parts), providers.builtin(spark), settings)
    assert as_rows(stream_refresh.scored_at(again, AS_OF, settings)) == as_rows(
        batch_scores(spark, rows, settings))


def test_refresh_reads_touched_buckets_only(spark, tmp_path):
    state = str(tmp_path / "state")
    for i, rows in enumerate((sample_rows(), sample_rows(1))):
        scan(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_refresh.refresh(stream_refresh.scan_stream(spark, str(tmp_path / "in")), state,
                               str(tmp_path / "checkpoint"), providers.builtin(spark),
                               buckets=64).awaitTermination()
    touched = stream_refresh.touched_buckets(spark, state, 1)
    assert len(touched) < len(stream_refresh.touched_buckets(spark, state, 0))
    plan = stream_refresh.known_partials(spark, state, 1)["facets"]._jdf.queryExecution().toString()
    filters = [m for m in re.findall(r"PartitionFilters: [^\n]*", plan) if "bucket" in m]
    assert filters and all("span" in m for m in filters)


def test_known_facets_lie_by_entity(spark, monkeypatch):
    """Facet rows are shuffled by entity once, whether they have to be merged or are one set; those of
    hot entities are not."""
    monkeypatch.setattr(E, "HOT_ROWS", 100)
    hosts = E.entity_hosts(staging.stage(scan(spark, sample_rows()), AS_OF))
    parts = stream_refresh.partials(hosts)
    double = {name: df.unionAll(df) for name, df in parts.items()}
    want = as_rows(parts["facets"].withColumns({"n": F.col("n") * 2, "n_with_ip": F.col("n_with_ip") * 2}))
    assert as_rows(stream_refresh.merged(double)["facets"]) == want
    once = stream_refresh.merged(parts, one_set=True)
    assert all(as_rows(once[name]) == as_rows(df) for name, df in parts.items())
    hot, ordinary = stream_refresh.dealt(parts["facets"], parts["measures"])
    assert {r.entity_domain for r in hot.select("entity_domain").distinct().collect()} == {"hot.com"}
    homes = ordinary.select("entity_domain", F.spark_partition_id().alias("p")).distinct()
    assert homes.count() == ordinary.select("entity_domain").distinct().count() > 30


def test_a_state_is_few_sets_that_hold_each_batch_once():
    for batch in range(300):
        sets = stream_refresh.sets_up_to(batch)
        held = [b for last, span in sets for b in range(last - span + 1, last + 1)]
        assert sorted(held) == list(range(batch + 1)) and len(sets) <= (batch + 1).bit_length()
        assert all(stream_refresh.span_of(last) == span for last, span in sets)
    assert len(stream_refresh.sets_up_to(15)) == 1 and len(stream_refresh.sets_up_to(14)) == 4


# --------------------------------------------------------------------------- account table
def account(spark, **values):
    rows = [{"primary_domain": "a.com", "ip": "1", "country_name": "Peru"}]
    base = batch_scores(spark, rows).drop("tier")
    extra = {"company": "Acme", "entity_class": "end_customer_company", "class_confidence": 0.9, **values}
    kinds = dict(base.dtypes)
    return base.withColumns({k: F.lit(v).cast(kinds.get(k, "string")) if isinstance(v, str) or v is None
                             else F.lit(v) for k, v in extra.items()})


def verdict_rows(spark, *rows):
    return spark.createDataFrame(rows, "entity_domain string, prompt_version string, model string, "
                                 "entity_class string, canonical_name string, confidence double, reasoning string")


def test_final_tiers_and_privacy(spark, tmp_path):
    rows = [{"primary_domain": d, "ip": "1"} for d in "abcd"]
    scores = batch_scores(spark, rows)
    got = curated.curate(scores, verdict_rows(
        spark, ("a", "v", "m", "end_customer_company", None, 0.9, "r"),
        ("b", "v", "m", "hosting_or_cloud", "B", 0.9, "r"),
        ("c", "v", "m", "government_or_education", "C", 0.59, "r")))
    tiers = {r.entity_domain: (r.company, r.tier) for r in got.collect()}
    assert tiers == {"a": ("a", "D - deprioritise"), "b": ("B", "X - not a prospect"),
                     "c": ("C", "R - needs review")}
    with pytest.raises(ValueError, match="ip"):
        curated.write_curated(got.withColumn("ip", F.lit("1")), str(tmp_path / "x"))
    curated.write_curated(got, str(tmp_path / "ok"))
    assert curated.table_bytes(spark, str(tmp_path / "ok")) > 0
    curated.export_csv(curated.crm_columns(got), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns[:2] == ["Company", "Domain"]


def test_default_tiers(spark):
    df = spark.createDataFrame([("B - nurture",), ("X - not a prospect",)], "tier string")
    assert curated.default_tiers(df) == ["B - nurture"]
    more = df.union(spark.createDataFrame([("A - call now",)], "tier string"))
    assert curated.default_tiers(more) == ["A - call now"]


def test_findings_texts(spark):
    df = account(spark, n_exposed_datastores=1, n_expired_certs=2, soonest_cert_expiry_days=0,
                 max_epss=0.125, headline_cve="CVE-1", headline_cve_cvss=9.85)
    df = df.withColumns({"max_epss": F.col("max_epss").cast("float"),
                         "headline_cve_cvss": F.col("headline_cve_cvss").cast("float")})
    got = findings.findings_table(df).orderBy("position").collect()
    assert [(r.label, r.detail, r.severity) for r in got] == [
        ("Exposed database", "1 database reachable from the public internet", "critical"),
        ("Expired certificate", "2 hosts serving an expired cert", "high"),
        ("Certificate expiring", "In 0 days", "medium"),
        ("CVE-1", "12.5% chance of exploitation within 30 days — CVSS 9.9", "high")]
    assert got[3].phrase == ("software associated with CVE-1, which carries a 12% probability of "
                             "exploitation in the next 30 days")


def test_outreach_texts(spark):
    df = account(spark, n_exposed_datastores=3, n_open_directories=1)
    drafts = {(r.format, r.tone): r.draft for r in findings.outreach(df).collect()}
    assert drafts["Cold email", "Urgent / technical"] == (
        "Subject: Exposed database on a.com\n\nHi — we track internet-facing exposure across Peru.\n\n"
        "On Acme's public infrastructure we can currently see 3 databases reachable from the public "
        "internet, and directory listings exposed on 1 host. That's visible to anyone scanning, not "
        "just us.\n\nHappy to walk through the detail on a short call if useful.")
    call = drafts["Call script", "Consultative / executive"].split("\n")
    assert call[1:3] == ["", "REASON FOR THE CALL"] and call[-1].startswith('  · "Understood — we found')
    assert "  · Open directory listing: 1 host  [observed]" in call


def test_outreach_without_findings(spark):
    drafts = {r.format: r.draft for r in findings.outreach(account(spark)).collect()}
    assert drafts["Cold email"] == drafts["LinkedIn InMail"] == (
        "No specific finding to lead with for Acme. Use the call script format, which leads on fit instead.")
    assert "lead with the ICP fit (1 hosts, 1 open ports)" in drafts["Call script"]


def test_badges_by_severity_then_context(spark):
    df = findings.with_findings(account(spark, n_self_signed=1, n_open_directories=1, n_remote_access=1,
                                        n_countries=3, entity_class="government_or_education"))
    got = [(b.text, b.kind) for b in df.select(findings.badges().alias("b")).first().b]
    assert got == [("Remote access exposed", "critical"), ("Open directory listing", "high"),
                   ("Self-signed certificate", "medium"), ("Public sector", "context"),
                   ("No incumbent WAF", "context"), ("3 markets", "context")]


# --------------------------------------------------------------------- profiles and audits
def test_sketches_of_batches_merge_to_distinct_counts(spark):
    hosts = spark.range(6000).selectExpr(
        "cast(id % 4000 as string) ip", "if(id % 7 = 0, null, concat('d', id % 900)) primary_domain",
        "if(id % 5 = 0, '', concat('o', id % 50)) org", "cast(if(id % 11 = 0, 0.5, 0.0) as float) max_epss",
        "if(id % 900 < 300, 'w', null) http_waf", "concat('c', id % 40) ssl_cert_cn",
        "if(id % 3 = 0, null, array(concat('v', id % 25), null)) cves", "id % 4 batch")
    exact = {"distinct IPs": 4000, "distinct primary_domain": 900, "distinct org": 41, "distinct CVEs": 25,
             "domains with EPSS > 0.1": None, "domains with no WAF anywhere": 600,
             "extra domains from cert CN": 40}
    exact["domains with EPSS > 0.1"] = hosts.where("max_epss > 0.1").agg(
        F.count_distinct("primary_domain")).first()[0]
    exact["distinct org"] = hosts.agg(F.count_distinct("org")).first()[0]
    batches = profiling.distinct_sketches(hosts, "batch")
    again = batches.unionByName(batches.where("batch = 1"))             # a replayed batch counts once
    got = {r.label: (r.estimate, r.error)
           for r in profiling.distinct_estimates(profiling.merge_sketches(again)).collect()}
    assert got == {k: (v, 0.0) for k, v in exact.items()}
    small = profiling.distinct_estimates(profiling.merge_sketches(
        profiling.distinct_sketches(hosts, "batch", lg=8), lg=8), lg=8)
    for r in small.collect():
        assert abs(r.estimate - exact[r.label]) <= 5 * r.error + 1e-9
    none = profiling.distinct_estimates(profiling.merge_sketches(
        profiling.distinct_sketches(hosts.where("false"), "batch")))
    assert {(r.estimate, r.error) for r in none.collect()} == {(0.0, 0.0)}


def test_path_inventory(spark):
    df = spark.createDataFrame([(x,) for x in (
        '{"a": {"b": {"c": {"d": {"e": 1}}}}}', '{"a": {}, "b": [], "c": null, "d": [null]}',
        '{"a": {"b": {"c": {"d": null}}}}', '{"x.y": {"z": {"w": {"q": 1}}}}', "bad")], "value string")
    got = {r.path: (r.filled, r.rate) for r in profiling.path_inventory(df, max_segments=4).collect()}
    assert got == {"a.b.c.d": (2, 50.0), "d": (1, 25.0), "x.y.z.w": (1, 25.0)}
    got = {r.path: (r.filled, r.rate) for r in profiling.path_inventory(df).collect()}
    assert got == {"a.b.c.d.e": (1, 25.0), "d": (1, 25.0), "x.y.z.w.q": (1, 25.0)}


def json_paths(text, max_segments):
    """Paths that one record fills, written out record by record."""
    out = []

    def walk(node, path):
        if max_segments is not None and path.count(".") >= max_segments - 1:
            out.append(path)
        elif isinstance(node, dict):
            for key, value in node.items():
                walk(value, f"{path}.{key}" if path else key)
        elif node is not None and node != []:
            out.append(path)

    walk(json.loads(text), "")
    return out


@pytest.mark.parametrize("depth, nodes", [(None, 200_000), (1, 200_000), (2, 3), (3, 200_000), (None, 5)])
def test_path_inventory_counts_what_records_fill(spark, depth, nodes):
    texts = ['{"a.b":1,"c d":[null],"e":[],"f":{},"g":null,"x":1.25,"h`i":[{"q":null}],"z":"s, t: >"}',
             '{"k":{"l":{"m":[1,"a"],"n":[[]],"o":[{}],"p":{"q":{}}}}, "DECIMAL(3,1)": {"a": 2.5}}',
             '[]', '[1]', '5', 'null', '{"": {"": true}}', '{"a": 1, "a": {"b": 2}}', ' {"k": false} ']
    texts += [json.dumps({"open": {f"CVE-{i}": {"cvss": i}}, "k": i % 2 or None}) for i in range(60)]
    broken = ["bad", '{"a": 1} tail', '{"a": NaN}', "", None, "[" * 5000]
    df = spark.createDataFrame([(t,) for t in texts + broken], "value string").repartition(3)
    got = {r.path: (r.filled, r.rate) for r in profiling.path_inventory(df, "value", depth, nodes).collect()}
    want = [p for t in texts for p in json_paths(t, depth)]
    assert got == {p: (want.count(p), 100.0 * want.count(p) / len(texts)) for p in want}
    assert profiling.path_inventory(df.where("false")).collect() == []


def test_value_frequencies(spark):
    df = spark.createDataFrame([(x,) for x in (
        '{"a": {"b": 1}}', '{"a": {"b": {"c": 2}}}', '{"a": {"b": 1}}', '{"a": null}', '{"a": 3}')],
        "value string")
    got = [(r.value, r.n) for r in profiling.value_frequencies(df, "a.b").collect()]
    assert got == [("1", 2), ('{"c":2}', 1)]


def test_top_values_are_pruned_before_the_shuffle(spark):
    plan = profiling.profile_breakdowns(scan(spark, sample_rows(20)))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_group_queries_combine_before_the_shuffle(spark):
    hosts = E.entity_hosts(staging.stage(scan(spark, sample_rows(20)), AS_OF))
    plan = E.entity_measures(hosts)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_sum" in plan
    facets = E.entity_facets(hosts)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(entity_domain" in facets and "value" in facets.split("hashpartitioning(")[1][:80]


def test_funnel_and_tiles(spark):
    scores = batch_scores(spark, sample_rows())
    rows = {r.stage: r for r in audit.funnel(scan(spark, sample_rows()), scores).collect()}
    assert rows["records"].n == 400 and rows["entities"].n == scores.count()
    assert rows["unresolved"].removed == rows["entities"].n - rows["unresolved"].n
    tiles = audit.percentile_tiers(scores, tiles=4).groupBy("tile").count().orderBy("tile").collect()
    n = scores.count()
    assert [r["count"] for r in tiles] == [n // 4 + (i < n % 4) for i in range(4)]


def test_facets_of_ordinary_entities_travel_as_hosts_and_hot_ones_spread(spark, monkeypatch):
    rows = sample_rows() + [{"primary_domain": "hot.com", "ip": None, "hostnames": ["n"], "http_components": None}]
    hosts = E.entity_hosts(staging.stage(scan(spark, rows), AS_OF))
    plan = E.entity_facets(hosts)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(entity_domain#\d+, \d+\), REPARTITION_BY_COL", plan)
    want = as_rows(E.entity_facets(hosts))
    for limit in (0, 20, 10_000):
        monkeypatch.setattr(E, "HOT_ROWS", limit)
        found = E.entity_facets(hosts)
        assert as_rows(found) == want
        assert found.groupBy("entity_domain", "facet", "value").count().filter("count > 1").isEmpty()
    n = sum(r.get("http_components") == ["t0"] and r["primary_domain"] == "hot.com" for r in rows)
    assert str(sorted({"entity_domain": "hot.com", "facet": "technology", "value": "t0", "n": n,
                       "n_with_ip": n}.items())) in {
        str(sorted(r.asDict().items())) for r in E.entity_facets(hosts).collect()}


def test_refresh_reads_a_batch_once(spark, tmp_path):
    passes = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passes.add(len(batch))
            yield batch

    scan(spark, [{"primary_domain": f"d{i % 7}.com", "ip": f"h{i}"} for i in range(20)]).write.parquet(str(tmp_path / "in"))
    source = stream_refresh.scan_stream(spark, str(tmp_path / "in"))
    stream_refresh.refresh(source.mapInPandas(count, source.schema), str(tmp_path / "state"),
                           str(tmp_path / "checkpoint"), providers.builtin(spark), DEFAULTS, 2).awaitTermination()
    assert passes.value == 20


def test_ingest_query_keeps_raw_lines_compressed(spark, tmp_path):
    from estatelens.plans import queries
    lines = spark.createDataFrame([('{"port": 1}',), ("broken",)], "value string")
    queries._ingest(spark, None, str(tmp_path), lines)
    names = [f for f in os.listdir(tmp_path / "in") if f.startswith("part-")]
    assert names and all(f.endswith(".gz") for f in names)
    assert stream_ingest.ingested(spark, f"{tmp_path}/out").count() == 1
    assert [r.line for r in stream_ingest.quarantined(spark, f"{tmp_path}/out").collect()] == ["broken"]


def test_facets_are_dealt_to_a_fixed_number_of_tasks_and_compiled(spark):
    hosts = E.entity_hosts(staging.stage(scan(spark, sample_rows()), AS_OF))
    plan = E.entity_facets(hosts, rows=hosts.count())._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan         # partitions of a given number are not put together again
    assert "lambda" not in plan and "Generate posexplode" in plan


def test_scores_are_a_view_of_stored_signals(spark, monkeypatch):
    wrote = []
    monkeypatch.setattr(Q, "_TABLES", {})
    monkeypatch.setattr(Q, "_build", lambda spark, sf, name: spark.range(1))
    monkeypatch.setattr(Q, "written", lambda df, name: wrote.append(name) or df)
    for name in ("signals:fixed", "scores:fixed", "scores:parity"):
        Q.table(spark, "none", name)
    assert wrote == ["signals-fixed"]


def test_raw_records_are_compiled_and_keep_their_findings(spark, tmp_path):
    def put(name, ddl, *rows):
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")

    put("region", "r_regionkey int, r_name string", (0, "R"))
    put("nation", "n_nationkey int, n_name string, n_regionkey int", (0, "N", 0))
    put("supplier", "s_suppkey long, s_name string, s_nationkey int", (1, "S", 0))
    put("part", "p_partkey long, p_name string, p_brand string, p_type string", (6, "P", "B", "T"), (7, "P", "B", "T"))
    put("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string", (1, 2, None, "x"))
    put("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        (1, 6, 1, 1, 0.05, 0.02, "R", "F", None), (1, 7, 1, 1, 0.05, 0.02, "R", "F", None),
        (1, 6, 1, 1, None, 0.02, "R", "F", None), (1, 6, 1, 4, 0.05, 0.02, "R", "F", None))
    raw = raw_records(spark, str(tmp_path))
    found = sorted((list(r.get("vulns", {})), list(r["http"].get("components", {}))) for r in
                   (json.loads(line.value) for line in raw.collect()))
    assert found == [([], []), ([], ["B", "zt"]), (["CVE-6-b", "CVE-6"], ["B", "zt"]), (["CVE-7"], ["B", "zt"])]
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = raw._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "map_from_arrays(" in plan and "transform(" not in plan


def test_percentile_query_sorts_only_its_columns(spark, monkeypatch):
    given = []
    monkeypatch.setattr(Q, "scores", lambda spark, sf: spark.range(9).selectExpr(
        "cast(id as string) entity_domain", "cast(id as int) intent_score", "array('x') products"))
    placed = audit.percentile_tiers
    monkeypatch.setattr(audit, "percentile_tiers", lambda df: given.append(df.columns) or placed(df))
    tiles = {r.entity_domain: r.tile for r in Q.QUERIES["tier_percentile"](spark, "none").collect()}
    assert tiles == {"8": 1, "7": 1, "6": 1, "5": 2, "4": 2, "3": 3, "2": 3, "1": 4, "0": 4}
    assert given == [["entity_domain", "intent_score"]]


def test_tasks_do_not_grow_with_a_stored_layer(spark, tmp_path):
    """Many well compressed files: a task reads a few of them, whatever their rows."""
    path = str(tmp_path / "facets")
    spark.range(64).repartition(64).write.parquet(path)
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 10


def test_tasks_do_not_grow_with_few_shuffle_partitions(spark):
    """This session has four shuffle partitions; AQE starts from more and puts them together."""
    import re
    plan = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
    assert int(re.search(r"hashpartitioning\(.*?, (\d+)\)", plan)[1]) > 100
    assert spark.range(1000).repartition("id").rdd.getNumPartitions() <= 100


def test_checks_of_hosts_read_the_stored_hosts(spark, tmp_path, monkeypatch):
    """A grouped check that found something looks again: at the table, not at the scan's joins."""
    looked = []
    real = quality.report
    monkeypatch.setattr(quality, "report", lambda df, table, some: looked.append((table, df.inputFiles()))
                        or real(df, table, some))
    layers = Layers(spark, str(tmp_path / "l"))
    layers.enforce = False
    layers.write_hosts(scan(spark, [{"primary_domain": "192.0.2.9"}, {"primary_domain": "192.0.2.9"},
                                    {"primary_domain": "192.0.2.8", "tags": ["honeypot"]},
                                    {"primary_domain": "a.com"}]), AS_OF)
    assert [t for t, _ in looked] == ["hosts"]
    assert looked[0][1] and all(str(tmp_path / "l" / "hosts") in f for f in looked[0][1])
    assert {r.check: r.failed for r in layers.reports if r.table == "hosts"}["entities_are_not_addresses"] == 1
