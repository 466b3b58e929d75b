"""Hosts to organisations, and the rule that separates infrastructure from the rest.

Shape of the aggregation, chosen for one entity that may own a third of all records:

* ``entity_measures`` holds only fixed-width aggregates, so it runs as a hash aggregate with a
  map-side combine; a hot entity leaves one small row per map task.
* ``entity_facets`` counts (entity, facet, value). Distinct counts, modes and lists all come from
  it. Hosts of ordinary entities are dealt by entity, one narrow row each, and become facet rows
  behind the shuffle; the facet rows of an entity lie together, so the next step combines them before
  it shuffles. For entities of more than ``HOT_ROWS`` rows the shuffle key includes the value, so a
  hot entity spreads over all tasks. No array of records is ever built.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from estatelens.config import DEFAULTS, RuleThresholds, Settings
from estatelens.functions.arrays import first, literals, matching

MAX_PATTERNS = 1_000_000
HOT_ROWS = 200_000          # rows from which on an entity is spread over tasks
TASK_ROWS = 250_000         # hosts that a task turns into facet rows, about


def entity_hosts(staged: DataFrame) -> DataFrame:
    """Attach the entity key; drop records without one, decoys and attacker infrastructure."""
    key = F.coalesce("primary_domain", "cert_domain")
    source = F.when(F.col("primary_domain").isNotNull(), "hostname").otherwise("certificate")
    return (staged.filter(key.isNotNull() & ~F.col("is_honeypot") & ~F.col("is_malicious_infra"))
            .withColumns({"entity_domain": key, "entity_source": source}))


# ------------------------------------------------------------------------------------- measures
def _flag_sum(flag: str) -> Column:
    return matching(F.col(flag))


def _any(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


MEASURES = {
    "n_services": lambda: F.count(F.lit(1)),
    # classification inputs
    "n_cloud": lambda: _flag_sum("is_cloud_or_cdn"),
    "n_sequential": lambda: _flag_sum("sequential_hostname"),
    "is_reverse_dns_zone": lambda: _any(F.col("is_reverse_dns_zone")),
    "has_hostname_anchor": lambda: _any(F.col("entity_source") == "hostname"),
    # findings
    "max_epss": lambda: F.max("max_epss"),
    "max_cvss": lambda: F.max("max_cvss"),
    "n_cves_critical": lambda: F.sum("n_cves_critical"),
    "n_cves_high": lambda: F.sum("n_cves_high"),
    "n_cves_verified": lambda: F.sum("n_cves_verified"),
    "n_cve_findings": lambda: F.sum("n_cves"),
    "n_eol_services": lambda: _flag_sum("runs_eol_software"),
    "n_deprecated_tls": lambda: _flag_sum("supports_deprecated_tls"),
    "n_dead_ssl": lambda: _flag_sum("supports_dead_ssl"),
    "n_weak_cert_sig": lambda: _flag_sum("weak_cert_signature"),
    "n_self_signed": lambda: _flag_sum("self_signed_cert"),
    "n_expired_certs": lambda: _flag_sum("ssl_expired"),
    "soonest_cert_expiry_days": lambda: F.min("days_to_cert_expiry"),
    "n_exposed_datastores": lambda: F.sum("n_datastore_services"),
    "n_remote_access": lambda: F.sum("n_remote_access_services"),
    "n_exposed_cameras": lambda: F.sum("n_exposed_cameras"),
    "n_open_directories": lambda: _flag_sum("open_directory"),
    "n_iot_devices": lambda: _flag_sum("iot_device"),
    "n_vpn_endpoints": lambda: _flag_sum("vpn_endpoint"),
    "heartbleed_vulnerable": lambda: _any(F.col("heartbleed") == "VULNERABLE"),
    "n_hosts_with_waf": lambda: F.count("http_waf"),
    "publishes_securitytxt": lambda: _any(F.col("has_securitytxt")),
    "headline_cve_epss": lambda: F.max("top_cve_epss"),
    "last_seen_at": lambda: F.max("scanned_at"),
}
# How two partial measure rows of one entity merge; everything not listed adds up.
MERGE_MAX = ("is_reverse_dns_zone", "has_hostname_anchor", "max_epss", "max_cvss",
             "heartbleed_vulnerable", "publishes_securitytxt", "headline_cve_epss", "last_seen_at")
MERGE_MIN = ("soonest_cert_expiry_days",)


def entity_measures(hosts: DataFrame, names=None) -> DataFrame:
    """Fixed-width aggregates per entity; ``names`` keeps the scan to the columns in use."""
    return hosts.groupBy("entity_domain").agg(
        *[MEASURES[name]().alias(name) for name in (names or MEASURES)])


CLASSIFICATION_MEASURES = ("n_services", "n_cloud", "n_sequential", "is_reverse_dns_zone",
                           "has_hostname_anchor")


# --------------------------------------------------------------------------------------- facets
# facet -> value as text. "host" falls back to the first hostname where there is no address.
FACETS = {
    "host": lambda: F.coalesce(F.col("ip"), first("hostnames")),
    "asn": lambda: F.col("asn"),
    "port": lambda: F.col("port"),
    "org": lambda: F.col("org_normalised"),
    "product": lambda: F.col("product"),
    "country_code": lambda: F.col("country_code"),
    "country_name": lambda: F.col("country_name"),
    "region_code": lambda: F.col("region_code"),
    "city": lambda: F.col("city"),
    "waf": lambda: F.col("http_waf"),
}
ARRAY_FACETS = {"technology": lambda: F.col("http_components")}
CLASSIFICATION_FACETS = ("host", "asn", "port", "org")
SIGNAL_FACETS = ("host", "port", "product", "country_code", "country_name", "region_code", "city",
                 "waf", "technology")


def entity_facets(hosts: DataFrame, names=None, rows: int | None = None) -> DataFrame:
    """(entity_domain, facet, value, n, n_with_ip): rows of each distinct value, with counts.

    Counts add up, so partial tables of separate scans merge by summing. Hosts are read three times,
    few columns each: give a stored table. ``rows``, if known, is the number of hosts, dealt to as many
    tasks as they need.
    """
    names = names or (*FACETS, *ARRAY_FACETS)
    plain = [name for name in names if name in FACETS]
    listed = [name for name in names if name in ARRAY_FACETS]
    if len(listed) > 1:
        raise ValueError("places tell one array facet only")
    # Rows are dealt with their values alone: of an address or the first hostname, one.
    narrow = hosts.select("entity_domain", F.col("ip").isNotNull().alias("has_ip"),
                          *[FACETS[name]().alias(name) for name in plain],
                          *[ARRAY_FACETS[name]().alias(name) for name in listed])
    values = F.array(*[F.col(name).cast("string") for name in plain]).cast("array<string>")
    for name in listed:
        values = F.concat(values, F.coalesce(F.col(name), F.array().cast("array<string>")))

    def counted(some: DataFrame) -> DataFrame:
        # A facet is its place among the names, the array facet last, until rows are counted.
        placed = some.select("entity_domain", F.col("has_ip").cast("int").alias("has_ip"),
                             F.posexplode(values).alias("place", "value"))
        facet = F.element_at(literals([*plain, *listed]), F.col("place") + 1).alias("facet")
        return (placed.filter("value is not null")
                .groupBy("entity_domain", F.least("place", F.lit(len(plain))).alias("place"), "value")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("has_ip").alias("n_with_ip"))
                .select("entity_domain", facet, "value", "n", "n_with_ip"))

    # At most one in HOT_ROWS of the rows.
    hot = F.broadcast(hosts.groupBy("entity_domain").agg(F.count(F.lit(1)).alias("n"))
                      .filter(F.col("n") > HOT_ROWS).select("entity_domain"))
    ordinary = narrow.join(hot, "entity_domain", "left_anti")
    # A number that is given stays: partitions put together by size would not fit a task's memory.
    tasks = max(-(-rows // TASK_ROWS), hosts.sparkSession.sparkContext.defaultParallelism) if rows else None
    return counted(narrow.join(hot, "entity_domain", "left_semi")).unionByName(
        counted(ordinary.repartition(*([tasks] if tasks else []), "entity_domain")))


def of_interest(facets: DataFrame, names) -> DataFrame:
    """Only these facets; the condition reaches the scan of a written facet table."""
    return facets.filter(F.col("facet").isin(*names))


def distinct_count(facet: str, extra: Column | None = None) -> Column:
    hit = F.col("facet") == facet
    return matching(hit if extra is None else hit & extra)


def sorted_values(facet: str) -> Column:
    """Every distinct value; facet rows are distinct already, so no set is rebuilt."""
    return F.array_sort(F.collect_list(F.when(F.col("facet") == facet, F.col("value"))))


def most_common(facet: str) -> Column:
    """The mode, smallest value on a tie."""
    key = F.struct((-F.col("n")).alias("n"), F.col("value"))
    return F.min(F.when(F.col("facet") == facet, key))["value"]


# ------------------------------------------------------------------------------- classification
def entity_rollup(hosts: DataFrame, measures: DataFrame | None = None,
                  facets: DataFrame | None = None) -> DataFrame:
    """One row per entity with everything the classification rules look at."""
    if measures is None:
        measures = entity_measures(hosts, CLASSIFICATION_MEASURES)
    if facets is None:
        facets = entity_facets(hosts, CLASSIFICATION_FACETS)
    distinct = of_interest(facets, CLASSIFICATION_FACETS).groupBy("entity_domain").agg(
        distinct_count("host", F.col("n_with_ip") > 0).alias("n_ips"),
        distinct_count("asn").alias("n_asns"),
        distinct_count("port").alias("n_ports"),
        F.array_join(sorted_values("org"), " | ").alias("orgs_seen"))
    zero = F.lit(0).cast("bigint")
    return (measures.join(distinct, "entity_domain", "left")
            .select("entity_domain", "n_services",
                    F.coalesce("n_ips", zero).alias("n_ips"),
                    F.coalesce("n_asns", zero).alias("n_asns"),
                    F.coalesce("n_ports", zero).alias("n_ports"),
                    F.coalesce("orgs_seen", F.lit("")).alias("orgs_seen"),
                    (F.col("n_cloud") / F.col("n_services")).alias("cloud_host_ratio"),
                    (F.col("n_sequential") / F.col("n_services")).alias("sequential_name_ratio"),
                    "is_reverse_dns_zone", "has_hostname_anchor"))


def _compact(pattern: Column) -> Column:
    return F.replace(pattern, F.lit(" "), F.lit(""))


def _names(rollup: DataFrame) -> DataFrame:
    """(entity_domain, name): normalised organisation names have no separator of their own."""
    return rollup.select("entity_domain", F.explode(F.split("orgs_seen", r" \| ")).alias("name"))


def names_of(facets: DataFrame) -> DataFrame:
    """The same from facet rows, where no entity's names are ever one value."""
    return of_interest(facets, ("org",)).select("entity_domain", F.col("value").alias("name"))


def _named(texts: DataFrame, text: str, providers: DataFrame, compact: bool) -> DataFrame:
    """``texts`` with provider and provider_class of every pattern they contain.

    The provider list is a reference table that does not grow with the data; its size is checked.
    All patterns are one automaton, built once per task, that reads each text once, however many
    patterns there are.
    """
    rows = providers.select("pattern", "provider", "provider_class").where(
        "pattern is not null").limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns: use seed_match_by_gram")
    known: dict[str, set] = {}
    for r in rows:
        pattern = r.pattern.replace(" ", "") if compact else r.pattern
        known.setdefault(pattern, set()).add((r.provider, r.provider_class))
    shared = texts.sparkSession.sparkContext.broadcast(known)
    names = [*texts.columns, "provider", "provider_class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for pattern, found in shared.value.items():
            if pattern:
                automaton.add_word(pattern, found)
        everywhere = shared.value.get("", set())
        if len(automaton):
            automaton.make_automaton()
        for batch in batches:
            at, hits = [], []
            for i, value in enumerate(batch.column(text).to_pylist()):
                if value is None:
                    continue
                found = set(everywhere)
                if len(automaton):
                    for _, of in automaton.iter(value):
                        found |= of
                at += [i] * len(found)
                hits += found
            provider, kind = zip(*hits) if hits else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(at, pa.int64())).columns, pa.array(provider, pa.string()),
                 pa.array(kind, pa.string())], names)

    return texts.mapInArrow(run, T.StructType([*texts.schema.fields, *[
        T.StructField(c, T.StringType()) for c in ("provider", "provider_class")]]))


def _grams(texts: DataFrame, text: str, providers: DataFrame, compact: bool) -> DataFrame:
    """The same for a list of any length: a text that contains a pattern contains its first g
    characters (g = the shortest pattern), so a join on grams finds it, and a test confirms it."""
    pattern = _compact(F.col("pattern")) if compact else F.col("pattern")
    keyed = providers.select(pattern.alias("pattern"), "provider", "provider_class")
    g = keyed.agg(F.min(F.length("pattern"))).first()[0] or 1
    own = F.when(F.length(text) >= g, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - g + 1), lambda i: F.substring(F.col(text), i, g))))
    return (texts.withColumn("_gram", F.explode(own))
            .join(keyed.withColumn("_gram", F.substring("pattern", 1, g)), "_gram")
            .where(F.col(text).contains(F.col("pattern")))
            .select(*texts.columns, "provider", "provider_class"))


def seed_match(rollup: DataFrame, providers: DataFrame, settings: Settings = DEFAULTS,
               find=_named, names: DataFrame | None = None) -> DataFrame:
    """Entities named in the provider list -> (matched_provider, matched_provider_class).

    Every domain and every distinct organisation name is tested once; names are joined back to
    their entities, so an organisation with very many names spreads over all tasks. ``names``
    (``names_of``) spares taking them out of the joined string again.
    """
    hits = find(rollup.select("entity_domain"), "entity_domain", providers, True)
    if settings.match_orgs:
        names = _names(rollup) if names is None else names
        found = find(names.select("name").distinct(), "name", providers, False)
        hits = hits.unionByName(names.join(found, "name").drop("name"))
    if settings.parity:
        matched = [F.min("provider").alias("matched_provider"),
                   F.min("provider_class").alias("matched_provider_class")]
        return hits.groupBy("entity_domain").agg(*matched)
    return (hits.groupBy("entity_domain")
            .agg(F.min(F.struct("provider", "provider_class")).alias("m"))
            .select("entity_domain", F.col("m.provider").alias("matched_provider"),
                    F.col("m.provider_class").alias("matched_provider_class")))


def seed_match_by_gram(rollup: DataFrame, providers: DataFrame,
                       settings: Settings = DEFAULTS) -> DataFrame:
    """``seed_match`` for a provider list too long to travel in a plan."""
    return seed_match(rollup, providers, settings, _grams)


def rule_cascade(rules: RuleThresholds) -> list[tuple[str, str, Column]]:
    """(evidence, class, condition) in order of precedence; first match wins."""
    n, ports = F.col("n_services"), F.col("n_ports")
    return [
        ("reverse_dns_zone", "infrastructure", F.col("is_reverse_dns_zone") == 1),
        ("seed_list", "infrastructure", F.col("matched_provider_class").isNotNull()),
        ("cloud_tag_volume", "likely_infrastructure",
         (F.col("cloud_host_ratio") >= rules.cloud_ratio) & (n >= rules.cloud_min_services)),
        ("sequential_hostnames", "likely_infrastructure",
         (F.col("sequential_name_ratio") >= rules.sequential_ratio)
         & (n >= rules.sequential_min_services)),
        ("port_diversity", "likely_infrastructure",
         (n >= rules.diversity_min_services) & (ports >= rules.diversity_min_ports)),
    ]


def first_match(cases: list[tuple[str, Column]], default: str | None) -> Column:
    chain = F.when(cases[0][1], cases[0][0])
    for value, condition in cases[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(F.lit(default))


def apply_rules(rollup: DataFrame, matched: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    cascade = rule_cascade(settings.rules)
    return rollup.join(matched, "entity_domain", "left").withColumns({
        "rule_class": first_match([(kind, cond) for _, kind, cond in cascade], "unresolved"),
        "rule_evidence": first_match([(name, cond) for name, _, cond in cascade], None),
    })


def classify_by_rule(rollup: DataFrame, providers: DataFrame, settings: Settings = DEFAULTS,
                     facets: DataFrame | None = None) -> DataFrame:
    names = None if facets is None else names_of(facets)
    return apply_rules(rollup, seed_match(rollup, providers, settings, names=names), settings)
