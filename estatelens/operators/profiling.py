"""Profiles of the scan table and inventories of raw JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from estatelens.functions.arrays import matching
from estatelens.session import written



def _hot() -> Column:
    return F.col("max_epss") > F.lit(0.1).cast("float")


def row_checks() -> dict[str, Column]:
    """Scalar checks that one pass over the table answers."""
    share = F.lit(100.0) * F.count("primary_domain") / F.count(F.lit(1))
    return {
        "total records": F.count(F.lit(1)),
        "primary_domain coverage": F.round(share, 2),
        "records with CVEs": matching(F.col("n_cves") > 0),
        "records with a critical CVE": matching(F.col("n_cves_critical") > 0),
        "records with a verified CVE": matching(F.col("n_cves_verified") > 0),
        "records with EPSS > 0.1": matching(_hot()),
        "records with product": F.count("product"),
        "expired certs": matching(F.col("ssl_expired")),
        "has security.txt": matching(F.col("has_securitytxt")),
        "records with a WAF": F.count("http_waf"),
        "heartbleed probed": F.count("heartbleed"),
        "SHA-1 certs": matching(F.lower("ssl_sig_alg").contains("sha1")),
    }


DISTINCT_CHECKS = ("distinct IPs", "distinct primary_domain", "distinct org", "distinct CVEs",
                   "domains with EPSS > 0.1", "domains with no WAF anywhere",
                   "extra domains from cert CN")


def profile_scalars(scan: DataFrame) -> DataFrame:
    """19 checks as (label, value).

    Distinct counts share one shuffle on (kind, value), so neither a frequent value nor a wide
    kind lands in one task.
    """
    checks = row_checks()
    flat = scan.agg(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(checks.values())])
    scalars = flat.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), F.col(f"c{i}").alias("value"))
        for i, label in enumerate(checks)])))

    def value(kind: str, col: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), col.alias("value"))

    only_cert = F.when(F.col("primary_domain").isNull(), F.col("ssl_cert_cn"))
    values = F.concat(
        F.array(value("ip", F.col("ip")), value("domain", F.col("primary_domain")),
                value("org", F.col("org")), value("cert", only_cert)),
        F.transform(F.coalesce("cves", F.array().cast("array<string>")),
                    lambda c: value("cve", c)))
    seen = (scan.select(_hot().cast("int").alias("hot"),
                        F.col("http_waf").isNotNull().cast("int").alias("waf"), F.inline(values))
            .filter("value is not null").groupBy("kind", "value")
            .agg(F.max("hot").alias("hot"), F.sum("waf").alias("waf")))
    kind = lambda name: F.col("kind") == name
    counts = dict(zip(DISTINCT_CHECKS, (
        kind("ip"), kind("domain"), kind("org"), kind("cve"),
        kind("domain") & (F.col("hot") == 1), kind("domain") & (F.col("waf") == 0),
        kind("cert"))))
    distinct = seen.agg(*[matching(c).cast("double").alias(f"d{i}")
                          for i, c in enumerate(counts.values())])
    return scalars.unionByName(distinct.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), F.col(f"d{i}").alias("value"))
        for i, label in enumerate(counts)]))))


# ------------------------------------------------------------- distinct counts across refreshes
SKETCH_LG = 16      # a sketch keeps up to 2 ** 16 hashes (512 KB): exact below, then 0.4 % error


def _sketched() -> dict[str, Column]:
    """What every sketch counts, nulls left out. The mark keeps empty strings, which sketches skip."""
    def text(col: Column | str) -> Column:
        return F.concat(F.lit("="), (F.col(col) if isinstance(col, str) else col).cast("string"))

    domain = text("primary_domain")
    return {"ip": text("ip"), "domain": domain, "org": text("org"),
            "hot domain": F.when(_hot(), domain),
            "waf domain": F.when(F.col("http_waf").isNotNull(), domain),
            "cert": F.when(F.col("primary_domain").isNull(), text("ssl_cert_cn"))}


def distinct_sketches(scan: DataFrame, *by: str, lg: int = SKETCH_LG) -> DataFrame:
    """(by, kind, sketch): one theta sketch per kind of value and group, as an addition to the exact
    counts of ``profile_scalars``. Sketches are filled before the shuffle, so what moves is one of
    bounded size per task, group and kind, however many values there are. Store them with a
    batch; ``merge_sketches`` of all batches is the sketch of their union, repeated values and
    batches included. An empty scan has empty sketches without ``by``, no rows with it."""
    kinds = _sketched()
    flat = scan.groupBy(*by).agg(*[F.theta_sketch_agg(c, lg).alias(f"s{i}")
                                   for i, c in enumerate(kinds.values())])
    cves = scan.select(*by, F.explode("cves").alias("cve")).groupBy(*by).agg(
        F.theta_sketch_agg(F.concat(F.lit("="), "cve"), lg).alias("sketch"))
    return flat.select(*by, F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"s{i}").alias("sketch"))
        for i, k in enumerate(kinds)]))).unionByName(cves.select(*by, F.lit("cve").alias("kind"), "sketch"))


def merge_sketches(sketches: DataFrame, *by: str, lg: int = SKETCH_LG) -> DataFrame:
    """(by, kind, sketch) of the union of everything that was sketched."""
    return sketches.groupBy(*by, "kind").agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def distinct_estimates(merged: DataFrame, lg: int = SKETCH_LG) -> DataFrame:
    """(label, estimate, error) of the distinct checks: exact where no sketch has overflowed, else
    ``error`` is one standard error. Domains without a WAF are a difference of two sketches, so
    their error is that of all domains."""
    kind = lambda name: F.max(F.when(F.col("kind") == name, F.col("sketch")))
    names = [*_sketched(), "cve"]
    row = merged.agg(*[kind(k).alias(k) for k in names])
    count = lambda sketch: F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("double")
    no_waf = F.theta_difference("domain", "waf domain")
    found = dict(zip(DISTINCT_CHECKS, (
        ("ip", "ip"), ("domain", "domain"), ("org", "org"), ("cve", "cve"),
        ("hot domain", "hot domain"), (no_waf, "domain"), ("cert", "cert"))))
    size = lambda base: F.when(count(base) > 2 ** lg, count(base) / (2 ** lg - 1) ** 0.5).otherwise(0.0)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("label"), count(what).alias("estimate"), size(base).alias("error"))
        for label, (what, base) in found.items()])))


def _malware_module() -> Column:
    module = F.lower("scan_module")
    return (module.contains("rat") | module.contains("malware") | module.contains("c2")
            | module.contains("botnet"))


# breakdown -> values of one record as an array
BREAKDOWNS = {
    "tags": lambda: F.col("tags"),
    "countries": lambda: F.array("country_name"),
    "org": lambda: F.array("org"),
    "services": lambda: F.col("services"),
    "ports": lambda: F.array(F.col("port").cast("string")),
    "waf vendors": lambda: F.array("http_waf"),
    "technologies": lambda: F.col("http_components"),
    "malware scan modules": lambda: F.array(F.when(_malware_module(), F.col("scan_module"))),
}
# How many values a published profile shows.
SHOWN = {"tags": 15, "countries": 12, "org": 15, "services": 12, "ports": 10, "waf vendors": 15,
         "technologies": 15, "malware scan modules": 15}


def profile_breakdowns(scan: DataFrame, sizes: dict[str, int] | None = SHOWN) -> DataFrame:
    """(breakdown, value, n): the most frequent values of eight fields, in one pass.

    ``sizes`` says how many per breakdown; None gives all. The rank filter is pushed below the
    shuffle, so only k rows per breakdown and task move.
    """
    def each(name: str):
        return lambda v: F.struct(F.lit(name).alias("breakdown"), v.alias("value"))

    pairs = [F.transform(F.coalesce(col(), F.array().cast("array<string>")), each(name))
             for name, col in BREAKDOWNS.items()]
    counted = (scan.select(F.inline(F.concat(*pairs))).filter("value is not null")
               .groupBy("breakdown", "value").agg(F.count(F.lit(1)).alias("n")))
    if sizes is None:
        return counted
    limit = F.lit(0)
    for name, k in sizes.items():
        limit = F.when(F.col("breakdown") == name, k).otherwise(limit)
    ranked = Window.partitionBy("breakdown").orderBy(F.desc("n"), "value")
    most = max(sizes.values(), default=0)
    return (counted.withColumn("rn", F.row_number().over(ranked)).filter(F.col("rn") <= most)
            .filter(F.col("rn") <= limit).drop("rn"))


# ---------------------------------------------------------------------------------- raw JSON
class PathCounts:
    """How many records fill each dotted path: a trie of keys with a count per node.

    A path string is made once per node, not once per record. Tries of different tasks, or of one
    task at different times, merge by adding the counts of equal paths.
    """

    def __init__(self, max_segments: int | None = None):
        self.most = None if max_segments is None else max_segments - 1
        self.clear()

    def clear(self) -> None:
        self.records, self.nodes = 0, 0
        self.root = self._node("")

    def _node(self, path: str) -> list:
        self.nodes += 1
        return [0, {}, self.most is not None and path.count(".") >= self.most, path]

    def add(self, record: object) -> None:
        self.records += 1
        self._walk(record, self.root)

    def _walk(self, value: object, node: list) -> None:
        if node[2]:                                     # the cut: it counts whatever it holds
            node[0] += 1
        elif isinstance(value, dict):
            children, path = node[1], node[3]
            for key, inner in value.items():
                child = children.get(key)
                if child is None:
                    child = children[key] = self._node(f"{path}.{key}" if path else key)
                self._walk(inner, child)
        elif value is not None and value != []:
            node[0] += 1

    def filled(self) -> Iterator[tuple[str | None, int]]:
        """(path, records); the records themselves under no path."""
        yield None, self.records
        todo = [self.root]
        while todo:
            count, children, _, path = todo.pop()
            if count:
                yield path, count
            todo += children.values()


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def path_inventory(lines: DataFrame, value: str = "value", max_segments: int | None = None,
                   max_nodes: int = 200_000) -> DataFrame:
    """(path, filled, rate): dotted paths with how many records fill them.

    Null, {} and [] do not fill a path and arrays are leaves. With ``max_segments`` a path is cut
    at so many segments, dots inside keys included; at the cut it counts whatever it holds.
    ``rate`` is per readable record: a line that is one whole JSON text.

    Every task counts paths in a trie and hands over one row per path; one that meets very many open
    keys hands its counts over at ``max_nodes`` and goes on, so its memory does not grow with them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PathCounts(max_segments)

        def taken() -> pa.RecordBatch:
            paths, filled = zip(*counts.filled())
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(filled, pa.int64())], ["path", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    continue
                try:
                    record = json.loads(text, parse_constant=_no_constant)
                except (ValueError, RecursionError):
                    continue
                counts.add(record)
                if counts.nodes > max_nodes:
                    yield taken()
        yield taken()

    counted = written(lines.select(F.col(value)).mapInArrow(run, "path string, n bigint")
                      .groupBy("path").agg(F.sum("n").alias("filled")), "paths")
    records = counted.where("path is null").first()
    total = records.filled if records else 0            # no partition, no row
    return counted.where("path is not null").select(
        "path", "filled", (F.lit(100.0) * F.col("filled") / F.lit(total)).alias("rate"))


def value_frequencies(lines: DataFrame, path: str, k: int | None = 25,
                      value: str = "value") -> DataFrame:
    """(value, n) at one dotted path, most frequent first; objects and arrays as JSON text."""
    steps = "$" + "".join(f"['{p}']" for p in path.split("."))
    at = F.try_variant_get(F.try_parse_json(value), steps, "string")
    counts = (lines.select(at.alias("value")).filter("value is not null")
              .groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    return counts.orderBy(F.desc("n"), "value").limit(k) if k else counts
