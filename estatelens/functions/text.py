"""String expressions: names, certificate anchors, rounding and phrases."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from estatelens.config import LEGAL_SUFFIXES
from estatelens.functions.arrays import ColumnLike, _c

WHITESPACE = " \t\n\r\x0b\x0c"
IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"


def null_if_empty(col: Column) -> Column:
    """``col`` is computed once; a condition beside its value would compute it twice."""
    return F.nullif(col, F.lit(""))


def stripped(col: ColumnLike) -> Column:
    """Without leading and trailing whitespace of any kind."""
    return F.trim(_c(col), F.lit(WHITESPACE))


def org_normalised(org: ColumnLike) -> Column:
    """Lower-case, punctuation to spaces, legal-form words dropped, trimmed; empty gives null."""
    plain = F.regexp_replace(F.lower(_c(org)), "[^a-z0-9 ]", " ")
    words = r"\b(" + "|".join(LEGAL_SUFFIXES) + r")\b"
    return null_if_empty(F.trim(F.regexp_replace(plain, words, " ")))


def cert_domain(common_name: ColumnLike) -> Column:
    """Certificate subject as an entity anchor: addresses are refused, ``*.`` is stripped."""
    cn = _c(common_name)
    return (F.when(cn.rlike(IPV4) | cn.contains(":"), F.lit(None).cast("string"))
             .when(cn.startswith("*."), F.substring(cn, 3, 1 << 30))
             .otherwise(cn))


def is_address(name: ColumnLike) -> Column:
    return _c(name).rlike(IPV4) | _c(name).contains(":")


def heartbleed_verdict(raw: ColumnLike) -> Column:
    """The text after the last `` - `` of a probe line."""
    return null_if_empty(stripped(F.substring_index(stripped(raw), " - ", -1)))


def sequential_name(hostname: Column) -> Column:
    return F.coalesce(hostname, F.lit("")).rlike(r"^[a-z-]*[0-9]{1,4}[.-]")


def reverse_dns_zone(domain: ColumnLike) -> Column:
    domain = _c(domain)
    hit = (domain.endswith(".in-addr.arpa") | domain.endswith(".ip6.arpa")
           | domain.isin("in-addr.arpa", "ip6.arpa"))
    return F.coalesce(hit, F.lit(False))


def timestamp_or_null(text: ColumnLike) -> Column:
    """Timestamp without zone; anything that does not start with a full date gives null."""
    text = _c(text)
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp_ntz"))


# --- exact decimal rounding -------------------------------------------------------------------
# Spark rounds the shortest decimal form of a double, half up. Published figures round the
# exact binary value, half to even: 0.125 -> 12%, not 13%. Splitting the value at float
# precision keeps both products exact, so the sign of the distance to the midpoint is exact too.

def rounded_units(value: ColumnLike, decimals: int) -> Column:
    """value * 10**decimals as BIGINT, rounded half to even on the exact binary value."""
    value = _c(value).cast("double")
    if decimals not in (0, 1, 2):
        raise ValueError("0 to 2 decimals")
    scale = float(10 ** decimals)
    high = value.cast("float").cast("double")
    low = value - high
    base = F.floor(value * scale)
    past_midpoint = (high * scale - (base.cast("double") + 0.5)) + low * scale
    up = (past_midpoint > 0) | ((past_midpoint == 0) & (base % 2 != 0))
    return base + F.when(up, 1).otherwise(0)


def fixed_point(value: ColumnLike, decimals: int) -> Column:
    """Text of a non-negative number with a fixed number of decimals."""
    units = rounded_units(value, decimals)
    if decimals == 0:
        return units.cast("string")
    scale = 10 ** decimals
    return F.concat(F.floor(units / scale).cast("string"), F.lit("."),
                    F.lpad((units % scale).cast("string"), decimals, "0"))


def rounded(value: ColumnLike, decimals: int) -> Column:
    return rounded_units(value, decimals) / float(10 ** decimals)


def count_phrase(n: ColumnLike, singular: str, plural: str | None = None) -> Column:
    """'1 host', '4 hosts'."""
    n = _c(n).cast("bigint")
    return F.concat(n.cast("string"), F.lit(" "),
                    F.when(n == 1, singular).otherwise(plural or singular + "s"))


def epss_phrase(probability: ColumnLike, precise: bool = False) -> Column:
    """Probability as a percentage that never reads as a certainty or as nothing."""
    p = _c(probability)
    percent = p.cast("double") * 100.0
    return (F.when(p >= F.lit(0.995).cast("float"), ">99%")
             .when(p < F.lit(0.01).cast("float"), "<1%")
             .otherwise(F.concat(fixed_point(percent, 1 if precise else 0), F.lit("%"))))


def template_value(col: ColumnLike, is_array: bool, max_items: int | None = None) -> Column:
    """A prompt slot: the non-empty items joined (on request only the first ``max_items``), or the
    value, or ``none``."""
    col = _c(col)
    if is_array:
        items = F.filter(col, lambda v: v.isNotNull() & (v != ""))
        items = items if max_items is None else F.slice(items, 1, max_items)
        return F.coalesce(null_if_empty(F.array_join(items, ", ")), F.lit("none"))
    return F.coalesce(col.cast("string"), F.lit("none"))


END = "<end>"


def one_record(line: ColumnLike, fields: T.StructType) -> Column:
    """Array of one item: the line's record, or null when the line is not one JSON object and
    nothing else. Explode it, so that a line is parsed once whoever reads the record.

    A parser stops at the end of the first value. Here the line is the first item of an array whose
    second holds the line's own digest, so all of the line has been read as one item when the
    digest is found there; a line cannot hold its own digest and close the array early.
    """
    line = _c(line)
    kind = T.ArrayType(T.StructType([*fields.fields, T.StructField(END, T.StringType())]))
    # Quotes and numbers as JSON has them.
    items = F.from_json(
        F.concat(F.lit("["), line, F.lit(f',{{"{END}":"'), F.sha2(line, 256), F.lit('"}]')), kind,
        {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})
    return F.transform(F.array(items), lambda i: F.when(
        (F.size(i) == 2) & (F.get(i, F.lit(1))[END] == F.sha2(line, 256)) & F.get(i, F.lit(0)).isNotNull(),
        F.struct(*[F.get(i, F.lit(0))[f.name].alias(f.name) for f in fields.fields])))
