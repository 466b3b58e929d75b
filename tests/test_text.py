import struct

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from estatelens.functions import text


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expr).collect()]


def test_org_normalised(spark):
    got = column(spark, ["Incapsula Inc.", "Aliyun Computing Co., LTD", "METEVERSE LIMITED", None,
                         "...", "A&B  GmbH", "Cobalt Corp"], "string", text.org_normalised("v"))
    assert got == ["incapsula", "aliyun computing", "meteverse", None, None, "a b", "cobalt"]


def test_org_normalised_reads_a_name_once(spark):
    names = spark.createDataFrame([("a",)], "v string").select(text.org_normalised("v").alias("o"))
    assert names._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") <= 2


def test_cert_domain(spark):
    got = column(spark, ["*.acme.com", "155.0.2.1", "2001:db8::1", "acme.com", None, "1.2.3.4.com"],
                 "string", text.cert_domain("v"))
    assert got == ["acme.com", None, None, "acme.com", None, "1.2.3.4.com"]


def test_heartbleed_verdict(spark):
    got = column(spark, ["2026/09/14 09:59:55 192.0.2.1:443 - VULNERABLE", "", None, "no separator",
                         "a - b - SAFE\n", "x - "], "string", text.heartbleed_verdict("v"))
    assert got == ["VULNERABLE", None, None, "no separator", "SAFE", "x -"]


def test_timestamps_need_a_full_date(spark):
    got = column(spark, ["2026-09-14T09:59:55.123", "2026-09-14", "2026", "20260101000000Z", "bad",
                         None], "string", text.timestamp_or_null("v").cast("string"))
    assert got == ["2026-09-14 09:59:55.123", "2026-09-14 00:00:00", None, None, None, None]


def test_sequential_and_reverse_names(spark):
    names = ["srv12.host.net", "vps-104.p.com", "www.acme.com", "ns1.acme.com", "node12345.x", None]
    assert column(spark, names, "string", text.sequential_name(F.col("v"))) == [
        True, True, False, True, False, False]
    zones = ["64.in-addr.arpa", "x.ip6.arpa", "in-addr.arpa", "xin-addr.arpa", None]
    assert column(spark, zones, "string", text.reverse_dns_zone("v")) == [
        True, True, True, False, False]


def test_count_phrase(spark):
    assert column(spark, [0, 1, 4], "int", text.count_phrase("v", "host")) == [
        "0 hosts", "1 host", "4 hosts"]


def test_epss_phrase_never_certain(spark):
    as_float = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    values = [as_float(x) for x in (0.0, 0.1, 0.125, 0.5, 0.99, 0.994, 0.996, 0.0099, 0.0149)]
    def expected(digits):
        return [">99%" if v >= as_float(0.995) else "<1%" if v < as_float(0.01)
                else f"{v:.{digits}%}" for v in values]
    assert column(spark, values, "float", text.epss_phrase("v")) == expected(0)
    assert column(spark, values, "float", text.epss_phrase("v", True)) == expected(1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(
    st.floats(0, 100), st.integers(0, 20000).map(lambda n: n / 200), st.integers(0, 9999).map(
        lambda n: n / 1000 + 0.0005)), min_size=200, max_size=400), st.sampled_from([0, 1, 2]))
def test_fixed_point_rounds_like_exact_decimals(spark, values, digits):
    got = column(spark, values, "double", text.fixed_point("v", digits))
    assert got == [f"{v:.{digits}f}" for v in values]
