import pytest

from estatelens.config import LABEL_WORDS
from estatelens.operators import evaluation, sampling
from estatelens.operators.verdicts import UnknownClass

# Published cross tables, batch:truth>prediction:count, with the counts per class
# (tp, fp, fn) published for all 75 rows and for the headline class of the held-out batch.
PUBLISHED = [
    ("1:company>company:4 1:company>unknown:2 1:government>government:2 1:hosting>company:1 "
     "1:hosting>hosting:9 1:hosting>unknown:1 1:isp>hosting:1 1:isp>isp:1 1:isp>unknown:3 "
     "1:security>security:1 2:company>company:6 2:company>hosting:1 2:company>isp:1 "
     "2:company>unknown:4 2:government>company:1 2:government>government:2 2:hosting>company:1 "
     "2:hosting>hosting:16 2:hosting>unknown:2 2:isp>company:4 2:isp>hosting:3 2:isp>isp:6 "
     "2:isp>unknown:1 2:unknown>unknown:2",
     {"company": (10, 7, 8), "hosting": (25, 5, 5), "security": (1, 0, 0), "isp": (7, 1, 12),
      "government": (4, 0, 1), "unknown": (2, 13, 0)}, 49, (6, 6, 6)),
    ("1:company>company:3 1:company>hosting:1 1:company>unknown:2 1:government>government:2 "
     "1:hosting>company:1 1:hosting>hosting:8 1:hosting>unknown:2 1:isp>hosting:1 1:isp>isp:1 "
     "1:isp>unknown:3 1:security>unknown:1 2:company>company:5 2:company>hosting:1 2:company>isp:1 "
     "2:company>unknown:5 2:government>company:1 2:government>government:2 2:hosting>company:2 "
     "2:hosting>hosting:16 2:hosting>unknown:1 2:isp>company:5 2:isp>isp:8 2:isp>unknown:1 "
     "2:unknown>unknown:2",
     {"company": (8, 9, 10), "hosting": (24, 3, 6), "security": (0, 0, 1), "isp": (9, 1, 10),
      "government": (4, 0, 1), "unknown": (2, 15, 0)}, 47, (5, 8, 7)),
    ("1:company>company:2 1:company>unknown:4 1:government>government:2 1:hosting>company:1 "
     "1:hosting>hosting:8 1:hosting>unknown:2 1:isp>company:1 1:isp>isp:2 1:isp>unknown:2 "
     "1:security>security:1 2:company>company:6 2:company>hosting:1 2:company>unknown:5 "
     "2:government>government:2 2:government>unknown:1 2:hosting>hosting:16 2:hosting>unknown:3 "
     "2:isp>company:3 2:isp>hosting:2 2:isp>isp:9 2:unknown>unknown:2",
     {"company": (8, 5, 10), "hosting": (24, 3, 6), "security": (1, 0, 0), "isp": (11, 0, 8),
      "government": (4, 0, 1), "unknown": (2, 17, 0)}, 50, (6, 3, 6)),
    ("1:company>company:5 1:company>unknown:1 1:government>government:2 1:hosting>company:1 "
     "1:hosting>hosting:8 1:hosting>unknown:2 1:isp>isp:3 1:isp>unknown:2 1:security>security:1 "
     "2:company>company:8 2:company>hosting:1 2:company>unknown:3 2:government>government:3 "
     "2:hosting>hosting:17 2:hosting>unknown:2 2:isp>company:3 2:isp>hosting:2 2:isp>isp:9 "
     "2:unknown>unknown:2",
     {"company": (13, 4, 5), "hosting": (25, 3, 5), "security": (1, 0, 0), "isp": (12, 0, 7),
      "government": (5, 0, 0), "unknown": (2, 10, 0)}, 58, (8, 3, 4)),
]


def pairs(spark, table):
    labels, found = [], []
    for cell in table.split():
        batch, flow, n = cell.split(":")
        truth, guess = flow.split(">")
        for _ in range(int(n)):
            name = f"e{len(labels)}"
            labels.append((name, LABEL_WORDS[truth], int(batch)))
            found.append((name, LABEL_WORDS[guess], 0.5, ""))
    return evaluation.pairs(
        spark.createDataFrame(labels, "entity_domain string, true_class string, batch int"),
        spark.createDataFrame(found, "entity_domain string, entity_class string, confidence double, "
                                     "reasoning string"))


@pytest.mark.parametrize("table,counts,correct,held_out", PUBLISHED)
def test_published_counts(spark, table, counts, correct, held_out):
    df = pairs(spark, table)
    rows = evaluation.confusion(df).collect()
    total = {r["class"]: (r.tp, r.fp, r.fn) for r in rows if r.batch is None}
    assert total == {LABEL_WORDS[k]: v for k, v in counts.items()}
    head = {r["class"]: r for r in rows if r.batch == 2}["end_customer_company"]
    assert (head.tp, head.fp, head.fn) == held_out
    acc = {r.batch: (r.n, r.accuracy) for r in evaluation.accuracy(df).collect()}
    assert acc[None] == (75, pytest.approx(correct / 75)) and acc[1][0] == 25 and acc[2][0] == 50


def test_zero_denominators_and_absent_classes(spark):
    df = pairs(spark, "1:company>isp:2 1:isp>isp:1")
    rows = {r["class"]: r for r in evaluation.confusion(df, by_batch=False).collect()}
    assert len(rows) == 6
    assert rows["end_customer_company"].precision is None and rows["end_customer_company"].recall == 0
    assert rows["end_customer_company"].f1 is None and rows["unknown"].support == 0
    assert rows["isp_telco"].precision == pytest.approx(1 / 3)


def test_failed_call_drops_only_its_own_row(spark):
    labels = spark.createDataFrame([("a", "isp_telco", 1), ("b", "unknown", 2)],
                                   "entity_domain string, true_class string, batch int")
    found = spark.createDataFrame([("b", "unknown", 0.5, "")], "entity_domain string, entity_class "
                                  "string, confidence double, reasoning string")
    got = evaluation.pairs(labels, found).collect()
    assert [(r.entity_domain, r.batch, r.correct) for r in got] == [("b", 2, True)]


def test_invalid_label_raises_and_blank_is_skipped(spark):
    schema = "entity_domain string, true_class string, batch int"
    ok = spark.createDataFrame([("a", "unknown", None), ("b", "", 1), ("c", None, 1)], schema)
    assert [(r.entity_domain, r.batch) for r in evaluation.labelled_only(ok).collect()] == [("a", 1)]
    with pytest.raises(UnknownClass):
        evaluation.labelled_only(spark.createDataFrame([("a", "shop", 1)], schema))


def test_baseline_selection(spark):
    df = spark.createDataFrame([("c", 0.5, "v1", "m", "t1"), ("c", 0.6, "v2", "m", "t2"),
                                ("c", 0.7, "v3", "m", "t3"), ("c", 0.4, "v1", "m", "t0")],
                               "class string, precision double, prompt_version string, model string, run_at string")
    assert evaluation.baseline_run(df, "v3", "m").first().precision == 0.6
    assert evaluation.baseline_run(df, "v3", "m", "v1:m").first().precision == 0.5
    assert evaluation.baseline_run(df, "v3", "m", "v7:m").count() == 0


def text(spark, *lines):
    return spark.createDataFrame(list(enumerate(lines)), "seq bigint, value string")


def test_worksheet(spark):
    df = text(spark, "# comment -> company", " 1. bond.style    -> company  # note # two",
              "      JP · 1 hosts", "no number -> isp", "9. x.y -> company", "12. x.y -> ISP",
              "nothing here")
    got = {r.entity_domain: (r.true_class, r.note) for r in evaluation.worksheet_labels(df).collect()}
    assert got == {"bond.style": ("end_customer_company", "note # two"), "x.y": ("isp_telco", "")}


@pytest.mark.parametrize("line,problem", [("1. a.b ->", "no label"),
                                          ("1. a.b -> bank", "unknown word bank")])
def test_worksheet_problems_stop_everything(spark, line, problem):
    sheet = text(spark, "2. ok.x -> isp", line)
    assert [r.problem for r in evaluation.parse_worksheet(sheet).collect()] == [None, problem]
    with pytest.raises(evaluation.LabelProblem, match="1 lines .* a.b"):
        evaluation.worksheet_labels(sheet)


def test_worksheet_needs_an_order(spark):
    with pytest.raises(evaluation.LabelProblem, match="seq"):
        evaluation.worksheet_labels(spark.createDataFrame([("1. a.b -> isp",)], "value string"))


def test_incomplete_sets_are_refused(spark):
    rows = spark.createDataFrame([("a", "isp_telco"), ("b", ""), ("c", None)],
                                 "entity_domain string, true_class string")
    with pytest.raises(evaluation.LabelProblem, match="2 rows"):
        evaluation.complete(rows)
    assert evaluation.complete(rows.where("entity_domain = 'a'")).count() == 1


def test_label_merge(spark):
    schema = "entity_domain string, true_class string, labeller_note string, batch int"
    existing = spark.createDataFrame([("a", "unknown", "old", 1), ("b", "isp_telco", "keep", 1)], schema)
    incoming = spark.createDataFrame([("a", "", "", 2), ("c", "", "", 2), ("d", "", "", 2)], schema)
    labels = spark.createDataFrame([("a", "isp_telco", ""), ("c", "unknown", "n")],
                                   "entity_domain string, true_class string, note string")
    merged = evaluation.merge_labels(existing, incoming, labels)
    got = {r.entity_domain: (r.true_class, r.labeller_note, r.batch) for r in merged.collect()}
    assert got == {"a": ("isp_telco", "old", 1), "b": ("isp_telco", "keep", 1),
                   "c": ("unknown", "n", 2), "d": ("", "", 2)}
    assert [r.entity_domain for r in evaluation.unlabelled(merged).collect()] == ["d"]
    assert evaluation.too_few_classes(merged.filter("true_class <> ''"))


def test_example_domains(spark):
    df = text(spark, "intro\n**`Acme.COM`** is\n**`b-c.io`** x\n see **`inline.com`**\n**`bad`**")
    assert sorted(r[0] for r in sampling.example_domains(df).collect()) == ["acme.com", "b-c.io"]


def pool(spark, sizes):
    rows = [(f"e{i}", "", "X", n, 1, 1, [], [], [], 0.0, ratio, None)
            for i, (n, ratio) in enumerate(sizes)]
    return spark.createDataFrame(rows, """entity_domain string, orgs_seen string, primary_country string,
      n_hosts bigint, n_ports bigint, n_products bigint, products array<string>,
      technologies array<string>, waf_vendors array<string>, cloud_host_ratio double,
      sequential_name_ratio double, rule_evidence string""")


def test_stratified_sample_tops_up_short_bands(spark):
    df = pool(spark, [(1, 0.0)] * 60 + [(5, 0.5)] * 4 + [(50, 0.0)] * 1)
    got = sampling.stratified(df, 25, "s").collect()
    assert len(got) == 25 == len({r.entity_domain for r in got})
    bands = [r.band for r in got]
    assert bands.count("single host") == 5 and bands.count("2-10 hosts") == 4
    assert bands.count("11-100 hosts") == 1 and bands.count("topped up") == 15
    again = sampling.stratified(df.repartition(7), 25, "s").collect()
    assert {r.entity_domain for r in got} == {r.entity_domain for r in again}


def test_stratified_sample_smaller_than_the_bands(spark):
    df = pool(spark, [(1, 0.0), (5, 0.0), (50, 0.0), (500, 0.0)])
    assert sampling.stratified(df, 3, "s").count() == 3
    assert sampling.stratified(df, 40, "s").count() == 4


def test_worksheet_rows_round_like_the_label_file(spark):
    df = pool(spark, [(1, 0.125), (1, 0.145), (1, 2 / 3)])
    got = [r.sequential_name_ratio for r in sampling.worksheet_rows(df, 2).collect()]
    assert got == [round(0.125, 2), round(0.145, 2), round(2 / 3, 2)]


def test_next_batch(spark):
    schema = "entity_domain string, batch int"
    assert sampling.next_batch(spark.createDataFrame([("a", None), ("b", 4)], schema)).first()[0] == 5
    assert sampling.next_batch(spark.createDataFrame([("a", None)], schema)).first()[0] == 2
    assert sampling.next_batch(spark.createDataFrame([], schema)).first()[0] == 1
