"""Miners of pages against plain definitions, and their edge cases."""

from __future__ import annotations

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from ledgerspark.operators import documents, mining, reports
from ledgerspark.plans import jobs
from ledgerspark.sources import orderpages

PAGES = "doc_id string, page_num int, text string, tables array<array<array<string>>>, image_count int"
SF = "/root/testdata/sf0.001"


def test_phrases_overlap_and_repeat(spark):
    text = "aaaa GWh x" + "y" * 300 + "gwh"
    pages = spark.createDataFrame([("d", 1, text, None, 0), ("d", 2, None, None, 0), ("d", 3, "", None, 0), ("e", 1, "éé gwh İGWH", None, 0)], PAGES)
    got = sorted((r.doc_id, r.phrase, r.offset, r.context) for r in mining.phrase_contexts(pages, [("A", "aa"), ("G", "gwh")]).collect())
    want = [("d", "aa", i, text[: i + 200]) for i in range(3)] + [("d", "gwh", 5, text[:205]), ("d", "gwh", 310, text[260:])] + [("e", "gwh", 3, "éé gwh İGWH"), ("e", "gwh", 8, "éé gwh İGWH")]
    assert got == sorted(want)


def test_discovered_metrics_equal_the_definition(spark):
    pages = orderpages.pages(spark, SF)

    def classed(kind, c, hit):
        c = c.lower()
        if kind == "operational":
            if re.search("vehicle|car|auto|deliver", c):
                return "vehicle_deliveries" if "deliver" in c else "vehicle_production" if "produc" in c else "vehicle_metrics"
            return "user_metrics" if re.search("subscriber|user|member|account", c) else "sales_metrics" if re.search("store|location|sold|transaction", c) else "unit_metrics" if "unit" in hit.lower() else None
        if "revenue" in c:
            return "total_revenue" if "total" in c else "segment_revenue" if re.search("segment|product|service", c) else "revenue"
        if re.search("income|profit|earning", c):
            return "gross_profit" if "gross" in c else "operating_income" if "operating" in c else "net_income" if "net" in c else "income"
        return "margin" if "margin" in c else "costs" if re.search("cost|expense", c) else None

    want = {}
    for p in sorted(pages.collect(), key=lambda p: p.page_num):
        for kind, patterns in mining.FIGURES.items():
            for pattern in patterns:
                for m in re.finditer(pattern, p.text, re.IGNORECASE):
                    name = classed(kind, p.text[max(0, m.start() - 50) : m.end() + 50], m.group())
                    if name:
                        want.setdefault((p.doc_id, kind, name), (p.page_num, m.group()))
    got = {(r.doc_id, r.kind, r.name): (r.page_num, r.pattern) for r in mining.discovered_metrics(pages).collect()}
    assert got == want and len(want) > 500


def test_routing_reads_the_pages_once_and_takes_gaps(spark):
    table = [["Segment", "Q1"], ["China", "(5)"], ["Total", "9"], ["", "1"], ["Short"], [None, "2"]]
    rows = [("d", 1, "Segment information. Net income of $2 billion and profit of $0 million", [table, [["one row"]], []], 0), ("d", 2, "Key metrics", [[["a", "b"], ["Items sold: 1,200", ""], ["5 users", ""]]], 0), ("d", 3, None, None, 0), ("d", 4, "Financial results", [[["x", "y"], ["TOTAL net revenue", "7"]]], 0), ("d", 5, "none", [table], 0)]
    routed = mining.route_pages(spark.createDataFrame(rows, PAGES))
    got = sorted((r.page_num, r.miner, r.name, r.value) for r in routed.collect())
    assert got == [(1, "segment", "geographic.China", -5.0), (1, "text", "net_income", 2000.0), (2, "operational", "active_users", 5.0), (2, "operational", "units_delivered", 1200.0), (4, "financial", "revenue.total", 7.0)]
    plan = mining.route_pages(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id"), F.lit(1).alias("page_num"), "text", F.lit(None).cast("array<array<array<string>>>").alias("tables")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_similar_contexts_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"d{i % 5}", i, f"{'Total ' if i % 7 == 0 else ''}m{i}", " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(9)))) for i in range(200)]
    rows += [("hot", 1000 + i, "same", "one two three") for i in range(40)] + [("hot", 2000, "none", None), ("hot", 2001, "none", "")]
    d = spark.createDataFrame(rows, "doc_id string, metric int, name string, context string")
    sets = [(doc, m, set((c or "").lower().split())) for doc, m, _, c in rows]
    for t in (0.3, 0.5, 0.75):
        want = {(a[0], a[1], b[1]) for a in sets for b in sets if a[0] == b[0] and a[1] < b[1] and a[2] and b[2] and len(a[2] & b[2]) / len(a[2] | b[2]) > t}
        assert {(r.doc_id, r.a, r.b) for r in mining.similar_contexts(d, t).collect()} == want
    tree = {r.metric: r.children for r in mining.context_hierarchies(d).collect()}
    near = {(a, b) for doc, a, b in {(r.doc_id, r.a, r.b) for r in mining.similar_contexts(d).collect()}}
    names = {m: n for _, m, n, _ in rows}
    assert tree == {m: ",".join(sorted([names[b] for a, b in near if a == m] + [names[a] for a, b in near if b == m])) for m, n in names.items() if "Total" in n and any(m in p for p in near)}


def test_company_rules(spark):
    rows = [("t", 1, "x; word; " * 30 + "Acme Co. (NASDAQ: ACME)", None, 0), ("n", 1, None, None, 0), ("l", 1, "the big brand shop; of old", None, 0), ("p", 2, "of 3; by Borealis, and", None, 0), ("q", 12, "Zeta Inc.", None, 0), ("h", 1, "results of\nfor all\nGreat Lakes Trading\n(more)", None, 0)]
    got = {r.doc_id: (r.company, r.rule) for r in mining.company_names(spark.createDataFrame(rows, PAGES), names=["Brand"]).collect()}
    assert got["n"] == ("Unknown", None) and got["q"] == ("Unknown", None) and got["p"] == ("Borealis", "mentioned") and got["l"] == ("brand", "listed") and got["h"] == ("Great Lakes Trading", "heading")
    assert got["t"] == ("word; Acme Co."[6:], "formal")


def test_coverage_passes_and_fails(spark):
    whole = [n for ns in reports.REQUIRED.values() for n in ns]
    rows = [("all", n, 1.0) for n in whole] + [("most", n, 1.0) for n in whole if n != "total_revenue"] + [("zero", n, 0.0) for n in whole] + [("odd", "unknown", 3.0), ("odd", "europe", None)]
    got = {(r.doc_id, r.category): (r.found, r.passed, r.critical) for r in mining.coverage(spark.createDataFrame(rows, "doc_id string, name string, value double")).collect()}
    assert got["all", "overall"] == (19, True, "") and got["most", "overall"] == (18, False, "Revenue breakdown by segment") and got["zero", "overall"][:2] == (0, False) and got["odd", "overall"][0] == 0
    assert got["most", "financial_segments"][1] is False and got["most", "geographic_segments"][1] is True and len(got) == 4 * 6
    own = mining.coverage(spark.createDataFrame([("d", "a", 1.0), ("d", "b", 0.0)], "doc_id string, name string, value double"), {"x": ["a"], "y": ["a", "b"]}).collect()
    assert {(r.category, r.found, r.total, r.passed, r.missing) for r in own} == {("x", 1, 1, True, ""), ("y", 1, 2, False, "b"), ("overall", 2, 3, False, "b")}


def test_rules_that_fail(spark):
    m = spark.createDataFrame([("a", "total_revenue", 100.0), ("a", "gross_profit", 40.0), ("a", "gross_margin", 45.0), ("a", "operating_margin", 5.0), ("b", "total_revenue", 100.0), ("b", "cost_of_revenue", 60.0), ("b", "gross_margin", 40.0), ("b", "operating_margin", 5.0)], "doc_id string, name string, value double")
    days = lambda doc, *ms: [(doc, "s", dt.date(2024, x, 1)) for x in ms]
    series = spark.createDataFrame(days("a", 1, 4, 7) + days("b", 1, 10), "doc_id string, name string, period date")
    got = {r.doc_id: (r.errors, r.warnings, r.is_valid) for r in reports.run_rules(reports.rules(m, series), m, series).collect()}
    assert got == {"a": ("", "margin_calculation", True), "b": ("time_series_continuity", "", False)}


def test_headings_with_letters_apart(spark):
    rows = [("d", 2, "O P E R A T I O N A L   S U M M A R Y of", None, 0), ("d", 1, "Operational Summary", None, 0), ("d", 3, "O P E R A T I O N A L", None, 0), ("d", 4, None, None, 0), ("d", 5, "FSD and O U T L O O K", None, 0)]
    got = {r.data_type: r.pages for r in documents.heading_tags(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {"operational_metrics": [1, 2], "technology_metrics": [5], "guidance": [5]}


def test_gaps_are_filled_from_target_pages_only(spark):
    energy = [["Energy", "Q1"], ["Storage deployed (GWh)", "4.5"]]
    pages = spark.createDataFrame([("has", 1, "none", [energy], 0), ("lacks", 1, "none", None, 0)], PAGES)
    said = [(d, n, f'{{"margin": "{n}"}}') for d in ("has", "lacks") for n in (1, 8, 9, 25)] + [("other", 1, '{"income": 1}')]
    got = {(r.doc_id, r.name): (r.value, r.source) for r in jobs.fill_gaps(pages, spark.createDataFrame(said, "doc_id string, page_num int, response string")).collect()}
    assert got == {("has", "storage_deployed_gwh"): (4.5, "primary"), ("has", "margins"): (25.0, "secondary"), ("lacks", "margins"): (25.0, "secondary")}
    few = spark.createDataFrame([(d, n, r) for d, n, r in said if n in (8, 9)], "doc_id string, page_num int, response string")
    assert {(r.doc_id, r.name): r.value for r in jobs.fill_gaps(pages, few).where("name = 'margins'").collect()} == {("lacks", "margins"): 9.0}


def test_business_models(spark):
    rows = [("a", 1, "Delivered 5 units of each vehicle", None, 3), ("b", 1, "3 million and 40 users", None, 0), ("b", 2, None, [[["x", "Q2"], ["y", "1"]]], 1), ("c", 1, "each store has 12 customers", None, 0), ("d", 1, None, None, 0)]
    got = {r.doc_id: (r.business_model, r.has_operational_metrics, r.has_time_series, r.visual_pages, r.page_count) for r in jobs.analyze_documents(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {"a": ("automotive", True, False, [1], 1), "b": ("technology/saas", True, True, [2], 2), "c": ("general", True, False, [], 1), "d": ("general", False, False, [], 1)}
