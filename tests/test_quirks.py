"""Hand-made inputs for the semantics that need care."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerspark.functions import exprs
from ledgerspark.model import COMPANY_FACTS, FILING_INDEX, SUBMISSIONS
from ledgerspark.operators import documents, extracted, flatten, quality, segments, views
from ledgerspark.plans import jobs
from ledgerspark.sources import readers
from ledgerspark.streaming import filings as streams


def entry(**k):
    from decimal import Decimal

    base = dict(start=None, end=None, instant=None, val=None, fy=None, fp=None, filed=None, segment=None) | k
    base["val"] = None if base["val"] is None else Decimal(base["val"])
    return Row(**base)


def company(spark):
    units = {
        "USD": [
            entry(fy="2024", val=1), entry(fy="0", end="2023-12-31", val=2), entry(end="20221231", val=3), entry(instant="CY2021Q1", val=4), entry(fy="2018", val=5), entry(fy="2019", val=6), entry(fy="2024"),
            entry(fy="2024", segment='[{"dimension": "A", "value": "x"}, {"dimension": "B", "value": "y"}]'), entry(fy="2024", val=7, segment='{"dimension": "A", "value": "z"}'),
        ],
        "EUR": [entry(fy="2024", val=9)],
    }
    return spark.createDataFrame([("1", "N", {"us-gaap": {"Revenues": Row(units=units)}})], COMPANY_FACTS)


def test_flatten_keeps_units_years_and_values(spark):
    rows = flatten.flatten_facts(company(spark), 2024, 5).collect()
    assert sorted((r.unit, r.period_year, int(r.value)) for r in rows) == [("EUR", 2024, 9), ("USD", 2019, 6), ("USD", 2021, 4), ("USD", 2022, 3), ("USD", 2023, 2), ("USD", 2024, 1), ("USD", 2024, 7)]


def test_segments_of_both_shapes_keep_null_values(spark):
    rows = flatten.flatten_segments(company(spark), 2024, 5).collect()
    assert sorted((r.dimension_axis, r.dimension_member, r.value) for r in rows if r.value is None) == [("A", "x", None), ("B", "y", None)]
    assert [(r.dimension_axis, r.dimension_member) for r in rows if r.value is not None] == [("A", "z")]


def test_filing_job(spark):
    out = jobs.filing_job(company(spark), 2024)
    assert {r.kind for r in out["discovered"].collect()} == {"product_segments"}
    assert out["scores"].first().axes == 2


def test_newest_filing_takes_the_first_of_equal_dates(spark):
    recent = Row(form=["10-Q", "10-Q", "10-K"], accessionNumber=["a", "b", "c"], filingDate=["2024-01-02", "2024-01-02", "2023-01-01"], reportDate=["x"] * 3, primaryDocument=["x"] * 3)
    f = flatten.flatten_filings(spark.createDataFrame([("7", "n", Row(recent=recent))], SUBMISSIONS))
    assert sorted((r.cik, r.form, r.accession) for r in flatten.newest_filing(f).collect()) == [("0000000007", "10-K", "c"), ("0000000007", "10-Q", "a")]


def test_index_sizes_and_instance_choice(spark):
    items = [Row(name="EX-1.htm", size="100"), Row(name="x_htm.xml", size="50"), Row(name="a_instance.xml", size=""), Row(name="x_Instance_htm.xml", size=""), Row(name="x_cal.xml", size="50")]
    i = flatten.index_items(spark.createDataFrame([("1", "acc", Row(item=items))], FILING_INDEX))
    r = flatten.filing_completeness(i).first()
    assert (r.structured_files, r.exhibit_files, r.captured_pct) == (4, 1, 50.0)
    assert [x.name for x in flatten.instance_documents(i).collect()] == ["x_Instance_htm.xml"]


XML = b"""<x xmlns:u="u"><context id="a"><entity><segment><explicitMember dimension="u:Ax">u:M1</explicitMember><explicitMember dimension="u:Bx">u:M2</explicitMember></segment></entity>
<period><startDate>2024-01-01</startDate><endDate>2024-03-31</endDate></period></context><context id="b"><period><instant>2024-03-31</instant></period></context>
<u:Rev contextRef="a">-5</u:Rev><u:Rev contextRef="b">1.5</u:Rev><u:T contextRef="b">1e6</u:T><u:T contextRef="b">1-2</u:T><u:Rev contextRef="nope">9</u:Rev></x>"""


def test_instances_from_files_and_archives(spark):
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a_cal.xml", "<x/>")
        f.writestr("a_htm.xml", XML)
    raw = flatten.flatten_instances(spark.createDataFrame([("f", XML), ("z", z.getvalue()), ("bad", b"<x>")], "path string, content binary"))
    rows = flatten.instance_facts(raw).where("filing = 'z'").collect()
    assert sorted((r.concept, None if r.value is None else float(r.value), r.segment_member, r.period_end) for r in rows if r.value is not None) == [("Rev", -5.0, "M1", dt.date(2024, 3, 31)), ("Rev", 1.5, None, dt.date(2024, 3, 31))]
    assert len(rows) == 4 and flatten.instance_segments(raw).where("filing = 'f'").count() == 2
    assert {(r.filing, r.total_facts, r.segment_dimensions) for r in flatten.instance_stats(raw).collect()} == {("f", 4, 2), ("z", 4, 2)}


def test_performance_status_and_compat(spark):
    s = spark.createDataFrame([("1", "A", "m", "c", dt.date(2024, q, 1), v) for q, v in ((3, 0.0), (6, -2.0), (9, 1.0))], "cik string, dimension_axis string, dimension_member string, concept string, period_end date, value double")
    status = lambda compat: {r.period_end.month: r.period_status for r in views.segment_performance(s, compat).collect()}
    assert status(False)[9] == "Latest" and status(True)[3] == "Latest"
    grown = {r.period_end.month: r.growth_pct for r in views.segment_growth(s).collect()}
    assert grown == {3: None, 6: None, 9: 150.0}


def test_numbers_of_cells(spark):
    cells = {"$1,234": 1234.0, "(5)": -5.0, "2B": 2000.0, "500K": 0.5, "x": None, "12%": 12.0, "": None}
    df = spark.createDataFrame([(k,) for k in cells], "c string").select("c", exprs.number(F.col("c")).alias("v"))
    assert {r.c: r.v for r in df.collect()} == cells
    years = spark.createDataFrame([(x,) for x in ("2024", "2024-12-31", "20241231", "CY2024Q1", "none")], "p string").select(exprs.period_year(F.col("p")).alias("y"))
    assert [r.y for r in years.collect()] == [2024, 2024, 2024, 2024, None]


PAGES = "doc_id string, page_num int, text string, tables array<array<array<string>>>, image_count int"


def test_document_mining(spark):
    table = [["Segment", "Q1 2025", "YoY"], ["Automotive revenue", "13,967", "5%"], ["Energy", "(2,730)", ""], ["Total", "19,335", ""]]
    pages = spark.createDataFrame([("d", 1, "Acme Motors Inc. reports Q1 2025 earnings. Revenue of $19.3 billion and net income of $409 million. Delivered 336,681 vehicles, 4.0 GWh.", [table, [["one row"]]], 1), ("d", 2, "F I N A N C I A L summary", None, 0)], PAGES)
    assert {(r.name, r.value_millions) for r in documents.text_metrics(pages).collect()} == {("revenue", 19300.0), ("net_income", 409.0)}
    assert {(r.segment, r.value) for r in documents.segment_rows(pages).collect()} == {("automotive_revenue", 13967.0), ("energy", -2730.0)}
    assert [(r.name, r.value, r.percent) for r in documents.table_metrics(pages, [("auto", "automotive")]).collect()] == [("auto", 13967.0, 5.0)]
    assert {(r.name, r.value) for r in documents.quantities(pages).collect()} == {("vehicles", 336681.0), ("gwh", 4.0)}
    r = jobs.analyze_documents(pages).first()
    assert r.company == "Acme Motors Inc." and r.period == "Q1 2025" and r.doc_type == "earnings" and r.visual_pages == [1] and r.business_model == "general"
    assert documents.classify_tables(pages).first().kind == "segment_financial_time_series"


def test_responses(spark):
    texts = ['```json\n{"revenue": {"total": "19335M"}, "list": [1, {"a": null, "b": true}]}\n```', 'Sure: {"margins": {"gross": 16.3}} ok', "revenue: $12.5", None]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(texts)], "doc_id string, page_num int, response string")
    got = {(r.path, r.value) for r in extracted.json_leaves(df).collect()}
    assert got == {("revenue.total", "19335M"), ("list[0]", "1"), ("list[1].b", "true"), ("margins.gross", "16.3")}
    assert {(r.target_path, r.value) for r in extracted.route_values(extracted.json_leaves(df)).collect()} >= {("revenue.total", 19335.0), ("margins", 16.3)}
    assert [(r.key, r.value) for r in extracted.fallback_values(df).collect()] == [("revenue", "12.5")]
    e = spark.createDataFrame([("1", '{"highlight": "h", "outlook": {"a": 1}, "trends": ["t1", "t2"]}', 5)], "cik string, insights string, health_score long")
    f = spark.createDataFrame([("1", "N")], "cik string, entity_name string")
    r = extracted.insights_view(e, f).first()
    assert (r.highlight, r.outlook, r.first_trend) == ("h", None, "t1")


def test_golden_report_sums_and_margin(spark):
    parents = spark.createDataFrame([("d", 19335.0), ("z", 0.0)], "doc_id string, value double")
    children = spark.createDataFrame([("d", v) for v in (13967.0, 2730.0, 2638.0)] + [("z", 1.0)], "doc_id string, value double")
    assert {r.doc_id: r.is_valid for r in quality.sum_to_parent(parents, children, ["doc_id"]).collect()} == {"d": True, "z": None}
    s = quality.overall_score(spark.createDataFrame([(0.9, None, 2)], "a double, b double, issues int"), ["a", "b"], "issues").first()
    assert abs(s.overall_score - 0.85) < 1e-9 and s.is_complete
    want = spark.createDataFrame([("d", "a"), ("d", "b")], "doc_id string, f string")
    r = quality.extraction_rate(want, want.where("f = 'a'"), ["doc_id", "f"], ["doc_id"]).first()
    assert (r.expected, r.extracted, r.rate) == (2, 1, 0.5)


def test_merge_fills_gaps(spark):
    a = spark.createDataFrame([("k1", 1.0), ("k2", None)], "k string, value double")
    b = spark.createDataFrame([("k1", 9.0), ("k2", 2.0), ("k3", 3.0)], "k string, value double")
    assert {(r.k, r.value, r.source) for r in segments.merge_sources(a, b, ["k"]).collect()} == {("k1", 1.0, "primary"), ("k2", 2.0, "secondary"), ("k3", 3.0, "secondary")}


def test_round_trip_through_files(spark, tmp_path):
    company(spark).write.json(str(tmp_path / "facts"))
    back = readers.read_company_facts(spark, str(tmp_path / "facts"))
    assert flatten.flatten_facts(back, 2024).count() == 7
    f = spark.createDataFrame([("1", "c", 1.0)], "cik string, concept string, value double")
    readers.write_facts(f, str(tmp_path / "t"))
    readers.write_facts(f, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1  # a replay adds nothing


def test_streams_agree_after_replay(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.xml").write_bytes(XML)
    (tmp_path / "in/skip.txt").write_bytes(b"no")
    for _ in range(2):  # the second run finds nothing new
        streams.stream_process_filings(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    (tmp_path / "in/b.xml").write_bytes(XML)
    streams.stream_process_filings(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/facts")).count() == 8


def test_request_stream_sends_once(spark, tmp_path):
    (tmp_path / "req").mkdir()
    recent = Row(form=["10-Q", "10-Q"], accessionNumber=["a", "b"], filingDate=["2024-01-02", "2024-02-02"], reportDate=["x"] * 2, primaryDocument=["x"] * 2)
    f = flatten.flatten_filings(spark.createDataFrame([("320193", "n", Row(recent=recent))], SUBMISSIONS))
    for k in range(2):
        (tmp_path / f"req/{k}.txt").write_text("{}")
        raw = spark.readStream.text(str(tmp_path / "req"))
        streams.stream_new_filings(raw, f, str(tmp_path / "sent"), str(tmp_path / "cp2")).awaitTermination()
    assert [r.accession for r in spark.read.parquet(str(tmp_path / "sent")).collect()] == ["b"]


def test_enrichment_stream(spark, tmp_path):
    m = spark.createDataFrame([("1", "2024-01-01", "Revenues=2023-12-31;Assets=2023-12-31", "A")], "cik string, filing_date string, sample_facts string, axes string")
    m.write.parquet(str(tmp_path / "m"))
    x = spark.createDataFrame([("1", "2024-01-01", "whole text", "mda", None, 1)], "cik string, filing_date string, full_text string, management_discussion string, risk_factors string, created_at long")
    streams.stream_enrichments(spark.readStream.schema(m.schema).parquet(str(tmp_path / "m")), x, str(tmp_path / "e"), str(tmp_path / "cp4")).awaitTermination()
    r = spark.read.parquet(str(tmp_path / "e")).first()
    assert (r.categories, r.text_length, r.health_score) == ("Assets,Revenue", 14, None)


def test_deep_json_and_wide_rows(spark):
    deep = '{"a":{"b":{"c":{"d":{"e":{"f":{"g":[[1]]}}}}}},"z":"}{[","y":"5%"}'
    df = spark.createDataFrame([("d", 1, deep), ("d", 2, "no {json"), ("d", 3, None)], "doc_id string, page_num int, response string")
    assert {(r.path, r.value, r.type) for r in extracted.json_leaves(df).collect()} == {("a.b.c.d.e.f.g[0][0]", "1", "other"), ("z", "}{[", "other"), ("y", "5%", "percentage")}
    rows = [["name", "x"], ["Total revenue"] + [""] * 150 + ["77"]] + [["filler", "1"]] * 1500 + [["Total revenue", "88"]]
    pages = spark.createDataFrame([("d", 1, "", [rows, [["h", "i"], ["Total revenue", "99"]]], 0)], "doc_id string, page_num int, text string, tables array<array<array<string>>>, image_count int")
    assert [(r.name, r.value) for r in documents.table_metrics(pages, [("r", "total revenue")]).collect()] == [("r", 99.0)]


def test_envelope_merged_and_metadata(spark, tmp_path):
    tables = [[["Energy", "Q1"], ["Storage deployed (GWh)", "4.5"]]]
    pages = spark.createDataFrame([("d", 1, "Acme Motors Inc. announces Q1 2025 earnings. Revenue of $12 million", tables, 0)], "doc_id string, page_num int, text string, tables array<array<array<string>>>, image_count int")
    responses = spark.createDataFrame([("d", 1, '{"segments": {"x": 3}}')], "doc_id string, page_num int, response string")
    r = jobs.document_envelopes(pages, responses, [("storage", "storage")]).first()
    assert r.analysis.period == "Q1 2025" and r.data["storage_deployed_gwh"] == 4.5 and r.data["revenue"] == 12.0 and r.validation.structure == 1.0
    (tmp_path / "m.json").write_text('{"metadata": {"cik": "7", "entityName": "N"}, "structured": {"facts": {"Assets": [{"value": 1.5, "unit": "USD", "period": "2024"}]}}}')
    assert tuple(readers.read_merged(spark, str(tmp_path / "m.json")).first()) == ("7", "N", "Assets", 1.5, "USD", "2024")
    f = spark.createDataFrame([("7", "a-1", "10-Q")], "cik string, accession string, form string")
    assert readers.write_filings_meta(f, str(tmp_path / "meta")).first().fetch_status == "pending_processing" and spark.read.parquet(str(tmp_path / "meta")).count() == 1


def test_json_of_great_depth_and_truncated_responses(spark):
    import time

    deep = '{"a":' * 500 + "[1.50, true, null]" + "}" * 500
    huge = '{"x": "' + "y" * 1_000_000 + '", "z": ' + "{" * 20_000
    rows = [("d", 1, deep), ("d", 2, huge), ("d", 3, "[" * 1_000_000), ("d", 4, "{" * 1_000_000), ("d", 5, 'said: {"k": {"n": 1e5, "n": 7}} ok'), ("d", 6, "```json\n[[{\"b\": \"v\"}]]\n```"), ("d", 7, "5"), ("d", 8, "")]
    began = time.time()
    got = {(r.page_num, r.path, r.key, r.value) for r in extracted.json_leaves(spark.createDataFrame(rows, "doc_id string, page_num int, response string")).collect()}
    path = ".".join(["a"] * 500)
    assert got == {(1, f"{path}[0]", "a", "1.50"), (1, f"{path}[1]", "a", "true"), (5, "k.n", "n", "7"), (6, "[0][0].b", "b", "v")} and time.time() - began < 10
