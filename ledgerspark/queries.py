"""Registered queries and the SQL that DuckDB runs for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import dbl, html_text
from ledgerspark.llm.common import Scratch
from ledgerspark.model import COMPANY_FACTS
from ledgerspark.operators import documents, extracted, flatten, quality, segments, views
from ledgerspark.sources import testtables as t

AS_OF = "2001-12-31"
YEARS = list(range(1995, 2002))
KNOWN = [("statement_segments", "Assets"), ("statement_segments", "Goodwill")]
LEXICON = [("total_revenue", "total revenue"), ("operating_income", "operating income")]

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, run: Q, sql: str | None = None, *tables: str) -> None:
    QUERIES[name] = run
    if sql:
        ORACLES[name] = f"WITH {', '.join(x.strip() for x in tables)}{sql if sql.startswith(',') else ' ' + sql}" if tables else sql


def _facts(make: Callable[[DataFrame], DataFrame]) -> Q:
    return lambda s, d: make(t.facts(s, d))


def _segs(make: Callable[[DataFrame], DataFrame]) -> Q:
    return lambda s, d: make(t.segments(s, d))


V = "cast(value AS double) AS value"
NOW = f"period_end > cast(date '{AS_OF}' - INTERVAL 12 MONTH AS date) AND period_end <= date '{AS_OF}'"
BEFORE = f"period_end > cast(date '{AS_OF}' - INTERVAL 24 MONTH AS date) AND period_end <= cast(date '{AS_OF}' - INTERVAL 12 MONTH AS date)"
TOP = lambda c, n: f"cast(max(CASE WHEN concept = '{c}' THEN value END) AS double) AS {n}"

_add("company_summary", _facts(lambda f: views.company_summary(f, AS_OF)), f"""
, n AS (SELECT cik, entity_name, {TOP('Revenues', 'r')}, {TOP('NetIncomeLoss', 'i')}, {TOP('Assets', 'a')}, {TOP('StockholdersEquity', 'e')}, max(period_end) AS latest_period FROM facts WHERE {NOW} GROUP BY 1, 2),
b AS (SELECT cik, {TOP('Revenues', 'p')} FROM facts WHERE {BEFORE} GROUP BY 1)
SELECT n.cik, entity_name, r AS latest_revenue, i AS latest_net_income, a AS total_assets, latest_period, (r - p) / abs(nullif(p, 0)) * 100 AS revenue_growth_pct,
  i / nullif(r, 0) * 100 AS net_margin_pct, i / nullif(e, 0) * 100 AS roe_pct FROM n LEFT JOIN b ON n.cik = b.cik""".lstrip(), t.FACTS)  # fmt: skip
_add("latest_facts", _facts(views.latest_facts), f"SELECT cik, entity_name, concept, period_end, {V} FROM facts QUALIFY row_number() OVER (PARTITION BY cik, concept ORDER BY period_end DESC, filing_date DESC) = 1", t.FACTS)
SEG = "PARTITION BY cik, dimension_axis, dimension_member, concept ORDER BY period_end"
_add("segment_growth", _segs(views.segment_growth), f"""SELECT *, (value - previous_value) / abs(nullif(previous_value, 0)) * 100 AS growth_pct FROM (
SELECT cik, dimension_axis, dimension_member, concept, period_end, {V}, cast(lag(value) OVER ({SEG}) AS double) AS previous_value FROM segments)""", t.SEGMENTS)  # fmt: skip
_add("segment_performance", _segs(views.segment_performance), f"""SELECT *, (value - previous_value) / abs(nullif(previous_value, 0)) * 100 AS growth_pct FROM (
SELECT cik, dimension_axis, dimension_member, concept, period_end, {V}, cast(lag(value) OVER ({SEG}) AS double) AS previous_value, cast(lead(value) OVER ({SEG}) AS double) AS next_value,
CASE WHEN lead(period_end) OVER ({SEG}) IS NULL THEN 'Latest' ELSE 'Historical' END AS period_status FROM segments)""", t.SEGMENTS)  # fmt: skip
_add("peer_comparison", _facts(lambda f: views.peer_comparison(f, AS_OF)), f"""
, o AS (SELECT cik, entity_name, {TOP('Revenues', 'revenue')}, {TOP('NetIncomeLoss', 'net_income')}, {TOP('Assets', 'total_assets')}, max(period_end) AS latest_period FROM facts WHERE period_end >= cast(date '{AS_OF}' - INTERVAL 3 MONTH AS date) GROUP BY 1, 2),
k AS (SELECT *, rank() OVER (ORDER BY revenue DESC NULLS LAST) AS revenue_rank, rank() OVER (ORDER BY net_income DESC NULLS LAST) AS profitability_rank, rank() OVER (ORDER BY total_assets DESC NULLS LAST) AS size_rank FROM o)
SELECT *, net_income / nullif(revenue, 0) * 100 AS net_margin_pct, revenue / nullif(total_assets, 0) AS asset_turnover,
CASE WHEN revenue_rank <= 3 THEN 'Top 3' WHEN revenue_rank <= 10 THEN 'Top 10' ELSE 'Other' END AS revenue_tier FROM k""".lstrip(), t.FACTS)  # fmt: skip
_add("time_series", _facts(lambda f: views.time_series(f, AS_OF)), f"""SELECT cik, entity_name, concept, period_end, year(period_end) AS year, quarter(period_end) AS quarter, {V}, row_number() OVER (PARTITION BY cik, concept ORDER BY period_end) AS sequence
FROM facts WHERE period_end > cast(date '{AS_OF}' - INTERVAL 60 MONTH AS date) AND period_end <= date '{AS_OF}'""", t.FACTS)  # fmt: skip
MODEL = f"""m AS (SELECT cik, entity_name, period_end, {TOP('Revenues', 'revenue')}, {TOP('OperatingIncomeLoss', 'operating_income')}, {TOP('NetIncomeLoss', 'net_income')}, {TOP('EarningsPerShareBasic', 'eps')} FROM facts GROUP BY 1, 2, 3),
model AS (SELECT *, CASE WHEN revenue > 0 THEN operating_income / revenue * 100 END AS operating_margin_pct,
(revenue - lag(revenue) OVER w) / abs(nullif(lag(revenue) OVER w, 0)) * 100 AS revenue_growth_pct FROM m WINDOW w AS (PARTITION BY cik ORDER BY period_end))"""
_add("financial_model", _facts(views.financial_model), "SELECT * FROM model", t.FACTS, MODEL)
_add("segment_pivot", _segs(lambda s: views.segment_pivot(s, YEARS)), f"""SELECT dimension_axis, dimension_member, {', '.join(f"cast(sum(CASE WHEN year(period_end) = {y} THEN value END) AS double) AS y{y}" for y in YEARS)}
FROM segments WHERE concept = 'Revenues' GROUP BY 1, 2""", t.SEGMENTS)  # fmt: skip
_add("segment_listing", _segs(lambda s: views.segment_listing(s, AS_OF)), f"SELECT cik, dimension_axis, dimension_member, period_end, {V} FROM segments WHERE concept = 'Revenues' AND {NOW}", t.SEGMENTS)
_add("fact_counts", lambda s, d: views.fact_counts(t.facts(s, d), t.segments(s, d)), """SELECT f.cik, total_facts, unique_concepts, coalesce(segmented_facts, 0) AS segmented_facts, coalesce(segment_dimensions, 0) AS segment_dimensions
FROM (SELECT cik, count(*) AS total_facts, count(DISTINCT concept) AS unique_concepts FROM facts GROUP BY 1) f
LEFT JOIN (SELECT cik, count(*) AS segmented_facts, count(DISTINCT dimension_axis) AS segment_dimensions FROM segments GROUP BY 1) s ON f.cik = s.cik""", t.FACTS, t.SEGMENTS)  # fmt: skip
_add("data_summary", _facts(views.data_summary), "SELECT cik, count(DISTINCT concept) AS concepts, count(*) AS facts, count(DISTINCT period_end) AS periods FROM facts GROUP BY 1", t.FACTS)
_add("period_coverage", _facts(views.period_coverage), """SELECT cik, concat(min(year(period_end)), '-', max(year(period_end))) AS range, count(DISTINCT year(period_end)) AS year_count,
count(DISTINCT strftime(period_end, '%Y-%m')) AS month_count, array_to_string(list_sort(list(DISTINCT year(period_end))), ',') AS years FROM facts GROUP BY 1""", t.FACTS)  # fmt: skip
_add("members_per_axis", _segs(views.members_per_axis), "SELECT dimension_axis, count(DISTINCT dimension_member) AS members, count(*) AS facts FROM segments GROUP BY 1", t.SEGMENTS)
_add("sample_members", _segs(views.sample_members), """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dimension_axis ORDER BY dimension_member) AS member_no, dense_rank() OVER (ORDER BY dimension_axis) AS axis_no
FROM (SELECT DISTINCT dimension_axis, dimension_member FROM segments)) WHERE member_no <= 3 AND axis_no <= 5""", t.SEGMENTS)  # fmt: skip
_add("series_stats", _facts(lambda f: views.series_op(f, "average")), "SELECT cik, concept, count(*) AS n, cast(min(value) AS double) AS lo, cast(max(value) AS double) AS hi, cast(sum(value) AS double) / count(value) AS mean FROM facts GROUP BY 1, 2", t.FACTS)
_add("series_growth", _facts(lambda f: views.series_op(f, "growth")), "SELECT cik, concept, (b - a) / abs(nullif(a, 0)) * 100 AS growth_pct FROM (SELECT cik, concept, cast(arg_min(value, period_end) AS double) AS a, cast(arg_max(value, period_end) AS double) AS b FROM facts GROUP BY 1, 2)", t.FACTS)
_add("series_trend", _facts(lambda f: views.series_op(f, "trend")), """SELECT cik, concept, CASE WHEN b > a * 1.05 THEN 'increasing' WHEN b < a * 0.95 THEN 'decreasing' ELSE 'stable' END AS trend FROM (
SELECT cik, concept, cast(sum(CASE WHEN k <= floor(n / 2) THEN value END) AS double) / count(CASE WHEN k <= floor(n / 2) THEN 1 END) AS a,
cast(sum(CASE WHEN k > floor(n / 2) THEN value END) AS double) / count(CASE WHEN k > floor(n / 2) THEN 1 END) AS b FROM (
SELECT *, row_number() OVER (PARTITION BY cik, concept ORDER BY period_end) AS k, count(*) OVER (PARTITION BY cik, concept) AS n FROM facts) WHERE n >= 3 GROUP BY 1, 2)""", t.FACTS)  # fmt: skip
SHOWN = "CASE WHEN abs(revenue) >= 1e9 THEN printf('%.1fB', revenue / 1e9) WHEN abs(revenue) >= 1e6 THEN printf('%.1fM', revenue / 1e6) WHEN abs(revenue) >= 1e3 THEN printf('%.1fK', revenue / 1e3) ELSE printf('%.1f', revenue) END"
_add("entity_digest", _facts(views.entity_digest), f"""SELECT cik, entity_name, period_end, concat_ws('; ', 'revenue ' || {SHOWN}, 'margin ' || printf('%.1f%%', operating_margin_pct), 'EPS ' || printf('%.2f', eps), 'growth ' || printf('%.1f%%', revenue_growth_pct)) AS digest
FROM model WHERE revenue IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cik ORDER BY period_end DESC) = 1""", t.FACTS, MODEL)  # fmt: skip
_add("recent_values", _facts(views.recent_values), f"SELECT * FROM (SELECT cik, concept, period_end, {V}, row_number() OVER (PARTITION BY cik, concept ORDER BY period_end DESC) AS age FROM facts) WHERE age <= 10", t.FACTS)
_add("run_summary", lambda s, d: views.run_summary(t.filing_status(s, d)), """SELECT fetch_status, count(*) AS runs, count(DISTINCT cik) AS companies, cast(sum(cast(seconds AS decimal(18,4))) AS double) AS total_seconds,
cast(sum(cast(seconds AS decimal(18,4))) AS double) / count(seconds) AS mean_seconds FROM status GROUP BY 1""", t.STATUS)  # fmt: skip
_add("latest_status", lambda s, d: views.latest_status(t.filing_status(s, d)), "SELECT cik, fetch_status, accession_number FROM status QUALIFY row_number() OVER (PARTITION BY cik ORDER BY created_at DESC, accession_number DESC) = 1", t.STATUS)
_add("anomaly_baseline", _facts(views.anomalies), """, e AS (SELECT cik, concept, quarter(period_end) AS q, cast(sum(value) AS double) / count(value) AS expected FROM facts GROUP BY 1, 2, 3)
SELECT f.cik, f.concept, period_end, cast(value AS double) AS value, expected, abs(cast(value AS double) - expected) / abs(nullif(expected, 0)) AS deviation,
coalesce(abs(cast(value AS double) - expected) / abs(nullif(expected, 0)) > 0.2, false) AS is_anomaly FROM facts f JOIN e ON f.cik = e.cik AND f.concept = e.concept AND quarter(period_end) = q""", t.FACTS)  # fmt: skip
_add("anomaly_model", _facts(lambda f: views.model_anomalies(f, views.fit_anomaly_model(f))))
CATEGORY = "CASE concept WHEN 'Revenues' THEN 'Revenue' WHEN 'CostOfRevenue' THEN 'Expenses' WHEN 'OperatingIncomeLoss' THEN 'Profitability' WHEN 'NetIncomeLoss' THEN 'Profitability' WHEN 'Assets' THEN 'Assets' WHEN 'Liabilities' THEN 'Liabilities' WHEN 'StockholdersEquity' THEN 'Equity' ELSE 'Other' END"
_add("categorized_facts", _facts(lambda f: segments.categorize(f).groupBy("cik", "category").agg(F.count("*").alias("n"))), f"SELECT cik, {CATEGORY} AS category, count(*) AS n FROM facts GROUP BY 1, 2", t.FACTS)
FOUND = """found AS (SELECT DISTINCT kind, concept FROM (SELECT DISTINCT concept FROM facts) JOIN (VALUES ('product_segments', '.*(revenue|sales|product)'), ('geographic_segments', '.*(geograph|country|region|domestic|foreign)'),
('customer_segments', '.*(customer|client)'), ('profit_segments', '.*(operating|netincome)')) v(kind, pattern) ON regexp_matches(lower(concept), '^(?:' || pattern || ')')
UNION SELECT 'statement_segments', concept FROM facts WHERE concept IN ('Assets', 'Goodwill'))"""
_add("discovered_segments", _facts(lambda f: segments.discover(f, KNOWN)), "SELECT * FROM found", t.FACTS, FOUND)
DISCOVERED = f"values_ AS (SELECT * FROM (SELECT kind, cik, f.concept, period_end, {V}, row_number() OVER (PARTITION BY kind, cik, f.concept ORDER BY period_end DESC) AS age FROM facts f JOIN found ON f.concept = found.concept) WHERE age <= 10)"
_add("discovered_values", _facts(lambda f: segments.discovered_values(f, segments.discover(f, KNOWN))), "SELECT * FROM values_", t.FACTS, FOUND, DISCOVERED)
_add("discovery_summary", lambda s, d: segments.discovery_summary(t.segments(s, d), segments.discover(t.facts(s, d), KNOWN)), "SELECT 'explicit_axes' AS kind, count(DISTINCT dimension_axis) AS n FROM segments UNION ALL SELECT kind, count(DISTINCT concept) FROM found GROUP BY 1", t.FACTS, t.SEGMENTS, FOUND)
_add("all_segments", lambda s, d: segments.with_implicit(t.segments(s, d), segments.discovered_values(f := t.facts(s, d), segments.discover(f, KNOWN))), f"SELECT cik, dimension_axis, dimension_member, concept, period_end, {V}, 'explicit' AS segment_kind FROM segments UNION ALL SELECT cik, kind, concept, concept, period_end, value, 'implicit' FROM values_", t.FACTS, t.SEGMENTS, FOUND, DISCOVERED)
_add("load_rows", lambda s, d: segments.load_rows(t.facts(s, d), t.segments(s, d)), f"SELECT cik, concept, period_end, {V}, 'fact' AS row_kind FROM facts UNION ALL SELECT cik, dimension_axis || '_' || dimension_member, period_end, cast(value AS double), 'segment' FROM segments", t.FACTS, t.SEGMENTS)
_add("merged_sources", _facts(lambda f: segments.merge_sources(f.where("concept <> 'Assets' or month(period_end) = 12").withColumn("value", dbl("value")), f.where("concept in ('Assets', 'Revenues')").withColumn("value", -dbl("value")), ["cik", "concept", "period_end"])), """SELECT cik, concept, period_end,
cast(CASE WHEN concept <> 'Assets' OR month(period_end) = 12 THEN value ELSE -value END AS double) AS value, CASE WHEN concept <> 'Assets' OR month(period_end) = 12 THEN 'primary' ELSE 'secondary' END AS source FROM facts""", t.FACTS)  # fmt: skip


def replaced_members(s: SparkSession, d: str) -> DataFrame:
    """The segments but those by product, doubled in Asia; they are derived once, written, and read thrice."""
    rows = Scratch(s, "segments").save(t.segments(s, d).where("dimension_axis <> 'ProductOrServiceAxis'").withColumn("value", dbl("value")), "rows")
    return segments.overwrite_members(rows, rows.where("dimension_member = 'ASIA'").withColumn("value", F.col("value") * 2), ["dimension_axis", "dimension_member"], "broadcast")


_add("replaced_members", replaced_members, "SELECT cik, dimension_axis, dimension_member, concept, period_end, CASE WHEN dimension_member = 'ASIA' THEN cast(value AS double) * 2 ELSE cast(value AS double) END AS value FROM segments WHERE dimension_axis <> 'ProductOrServiceAxis'", t.SEGMENTS)
CRIT = ", ".join(f"'{c}'" for c in quality.CRITICAL)
AXES_SQL = ", ".join(f"'{c}'" for c in quality.EXPECTED_AXES)
SCORES = f"""scores AS (SELECT f.cik, concepts, facts, coalesce(axes, 0) AS axes, coalesce(axes, 0) >= 10 AS enough_axes, coalesce(axes, 0) - coalesce(expected, 0) AS additional_axes,
critical / 10 * 100 AS critical_pct, coalesce(expected, 0) / 4 * 100 AS axes_pct,
((CASE WHEN concepts >= 100 THEN 1.0 ELSE 0.0 END + CASE WHEN facts >= 500 THEN 1.0 ELSE 0.0 END + CASE WHEN axes > 0 THEN 1.0 ELSE 0.0 END)::double / 3) * 0.3::double
 + (critical / 10) * 0.4::double + (coalesce(expected, 0) / 4) * 0.2::double + flags / 5 * 0.1::double AS score FROM (
SELECT cik, count(DISTINCT concept) AS concepts, count(*) AS facts, count(DISTINCT CASE WHEN concept IN ({CRIT}) THEN concept END) AS critical,
2 + (count(entity_name) > 0)::int + bool_and(period_end IS NOT NULL)::int + bool_and(value IS NOT NULL)::int AS flags FROM facts GROUP BY 1) f
LEFT JOIN (SELECT cik, count(DISTINCT dimension_axis) AS axes, count(DISTINCT CASE WHEN dimension_axis IN ({AXES_SQL}) THEN dimension_axis END) AS expected FROM segments GROUP BY 1) s ON f.cik = s.cik)"""
_score = lambda s, d: quality.completeness_score(t.facts(s, d), t.segments(s, d))
_add("completeness_score", _score, "SELECT *, score >= 0.8 AS is_complete FROM scores", t.FACTS, t.SEGMENTS, SCORES)
MISSING = f"missing AS (SELECT c.cik, v.concept FROM (SELECT DISTINCT cik FROM facts) c CROSS JOIN (VALUES {', '.join(f'({chr(39)}{c}{chr(39)})' for c in quality.CRITICAL)}) v(concept) WHERE NOT EXISTS (SELECT 1 FROM facts f WHERE f.cik = c.cik AND f.concept = v.concept))"
_add("missing_critical", _facts(quality.missing_critical), "SELECT * FROM missing", t.FACTS, MISSING)
_add("quality_advice", lambda s, d: quality.recommendations(_score(s, d), quality.missing_critical(t.facts(s, d))), """SELECT cik, concat_ws('; ', CASE WHEN concepts < 100 THEN 'few concepts' END, CASE WHEN facts < 500 THEN 'few facts' END, CASE WHEN axes < 10 THEN 'few axes' END,
(SELECT 'missing ' || array_to_string(list_sort(list(concept))[1:3], ', ') FROM missing m WHERE m.cik = scores.cik HAVING count(*) > 0)) AS advice FROM scores""", t.FACTS, t.SEGMENTS, SCORES, MISSING)  # fmt: skip
KEYS = ["cik", "concept", "period_end"]
_add("sum_to_parent", lambda s, d: quality.sum_to_parent(t.facts(s, d), t.segments(s, d).where("dimension_axis = 'ProductOrServiceAxis'"), KEYS), """SELECT f.cik, f.concept, f.period_end, cast(f.value AS double) AS total, cast(p.parts AS double) AS parts, children,
abs(cast(f.value AS double) - cast(p.parts AS double)) / abs(nullif(cast(f.value AS double), 0)) <= 0.01 AS is_valid FROM facts f JOIN (
SELECT cik, concept, period_end, sum(value) AS parts, count(*) AS children FROM segments WHERE dimension_axis = 'ProductOrServiceAxis' GROUP BY 1, 2, 3) p ON f.cik = p.cik AND f.concept = p.concept AND f.period_end = p.period_end""", t.FACTS, t.SEGMENTS)  # fmt: skip
_add("quality_issues", _facts(lambda f: quality.quality_issues(f.withColumn("value", F.when(F.col("concept") == "Revenues", -dbl("value")).otherwise(dbl("value"))))), "SELECT cik, concept, period_end, 'negative value' AS issue FROM facts WHERE (concept = 'Revenues' AND -value < 0) OR (concept IN ('Assets', 'CostOfRevenue') AND value < 0)", t.FACTS)
_add("gate_checks", lambda s, d: quality.gate_checks(t.facts(s, d), t.segments(s, d), t.load(s, d, "documents")), """, g AS (SELECT * FROM (SELECT count(*) AS f, count(DISTINCT concept) AS c FROM facts), (SELECT count(*) AS s, count(DISTINCT dimension_axis) AS x FROM segments), (SELECT sum(length(text))::bigint AS t FROM documents))
SELECT 'facts over 500' AS "check", f AS actual, f > 500 AS passed FROM g UNION ALL SELECT 'concepts over 500', c, c > 500 FROM g UNION ALL SELECT 'axes over 15', x, x > 15 FROM g UNION ALL SELECT 'segment facts over 400', s, s > 400 FROM g
UNION ALL SELECT 'text over 100000', t, t > 100000 FROM g UNION ALL SELECT 'overall', NULL, f > 500 AND c > 500 AND x > 15 AND s > 400 AND t > 100000 FROM g""", t.FACTS, t.SEGMENTS)  # fmt: skip


def company_facts_json(s: SparkSession, d: str) -> DataFrame:
    """The facts packed as company-facts documents (JSON text and back), two shapes of periods and segments."""
    f = t.facts(s, d)
    text = lambda c: F.col(c).cast("string")
    one = F.to_json(F.struct(F.lit("ProductOrServiceAxis").alias("dimension"), F.col("concept").alias("value")))
    segment = F.when(F.month("period_end") == 3, one).when(F.month("period_end") == 6, F.concat(F.lit("["), one, F.lit("]")))
    fy = F.when(F.month("period_end") == 12, F.year("period_end").cast("string")).when(F.month("period_end") == 9, F.lit("0"))
    none = F.lit(None).cast("string")
    entry = F.struct(none.alias("start"), text("period_end").alias("end"), none.alias("instant"), F.col("value").cast("decimal(38,9)").alias("val"), fy.alias("fy"), none.alias("fp"), text("filing_date").alias("filed"), segment.alias("segment"))
    a = f.groupBy("cik", "entity_name", "concept", "unit").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    b = a.groupBy("cik", "entity_name", "concept").agg(F.map_from_entries(F.collect_list(F.struct("unit", "entries"))).alias("units"))
    c = b.groupBy("cik", "entity_name").agg(F.map_from_entries(F.collect_list(F.struct("concept", F.struct("units")))).alias("concepts"))
    doc = F.to_json(F.struct("cik", F.col("entity_name").alias("entityName"), F.create_map(F.lit("us-gaap"), "concepts").alias("facts")))
    return c.select(F.from_json(doc, COMPANY_FACTS).alias("x")).select("x.*")


PERIOD = "CASE WHEN month(period_end) = 12 THEN cast(year(period_end) AS varchar) ELSE cast(period_end AS varchar) END"
_add("flattened_facts", lambda s, d: flatten.flatten_facts(company_facts_json(s, d), 2001, 5).select("cik", "entity", "concept", "unit", "period", "period_year", dbl("value").alias("value")), f"SELECT cik, entity_name AS entity, concept, unit, {PERIOD} AS period, cast(year(period_end) AS integer) AS period_year, {V} FROM facts WHERE year(period_end) >= 1996", t.FACTS)
_add("flattened_segments", lambda s, d: flatten.flatten_segments(company_facts_json(s, d), 2001, 5).withColumn("value", dbl("value")), f"SELECT cik, 'ProductOrServiceAxis' AS dimension_axis, concept AS dimension_member, concept, unit, {PERIOD} AS period, {V} FROM facts WHERE year(period_end) >= 1996 AND month(period_end) IN (3, 6)", t.FACTS)


def filings(s: SparkSession, d: str) -> DataFrame:
    """Submissions with parallel arrays: a customer is a company, an order a filing, its priority the form."""
    o = t.load(s, d, "orders")
    listed = F.sort_array(F.collect_list(F.struct("o_orderkey", F.col("o_orderpriority").alias("form"), F.col("o_orderdate").cast("date").cast("string").alias("filed"))))
    a = o.groupBy("o_custkey").agg(listed.alias("x"))
    text = lambda c: F.transform("x", lambda r: r[c].cast("string"))
    recent = F.struct(text("form").alias("form"), text("o_orderkey").alias("accessionNumber"), text("filed").alias("filingDate"), text("filed").alias("reportDate"), text("form").alias("primaryDocument"))
    return flatten.flatten_filings(a.select(F.col("o_custkey").cast("string").alias("cik"), F.lit("x").alias("name"), F.struct(recent.alias("recent")).alias("filings")))


FILINGS = "filings AS (SELECT lpad(cast(o_custkey AS varchar), 10, '0') AS cik, o_orderpriority AS form, cast(o_orderkey AS varchar) AS accession, o_orderkey, cast(o_orderdate AS date) AS filing_date FROM orders)"
NEWEST = "QUALIFY row_number() OVER (PARTITION BY cik, form ORDER BY filing_date DESC, o_orderkey) = 1"
_add("newest_filing", lambda s, d: flatten.newest_filing(filings(s, d)).select("cik", "form", "accession", "filing_date"), f"SELECT cik, form, accession, filing_date FROM filings {NEWEST}", FILINGS)
_add("new_filings", lambda s, d: flatten.new_filings(f := filings(s, d), f.where("form = '1-URGENT'")).select("accession", "cik", "form"), "SELECT accession, cik, form FROM filings WHERE form <> '1-URGENT'", FILINGS)


def index_items(s: SparkSession, d: str) -> DataFrame:
    """Filing index: an order's lines are the files of a filing, named by flag and line number."""
    name = F.when(F.col("l_returnflag") == "R", F.concat(F.when(F.col("l_linenumber") % 2 == 1, "Instance").otherwise("x"), F.col("l_linenumber"), F.lit("_htm.xml"))).when(F.col("l_returnflag") == "A", F.concat(F.lit("EX-"), F.col("l_linenumber"), F.lit(".pdf"))).otherwise(F.concat(F.lit("d"), F.col("l_linenumber"), F.lit(".xsd")))
    size = F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("l_quantity").cast("long").cast("string"))
    items = t.load(s, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", name.alias("name"), size.alias("size")))).alias("x"))
    directory = F.struct(F.transform("x", lambda r: F.struct(r["name"].alias("name"), r["size"].alias("size"))).alias("item"))
    return flatten.index_items(items.select(F.lit("c").alias("cik"), F.col("l_orderkey").cast("string").alias("accession"), directory.alias("directory")))


ITEMS = """items AS (SELECT cast(l_orderkey AS varchar) AS accession, l_linenumber AS n, CASE l_returnflag WHEN 'R' THEN CASE WHEN l_linenumber % 2 = 1 THEN 'Instance' ELSE 'x' END || l_linenumber || '_htm.xml' WHEN 'A' THEN 'EX-' || l_linenumber || '.pdf' ELSE 'd' || l_linenumber || '.xsd' END AS name,
CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(trunc(l_quantity) AS bigint) END AS size FROM lineitem)"""
_add("filing_completeness", lambda s, d: flatten.filing_completeness(index_items(s, d)).drop("cik"), """SELECT accession, count(CASE WHEN regexp_matches(name, '\\.(xml|xsd|json)$') THEN 1 END) AS structured_files, count(CASE WHEN name LIKE 'EX-%' THEN 1 END) AS exhibit_files,
coalesce(sum(CASE WHEN regexp_matches(name, '\\.(xml|xsd|json)$') THEN size END), 0)::double / nullif(sum(size), 0)::double * 100 AS captured_pct FROM items GROUP BY 1""", ITEMS)  # fmt: skip
_add("instance_documents", lambda s, d: flatten.instance_documents(index_items(s, d)).drop("cik"), "SELECT accession, name FROM items WHERE name LIKE '%\\_htm.xml' ESCAPE '\\' AND lower(name) LIKE '%instance%' QUALIFY row_number() OVER (PARTITION BY accession ORDER BY n) = 1", ITEMS)


def instances(s: SparkSession, d: str) -> DataFrame:
    """One XML instance per company, composed from its facts: a context per period, one with a dimension."""
    f = t.facts(s, d)
    cid = F.concat(F.lit("p"), F.col("period_end").cast("string"))
    dim = F.when(F.month("period_end") == 12, '<segment><explicitMember dimension="us:ProductOrServiceAxis">us:AllMember</explicitMember></segment>').otherwise("")
    context = F.concat(F.lit('<context id="'), cid, F.lit('"><entity>'), dim, F.lit("</entity><period><instant>"), F.col("period_end").cast("string"), F.lit("</instant></period></context>"))
    fact = F.concat(F.lit("<us:"), F.col("concept"), F.lit(' contextRef="'), cid, F.lit('" unitRef="USD">'), F.col("value").cast("string"), F.lit("</us:"), F.col("concept"), F.lit(">"))
    one = f.groupBy("cik").agg(F.array_join(F.collect_set(context), "").alias("c"), F.array_join(F.collect_list(fact), "").alias("f"))
    xml = F.concat(F.lit('<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:us="http://fasb.org/us-gaap">'), "c", "f", F.lit("</xbrl>"))
    return one.select(F.col("cik").alias("path"), xml.cast("binary").alias("content"))


_add("instance_facts", lambda s, d: flatten.instance_facts(flatten.flatten_instances(instances(s, d))).select(F.col("filing").alias("cik"), "concept", "period_end", "unit", dbl("value").alias("value"), "segment_member"), f"SELECT cik, concept, period_end, unit, {V}, CASE WHEN month(period_end) = 12 THEN 'AllMember' END AS segment_member FROM facts", t.FACTS)
_add("instance_stats", lambda s, d: flatten.instance_stats(flatten.flatten_instances(instances(s, d))).withColumnRenamed("filing", "cik"), "SELECT cik, count(*) AS total_facts, count(CASE WHEN month(period_end) = 12 THEN 1 END) AS segmented_facts, count(DISTINCT concept) AS unique_concepts, max(CASE WHEN month(period_end) = 12 THEN 1 ELSE 0 END)::bigint AS segment_dimensions FROM facts GROUP BY 1", t.FACTS)
_add("page_text", lambda s, d: t.load(s, d, "pages").select("page_id", html_text(F.col("html")).alias("text")), """SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(
regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
'&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '[ \\t\\r\\n\\f]+', ' ', 'g')) AS text FROM pages""")  # fmt: skip


def report_pages(s: SparkSession, d: str) -> DataFrame:
    """A report of two pages for each company and period, composed from the financial model."""
    m = views.financial_model(t.facts(s, d)).where("revenue is not null")
    money = lambda c: F.floor(F.col(c)).cast("long").cast("string")
    doc = F.concat_ws("/", "cik", F.col("period_end").cast("string"))
    text = F.concat(F.lit("Financial results. Q1 2001 earnings. Total revenue was $"), money("revenue"), F.lit(" million. Operating income of $"), money("operating_income"), F.lit(" million."))
    rows = F.array(F.array(F.lit("Item"), F.lit("Q1 2001"), F.lit("YoY")), F.array(F.lit("Total revenue"), money("revenue"), F.lit("5%")), F.array(F.lit("Operating income"), money("operating_income"), F.lit("2%")))
    page = lambda n, x, tab: F.struct(F.lit(n).alias("page_num"), x.alias("text"), tab.alias("tables"))
    both = F.explode(F.array(page(1, text, F.array(rows)), page(2, F.lit("Segment information"), F.array().cast("array<array<array<string>>>"))))
    return m.select(doc.alias("doc_id"), both.alias("p")).select("doc_id", "p.*", F.lit(0).alias("image_count"))


DOCS = ", docs AS (SELECT cik || '/' || cast(period_end AS varchar) AS doc_id, floor(revenue) AS r, floor(operating_income) AS o FROM model WHERE revenue IS NOT NULL) "
_add("text_metrics", lambda s, d: documents.text_metrics(report_pages(s, d)).select("doc_id", "name", "value_millions", "unit"), DOCS + "SELECT doc_id, 'total_revenue' AS name, r AS value_millions, 'million' AS unit FROM docs UNION ALL SELECT doc_id, 'operating_income', o, 'million' FROM docs WHERE o >= 0", t.FACTS, MODEL)
_add("table_metrics", lambda s, d: documents.table_metrics(report_pages(s, d), LEXICON).select("doc_id", "name", "value", "percent"), DOCS + "SELECT doc_id, 'total_revenue' AS name, r AS value, 5.0::double AS percent FROM docs UNION ALL SELECT doc_id, 'operating_income', o, 2.0::double FROM docs", t.FACTS, MODEL)
_add("report_sections", lambda s, d: documents.sections(report_pages(s, d).where("page_num = 1 or cast(substring(doc_id, 1, 10) AS int) % 4 > 0")).select("doc_id", "data_type", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"), "priority"), DOCS + "SELECT doc_id, 'financial' AS data_type, '1' AS pages, 'high' AS priority FROM docs UNION ALL SELECT doc_id, 'segment', '2', 'medium' FROM docs WHERE cast(substr(doc_id, 1, 10) AS integer) % 4 > 0", t.FACTS, MODEL)


def responses(s: SparkSession, d: str) -> DataFrame:
    """Extraction responses from the events: fenced, bare, or with words around the JSON."""
    e = t.load(s, d, "events")
    body = F.concat(F.lit('{"revenue": {"total": '), F.col("value").cast("decimal(18,2)").cast("string"), F.lit('}, "detail": ['), F.col("props"), F.lit("]}"))
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(kind == 1, F.concat(F.lit("Here: "), body, F.lit(" done"))).otherwise(body)
    return e.select(F.col("event_id").alias("doc_id"), F.lit(1).alias("page_num"), text.alias("response"))


_add("json_leaves", lambda s, d: extracted.json_leaves(responses(s, d)).select("doc_id", "path", "key", dbl("value").alias("value"), "type"), """SELECT event_id AS doc_id, 'revenue.total' AS path, 'total' AS key, cast(cast(value AS decimal(18,2)) AS double) AS value, 'revenue' AS type FROM events
UNION ALL SELECT event_id, 'detail[0].k', 'k', cast(json_extract(props, '$.k') AS double), 'other' FROM events""")  # fmt: skip
#: Places of a figure in a response, by the type of its event.
PLACES = {"signup": "segment.gross_margin", "view": "total.revenue", "click": "vehicles.deliveries", "error": "net_income", "purchase": "segment.sales"}


def placed_responses(s: SparkSession, d: str) -> DataFrame:
    """A response for each event whose figure stands where its type tells; some are shares, of some there is no figure."""
    place = F.element_at(F.create_map(*[F.lit(x) for kv in PLACES.items() for x in kv]), F.col("event_type"))
    outer, inner = F.split_part(place, F.lit("."), F.lit(1)), F.split_part(place, F.lit("."), F.lit(-1))
    figure = F.when(F.col("event_id") % 7 == 0, "n/a").when(F.col("event_id") % 5 == 0, "12%").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    text = F.format_string('{"%s": {"%s": "%s"}, "rate": "%s"}', outer, inner, figure, F.when(F.col("event_id") % 2 == 0, "7%").otherwise("7"))
    return t.load(s, d, "events").select(F.col("event_id").alias("doc_id"), F.lit(1).alias("page_num"), text.alias("response"))


_add("leaf_types", lambda s, d: extracted.type_histogram(extracted.json_leaves(placed_responses(s, d))), """SELECT type, count(*) AS n, count(DISTINCT event_id) AS documents FROM (
SELECT event_id, CASE event_type WHEN 'signup' THEN 'margin' WHEN 'view' THEN 'revenue' WHEN 'purchase' THEN 'revenue' WHEN 'error' THEN 'income' WHEN 'click' THEN CASE WHEN event_id % 5 = 0 AND event_id % 7 > 0 THEN 'percentage' ELSE 'other' END END AS type FROM events
UNION ALL SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'percentage' ELSE 'other' END FROM events) GROUP BY 1""")  # fmt: skip
_add("routed_values", lambda s, d: extracted.route_values(extracted.json_leaves(placed_responses(s, d))).groupBy("target_path").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")), """SELECT target_path, count(*) AS n, sum(v)::double AS total FROM (
SELECT CASE event_type WHEN 'signup' THEN 'segments' WHEN 'purchase' THEN 'segments' WHEN 'view' THEN 'revenue.total' WHEN 'click' THEN 'operational' ELSE 'income' END AS target_path, CASE WHEN event_id % 5 = 0 THEN 12 ELSE value END::decimal(18,2) AS v FROM events WHERE event_id % 7 > 0
UNION ALL SELECT 'other', 7 FROM events) GROUP BY 1""")  # fmt: skip
