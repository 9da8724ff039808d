"""Queries over pages and metrics that grow with the tables, over status events, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import report_queries as r
from ledgerspark.functions import exprs
from ledgerspark.operators import documents, extracted, mining, quality, reports, segments, views
from ledgerspark.plans import jobs
from ledgerspark.queries import AS_OF, NOW, responses
from ledgerspark.report_queries import ORACLES, QUERIES, _add, _facts
from ledgerspark.sources import orderpages as o
from ledgerspark.sources import readers
from ledgerspark.sources import testtables as t
from ledgerspark.streaming import states

PHRASES = ", ".join(f"('{m}', '{p}')" for m, p in mining.PHRASES)
_add("phrase_contexts", lambda s, d: mining.phrase_contexts(o.pages(s, d)), f"""SELECT doc_id, page_num, metric, phrase, i AS "offset", substr(text, greatest(i - 50, 0) + 1, least(i, 50) + 200) AS context
FROM (SELECT *, unnest(range(length(text))) AS i FROM opages) JOIN (VALUES {PHRASES}) v(metric, phrase) ON lower(substr(text, i + 1, length(phrase))) = phrase""", o.PAGES)  # fmt: skip

_any = lambda kind: " OR ".join(f"regexp_matches(lower(text), '{p}')" for p in documents.SECTIONS[kind])
ROUTED = f""", kinds AS (SELECT *, {_any('financial')} AS f, {_any('operational')} AS m, {_any('segment')} AS g FROM opages),
body AS (SELECT l.*, f, m, g FROM olines l JOIN kinds k USING (doc_id, page_num) WHERE l.o_orderkey % 5 < 4)
SELECT doc_id, page_num, 'financial' AS miner, 'revenue.total' AS name, e::double AS value FROM body WHERE f AND label = 'Total revenue'
UNION ALL SELECT doc_id, page_num, 'operational', 'units_delivered', q FROM body WHERE m AND label = 'Units delivered'
UNION ALL SELECT doc_id, page_num, 'segment', 'geographic.United States', q FROM body WHERE g AND label = 'United States' AND header IN ('Segment Amount', 'Region Amount')
UNION ALL SELECT doc_id, page_num, 'text', CASE l_partkey % 8 WHEN 3 THEN 'total_revenue' WHEN 4 THEN 'service_revenue' ELSE 'net_income' END, e FROM olines WHERE l_partkey % 8 IN (3, 4, 6)"""  # fmt: skip
_add("routed_pages", lambda s, d: mining.route_pages(o.pages(s, d)), ROUTED, o.PAGES)

_add("table_kinds", lambda s, d: documents.classify_tables(o.pages(s, d)), f""", words AS (SELECT doc_id, page_num, lower(any_value(header) || ' ' || string_agg(label || ' ' || cell, ' ' ORDER BY row_num)) AS w FROM olines WHERE o_orderkey % 5 < 4 GROUP BY 1, 2),
told AS (SELECT *, regexp_matches(w, '{documents.OPERATIONAL_WORDS}') AS op, regexp_matches(w, '{documents.FINANCIAL_WORDS}') AS fin, regexp_matches(w, '{documents.SERIES_SIGNS}') AS ser FROM words),
named AS (SELECT *, CASE WHEN op THEN 'operational_metrics' WHEN fin AND regexp_matches(w, 'segment|geographic') THEN 'segment_financial' WHEN fin AND w LIKE '%margin%' AND w LIKE '%\\%%' ESCAPE '\\' THEN 'margins' WHEN fin THEN 'financial' END AS k FROM told)
SELECT doc_id, page_num, 0 AS table_num, CASE WHEN ser AND k IS NULL THEN 'time_series' WHEN ser THEN k || '_time_series' ELSE k END AS kind, CASE WHEN op THEN 0.85 WHEN fin THEN 0.9 ELSE 0.7 END::double AS confidence FROM named WHERE ser OR k IS NOT NULL""", o.PAGES)  # fmt: skip

PAIRS = ", pairs AS (SELECT * FROM (SELECT a.doc_id, a.metric AS a, b.metric AS b, a.name AS an, b.name AS bn, len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) AS similarity FROM ctx a JOIN ctx b ON a.doc_id = b.doc_id AND a.metric < b.metric) WHERE similarity > 0.5) "
_add("similar_contexts", lambda s, d: mining.similar_contexts(o.contexts(s, d)), PAIRS + "SELECT doc_id, a, b, similarity FROM pairs", o.CONTEXTS)
_add("context_hierarchies", lambda s, d: mining.context_hierarchies(o.contexts(s, d)), PAIRS + """, ways AS (SELECT doc_id, a AS metric, an AS parent, bn AS child FROM pairs UNION ALL SELECT doc_id, b, bn, an FROM pairs)
SELECT doc_id, metric, parent, array_to_string(list_sort(list(child)), ',') AS children FROM ways WHERE parent LIKE 'Total%' GROUP BY 1, 2, 3""", o.CONTEXTS)  # fmt: skip


def named_pages(s: SparkSession, d: str) -> DataFrame:
    """A short report for each customer in which another rule names the company, or none does."""
    c, k = F.col, F.col("c_custkey") % 10
    name = F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(" Works"))
    page = lambda n, *parts: F.struct(F.lit(n).alias("page_num"), F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("text"))
    none = page(1, "(none)")
    ways = [
        [page(1, name, " Inc.\nreport of the year"), page(2, "Other Corp.")], [page(1, "a b " * 30, "Inc.; " + "; " * 120, name, " Corp. (NYSE: WRKS)")], [page(1, name, "\nQuarterly Results of trade")],
        [page(1, "12% up; © 2024 ", name, "; all")], [page(1, "notes; x\n", name, " overview\n(all)")], [page(1, "(today) ", name, " announces sales")], [none, page(2, "x; The Workshop team met")],
        [none, page(3, "y; made by Acme, said")], [none, page(11, name, " Inc.")], [none, page(2, "of 5; ", name, " Ltd.; more"), page(1, "(also none)")],
    ]
    at = F.when(F.lit(False), F.array(none))
    for i, way in enumerate(ways):
        at = at.when(k == i, F.array(*way))
    return t.load(s, d, "customer").select(c("c_custkey").alias("doc_id"), F.explode(at).alias("p")).select("doc_id", "p.*")


_add("company_names", lambda s, d: mining.company_names(named_pages(s, d)), """SELECT c_custkey AS doc_id, CASE c_custkey % 10 WHEN 0 THEN n || ' Inc.' WHEN 1 THEN n || ' Corp.' WHEN 4 THEN n || ' overview' WHEN 6 THEN 'Workshop' WHEN 7 THEN 'Acme' WHEN 8 THEN 'Unknown' WHEN 9 THEN n || ' Ltd.' ELSE n END AS company,
CASE c_custkey % 10 WHEN 6 THEN 2 WHEN 7 THEN 3 WHEN 8 THEN NULL WHEN 9 THEN 2 ELSE 1 END AS page_num, (['formal', 'ticker', 'header', 'copyright', 'heading', 'announced', 'team', 'mentioned', NULL, 'formal'])[c_custkey % 10 + 1] AS rule
FROM (SELECT c_custkey, c_mktsegment[1] || lower(c_mktsegment[2:]) || ' Works' AS n FROM customer)""")  # fmt: skip

WANTED = ", ".join(f"('{c}', '{n}', {mining.CHECKS[c][1] if n in mining.CHECKS[c][0] else 'NULL'}, {repr(reports.CRITICAL[n]) if n in reports.CRITICAL else 'NULL'})" for c, ns in reports.REQUIRED.items() for n in ns)
_add("coverage_rollup", lambda s, d: mining.coverage(o.metrics(s, d)), f""", have AS (SELECT doc_id, name, max(value) <> 0 AS got FROM om GROUP BY 1, 2),
want AS (SELECT d.doc_id, v.*, coalesce(h.got, false) AS got FROM (SELECT DISTINCT doc_id FROM om) d CROSS JOIN (VALUES {WANTED}) v(category, name, need, said) LEFT JOIN have h USING (doc_id, name)),
sums AS (SELECT doc_id, category, grouping(category) AS g, count(CASE WHEN got THEN 1 END) AS found, count(*) AS total, max(need) AS need, count(CASE WHEN got AND need IS NOT NULL THEN 1 END) AS met,
  coalesce(string_agg(name, ', ' ORDER BY name) FILTER (NOT got), '') AS missing, coalesce(string_agg(said, ', ' ORDER BY said) FILTER (NOT got AND said IS NOT NULL), '') AS critical FROM want GROUP BY ROLLUP (doc_id, category))
SELECT doc_id, CASE WHEN g = 1 THEN 'overall' ELSE category END AS category, found, total, found / total AS score, CASE WHEN g = 1 THEN found / total >= 0.8 AND critical = '' ELSE met >= need END AS passed, missing, critical FROM sums WHERE doc_id IS NOT NULL""", o.METRICS)  # fmt: skip


def status_events(s: SparkSession, d: str) -> DataFrame:
    """Status events of filings, a user's events being those of one filing."""
    #: What the types of events stand for.
    names = {"signup": "pending", "view": "processing", "click": "completed_with_errors", "error": "failed", "purchase": "completed"}
    status = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("event_type"))
    return t.load(s, d, "events").select(F.col("user_id").cast("string").alias("cik"), F.col("event_id").alias("accession_number"), status.alias("fetch_status"), F.col("ts").alias("created_at"))


_add("filing_states", lambda s, d: states.status_fold(status_events(s, d)).withColumn("changed_at", F.unix_micros("changed_at")), f""", e AS (SELECT user_id, list({{'s': CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'processing' WHEN 'click' THEN 'completed_with_errors' WHEN 'error' THEN 'failed' ELSE 'completed' END,
  'm': 0::bigint, 't': epoch_us(ts)}} ORDER BY ts, event_id) AS x FROM events GROUP BY 1),
r AS (SELECT user_id, len(x) AS n, list_reduce(x, lambda a, b: CASE WHEN (a.s || '>' || b.s) IN ({', '.join(repr(m) for m in states.MOVES)}) THEN {{'s': b.s, 'm': a.m + 1, 't': b.t}} ELSE a END, {{'s': '', 'm': 0::bigint, 't': NULL::bigint}}) AS f FROM e)
SELECT user_id::varchar AS cik, nullif(f.s, '') AS fetch_status, f.m AS moves, n - f.m AS illegal, n AS events, f.t AS changed_at FROM r""".lstrip(", ").join(["WITH ", ""]))  # fmt: skip

TOKENS = ["Revenue", "Costs", "Assets", "Liabilities", "Equity", "Cash Flow", "Other"]
_add("category_tokens", _facts(lambda f: f.select("cik", "period_end", "concept", exprs.category_token(F.concat(F.lit("This is "), F.regexp_replace("concept", "([a-z])([A-Z])", "$1 $2"), F.lit(". Cash Flow or Other"))).alias("category"))), """SELECT cik, period_end, concept,
CASE concept WHEN 'Revenues' THEN 'Revenue' WHEN 'CostOfRevenue' THEN 'Revenue' WHEN 'Assets' THEN 'Assets' WHEN 'StockholdersEquity' THEN 'Equity' ELSE 'Cash Flow' END AS category FROM facts""", t.FACTS)  # fmt: skip
_add("overridden_pages", lambda s, d: documents.page_selection(o.pages(s, d), 3, {2: 0.95, 4: 0.1}).select("doc_id", "page_num", "priority"), """SELECT doc_id, page_num, p AS priority FROM (SELECT doc_id, page_num, CASE WHEN page_num = 2 THEN 0.95 WHEN page_num = 4 THEN 0.1 WHEN page_num = 5 THEN 1.0 WHEN page_num IN (3, 6, 7) THEN 0.9
WHEN page_num <= 10 THEN 0.7 WHEN page_num <= 20 THEN 0.5 ELSE 0.3 END::double AS p FROM opages) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, page_num) <= 3""", o.PAGES)  # fmt: skip

_add("quantities", lambda s, d: documents.quantities(o.pages(s, d)).select("doc_id", "page_num", "name", "value"), """SELECT doc_id, page_num, name, q::double AS value FROM (SELECT *, CASE l_partkey % 8 WHEN 0 THEN 'units' WHEN 1 THEN 'units' WHEN 2 THEN 'gwh' WHEN 5 THEN 'vehicles' WHEN 7 THEN 'users' END AS name FROM olines)
WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, name ORDER BY page_num, row_num) = 1""", o.PAGES)  # fmt: skip


def headed_pages(s: SparkSession, d: str) -> DataFrame:
    """A page for each order of a customer, some with headings whose letters are set apart."""
    heads = ["O P E R A T I O N A L   S U M M A R Y", "Financial Summary", "E N E R G Y   &   S E R V I C E S", "the outlook", "C O R E   T E C H N O L O G Y", "O U T L O O K and FSD", "F I N A N C I A L", "nothing"]
    turn = o.Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return t.load(s, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.row_number().over(turn).alias("page_num"), F.get(F.array(*[F.lit(h) for h in heads]), (F.col("o_orderkey") % 8).cast("int")).alias("text"))


_add("heading_tags", lambda s, d: documents.heading_tags(headed_pages(s, d)).withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ",")), """SELECT doc_id, data_type, array_to_string(list_sort(list(page_num)), ',') AS pages FROM (
SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page_num, unnest([['operational_metrics'], ['financial'], ['segment_metrics'], ['guidance'], ['technology_metrics'], ['guidance', 'technology_metrics'], [], []][o_orderkey % 8 + 1]) AS data_type FROM orders) GROUP BY 1, 2""")  # fmt: skip

_add("extracted_share", lambda s, d: quality.extraction_rate(m := o.metrics(s, d).where("value > 0"), o.metrics(s, d).where(F.col("name").isin(o.NAMES[:12])), ["doc_id", "name"], ["doc_id"]), f"""SELECT doc_id, count(DISTINCT CASE WHEN value > 0 THEN name END) AS expected,
count(DISTINCT CASE WHEN k THEN name END) AS extracted, CASE WHEN count(DISTINCT CASE WHEN value > 0 THEN name END) > 0 THEN count(DISTINCT CASE WHEN k AND g THEN name END) / count(DISTINCT CASE WHEN value > 0 THEN name END) WHEN count(DISTINCT CASE WHEN k THEN name END) > 0 THEN 1.0 ELSE 0.0 END AS rate,
coalesce(rate >= 0.7, false) AS is_complete FROM (SELECT *, name IN {tuple(o.NAMES[:12])!r} AS k, bool_or(value > 0) OVER (PARTITION BY doc_id, name) AS g FROM om) GROUP BY 1 HAVING expected > 0 OR extracted > 0""", o.METRICS)  # fmt: skip
_add("mean_confidence", lambda s, d: reports.mean_confidence(o.metrics(s, d).withColumn("confidence", F.when(F.col("value") > 0, F.length("name") / 64))), "SELECT doc_id, avg(CASE WHEN value > 0 THEN length(name) / 64 END) AS confidence FROM om GROUP BY 1", o.METRICS)
_add("value_counts", lambda s, d: reports.value_counts(o.metrics(s, d), o.metrics(s, d).where("value > 0"), status_events(s, d).select(F.col("cik").cast("long").alias("doc_id"))), """SELECT doc_id, sum(n)::bigint AS points FROM (SELECT doc_id, count(*) + count(CASE WHEN value > 0 THEN 1 END) AS n FROM om GROUP BY 1
UNION ALL SELECT user_id, count(*) FROM events GROUP BY 1) GROUP BY 1""", o.METRICS)  # fmt: skip
_add("summary_with_axes", lambda s, d: views.data_summary(t.facts(s, d), t.segments(s, d)), """SELECT f.*, coalesce(axes, 0) AS axes, coalesce(segment_facts, 0) AS segment_facts FROM (SELECT cik, count(DISTINCT concept) AS concepts, count(*) AS facts, count(DISTINCT period_end) AS periods FROM facts GROUP BY 1) f
LEFT JOIN (SELECT cik, count(DISTINCT dimension_axis) AS axes, count(*) AS segment_facts FROM segments GROUP BY 1) s USING (cik)""", t.FACTS, t.SEGMENTS)  # fmt: skip
_add("listed_values", _facts(lambda f: reports.first_values(f.withColumn("ordinal", F.month("period_end") % 4 + F.length("concept") % 3), listed="ordinal")), """SELECT cik, entity_name, concept, cast(value AS double) AS value, unit, period_end FROM facts
QUALIFY row_number() OVER (PARTITION BY cik, concept ORDER BY month(period_end) % 4 + length(concept) % 3, period_end DESC) = 1""", t.FACTS)  # fmt: skip

SERIES = f""", s AS (SELECT cik AS doc_id, concept AS name, period_end AS period FROM facts WHERE NOT (cast(cik AS integer) % 4 = 1 AND month(period_end) = 6) AND NOT (cast(cik AS integer) % 4 = 2 AND concept = 'Assets' AND year(period_end) = 1996)),
gaps AS (SELECT doc_id, bool_or(gap) AS broken FROM (SELECT doc_id, period - lag(period) OVER (PARTITION BY doc_id, name ORDER BY period) > 100 AS gap FROM s) GROUP BY 1)
SELECT doc_id, CASE WHEN broken THEN 'time_series_continuity' ELSE '' END AS errors, '' AS warnings, NOT coalesce(broken, false) AS is_valid FROM gaps"""


def series(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, name, period): a company's facts as series, with a quarter missing in some and a year in others."""
    nk = F.col("cik").cast("int") % 4
    rows = t.facts(s, d).where(~((nk == 1) & (F.month("period_end") == 6)) & ~((nk == 2) & (F.col("concept") == "Assets") & (F.year("period_end") == 1996)))
    return rows.select(F.col("cik").alias("doc_id"), F.col("concept").alias("name"), F.col("period_end").alias("period"), "value")


_add("series_rules", lambda s, d: reports.run_rules(reports.rules(x := series(s, d), x).where("rule = 'time_series_continuity'"), x, x), SERIES, t.FACTS)
_add("company_health", lambda s, d: views.company_summary(f := t.facts(s, d), AS_OF, enrichments=f.select("cik", (F.col("cik").cast("int") * F.month("period_end")).alias("health_score"))).select("cik", "health_score"), f"SELECT cik, max(cast(cik AS integer) * month(period_end)) AS health_score FROM facts WHERE cik IN (SELECT cik FROM facts WHERE {NOW}) GROUP BY 1", t.FACTS)

_add("discovered_metrics", lambda s, d: mining.discovered_metrics(o.pages(s, d)))
_add("rule_categories", _facts(lambda f: segments.categorize_by_rules(f, {"Assets": "Assets"}, f.where("concept = 'NetIncomeLoss'").select("concept", F.lit("It is Equity, I think").alias("answer"))).groupBy("cik", "category").agg(F.count("*").alias("n"))), """SELECT cik,
CASE concept WHEN 'Assets' THEN 'Assets' WHEN 'NetIncomeLoss' THEN 'Equity' WHEN 'CostOfRevenue' THEN 'Costs' WHEN 'Revenues' THEN 'Revenue' WHEN 'StockholdersEquity' THEN 'Equity' ELSE 'Profitability' END AS category, count(*) AS n FROM facts GROUP BY 1, 2""", t.FACTS)  # fmt: skip
_add("placed_values", lambda s, d: extracted.route_values(extracted.json_leaves(responses(s, d))), """SELECT event_id AS doc_id, 1 AS page_num, 'revenue.total' AS path, 'revenue.total' AS target_path, cast(cast(value AS decimal(18,2)) AS double) AS value FROM events
UNION ALL SELECT event_id, 1, 'detail[0].k', 'other', cast(json_extract(props, '$.k') AS double) FROM events""")  # fmt: skip
_add("fallback_values", lambda s, d: extracted.fallback_values(t.load(s, d, "events").select(F.col("event_id").alias("doc_id"), F.lit(1).alias("page_num"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Revenue: $"), F.col("event_id"), F.lit(" and margin = 5."))).otherwise('{"revenue": 1}').alias("response"))), """SELECT event_id AS doc_id, 1 AS page_num,
unnest(['revenue', 'margin']) AS key, unnest([event_id::varchar, '5.']) AS value FROM events WHERE event_id % 2 = 0""")  # fmt: skip
_add("filing_texts", lambda s, d: readers.filing_text(x := t.load(s, d, "documents").select(F.col("source").alias("cik"), F.col("lang").alias("filing_date"), F.col("text").alias("full_text"), F.lit(None).cast("string").alias("management_discussion"), F.lit("risks").alias("risk_factors"), F.col("doc_id").alias("created_at")), x.where("filing_date <> 'en'"), 1000), """SELECT source AS cik, lang AS filing_date,
substr(arg_max(concat_ws(chr(10), text, 'risks'), doc_id), 1, 1000) AS text FROM documents WHERE lang <> 'en' AND source IS NOT NULL GROUP BY 1, 2""")  # fmt: skip

_add("segment_hierarchies", lambda s, d: mining.segment_hierarchies(reports.segment_names(r.pages(s, d))), r.VARIED + "SELECT doc_id, CASE WHEN nk % 3 = 0 THEN 'Geographic Revenue' ELSE 'Product/Service Revenue' END AS parent, CASE WHEN nk % 3 = 0 THEN 'Asia' ELSE 'Cloud' END AS children, CASE WHEN nk % 3 = 0 THEN 'geographic_segments' ELSE 'product_segments' END AS kind FROM docs", *r.SOURCES)
_add("document_analysis", lambda s, d: jobs.analyze_documents(r.pages(s, d)).withColumns({"data_types": F.array_join("data_types", ","), "visual_pages": F.size("visual_pages")}), r.VARIED + """SELECT doc_id, NULL::varchar AS company, NULL::varchar AS period, 'report' AS doc_type, CASE WHEN nk % 3 = 0 THEN 'financial,guidance,operational,segment' ELSE 'operational,segment' END AS data_types,
0 AS visual_pages, 3 AS page_count, CASE WHEN mo = 3 THEN 'automotive' ELSE 'general' END AS business_model, mo = 3 AS has_operational_metrics, nk % 2 = 0 OR regexp_matches(nk::varchar, '20[0-9]{2}') AS has_time_series FROM docs""", *r.SOURCES)  # fmt: skip


def page_responses(s: SparkSession, d: str) -> DataFrame:
    """Saved responses of three pages of each report."""
    said = F.array(*[F.struct(F.lit(n).alias("page_num"), F.lit(x).alias("response")) for n, x in ((4, '{"total_revenue": "11"}'), (8, '{"margin": "3"}'), (9, '{"energy_segment": {"gwh": "7"}}'))])
    return r.varied(s, d).select("doc_id", F.explode(said).alias("p")).select("doc_id", "p.*")


_add("gap_filled", lambda s, d: jobs.fill_gaps(r.pages(s, d), page_responses(s, d)), r.VARIED + r.MINED + """SELECT doc_id, name, value::double AS value, 'primary' AS source FROM mined UNION ALL SELECT doc_id, 'revenue.total', 11, 'secondary' FROM docs
UNION ALL SELECT doc_id, 'segments', 7, 'secondary' FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM mined WHERE name = 'storage_deployed_gwh')""", *r.SOURCES)  # fmt: skip

__all__ = ["ORACLES", "QUERIES"]  # those of the modules before and of this one
