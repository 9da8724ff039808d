"""Queries over whole reports, their pages composed from the financial model with varying figures, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions import exprs
from ledgerspark.operators import documents, extracted, quality, reports, views
from ledgerspark.queries import DOCS, MODEL, ORACLES, QUERIES, _add, _facts
from ledgerspark.sources import testtables as t


def varied(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, nk, mo, r, o): the report of a company and period, with the numbers that its pages vary by."""
    m = views.financial_model(t.facts(s, d)).where("revenue is not null")
    whole = lambda c: F.floor(F.col(c)).cast("long").alias(c[0])
    return m.select(F.concat_ws("/", "cik", F.col("period_end").cast("string")).alias("doc_id"), F.col("cik").cast("int").alias("nk"), F.month("period_end").alias("mo"), whole("revenue"), whole("operating_income"))


def pages(s: SparkSession, d: str) -> DataFrame:
    """Three pages a report: text with deliveries and storage in some, energy tables in some, a table of segments."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) and not p.startswith("$") else F.col(p[1:]).cast("string") for p in parts])
    row = lambda *cells: F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells])
    nothing = F.array().cast("array<array<array<string>>>")
    first = F.concat(
        text("Total revenue was $", "$r", " million. "), F.when(F.col("mo") == 3, F.concat(F.lit("Deliveries: "), (F.col("nk") * 100).cast("string"), F.lit(" units. "))).otherwise(""),
        F.when(F.col("mo").isin(3, 6), text("Storage reached ", "$nk", ".5 GWh. ")).otherwise(""), F.when(F.col("nk") % 3 == 0, "Asia sales grew; financial results and outlook.").otherwise("Cloud sales fell; key metrics."),
    )
    energy = F.array(F.array(row("Energy", "Share", "Q1"), row("Storage deployed (GWh)", "12%", text("$nk", ".25")), row("Solar deployed (MW)", "3%", (F.col("nk") + 10).cast("string"))))
    share = F.array(F.array(row("Revenue by segment", "Gross profit"), row("United States", F.concat(F.lit("("), F.col("nk").cast("string"), F.lit(")"))), row("Europe", F.col("mo").cast("string"))))
    page = lambda n, x, tab: F.struct(F.lit(n).alias("page_num"), x.alias("text"), tab.alias("tables"))
    every = F.array(page(1, first, nothing), page(2, F.lit("Operational highlights"), F.when(F.col("nk") % 2 == 0, energy).otherwise(nothing)), page(3, F.lit("Segment information"), share))
    return varied(s, d).select("doc_id", F.explode(every).alias("p")).select("doc_id", "p.*", F.lit(0).alias("image_count"))


def metrics(s: SparkSession, d: str) -> DataFrame:
    """Metric rows with gaps, wrong sums and odd percentages in some reports."""
    one = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("double").alias("value"))
    nk, mo, r = F.col("nk"), F.col("mo"), F.col("r")
    every = F.array_compact(F.array(
        one("total_revenue", r), one("automotive_revenue", F.floor(r / 2)), one("energy_revenue", F.when(nk % 5 == 0, F.lit(0)).otherwise(r - F.floor(r / 2))),
        F.when(nk % 2 == 0, one("storage_deployed_gwh", nk)), F.when(mo == 3, one("deliveries_total", nk * 100)), F.when(nk % 7 == 0, one("operating_margin", nk * mo)),
        F.when(nk % 3 == 0, one("europe", mo)), one("gross_margin", F.lit(50) + nk % 2 * 3), one("cost_of_revenue", F.floor(r / 2)),
    ))
    return varied(s, d).select("doc_id", F.explode(every).alias("m")).select("doc_id", "m.name", "m.value", F.lit(1).alias("page_num"), F.lit("table").alias("source"))


def fuller_metrics(s: SparkSession, d: str) -> DataFrame:
    """The metric rows, and in every fourth report all required ones, but for the deliveries in every eighth."""
    names = F.array(*[F.lit(n) for ns in reports.REQUIRED.values() for n in ns])
    more = varied(s, d).where("nk % 4 = 0").select("doc_id", "nk", F.explode(names).alias("name")).where("nk % 8 = 0 or name <> 'deliveries_total'")
    return metrics(s, d).unionByName(more.select("doc_id", "name", F.lit(1.0).alias("value"), F.lit(1).alias("page_num"), F.lit("table").alias("source")))


def fewer_pages(s: SparkSession, d: str) -> DataFrame:
    """The pages without the third in every fourth report."""
    return pages(s, d).where("page_num < 3 or cast(substring(doc_id, 1, 10) AS int) % 4 > 0")


VARIED = DOCS.replace("floor(operating_income) AS o FROM", "floor(operating_income) AS o, cast(cik AS integer) AS nk, month(period_end) AS mo FROM")
MINED = """, mined AS (SELECT doc_id, 'storage_deployed_gwh' AS name, nk + 0.25::double AS value, 2 AS page_num, 'table' AS source FROM docs WHERE nk % 2 = 0 UNION ALL SELECT doc_id, 'solar_deployed_mw', nk + 10, 2, 'table' FROM docs WHERE nk % 2 = 0
UNION ALL SELECT doc_id, 'storage_deployed_gwh', nk + 0.5::double, 1, 'text_extraction' FROM docs WHERE nk % 2 = 1 AND mo IN (3, 6) UNION ALL SELECT doc_id, 'deliveries_total', nk * 100, 1, 'text_extraction' FROM docs WHERE mo = 3 AND nk * 100 > 1000) """
METRICS = """, ms AS (SELECT doc_id, name, value::double AS value FROM (
SELECT doc_id, nk, mo, unnest(['total_revenue', 'automotive_revenue', 'energy_revenue', 'storage_deployed_gwh', 'deliveries_total', 'operating_margin', 'europe', 'gross_margin', 'cost_of_revenue']) AS name,
unnest([r, floor(r / 2), CASE WHEN nk % 5 = 0 THEN 0 ELSE r - floor(r / 2) END, nk, nk * 100, nk * mo, mo, 50 + nk % 2 * 3, floor(r / 2)]) AS value FROM docs)
WHERE (name <> 'storage_deployed_gwh' OR nk % 2 = 0) AND (name <> 'deliveries_total' OR mo = 3) AND (name <> 'operating_margin' OR nk % 7 = 0) AND (name <> 'europe' OR nk % 3 = 0)) """
REQUIRED = ", ".join(f"('{c}', '{n}')" for c, ns in reports.REQUIRED.items() for n in ns)
SOURCES = (t.FACTS, MODEL)

_add("mined_metrics", lambda s, d: reports.mined_metrics(pages(s, d)), VARIED + MINED + "SELECT * FROM mined", *SOURCES)
_add("found_flags", lambda s, d: reports.found_flags(metrics(s, d)), VARIED + METRICS + f"""SELECT doc_id, category, count(value) > 0 AS found, coalesce(array_to_string(list_sort(list(v.name) FILTER (value IS NULL)), ','), '') AS missing
FROM (SELECT DISTINCT doc_id FROM ms) CROSS JOIN (VALUES {REQUIRED}) v(category, name) LEFT JOIN ms USING (doc_id, name) GROUP BY 1, 2""", *SOURCES)  # fmt: skip
COVER = f", cover AS (SELECT doc_id, count(*)::integer AS found, bool_or(name = 'deliveries_total') AS d, bool_or(name = 'storage_deployed_gwh') AS g FROM ms WHERE name IN (SELECT name FROM (VALUES {REQUIRED}) v(category, name)) GROUP BY 1) "
FULLER = f""", fuller AS (SELECT doc_id, name FROM ms UNION SELECT doc_id, name FROM docs, (VALUES {REQUIRED}) v(category, name) WHERE nk % 4 = 0 AND (nk % 8 = 0 OR name <> 'deliveries_total')),
covered AS (SELECT doc_id, count(*)::integer AS found, bool_or(name = 'deliveries_total') AS d, bool_or(name = 'storage_deployed_gwh') AS g, bool_or(name = 'total_revenue') AS t FROM fuller WHERE name IN (SELECT name FROM (VALUES {REQUIRED}) v(category, name)) GROUP BY 1) """
_add("category_coverage", lambda s, d: reports.category_coverage(fuller_metrics(s, d)), VARIED + METRICS + FULLER + """SELECT doc_id, found, 19 AS total, found / 19 AS score,
concat_ws(', ', CASE WHEN NOT d THEN 'Vehicle deliveries' END, CASE WHEN NOT g THEN 'Energy storage metrics' END, CASE WHEN NOT t THEN 'Revenue breakdown by segment' END) AS critical_missing, found / 19 >= 0.8 AND d AND g AND t AS is_complete FROM covered""", *SOURCES)  # fmt: skip
_add("target_pages", lambda s, d: reports.target_pages(metrics(s, d)).select("doc_id", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages")), VARIED + """SELECT doc_id, '1,2,3,6' || CASE WHEN nk % 2 = 1 THEN ',9,10,11' ELSE '' END
|| CASE WHEN nk % 3 <> 0 THEN ',25,26,27' ELSE '' END AS pages FROM docs""", *SOURCES)  # fmt: skip
_add("valid_pages", lambda s, d: reports.valid_pages(fewer_pages(s, d), reports.target_pages(metrics(s, d)).withColumn("pages", F.filter("pages", lambda x: x > 1))).select("doc_id", "page_num"), VARIED + "SELECT doc_id, unnest(CASE WHEN nk % 4 > 0 THEN [2, 3] ELSE [2] END) AS page_num FROM docs", *SOURCES)
GROUPS = ", gs AS (SELECT doc_id, 1 AS page_num, CASE WHEN nk % 3 = 0 THEN 'financial,guidance' ELSE 'operational' END AS data_types FROM docs UNION ALL SELECT doc_id, 2, 'operational' FROM docs UNION ALL SELECT doc_id, 3, 'segment' FROM docs) "
_add("page_groups", lambda s, d: reports.page_groups(documents.sections(pages(s, d))), VARIED + GROUPS + "SELECT * FROM gs", *SOURCES)
_add("extraction_plan", lambda s, d: documents.sections(pages(s, d)).select("doc_id", "data_type", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"), "priority"), VARIED + """SELECT doc_id, 'financial' AS data_type, '1' AS pages, 'high' AS priority FROM docs WHERE nk % 3 = 0
UNION ALL SELECT doc_id, 'guidance', '1', 'medium' FROM docs WHERE nk % 3 = 0 UNION ALL SELECT doc_id, 'operational', CASE WHEN nk % 3 = 0 THEN '2' ELSE '1,2' END, 'high' FROM docs UNION ALL SELECT doc_id, 'segment', '3', 'medium' FROM docs""", *SOURCES)  # fmt: skip
_add("target_tables", lambda s, d: reports.target_tables(pages(s, d)), VARIED + """SELECT doc_id, 2 AS page_num, 0 AS table_num, 'energy_metrics' AS target FROM docs WHERE nk % 2 = 0 UNION ALL SELECT doc_id, 3, 0, 'financial_summary' FROM docs
UNION ALL SELECT doc_id, 3, 0, 'geographic_segments' FROM docs""", *SOURCES)  # fmt: skip
_add("revenue_rows", lambda s, d: reports.revenue_rows(pages(s, d)), VARIED + "SELECT doc_id, 3 AS page_num, 0 AS table_num, 1 AS row_num, 'United States|(' || nk || ')' AS cells FROM docs UNION ALL SELECT doc_id, 3, 0, 2, 'Europe|' || mo FROM docs", *SOURCES)
_add("segment_table_rows", lambda s, d: documents.segment_rows(pages(s, d)), VARIED + "SELECT doc_id, 3 AS page_num, 'united_states' AS segment, 'product' AS segment_type, (-nk)::double AS value FROM docs UNION ALL SELECT doc_id, 3, 'europe', 'product', mo FROM docs", *SOURCES)
_add("segment_names", lambda s, d: reports.segment_names(pages(s, d)), VARIED + "SELECT doc_id, CASE WHEN nk % 3 = 0 THEN 'Asia' ELSE 'Cloud' END AS segment FROM docs", *SOURCES)
_add("hierarchies", lambda s, d: reports.hierarchies(metrics(s, d)), VARIED + "SELECT doc_id, 'total_revenue' AS parent, 'automotive_revenue,energy_revenue' AS children FROM docs UNION ALL SELECT doc_id, 'geographic', 'europe' FROM docs WHERE nk % 3 = 0", *SOURCES)
_add("document_rules", lambda s, d: reports.rules(metrics(s, d)), VARIED + """SELECT doc_id, unnest(['sum_to_parent', 'percentage_range', 'segment_completeness']) AS rule, unnest([0.01, 100, NULL])::double AS tolerance, unnest([true, false, true]) AS required FROM docs
UNION ALL SELECT doc_id, 'margin_calculation', 0.005, false FROM docs WHERE nk % 7 = 0""", *SOURCES)  # fmt: skip
RULES = ", ran AS (SELECT doc_id, CASE WHEN nk % 5 <> 0 THEN '' WHEN ceil(r / 2) > 0.01 * r THEN 'segment_completeness,sum_to_parent' ELSE 'segment_completeness' END AS errors, concat_ws(',', CASE WHEN nk % 7 = 0 AND nk % 2 = 1 THEN 'margin_calculation' END, CASE WHEN nk % 7 = 0 AND nk * mo > 100 THEN 'percentage_range' END) AS warnings FROM docs) "
_add("rule_results", lambda s, d: reports.run_rules(reports.rules(m := metrics(s, d)), m), VARIED + RULES + "SELECT *, errors = '' AS is_valid FROM ran", *SOURCES)
_add("margin_check", lambda s, d: quality.margin_check(metrics(s, d)), VARIED + "SELECT doc_id, (50 + nk % 2 * 3)::double AS gross_margin, (r - floor(r / 2)) / r * 100 AS recomputed, abs((r - floor(r / 2)) / r * 100 - (50 + nk % 2 * 3)) < 1 AS is_valid FROM docs", *SOURCES)
_add("expected_fields", lambda s, d: reports.expected_fields(documents.sections(pages(s, d))), VARIED + f"""SELECT doc_id, category || '.' || name AS path,
CASE category WHEN 'margins' THEN 'percentage' WHEN 'vehicle_metrics' THEN 'count' WHEN 'energy_metrics' THEN regexp_extract(name, '[a-z]+$') ELSE 'millions' END AS unit,
CASE WHEN category = 'geographic_segments' THEN 3 WHEN category LIKE '%\\_metrics' ESCAPE '\\' AND nk % 3 = 0 THEN 2 ELSE 1 END AS page_num
FROM docs, (VALUES {REQUIRED}) v(category, name) WHERE category NOT IN ('financial_segments', 'margins') OR nk % 3 = 0""", *SOURCES)  # fmt: skip
_add("first_values", _facts(lambda f: reports.first_values(f)), """SELECT cik, entity_name, concept, cast(value AS double) AS value, unit, period_end FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY concept) AS k FROM (
SELECT * FROM facts QUALIFY row_number() OVER (PARTITION BY cik, concept ORDER BY period_end DESC) = 1)) WHERE k <= 100""", t.FACTS)  # fmt: skip
KEY = ", ".join(f"'{c}'" for c in reports.KEY_METRICS)
_add("key_metrics", _facts(reports.key_metrics), f"""SELECT cik, concept, CASE WHEN v > 1000000 THEN format('{{:,.1f}}M', v / 1000000) ELSE format('{{:,.2f}}', v) END AS shown, unit, period_end
FROM (SELECT *, cast(value AS double) AS v FROM facts WHERE concept IN ({KEY}) QUALIFY row_number() OVER (PARTITION BY cik, concept ORDER BY period_end DESC) = 1)""", t.FACTS)  # fmt: skip
_add("enrichment_messages", lambda s, d: reports.enrichment_messages(t.facts(s, d), t.segments(s, d)), """SELECT f.cik, sample_facts, axes FROM (SELECT cik, string_agg(concept || '=' || period_end, ';' ORDER BY period_end, concept) AS sample_facts FROM (
SELECT * FROM facts QUALIFY row_number() OVER (PARTITION BY cik ORDER BY period_end, concept) <= 10) GROUP BY 1) f LEFT JOIN (SELECT cik, array_to_string(list_sort(list(DISTINCT dimension_axis)), ',') AS axes FROM segments GROUP BY 1) g ON f.cik = g.cik""", t.FACTS, t.SEGMENTS)  # fmt: skip
_add("facts_of_companies", lambda s, d: reports.of_companies(t.facts(s, d), t.load(s, d, "supplier").where("s_nationkey % 5 = 1").select(F.col("s_suppkey").cast("string").alias("cik"))).groupBy("cik").agg(F.count("*").alias("n")), "SELECT cik, count(*) AS n FROM facts WHERE cast(cik AS integer) IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 5 = 1) GROUP BY 1", t.FACTS)


def structured(s: SparkSession, d: str) -> DataFrame:
    """Structured responses: figures with signs, percent signs, suffixes and missing parts."""
    nk, mo, r = (F.col(c).cast("string") for c in ("nk", "mo", "r"))
    energy = F.when(F.col("nk") % 2 == 0, F.concat(F.lit('"storage_gwh": "'), nk, F.lit('.25"'))).otherwise("")
    text = F.concat(F.lit('{"revenue": {"total": "$'), r, F.lit('M", "segments": {"energy_storage": "('), nk, F.lit(')", "services": null}}, "margins": {"Gross": "'), mo, F.lit('%"}, "operational": {"Energy": {'), energy, F.lit('}}, "geographic": {"north_america": "'), nk, F.lit('B"}}'))
    return varied(s, d).select("doc_id", text.alias("response"))


_add("structured_rows", lambda s, d: reports.structured_rows(structured(s, d)), VARIED + """SELECT doc_id, 'revenue' AS section, 'total_revenue' AS name, r::double AS value FROM docs UNION ALL SELECT doc_id, 'segments', 'Energy Storage', -nk FROM docs
UNION ALL SELECT doc_id, 'margins', 'gross', mo FROM docs UNION ALL SELECT doc_id, 'geographic', 'North America', nk * 1000 FROM docs UNION ALL SELECT doc_id, 'operational', 'energy_storage_gwh', nk + 0.25 FROM docs WHERE nk % 2 = 0""", *SOURCES)  # fmt: skip


def saved(s: SparkSession, d: str) -> DataFrame:
    """Saved responses: of the first page, blank in spring; of the second, blank or missing in two reports of three."""
    nk, page = F.col("nk") % 3, lambda n, x: F.struct(F.lit(n).alias("page_num"), x.alias("response"))
    both = F.array(page(1, F.when(F.col("mo") == 3, " ").otherwise("{}")), page(2, F.when(nk == 0, "{}").otherwise(" ")))
    return varied(s, d).select("doc_id", "nk", F.explode(both).alias("p")).where("p.page_num = 1 or nk % 3 < 2").select("doc_id", "p.*")


def leaves(s: SparkSession, d: str) -> DataFrame:
    return extracted.json_leaves(structured(s, d).withColumn("page_num", F.lit(1)))


_add("structure_score", lambda s, d: reports.structure_score(leaves(s, d).where("cast(substring(doc_id, 1, 10) AS int) % 3 > 0 or not path like '%.%.%'"), metrics(s, d).withColumn("value", F.when(F.col("name") != "europe", F.col("value")))), VARIED + METRICS + """SELECT doc_id, CASE WHEN cast(substr(doc_id, 1, 10) AS integer) % 3 > 0 THEN 3 ELSE 2 END AS depth, count(*) AS metric_count, (1 + count(CASE WHEN name <> 'europe' THEN 1 END) / count(*)) / 2 AS score FROM ms GROUP BY 1""", *SOURCES)
_add("validation_report", lambda s, d: reports.validation_report(leaves(s, d), metrics(s, d)), VARIED + METRICS + COVER + RULES + """SELECT doc_id, 1.0::double AS structure, found / 19 AS coverage, concat_ws(', ', CASE WHEN NOT d THEN 'Vehicle deliveries' END, CASE WHEN NOT g THEN 'Energy storage metrics' END) AS critical_missing,
errors, warnings, errors = '' AS is_valid, (1 + found / 19 + (errors = '')::int) / 3 AS overall, (1 + found / 19 + (errors = '')::int) / 3 >= 0.7 AS is_complete FROM cover JOIN ran USING (doc_id)""", *SOURCES)  # fmt: skip
_add("document_advice", lambda s, d: reports.advice(reports.validation_report(leaves(s, d), metrics(s, d)).select("doc_id", F.col("overall").alias("score"), "errors", F.size(F.filter(F.split("warnings", ","), lambda x: x != "")).alias("issues"), F.lit("traditional").alias("method"), F.lit("platform").alias("business_model"))), VARIED + METRICS + COVER + RULES + """SELECT doc_id,
concat_ws('; ', CASE WHEN x < 0.7 THEN 'low completeness' END, CASE WHEN errors <> '' THEN 'hierarchy errors' END, CASE WHEN warnings <> '' THEN len(string_split(warnings, ',')) || ' quality issues' END, 'traditional extraction', CASE WHEN x < 0.8 THEN 'check metrics of platform' END) AS advice
FROM (SELECT doc_id, errors, warnings, (1 + found / 19 + (errors = '')::int) / 3 AS x FROM cover JOIN ran USING (doc_id))""", *SOURCES)  # fmt: skip
_add("typed_fields", lambda s, d: reports.typed_fields(leaves(s, d), reports.page_groups(documents.sections(pages(s, d)))), VARIED + """, leaf AS (SELECT doc_id, nk, unnest(['revenue.total', 'revenue.segments.energy_storage', 'margins.Gross', 'operational.Energy.storage_gwh', 'geographic.north_america']) AS path,
unnest(['$' || r::bigint || 'M', '(' || nk || ')', mo || '%', CASE WHEN nk % 2 = 0 THEN nk || '.25' END, nk || 'B']) AS value FROM docs)
SELECT doc_id, unnest(CASE WHEN nk % 3 = 0 THEN ['financial', 'guidance'] ELSE ['operational'] END) AS data_type, path, value FROM leaf WHERE value IS NOT NULL""", *SOURCES)  # fmt: skip
_add("extraction_summary", lambda s, d: reports.extraction_summary(reports.page_groups(documents.sections(fewer_pages(s, d))), saved(s, d)), VARIED + """SELECT doc_id, CASE WHEN nk % 4 > 0 THEN 3 ELSE 2 END AS requested,
(mo > 3)::int + (nk % 3 = 0)::int AS processed, (mo = 3)::int + (nk % 3 = 1)::int AS errors FROM docs""", *SOURCES)  # fmt: skip
_add("metric_classes", lambda s, d: documents.mentions(pages(s, d), documents.MONEY).select("doc_id", exprs.financial_class(F.col("context")).alias("class"), exprs.operational_class(F.col("context"), F.col("hit")).alias("operational")), VARIED + "SELECT doc_id, 'total_revenue' AS class, CASE WHEN mo = 3 THEN 'vehicle_deliveries' END AS operational FROM docs", *SOURCES)
_add("selected_pages", lambda s, d: documents.page_selection(fewer_pages(s, d), 2).select("doc_id", "page_num", "priority"), VARIED + "SELECT doc_id, unnest(CASE WHEN nk % 4 > 0 THEN [3, 1] ELSE [1, 2] END) AS page_num, unnest(CASE WHEN nk % 4 > 0 THEN [0.9, 0.7] ELSE [0.7, 0.7] END)::double AS priority FROM docs", *SOURCES)
_add("request_keys", lambda s, d: pages(s, d).select("doc_id", "page_num", exprs.request_key(F.col("doc_id"), F.col("page_num"), F.lit("extract")).alias("key")), VARIED + "SELECT doc_id, p AS page_num, md5(doc_id || ':' || p || ':extract') AS key FROM docs, (VALUES (1), (2), (3)) v(p)", *SOURCES)

__all__ = ["ORACLES", "QUERIES"]  # those of ``queries`` and of this module
