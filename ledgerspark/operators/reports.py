"""Report documents as a whole: miners with text fallback, target tables and pages, coverage, rules, the report.

Metric rows are (doc_id, name, value, page_num, source); leaves are those of ``extracted.json_leaves``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import dbl, is_number, number, title
from ledgerspark.operators import documents, quality

#: The metrics a complete report has, by category.
REQUIRED = {
    "vehicle_metrics": ["production_model_3y", "production_model_sx", "production_total", "deliveries_model_3y", "deliveries_model_sx", "deliveries_total"],
    "energy_metrics": ["storage_deployed_gwh", "solar_deployed_mw"],
    "financial_segments": ["automotive_revenue", "energy_revenue", "services_revenue", "total_revenue"],
    "geographic_segments": ["united_states", "china", "europe", "other"],
    "margins": ["total_gross_margin", "automotive_gross_margin", "operating_margin"],
}
#: Metrics without which a report is not complete, and what is said to be missing.
CRITICAL = {"deliveries_total": "Vehicle deliveries", "storage_deployed_gwh": "Energy storage metrics", "total_revenue": "Revenue breakdown by segment"}
#: Pages on which a missing category is looked for, and those looked at in any case.
CATEGORY_PAGES = {"energy_metrics": [9, 10, 11], "financial_segments": [4, 5, 23, 24], "geographic_segments": [25, 26, 27]}
SUMMARY_PAGES = [1, 2, 3, 6]
#: Patterns of segment names in text.
SEGMENT_NAMES = [
    r"(?i)([\w\s]+)\s+revenue\s*:?\s*\$?\s*\d+",
    r"(?i)revenue\s+by\s+([\w\s]+)",
    r"(?i)(automotive|energy|services?|products?|software|hardware|cloud|retail|wholesale)\s+(?:revenue|sales)",
    r"(?i)(united states|us|china|europe|asia|americas?|emea|apac)\s+(?:revenue|sales)",
]


def energy_metrics(pages: DataFrame) -> DataFrame:
    """Storage (GWh) and solar (MW) rows of tables: the first numeric cell that is no percentage; the last row of a
    document counts."""
    rows = documents.table_rows(pages)
    text = F.lower(F.array_join("row", " "))
    name = F.when(F.contains(text, F.lit("storage")) & F.contains(text, F.lit("gwh")), "storage_deployed_gwh").when(F.contains(text, F.lit("solar")) & F.contains(text, F.lit("mw")), "solar_deployed_mw")
    cell = F.try_element_at(F.filter("row", lambda c: is_number(c) & ~F.trim(c).endswith("%")), F.lit(1))
    found = rows.select("doc_id", "page_num", F.struct("table_num", "row_num").alias("offset"), name.alias("name"), number(cell).alias("value"))
    return documents.last_by_name(found.where("name is not null and value is not null")).select("doc_id", "name", "value", "page_num", F.lit("table").alias("source"))


def text_fallback(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Storage from the first page whose text names GWh, where ``found`` has none; deliveries over 1000 from the last
    page that names them."""
    gwh = F.nullif(F.regexp_extract("text", r"(?i)(\d+\.?\d*)\s*GWh", 1), F.lit("")).cast("double")
    sent = number(F.nullif(F.regexp_extract("text", r"(?i)deliver(?:ies|ed)\s*:?\s*([\d,]+)", 1), F.lit("")))
    met = pages.select("doc_id", "page_num", gwh.alias("gwh"), sent.alias("sent"))
    storage = met.where("gwh is not null").groupBy("doc_id").agg(F.min_by("gwh", "page_num").alias("value"), F.min("page_num").alias("page_num"))
    storage = storage.join(found.where("name = 'storage_deployed_gwh'").select("doc_id").distinct().hint("merge"), "doc_id", "left_anti")
    sent = met.where("sent > 1000").groupBy("doc_id").agg(F.max_by("sent", "page_num").alias("value"), F.max("page_num").alias("page_num"))
    shape = lambda df, name: df.select("doc_id", F.lit(name).alias("name"), "value", "page_num", F.lit("text_extraction").alias("source"))
    return shape(storage, "storage_deployed_gwh").unionByName(shape(sent, "deliveries_total"))


def mined_metrics(pages: DataFrame) -> DataFrame:
    """Table rows first, text where tables lack them."""
    found = energy_metrics(pages)
    return found.unionByName(text_fallback(pages, found))


def found_flags(metrics: DataFrame) -> DataFrame:
    """(doc_id, category, found, missing): whether any metric of a category was found, and the names that were not."""
    wanted = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(n).alias("name")) for c, names in REQUIRED.items() for n in names])
    every = metrics.select("doc_id").distinct().select("doc_id", F.explode(wanted).alias("w")).select("doc_id", "w.*")
    have = metrics.where("value is not null").select("doc_id", "name").distinct().withColumn("got", F.lit(1))
    both = every.join(have.hint("merge"), ["doc_id", "name"], "left")
    return both.groupBy("doc_id", "category").agg((F.count("got") > 0).alias("found"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("got").isNull(), F.col("name")))), ",").alias("missing"))


def category_coverage(metrics: DataFrame) -> DataFrame:
    """(doc_id, found, total, score, critical_missing, is_complete): share of the required metrics; complete from 0.8
    and with all critical ones."""
    names = metrics.where("value is not null").groupBy("doc_id").agg(F.collect_set("name").alias("names"))
    wanted = [n for ns in REQUIRED.values() for n in ns]
    have = F.size(F.array_intersect("names", F.array(*[F.lit(n) for n in wanted])))
    gaps = F.array_compact(F.array(*[F.when(~F.array_contains("names", n), F.lit(said)) for n, said in CRITICAL.items()]))
    out = names.select("doc_id", have.alias("found"), F.lit(len(wanted)).alias("total"), (have / len(wanted)).alias("score"), gaps.alias("gaps"))
    return out.select("doc_id", "found", "total", "score", F.array_join("gaps", ", ").alias("critical_missing"), ((F.col("score") >= 0.8) & (F.size("gaps") == 0)).alias("is_complete"))


def target_pages(metrics: DataFrame) -> DataFrame:
    """(doc_id, pages): sorted pages on which what is missing may stand. Storage is missed by name, other categories
    when they have no metric."""
    names = metrics.where("value is not null").groupBy("doc_id").agg(F.collect_set("name").alias("names"))
    any_of = lambda c: F.arrays_overlap("names", F.array(*[F.lit(n) for n in REQUIRED[c]]))
    lack = {"energy_metrics": ~F.array_contains("names", "storage_deployed_gwh"), "financial_segments": ~any_of("financial_segments"), "geographic_segments": ~any_of("geographic_segments")}
    none = F.array().cast("array<int>")
    pages = F.concat(F.array(*[F.lit(p) for p in SUMMARY_PAGES]), *[F.when(lack[c], F.array(*[F.lit(p) for p in ps])).otherwise(none) for c, ps in CATEGORY_PAGES.items()])
    return names.select("doc_id", F.sort_array(F.array_distinct(pages)).alias("pages"))


def valid_pages(pages: DataFrame, wanted: DataFrame | None = None, first: int = 15) -> DataFrame:
    """The pages that ``wanted`` (doc_id, pages) names and that exist; without it the first ``first``."""
    if wanted is None:
        return pages.where(F.col("page_num") <= first)
    return pages.join(wanted.select("doc_id", F.explode("pages").alias("page_num")).hint("merge"), ["doc_id", "page_num"], "left_semi")


def page_groups(sections: DataFrame) -> DataFrame:
    """(doc_id, page_num, data_types): what is asked of each page of an extraction plan (``documents.sections``)."""
    rows = sections.select("doc_id", "data_type", F.explode("pages").alias("page_num"))
    return rows.groupBy("doc_id", "page_num").agg(F.array_join(F.sort_array(F.collect_set("data_type")), ",").alias("data_types"))


def target_tables(pages: DataFrame, sample: int = 3) -> DataFrame:
    """(doc_id, page_num, table_num, target): tables that hold wanted data, by header and first rows."""
    t = pages.select("doc_id", "page_num", F.posexplode("tables").alias("table_num", "t")).where(F.size("t") > 0)
    head, body = F.lower(F.array_join(F.get("t", F.lit(0)), " ")), F.lower(F.array_join(F.flatten(F.slice("t", 2, sample)), " "))
    has = lambda c, *words: [F.contains(c, F.lit(w)) for w in words]
    a, b, c = has(head, "revenue", "gross profit", "operating")
    production, deliveries, model, gwh, mwh, storage, cars, energy, services = has(body, "production", "deliveries", "model", "gwh", "mwh", "storage", "automotive", "energy", "services")
    flags = {
        "financial_summary": a & (b | c), "vehicle_metrics": (production | deliveries) & model, "energy_metrics": (gwh | mwh) & storage,
        "geographic_segments": body.rlike("united states|china|europe|other"), "product_segments": cars & energy & services,
    }
    return t.select("doc_id", "page_num", "table_num", F.explode(F.array_compact(F.array(*[F.when(f, F.lit(n)) for n, f in flags.items()]))).alias("target"))


def revenue_rows(pages: DataFrame) -> DataFrame:
    """Body rows, as text, of tables that name revenue or segments."""
    rows = documents.table_rows(pages).where("row_num > 0")
    return rows.where(F.lower(F.array_join("header", " ")).rlike("revenue|segment")).select("doc_id", "page_num", "table_num", "row_num", F.array_join("row", "|").alias("cells"))


def segment_names(pages: DataFrame) -> DataFrame:
    """(doc_id, segment): distinct names of segments in the text, by four patterns."""
    found = F.flatten(F.array(*[F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in SEGMENT_NAMES]))
    return pages.select("doc_id", F.explode_outer(F.transform(found, F.trim)).alias("segment")).where("segment <> ''").distinct()


def hierarchies(metrics: DataFrame) -> DataFrame:
    """(doc_id, parent, children): the parts found of each total; a total without parts is none."""
    rules = [("total_revenue", n) for n in REQUIRED["financial_segments"] if n != "total_revenue"] + [("geographic", n) for n in REQUIRED["geographic_segments"]]
    rules = F.broadcast(metrics.sparkSession.createDataFrame(rules, "parent string, name string"))  # a fixed list
    return metrics.join(rules, "name").groupBy("doc_id", "parent").agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("children"))


def expected_fields(sections: DataFrame) -> DataFrame:
    """(doc_id, path, unit, page_num): a field for each required metric of the sections a document has, on the first
    page of the section."""
    kinds = {"financial": ["financial_segments", "margins"], "operational": ["vehicle_metrics", "energy_metrics"], "segment": ["geographic_segments"]}
    rows = [(k, f"{c}.{n}", "percentage" if c == "margins" else "count" if c == "vehicle_metrics" else n.rpartition("_")[2] if c == "energy_metrics" else "millions") for k, cs in kinds.items() for c in cs for n in REQUIRED[c]]
    fields = F.broadcast(sections.sparkSession.createDataFrame(rows, "data_type string, path string, unit string"))  # a fixed list
    return sections.join(fields, "data_type").select("doc_id", "path", "unit", F.array_min("pages").alias("page_num"))


def rules(metrics: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """(doc_id, rule, tolerance, required): the checks that apply to a document by what was found in it."""
    flags = metrics.groupBy("doc_id").agg(F.collect_set("name").alias("names"))
    overlap = lambda c: F.arrays_overlap("names", F.array(*[F.lit(n) for n in REQUIRED[c]]))
    one = lambda n, tol, req: F.struct(F.lit(n).alias("rule"), F.lit(tol).cast("double").alias("tolerance"), F.lit(req).alias("required"))
    parts = F.arrays_overlap("names", F.array(*[F.lit(n) for n in REQUIRED["financial_segments"][:3]]))
    every = [F.when(parts & F.array_contains("names", "total_revenue"), one("sum_to_parent", 0.01, True)), one("percentage_range", 100.0, False), F.when(overlap("margins"), one("margin_calculation", 0.005, False)), F.when(parts, one("segment_completeness", None, True))]
    out = flags.select("doc_id", F.explode(F.array_compact(F.array(*every))).alias("r")).select("doc_id", "r.*")
    if series is not None:
        out = out.unionByName(series.select("doc_id").distinct().select("doc_id", F.lit("time_series_continuity").alias("rule"), F.lit(None).cast("double").alias("tolerance"), F.lit(True).alias("required")))
    return out


def run_rules(checks: DataFrame, metrics: DataFrame, series: DataFrame | None = None, gap_days: int = 100) -> DataFrame:
    """(doc_id, errors, warnings, is_valid): failed rules that are required or not. ``time_series_continuity`` fails where a name in
    ``series`` (doc_id, name, period) skips more than ``gap_days`` from one period to the next, ``margin_calculation``
    where the recomputed margin is off by more than the tolerance, taken as a share. A rule without its figures passes."""
    value = lambda n: F.max(F.when(F.col("name") == n, dbl("value")))
    parts = REQUIRED["financial_segments"][:3]
    facts = metrics.groupBy("doc_id").agg(
        value("total_revenue").alias("total"), F.sum(F.when(F.col("name").isin(parts), dbl("value"))).alias("parts"), *[value(n).alias(n) for n in quality.MARGIN_PARTS],
        F.bool_or(F.col("name").isin(REQUIRED["margins"]) & ~dbl("value").between(-100, 100)).alias("outside"),
        F.bool_or(F.col("name").isin(parts) & (F.coalesce(dbl("value"), F.lit(0.0)) == 0)).alias("hollow"),
    )
    both = checks.join(facts.hint("merge"), "doc_id", "left").withColumn("broken", F.lit(False))
    if series is not None:
        turn = Window.partitionBy("doc_id", "name").orderBy("period")
        gaps = series.select("doc_id", (F.datediff("period", F.lag("period").over(turn)) > gap_days).alias("gap"))
        gaps = gaps.groupBy("doc_id").agg(F.coalesce(F.bool_or("gap"), F.lit(False)).alias("broken"))
        both = both.drop("broken").join(gaps.hint("merge"), "doc_id", "left")
    failed = (
        F.when(F.col("rule") == "sum_to_parent", F.abs(F.col("total") - F.col("parts")) > F.col("tolerance") * F.abs("total"))
        .when(F.col("rule") == "percentage_range", F.col("outside")).when(F.col("rule") == "segment_completeness", F.col("hollow"))
        .when(F.col("rule") == "margin_calculation", F.abs(quality.recomputed_margin() - F.col("gross_margin")) > F.col("tolerance") * 100)
        .when(F.col("rule") == "time_series_continuity", F.col("broken")).otherwise(False)
    )
    both = both.withColumn("failed", F.coalesce(failed, F.lit(False)))
    names = lambda cond: F.array_join(F.sort_array(F.collect_list(F.when(F.col("failed") & cond, F.col("rule")))), ",")
    return both.groupBy("doc_id").agg(names(F.col("required")).alias("errors"), names(~F.col("required")).alias("warnings"), (~F.bool_or(F.col("failed") & F.col("required"))).alias("is_valid"))


def structured_rows(responses: DataFrame) -> DataFrame:
    """Sections of a structured response (JSON text in ``response``) as metric rows: revenue, segments, margins,
    operational and geographic values, names in title case where they name a segment or region."""
    pair = "map<string,string>"
    kind = f"revenue struct<total:string,segments:{pair}>, margins {pair}, operational map<string,{pair}>, geographic {pair}"
    r = responses.select("doc_id", F.from_json("response", kind).alias("r")).select("doc_id", "r.*")
    rows = lambda section, c, name: r.select("doc_id", F.lit(section).alias("section"), F.explode(c).alias("k", "v")).select("doc_id", "section", name(F.col("k")).alias("name"), number(F.col("v")).alias("value"))
    total = r.select("doc_id", F.lit("revenue").alias("section"), F.lit("total_revenue").alias("name"), number(F.col("revenue.total")).alias("value"))
    work = r.select("doc_id", F.explode("operational").alias("cat", "m")).select("doc_id", "cat", F.explode("m").alias("k", "v"))
    work = work.select("doc_id", F.lit("operational").alias("section"), F.lower(F.concat_ws("_", "cat", "k")).alias("name"), number(F.col("v")).alias("value"))
    out = total.unionByName(rows("segments", "revenue.segments", title)).unionByName(rows("margins", "margins", F.lower)).unionByName(rows("geographic", "geographic", title)).unionByName(work)
    return out.where("value is not null")


def typed_fields(leaves: DataFrame, groups: DataFrame) -> DataFrame:
    """Leaves of a page under the data types asked of it: (doc_id, data_type, path, value), the newest page wins."""
    asked = groups.select("doc_id", "page_num", F.explode(F.split("data_types", ",")).alias("data_type"))
    met = leaves.join(asked.hint("merge"), ["doc_id", "page_num"])
    return met.groupBy("doc_id", "data_type", "path").agg(F.max_by("value", "page_num").alias("value"))


def structure_score(leaves: DataFrame, metrics: DataFrame) -> DataFrame:
    """(doc_id, depth, metric_count, score): mean of 1 for nested data and the share of metrics with a value."""
    deep = leaves.groupBy("doc_id").agg(F.max(F.size(F.split("path", r"\.|\["))).alias("depth"))
    flat = metrics.groupBy("doc_id").agg(F.count("*").alias("metric_count"), F.count("value").alias("valued"))
    both = deep.join(flat.hint("merge"), "doc_id", "full_outer")
    parts = F.array_compact(F.array(F.when(F.col("depth").isNotNull(), 1.0), F.when(F.col("metric_count") > 0, F.col("valued") / F.col("metric_count"))))
    return both.select("doc_id", "depth", F.coalesce("metric_count", F.lit(0)).alias("metric_count"), (F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)).alias("score"))


def mean_confidence(metrics: DataFrame) -> DataFrame:
    """(doc_id, confidence): the mean of the confidences that are given; null without any."""
    return metrics.groupBy("doc_id").agg(F.avg("confidence").alias("confidence"))


def value_counts(metrics: DataFrame, leaves: DataFrame, series: DataFrame) -> DataFrame:
    """(doc_id, points): metrics with a value, leaves and points of time series of each document, in one aggregate."""
    one = lambda df, cond: df.where(cond).select("doc_id")
    every = one(metrics, "value is not null").unionByName(one(leaves, "value is not null")).unionByName(series.select("doc_id"))
    return every.groupBy("doc_id").agg(F.count("*").alias("points"))


def advice(reports: DataFrame) -> DataFrame:
    """What to do about a document, from its score, errors, issues, method and business model."""
    lines = F.array_compact(F.array(
        F.when(F.col("score") < 0.7, "low completeness"), F.when(F.col("errors") != "", "hierarchy errors"), F.when(F.col("issues") > 0, F.concat(F.col("issues").cast("string"), F.lit(" quality issues"))),
        F.when(F.col("method") == "traditional", "traditional extraction"), F.when((F.col("business_model") != "general") & (F.col("score") < 0.8), F.concat(F.lit("check metrics of "), F.col("business_model"))),
    ))
    return reports.select("doc_id", F.array_join(lines, "; ").alias("advice"))


def validation_report(leaves: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row per document: structure and coverage scores, rule errors and warnings, overall score, completeness."""
    s = structure_score(leaves, metrics).select("doc_id", F.col("score").alias("structure"))
    c = category_coverage(metrics).select("doc_id", F.col("score").alias("coverage"), "critical_missing")
    v = run_rules(rules(metrics), metrics)
    out = s.join(c.hint("merge"), "doc_id", "left").join(v.hint("merge"), "doc_id", "left")
    parts = F.array_compact(F.array(F.col("structure"), F.col("coverage"), F.when(F.col("is_valid"), 1.0).when(~F.col("is_valid"), 0.0)))
    mean = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)
    return out.withColumns({"overall": mean, "is_complete": mean >= 0.7})


def first_values(facts: DataFrame, concepts: list[str] | None = None, most: int = 100, listed: str | None = None) -> DataFrame:
    """The first listed value of each concept of a company, by the column ``listed`` (ties: the newest), or the newest where
    no such column is named; of a company at most ``most`` concepts, by name."""
    newest = Window.partitionBy("cik", "concept").orderBy(*([F.col(listed)] if listed else []), F.desc("period_end"))
    rows = (facts if concepts is None else facts.where(F.col("concept").isin(concepts))).withColumn("rn", F.row_number().over(newest)).where("rn = 1")
    rows = rows.withColumn("k", F.row_number().over(Window.partitionBy("cik").orderBy("concept"))).where(F.col("k") <= most)
    return rows.select("cik", "entity_name", "concept", dbl("value").alias("value"), "unit", "period_end")


#: The metrics of the key-metric export.
KEY_METRICS = ["Revenues", "CostOfRevenue", "GrossProfit", "OperatingIncomeLoss", "NetIncomeLoss", "Assets", "Liabilities", "StockholdersEquity", "CashAndCashEquivalentsAtCarryingValue", "EarningsPerShareBasic"]


def key_metrics(facts: DataFrame) -> DataFrame:
    """Newest key metrics with the value as text: over a million in millions (``1,234.5M``)."""
    shown = F.when(F.col("value") > 1_000_000, F.concat(F.format_number(F.col("value") / 1_000_000, 1), F.lit("M"))).otherwise(F.format_number("value", 2))
    return first_values(facts, KEY_METRICS).select("cik", "concept", shown.alias("shown"), "unit", "period_end")


def enrichment_messages(facts: DataFrame, segments: DataFrame, most: int = 10) -> DataFrame:
    """(cik, sample_facts, axes): the first facts of a company by period and concept, and its axes."""
    turn = Window.partitionBy("cik").orderBy("period_end", "concept")
    some = facts.withColumn("rn", F.row_number().over(turn)).where(F.col("rn") <= most)
    text = F.concat_ws("=", "concept", F.col("period_end").cast("string"))
    some = some.groupBy("cik").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", text.alias("x")))), lambda s: s["x"]), ";").alias("sample_facts"))
    axes = segments.groupBy("cik").agg(F.array_join(F.sort_array(F.collect_set("dimension_axis")), ",").alias("axes"))
    return some.join(axes, "cik", "left")


def of_companies(facts: DataFrame, companies: DataFrame) -> DataFrame:
    """Facts of the listed companies; ids are compared with leading zeros."""
    return facts.join(companies.select(F.lpad("cik", 10, "0").alias("cik")).distinct(), "cik", "left_semi")


def is_error(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def extraction_summary(groups: DataFrame, responses: DataFrame) -> DataFrame:
    """(doc_id, requested, processed, errors): pages asked for, answered, and answered with nothing."""
    met = groups.select("doc_id", "page_num").join(responses.select("doc_id", "page_num", "response").withColumn("came", F.lit(1)).hint("merge"), ["doc_id", "page_num"], "left")
    good = F.col("came").isNotNull() & ~is_error(F.col("response"))
    return met.groupBy("doc_id").agg(F.count("*").alias("requested"), F.count(F.when(good, 1)).alias("processed"), F.count(F.when(F.col("came").isNotNull() & ~good, 1)).alias("errors"))
