"""Composed jobs: chains of operators, each one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import documents, extracted, flatten, mining, quality, reports, segments
from ledgerspark.sources import tables


def filing_job(company_facts: DataFrame, as_of_year: int, years_back: int = 5) -> dict[str, DataFrame]:
    """Landed company facts to facts, segments, discovered concepts and scores."""
    facts = flatten.flatten_facts(company_facts, as_of_year, years_back).withColumns({"period_end": F.col("period"), "entity_name": F.col("entity")})
    axes = flatten.flatten_segments(company_facts, as_of_year, years_back)
    return {"facts": facts, "segments": axes, "discovered": segments.discover(facts), "scores": quality.completeness_score(facts, axes)}


def load_filings(files: DataFrame, root: str, batch: int) -> None:
    """Instance files (path, content) to facts, segments, statistics and a status each, committed as one batch below ``root``
    (``tables.committed`` reads them). A file that is no XML gives no rows and the status ``failed``; a failure on the
    way leaves nothing of the batch visible, and the batch may be loaded again."""
    raw = flatten.flatten_instances(files).persist()
    found = raw.select("filing").distinct().withColumn("got", F.lit(1))
    status = files.select(F.col("path").alias("filing")).distinct().join(found.hint("merge"), "filing", "left")
    status = status.select("filing", F.when(F.col("got").isNotNull(), "completed").otherwise("failed").alias("fetch_status"))
    tables.commit({"facts": flatten.instance_facts(raw), "segments": flatten.instance_segments(raw), "stats": flatten.instance_stats(raw), "status": status}, root, batch)
    raw.unpersist()


#: Business models and the parts of metric names that tell them, in the order of the tests.
MODELS = [("automotive", "vehicle"), ("technology/saas", "subscriber|user"), ("retail", "store|transaction")]


def analyze_documents(pages: DataFrame) -> DataFrame:
    """One analysis row per document: company, period, kind, sections, pages with images, number of pages, business model by the
    operational metrics that its text mentions, and whether it has such metrics and tables over time."""
    plan = documents.sections(pages).groupBy("doc_id").agg(F.sort_array(F.collect_set("data_type")).alias("data_types"))
    images = pages.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.when(F.col("image_count") > 0, F.col("page_num")))).alias("visual_pages"), F.count("*").alias("page_count"))
    names = mining.discovered_metrics(pages).where("kind = 'operational'").groupBy("doc_id").agg(F.array_join(F.collect_set("name"), ",").alias("names"))
    series = documents.classify_tables(pages).groupBy("doc_id").agg(F.bool_or(F.contains("kind", F.lit("time_series"))).alias("series"))
    out = documents.company_info(pages).join(plan.hint("merge"), "doc_id", "left").join(images.hint("merge"), "doc_id").join(names.hint("merge"), "doc_id", "left").join(series.hint("merge"), "doc_id", "left")
    model = F.when(F.lit(False), "")
    for name, words in MODELS:
        model = model.when(F.col("names").rlike(words), name)
    return out.withColumns({"business_model": model.otherwise("general"), "has_operational_metrics": F.col("names").isNotNull(), "has_time_series": F.coalesce("series", F.lit(False))}).drop("names", "series")


def _mined(pages: DataFrame, lexicon: list[tuple[str, str]]) -> DataFrame:
    """(doc_id, name, value): metrics of tables, else of texts."""
    ranked = lambda df, k: df.select("doc_id", "name", "value", F.lit(k).alias("rank")).where("value is not null")
    base = ranked(documents.table_metrics(pages, lexicon), 0).unionByName(ranked(documents.text_metrics(pages).withColumnRenamed("value_millions", "value"), 1))
    return base.groupBy("doc_id", "name").agg(F.min_by("value", "rank").alias("value"))


def _routed(responses: DataFrame) -> DataFrame:
    return extracted.route_values(extracted.json_leaves(responses)).groupBy("doc_id", F.col("target_path").alias("name")).agg(F.max("value").alias("value"))


def extract_documents(pages: DataFrame, responses: DataFrame, lexicon: list[tuple[str, str]]) -> DataFrame:
    """Metric rows of tables and texts; extracted JSON fills what they lack."""
    return segments.merge_sources(_mined(pages, lexicon), _routed(responses), ["doc_id", "name"])


def fill_gaps(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """(doc_id, name, value, source): the metrics mined from pages; of the saved responses only those of the pages on which
    something that was not found may stand fill the rest. Documents without any metric lack everything."""
    base = reports.mined_metrics(pages).select("doc_id", "name", "value")
    every = base.unionByName(pages.select("doc_id").distinct().select("doc_id", F.lit("").alias("name"), F.lit(0.0).alias("value")))
    wanted = reports.valid_pages(responses, reports.target_pages(every))
    return segments.merge_sources(base, _routed(wanted), ["doc_id", "name"])


def document_envelopes(pages: DataFrame, responses: DataFrame, lexicon: list[tuple[str, str]]) -> DataFrame:
    """One row per document: ``analysis`` (company, period, kind, model), ``data`` (name -> value) and ``validation``."""
    leaves = extracted.json_leaves(responses)
    rows = extract_documents(pages, responses, lexicon).withColumnsRenamed({"source": "origin"})
    mined = reports.mined_metrics(pages).select("doc_id", "name", "value")
    rows = rows.select("doc_id", "name", "value").unionByName(mined).groupBy("doc_id", "name").agg(F.max("value").alias("value"))
    data = rows.groupBy("doc_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("data"))
    checks = reports.validation_report(leaves, rows)
    a = analyze_documents(pages)
    a = a.select("doc_id", F.struct(*[c for c in a.columns if c != "doc_id"]).alias("analysis"))
    v = checks.select("doc_id", F.struct(*[c for c in checks.columns if c != "doc_id"]).alias("validation"))
    return a.join(data.hint("merge"), "doc_id", "left").join(v.hint("merge"), "doc_id", "left")
