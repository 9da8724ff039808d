"""Mining report pages: ``(doc_id, page_num, text, tables, image_count)`` to metric rows.

``tables`` is an array of tables, each an array of rows of cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import metric_name, normal_name, row_percent, row_value

#: Section headings and table words, by kind.
SECTIONS = {
    "financial": [r"financial\s+(results?|statements?|highlights?)", r"consolidated\s+statements?", r"income\s+statements?", r"balance\s+sheets?", r"cash\s+flows?"],
    "operational": [r"operational\s+(metrics?|highlights?|data)", r"key\s+(metrics?|performance|indicators)", r"business\s+(metrics?|highlights?)", r"quarterly\s+(metrics?|highlights?)"],
    "segment": [r"segment\s+(information|data|results?)", r"revenue\s+by\s+(segment|product|geography|region)", r"business\s+segments?", r"geographic\s+(segments?|breakdown|revenue)"],
    "guidance": [r"(outlook|guidance|forecast)", r"forward[- ]looking", r"expectations?"],
}
#: Phrases of summary headings, also with letters set apart.
HEADINGS = {
    "operational_metrics": ["operational summary"], "financial": ["financial summary"], "segment_metrics": ["energy & services", "energy generation and storage"],
    "guidance": ["outlook"], "technology_metrics": ["core technology", "fsd", "artificial intelligence"],
}
MONEY = r"(?i)\$\s?([0-9][0-9,]*(?:\.[0-9]+)?)\s*(million|billion)"
QUANTITY = r"(?i)([0-9][0-9,]*(?:\.[0-9]+)?)\s*(vehicles|units|GWh|MW|users|subscribers)"


def matches(text: Column, pattern: str) -> Column:
    """Array of (offset, hit) of all matches, offsets in characters from 0."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["piece"])
        return F.struct((at + F.length(x["hit"])).alias("at"), F.concat(acc["out"], F.array(F.struct(at.alias("offset"), x["hit"].alias("hit")))).alias("out"))

    pairs = F.filter(F.arrays_zip(pieces.alias("piece"), hits.alias("hit")), lambda x: x["hit"].isNotNull())
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<offset:int,hit:string>>").alias("out")), step, lambda a: a["out"])


def mentions(pages: DataFrame, pattern: str, width: int = 50) -> DataFrame:
    """Matches with the text around them: (doc_id, page_num, offset, hit, context)."""
    rows = pages.select("doc_id", "page_num", "text", F.explode(matches(F.col("text"), pattern)).alias("m"))
    context = F.substring("text", F.greatest(F.col("m.offset") - width, F.lit(0)) + 1, F.length("m.hit") + F.least(F.col("m.offset"), F.lit(width)) + width)
    return rows.select("doc_id", "page_num", "m.offset", "m.hit", context.alias("context"))


def first_by_name(rows: DataFrame) -> DataFrame:
    """First occurrence of each metric name in a document."""
    w = Window.partitionBy("doc_id", "name").orderBy("page_num", "offset")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def last_by_name(rows: DataFrame) -> DataFrame:
    """Last occurrence of each metric name in a document."""
    names = [c for c in rows.columns if c not in ("doc_id", "name")]
    return rows.groupBy("doc_id", "name").agg(F.max_by(F.struct(*names), F.struct("page_num", "offset")).alias("x")).select("doc_id", "name", "x.*")


def text_metrics(pages: DataFrame) -> DataFrame:
    """Money mentions named by the words since the last sum or sentence, the last one of each name in a document."""
    m = mentions(pages, MONEY)
    before = F.substring("context", F.lit(1), F.least(F.col("offset"), F.lit(50)))
    m = m.withColumn("name", metric_name(F.element_at(F.split(before, r"[$.]", -1), -1))).where("name is not null")
    raw = F.replace(F.regexp_extract("hit", MONEY, 1), F.lit(",")).cast("double")
    unit = F.lower(F.regexp_extract("hit", MONEY, 2))
    scaled = m.withColumns({"value_raw": raw, "unit": unit, "value_millions": raw * F.when(unit == "billion", 1000.0).otherwise(1.0)})
    return last_by_name(scaled.select("doc_id", "page_num", "offset", "name", "value_raw", "unit", "value_millions"))


def quantities(pages: DataFrame) -> DataFrame:
    """Operational quantities in text, the first of each unit in a document."""
    m = mentions(pages, QUANTITY)
    return first_by_name(m.select("doc_id", "page_num", "offset", F.lower(F.regexp_extract("hit", QUANTITY, 2)).alias("name"), F.replace(F.regexp_extract("hit", QUANTITY, 1), F.lit(",")).cast("double").alias("value")))


def section_hits(pages: DataFrame) -> DataFrame:
    """(doc_id, page_num, data_type, pattern): a row for every pattern that fits a page."""
    rules = F.broadcast(pages.sparkSession.createDataFrame([(k, p) for k, ps in SECTIONS.items() for p in ps], "data_type string, pattern string"))  # 16 rows
    return pages.select("doc_id", "page_num", F.lower("text").alias("low")).join(rules, F.rlike("low", "pattern")).select("doc_id", "page_num", "data_type", "pattern")


def heading_tags(pages: DataFrame) -> DataFrame:
    """(doc_id, data_type, pages): sorted pages that name a summary, an outlook or a technology; a heading may have its letters
    set apart by one blank and its words by three."""
    apart = lambda p: "   ".join(" ".join(w) for w in p.split())
    low = F.lower(F.coalesce("text", F.lit("")))
    flags = {k: reduce(Column.__or__, [F.contains(low, F.lit(x)) for p in ps for x in (p, apart(p))]) for k, ps in HEADINGS.items()}
    found = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in flags.items()])))
    return pages.select("doc_id", "page_num", found.alias("data_type")).groupBy("doc_id", "data_type").agg(F.sort_array(F.collect_set("page_num")).alias("pages"))


def sections(pages: DataFrame) -> DataFrame:
    """(doc_id, data_type, pages): sorted pages on which a section shows."""
    out = section_hits(pages).groupBy("doc_id", "data_type").agg(F.sort_array(F.collect_set("page_num")).alias("pages"))
    return out.withColumn("priority", F.when(F.col("data_type").isin("financial", "operational"), "high").otherwise("medium"))


def table_rows(pages: DataFrame) -> DataFrame:
    """One row per table row; tables with one row are left out. ``header`` is the table's first row."""
    t = pages.select("doc_id", "page_num", F.posexplode("tables").alias("table_num", "t")).where(F.size("t") >= 2)
    return t.select("doc_id", "page_num", "table_num", F.get("t", F.lit(0)).alias("header"), F.posexplode("t").alias("row_num", "row"))


#: Words of financial and operational tables, and signs of a time series.
FINANCIAL_WORDS = "revenue|income|profit|loss|margin|expense|cost"
OPERATIONAL_WORDS = "units|delivered|produced|sold|volume|quantity|production|deliveries|delivery|operational summary"
SERIES_SIGNS = r"q[1-4]|20\d{2}|quarter|year|ytd|fiscal"


def classify_tables(pages: DataFrame) -> DataFrame:
    """Kind and confidence of each table of two rows or more, by all its words: operational ones win over financial ones, which are
    ``segment_financial`` or ``margins`` where they say so; ``_time_series`` is added where quarters or years stand.
    Tables of no kind are left out."""
    t = pages.select("doc_id", "page_num", F.posexplode("tables").alias("table_num", "t")).where(F.size("t") >= 2)
    words = F.lower(F.array_join(F.flatten("t"), " "))
    money = F.when(words.rlike("segment|geographic"), "segment_financial").when(F.contains(words, F.lit("margin")) & F.contains(words, F.lit("%")), "margins").otherwise("financial")
    kind = F.when(words.rlike(OPERATIONAL_WORDS), "operational_metrics").when(words.rlike(FINANCIAL_WORDS), money)
    sure = F.when(words.rlike(OPERATIONAL_WORDS), 0.85).when(words.rlike(FINANCIAL_WORDS), 0.9).otherwise(0.7)
    series = F.when(words.rlike(SERIES_SIGNS), F.when(kind.isNull(), "time_series").otherwise(F.concat(kind, F.lit("_time_series"))))
    return t.select("doc_id", "page_num", "table_num", F.coalesce(series, kind).alias("kind"), sure.alias("confidence")).where("kind is not null")


def table_metrics(pages: DataFrame, lexicon: list[tuple[str, str]]) -> DataFrame:
    """Values and percentages of the rows whose first cell fits a lexicon entry (name, pattern)."""
    rows = table_rows(pages).where("row_num > 0")
    first = F.lower(F.get("row", F.lit(0)))
    names = F.explode(F.array_compact(F.array(*[F.when(first.rlike(p), F.lit(n)) for n, p in lexicon])))
    rows = rows.select("doc_id", "page_num", F.struct("table_num", "row_num").alias("offset"), names.alias("name"), row_value(F.col("row")).alias("value"), row_percent(F.col("row")).alias("percent"))
    return last_by_name(rows.where("value is not null or percent is not null"))


def segment_rows(pages: DataFrame) -> DataFrame:
    """Body rows of tables whose header names segments or regions; totals and ``other`` are left out."""
    head = F.lower(F.array_join("header", " "))
    rows = table_rows(pages).where("row_num > 0").where(head.rlike("segment|region|geograph"))
    name = F.get("row", F.lit(0))
    kind = F.when(head.rlike("region|geograph"), "geographic").otherwise("product")
    out = rows.select("doc_id", "page_num", normal_name(name).alias("segment"), kind.alias("segment_type"), row_value(F.col("row")).alias("value"))
    return out.where("value is not null and not segment rlike 'total|other'")


def page_selection(pages: DataFrame, most: int = 15, overrides: dict[int, float] | None = None) -> DataFrame:
    """The pages of highest priority of each document, ties by page number; ``overrides`` gives pages a priority of their own."""
    p = F.col("page_num")
    #: The priorities.
    priority = F.when(p.isin(4, 5), 1.0).when(p.isin(3, 6, 7), 0.9).when(p <= 10, 0.7).when(p <= 20, 0.5).otherwise(0.3)
    w = Window.partitionBy("doc_id").orderBy(F.desc("priority"), "page_num")
    for page, own in (overrides or {}).items():
        priority = F.when(p == page, F.lit(float(own))).otherwise(priority)
    return pages.select("doc_id", "page_num", priority.alias("priority")).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)


def company_info(pages: DataFrame) -> DataFrame:
    """Company (null where no rule names one), period and kind of each document, by ordered rules over its pages."""
    from ledgerspark.operators import mining  # which builds on this module

    names = mining.company_names(pages).where("rule is not null").select("doc_id", "company")
    period = F.coalesce(*[F.nullif(F.regexp_extract("text", p, 0), F.lit("")) for p in (r"Q[1-4] \d{4}", r"(?i)(?:first|second|third|fourth) quarter \d{4}", r"FY ?\d{4}")])
    periods = pages.withColumn("p", period).where("p is not null").groupBy("doc_id").agg(F.min_by("p", "page_num").alias("period"))
    kind = pages.groupBy("doc_id").agg(F.when(F.bool_or(F.lower("text").contains("earnings")), "earnings").when(F.bool_or(F.lower("text").contains("annual report")), "annual_report").otherwise("report").alias("doc_type"))
    return kind.join(names.hint("merge"), "doc_id", "left").join(periods.hint("merge"), "doc_id", "left")
