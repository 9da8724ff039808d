"""Mining pages in one pass: phrase contexts, routing of pages to miners, similar contexts, company names, coverage.

Pages are (doc_id, page_num, text, tables, image_count) as in ``documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import financial_class, metric_name, number, operational_class, row_value
from ledgerspark.operators.documents import SECTIONS
from ledgerspark.operators.reports import CRITICAL, REQUIRED

#: The phrases that are looked for and the metrics they stand for.
PHRASES = [("Vehicle Production", "vehicle production"), ("Vehicle Deliveries", "vehicle deliveries"), ("Energy Storage", "energy storage"), ("Energy Storage", "gwh")]


def _hits(pages: DataFrame, rules: list[tuple[str, str, re.Pattern]], before: int, after: int) -> DataFrame:
    """(doc_id, page_num, kind, rule, nth, offset, hit, context): every hit of every rule (kind, rule, pattern) in the whole text, in one pass
    over the pages; ``nth`` numbers the rules. The context reaches ``before`` characters before the hit and ``after``
    past its end."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                hits = [
                    (i, kind, rule, nth, x.start(), x.group(), t[max(0, x.start() - before) : x.end() + after])
                    for i, t in enumerate(part.column(2).to_pylist()) if t for nth, (kind, rule, p) in enumerate(rules) for x in p.finditer(t)
                ]
                i, *cols = zip(*hits, strict=True) if hits else ((),) * 7
                took = pa.array(i, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(took), part.column(1).take(took), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    names = ["doc_id", "page_num", "kind", "rule", "nth", "offset", "hit", "context"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
    ids = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in names[:2])
    return pages.select("doc_id", "page_num", "text").mapInArrow(find, f"{ids}, kind string, rule string, nth int, offset int, hit string, context string")


def phrase_contexts(pages: DataFrame, phrases: list[tuple[str, str]] | None = None, before: int = 50, after: int = 200) -> DataFrame:
    """(doc_id, page_num, metric, phrase, offset, context): every place of every phrase, in any case, overlapping ones
    too, with ``before`` characters before its start and ``after`` from it on. Offsets are characters from 0; null texts
    have none. A page is searched whole, phrase by phrase, in time linear in its length."""
    rules = [(m, p, re.compile(f"(?={re.escape(p)})", re.IGNORECASE)) for m, p in phrases or PHRASES]  # hits of no length, so they may overlap
    return _hits(pages, rules, before, after).select("doc_id", "page_num", F.col("kind").alias("metric"), F.col("rule").alias("phrase"), "offset", "context")


#: Patterns of operational and financial figures in text.
FIGURES = {
    "operational": [r"(\d+[\d,]*)\s*(units?|deliveries|sales|sold|shipped)", r"(volume|quantity|count)\s*:?\s*(\d+[\d,]*)", r"(\d+[\d,]*)\s*(subscribers?|users?|customers?|accounts?)"],
    "financial": [r"\$?\s*(\d+[\d,]*\.?\d*)\s*(million|billion|mn|bn|[mb])", r"revenue\s*:?\s*\$?\s*(\d+[\d,]*\.?\d*)", r"(gross|operating|net)\s*(profit|margin|income)"],
}


def discovered_metrics(pages: DataFrame, around: int = 50) -> DataFrame:
    """(doc_id, kind, name, page_num, pattern, context): the operational and financial figures that a document's text mentions,
    classed by the ``around`` characters on either side; of each name the first by page, pattern and place."""
    rules = [(k, p, re.compile(p, re.IGNORECASE)) for k, ps in FIGURES.items() for p in ps]
    hits = _hits(pages, rules, around, around)
    name = F.when(F.col("kind") == "operational", operational_class(F.col("context"), F.col("hit"))).otherwise(financial_class(F.col("context")))
    first = F.min_by(F.struct("page_num", F.col("hit").alias("pattern"), F.trim("context").alias("context")), F.struct("page_num", "nth", "offset"))
    return hits.withColumn("name", name).where("name is not null").groupBy("doc_id", "kind", "name").agg(first.alias("x")).select("doc_id", "kind", "name", "x.*")


#: Patterns of figures with their units, and what leads a segment table or a region.
UNITS, DONE = r"(\d+[\d,]*)\s*(units?|customers?|subscribers?|users?)", r"(delivered|produced|sold|shipped)\s*:?\s*(\d+[\d,]*)"
SEGMENT_HEADS, REGIONS = "segment|product|region|geography", "states|china|europe"
SUM = r"(?i)\$\s?([0-9][0-9,]*(?:\.[0-9]+)?)\s*(million|billion)"


def _group(text: Column, pattern: str, n: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))


def route_pages(pages: DataFrame) -> DataFrame:
    """(doc_id, page_num, miner, name, value): each page goes to the miners of its kinds in one pass over the pages.

    Financial pages: rows of a total revenue. Operational pages: rows with a figure and its unit, named by the row.
    Segment pages: rows of tables whose header leads segments or regions, but for totals and others. All pages: sums of
    money in the text, named by the up to 50 characters before them within their sentence. Tables of one row and
    figures of zero are left out; pages of no kind have their text mined only.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    kind = {k: low.rlike("|".join(f"(?:{p})" for p in SECTIONS[k])) for k in ("financial", "operational", "segment")}
    one = lambda miner, row, lead: F.struct(F.lit(miner).alias("miner"), row.alias("row"), lead.alias("lead"))
    no_lead, none = F.lit(None).cast("string"), F.array().cast("array<struct<miner:string,row:array<string>,lead:string>>")
    tables = F.filter(F.coalesce("tables", F.array().cast("array<array<array<string>>>")), lambda t: F.size(t) >= 2)
    rows = F.flatten(tables)

    def segment(t: Column) -> Column:
        body = F.filter(F.slice(t, F.lit(2), F.size(t)), lambda r: (F.size(r) >= 2) & (F.trim(F.get(r, F.lit(0))) != "") & ~F.lower(F.get(r, F.lit(0))).rlike("total|other"))
        places = F.exists(body, lambda r: F.lower(F.get(r, F.lit(0))).rlike(REGIONS) & row_value(r).isNotNull())
        heads = F.lower(F.array_join(F.get(t, F.lit(0)), " ")).rlike(SEGMENT_HEADS)
        return F.when(heads, F.transform(body, lambda r: one("segment", r, F.when(places, "geographic.").otherwise("segments.")))).otherwise(none)

    # Before each sum of money stands the piece of text since the sum before it.
    sums = F.regexp_extract_all("text", F.lit(SUM), F.lit(0))
    text = F.filter(F.arrays_zip(F.split("text", SUM, -1).alias("piece"), sums.alias("hit")), lambda x: x["hit"].isNotNull())
    out = F.concat(
        F.when(kind["financial"], F.transform(rows, lambda r: one("financial", r, no_lead))).otherwise(none), F.when(kind["operational"], F.transform(rows, lambda r: one("operational", r, no_lead))).otherwise(none),
        F.when(kind["segment"], F.flatten(F.transform(tables, segment))).otherwise(none), F.coalesce(F.transform(text, lambda x: one("text", F.array(x["piece"], x["hit"]), no_lead)), none),
    )
    # Names and values are worked out on plain rows, each part of them once.
    met, miner, first = pages.select("doc_id", "page_num", F.explode(out).alias("m")).select("doc_id", "page_num", "m.*"), F.col("miner"), F.get("row", F.lit(0))
    before = F.element_at(F.split(F.right(first, F.lit(50)), r"[$.]", -1), -1)
    met = met.withColumn("words", F.lower(F.when(miner == "text", before).otherwise(F.array_join("row", " "))))
    name = F.when(miner == "segment", F.concat("lead", F.trim(first))).when(miner != "financial", metric_name(F.col("words")))
    name = name.when(F.contains("words", F.lit("total")) & F.contains("words", F.lit("revenue")), F.lit("revenue.total"))
    met = met.withColumn("name", name).where("name is not null")
    hit = F.get("row", F.lit(1))
    scaled = F.replace(F.regexp_extract(hit, SUM, 1), F.lit(",")).cast("double") * F.when(F.lower(F.regexp_extract(hit, SUM, 2)) == "billion", 1000.0).otherwise(1.0)
    figure = F.coalesce(_group(F.col("words"), UNITS, 1), _group(F.col("words"), DONE, 2))
    value = F.when(miner == "text", scaled).when(miner == "operational", number(figure)).otherwise(row_value(F.col("row")))
    return met.select("doc_id", "page_num", "miner", "name", value.alias("value")).where("value <> 0")


#: Documents of more metrics than this are compared by an index of words, others metric by metric.
DIRECT = 64


def _similar_pairs(metrics: DataFrame, threshold: float, id_col: str) -> DataFrame:
    """(doc_id, a, b, an, bn, similarity): the pairs of ``similar_contexts`` with the names of either metric.

    All steps need the rows by document, so the metrics are shuffled once. An index lists the first words of each set, from rare to
    frequent ones, with the set; a pair that meets at several words is taken at the first of them."""
    words = F.array_distinct(F.filter(F.split(F.lower("context"), r"\s+"), lambda w: w != ""))
    name = F.col("name") if "name" in metrics.columns else F.lit(None).cast("string")
    sets = metrics.select("doc_id", F.col(id_col).alias("id"), words.alias("x"), name.alias("name")).where(F.size("x") > 0).repartition("doc_id")
    sets = sets.groupBy("doc_id", "id").agg(F.array_distinct(F.flatten(F.collect_list("x"))).alias("x"), F.collect_list("name").alias("names"))
    sets = sets.withColumns({"n": F.size("x"), "k": F.count("*").over(Window.partitionBy("doc_id"))})

    def compared(rows: DataFrame, *on: str, turn: Column | None = None) -> DataFrame:
        a, b = rows.alias("a"), rows.alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
        fit = (F.col("a.id") < F.col("b.id")) & (F.col("b.n") > threshold * F.col("a.n")) & (F.col("a.n") > threshold * F.col("b.n"))
        met = a.join(b.hint("merge"), reduce(Column.__and__, same) & fit)
        met = met if turn is None else met.where(turn)
        both = F.size(F.array_intersect("a.x", "b.x"))
        out = met.select("a.doc_id", F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.col("a.names").alias("an"), F.col("b.names").alias("bn"), both.alias("both"), (F.col("a.n") + F.col("b.n")).alias("sum"))
        return out.withColumn("similarity", F.col("both") / (F.col("sum") - F.col("both"))).where(F.col("similarity") > threshold).drop("both", "sum")

    large = sets.where(F.col("k") > DIRECT).select("doc_id", "id", "n", "names", F.explode("x").alias("w")).withColumn("held", F.count("*").over(Window.partitionBy("doc_id", "w")))
    large = large.groupBy("doc_id", "id").agg(F.first("n").alias("n"), F.first("names").alias("names"), F.sort_array(F.collect_list(F.struct("held", "w"))).alias("x"))
    lead = F.slice("x", F.lit(1), F.col("n") - F.floor(F.col("n") * threshold).cast("int"))
    large = large.withColumn("x", F.transform("x", lambda s: s["w"])).withColumn("lead", lead).withColumn("w", F.explode("lead"))
    by_word = compared(large, "doc_id", "w", turn=F.get(F.array_intersect("a.lead", "b.lead"), F.lit(0)) == F.col("a.w"))
    return compared(sets.where(F.col("k") <= DIRECT), "doc_id").unionByName(by_word)


def similar_contexts(metrics: DataFrame, threshold: float = 0.5, id_col: str = "metric") -> DataFrame:
    """(doc_id, a, b, similarity): pairs of a document's metrics, a < b, whose contexts share more than ``threshold`` of
    their words (in lower case).

    A set-similarity join: the metrics of a document of up to ``DIRECT`` are compared with each other. In larger ones words are
    ordered from rare to frequent in their document; two sets that are similar enough share one of their first
    n - floor(threshold * n) words, so only these go into the inverted index, and of the metrics that meet there
    those of too different sizes are dropped before whole sets are compared. Metrics without words are similar to none.
    """
    return _similar_pairs(metrics.drop("name"), threshold, id_col).select("doc_id", "a", "b", "similarity")


def context_hierarchies(metrics: DataFrame, threshold: float = 0.5, id_col: str = "metric") -> DataFrame:
    """(doc_id, parent, children): for each metric with ``total`` in its name the sorted names of the document's
    other metrics in a similar context; totals without any are left out."""
    pairs = _similar_pairs(metrics, threshold, id_col)
    way = lambda p, c: F.struct(F.col(p).alias("p"), F.filter(p + "n", lambda x: F.contains(F.lower(x), F.lit("total"))).alias("parents"), F.col(c + "n").alias("c"))
    ways = F.filter(F.array(way("a", "b"), way("b", "a")), lambda w: F.size(w["parents"]) > 0)
    met = pairs.select("doc_id", F.explode(ways).alias("x")).select("doc_id", "x.p", "x.c", F.explode("x.parents").alias("parent"))
    out = met.groupBy("doc_id", "p", "parent").agg(F.array_join(F.sort_array(F.flatten(F.collect_list("c"))), ",").alias("children"))
    return out.select("doc_id", F.col("p").alias("metric"), "parent", "children")


def segment_hierarchies(segments: DataFrame) -> DataFrame:
    """(doc_id, parent, children, kind) of the segment names (doc_id, segment) of each document: places, and products or services."""
    #: Words of places, and the parents' names.
    place = F.lower("segment").rlike("states|china|europe|asia")
    rows = segments.withColumn("kind", F.when(place, "geographic_segments").otherwise("product_segments"))
    parent = F.when(F.col("kind") == "geographic_segments", "Geographic Revenue").otherwise("Product/Service Revenue")
    return rows.groupBy("doc_id", "kind").agg(F.array_join(F.sort_array(F.collect_set("segment")), ",").alias("children")).select("doc_id", parent.alias("parent"), "children", "kind")


#: Patterns of company names, in the order in which they are tried.
FORMAL = r"([A-Z][A-Za-z0-9\s&,.'-]+(?:Inc\.|Corporation|Corp\.|Company|Co\.|LLC|Ltd\.|Limited|LP|LLP))"
TICKER = r"(?:NASDAQ|NYSE|AMEX|OTC)\s*:\s*([A-Z]{1,5})"
HEADER = r"^([A-Z][A-Za-z0-9\s&,.'-]+)\s*\n.*(?:Earnings|Results|Report)"
COPYRIGHT = r"(?:©|Copyright)\s*\d{4}\s+([A-Z][A-Za-z0-9\s&,.'-]+)"
ANNOUNCED = r"([A-Z][A-Za-z0-9\s&,.'-]+)\s+(?:announces?|reports?)"
MENTIONED = [r"(?:The|the)\s+([A-Z][a-z]+)\s+(?:team|company|corporation)", r"([A-Z][a-z]+)\s+(?:reported|achieved|delivered|announced)", r"(?:at|by|from)\s+([A-Z][a-z]+)(?:\s|,|\.|$)"]
#: Words with which no heading line begins, and that none holds.
NO_START, NO_WORD = ["for ", "the ", "and ", "or "], ["quarter", "earnings", "results", "update"]


def _named(text: Column, pattern: str) -> Column:
    """The first hit of a pattern, with single spaces, if a name has that length."""
    name = F.regexp_replace(F.trim(F.regexp_extract(text, f"(?im){pattern}", 1)), r"\s+", " ")
    return F.when(F.length(name).between(4, 99), name)


def company_names(pages: DataFrame, names: list[str] | None = None, around: int = 200) -> DataFrame:
    """(doc_id, company, page_num, rule): the name by the first rule that gives one, ``Unknown`` where none does.

    On page 1, in this order: a formal name; a ticker, which stands for the formal name within ``around`` characters of it (a
    ticker without one names nobody); one of ``names``; the line above a report's title; a copyright line; a line among
    the first ten that looks like a name; the words before "announces" or "reports". Then pages 2 to 10 in turn: formal name, header and copyright,
    then words in the middle of a sentence, then ``names``. Every page's candidates are ranked as one struct, and the
    least of a document wins.
    """
    text = F.coalesce("text", F.lit(""))
    known = "|".join(re.escape(n) for n in names or [])
    ticker = F.regexp_extract(text, f"(?im){TICKER}", 1)
    at = F.regexp_instr(text, F.lit(f"(?im){TICKER}"))
    hit = F.length(F.regexp_extract(text, f"(?im){TICKER}", 0))
    window = F.substring(text, F.greatest(at - around, F.lit(1)), F.least(at - 1, F.lit(around)) + hit + around)
    plain = F.length(ticker).between(4, 5) & ticker.rlike("^[A-Z]+$")
    lines = F.transform(F.slice(F.split(text, "\n"), 1, 10), F.trim)
    heading = F.filter(lines, lambda x: F.length(x).between(6, 49) & ~reduce(Column.__or__, [F.lower(x).startswith(w) for w in NO_START]) & ~F.lower(x).rlike("|".join(NO_WORD)) & x.rlike(r"^[A-Z][A-Za-z0-9\s&,.'-]+"))
    worded = [F.get(F.filter(F.regexp_extract_all(text, F.lit(p), F.lit(1)), lambda x: (F.length(x) > 3) & ~F.lower(x).isin("the", "this", "these", "those")), F.lit(0)) for p in MENTIONED]
    listed = _named(text, rf"\b({known})\b") if known else F.lit(None).cast("string")
    first = {"formal": _named(text, FORMAL), "ticker": F.when(plain, _named(window, FORMAL)), "listed": listed, "header": _named(text, HEADER), "copyright": _named(text, COPYRIGHT), "heading": F.get(heading, F.lit(0)), "announced": _named(text, ANNOUNCED)}
    later = {"formal": first["formal"], "listed": listed, "header": first["header"], "copyright": first["copyright"], "team": worded[0], "reported": worded[1], "mentioned": worded[2]}
    ranked = lambda rules: F.array_compact(F.array(*[F.when(c.isNotNull(), F.struct(F.col("page_num").alias("page_num"), F.lit(i).alias("rank"), F.lit(n).alias("rule"), c.alias("company"))) for i, (n, c) in enumerate(rules.items())]))
    best = F.array_min(F.when(F.col("page_num") == 1, ranked(first)).otherwise(ranked(later)))
    rows = pages.select("doc_id", F.when(F.col("page_num") <= 10, best).alias("b"))
    won = rows.groupBy("doc_id").agg(F.min("b").alias("b"))
    return won.select("doc_id", F.coalesce("b.company", F.lit("Unknown")).alias("company"), "b.page_num", "b.rule")


#: What makes each category's check pass: the metrics of which so many must be found.
CHECKS = {
    "vehicle_metrics": (["deliveries_total"], 1), "energy_metrics": (["storage_deployed_gwh"], 1), "financial_segments": (["total_revenue"], 1),
    "geographic_segments": (REQUIRED["geographic_segments"], 3), "margins": (["automotive_gross_margin"], 1),
}


def coverage(metrics: DataFrame, expected: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, category, found, total, score, passed, missing, critical): the expected metrics of each category and, as
    ``overall``, of the document, in one rollup.

    ``expected`` (category -> names) is the required ones unless given. A metric is found where its value is neither null nor zero.
    A category passes by its check (five checks; other categories when all is found); the document when 0.8 are found
    and nothing critical is missing. Metrics that nobody expects are ignored; documents without any row are not
    there.
    """
    one = lambda c, n: F.struct(F.lit(c).alias("category"), F.lit(n).alias("name"), F.lit(CHECKS[c][1] if c in CHECKS and n in CHECKS[c][0] else None).cast("int").alias("need"), F.lit(CRITICAL.get(n)).cast("string").alias("said"))
    lexicon = F.array(*[one(c, n) for c, names in (expected or REQUIRED).items() for n in names])
    have = metrics.groupBy("doc_id", "name").agg(F.coalesce(F.bool_or(F.col("value") != 0), F.lit(False)).alias("got"))
    docs = have.groupBy("doc_id").agg(F.collect_set(F.when(F.col("got"), F.col("name"))).alias("names"))
    rows = docs.select("doc_id", "names", F.explode(lexicon).alias("t")).select("doc_id", "t.*", F.array_contains("names", F.col("t.name")).alias("got"))
    lost = ~F.col("got")
    listed = lambda c, cond: F.array_join(F.sort_array(F.collect_list(F.when(cond, F.col(c)))), ", ")
    out = rows.rollup("doc_id", "category").agg(
        F.count(F.when(F.col("got"), 1)).alias("found"), F.count("*").alias("total"), F.grouping("category").alias("whole"), F.max("need").alias("need"), F.count(F.when(F.col("got") & F.col("need").isNotNull(), 1)).alias("met"),
        listed("name", lost).alias("missing"), listed("said", lost & F.col("said").isNotNull()).alias("critical"),
    ).where("doc_id is not null")
    score = F.col("found") / F.col("total")
    passed = F.when(F.col("whole") == 1, (score >= 0.8) & (F.col("critical") == "")).when(F.col("need").isNull(), F.col("found") == F.col("total")).otherwise(F.col("met") >= F.col("need"))
    return out.select("doc_id", F.when(F.col("whole") == 1, "overall").otherwise(F.col("category")).alias("category"), "found", "total", score.alias("score"), passed.alias("passed"), "missing", "critical")
