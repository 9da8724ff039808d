"""Segment discovery, source merging and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import category_token, dbl
from ledgerspark.model import CATEGORIES, SEGMENT_PATTERNS


def categorize(facts: DataFrame, categories: dict[str, str] | None = None) -> DataFrame:
    """Category of each fact by a fixed concept map; ``Other`` without an entry."""
    spark = facts.sparkSession
    cat = spark.createDataFrame(list((categories or CATEGORIES).items()), "concept string, category string")
    return facts.join(F.broadcast(cat), "concept", "left").withColumn("category", F.coalesce("category", F.lit("Other")))


#: Words that tell a concept's category, in the order of the tests.
CATEGORY_WORDS = {
    "Cash Flow": "cash", "Costs": "cost|expense", "Revenue": "revenue|sales", "Liabilities": "liabilit|debt|payable", "Equity": "equity|stockholder",
    "Assets": "asset|receivable|inventor|goodwill", "Profitability": "income|profit|earning|margin|loss", "Operational Metrics": "unit|deliver|production|employee",
}


def categorize_by_rules(facts: DataFrame, categories: dict[str, str] | None = None, answers: DataFrame | None = None) -> DataFrame:
    """Category of each fact: by the concept map, else by a model's saved answer (``answers``: concept, answer) if it names a
    category, else by the first words that the concept holds, else ``Other``. Each distinct concept is looked at once."""
    spark = facts.sparkSession
    cat = spark.createDataFrame(list((categories or CATEGORIES).items()), "concept string, listed string")
    concepts = facts.select("concept").distinct().join(F.broadcast(cat), "concept", "left")
    answered = answers.groupBy("concept").agg(F.min(category_token(F.col("answer"))).alias("told")) if answers is not None else spark.createDataFrame([], "concept string, told string")
    concepts = concepts.join(answered.hint("merge"), "concept", "left")
    worded = F.when(F.lit(False), F.lit(None).cast("string"))
    for category, words in CATEGORY_WORDS.items():
        worded = worded.when(F.lower("concept").rlike(words), category)
    concepts = concepts.select("concept", F.coalesce("listed", "told", worded, F.lit("Other")).alias("category"))
    return facts.join(concepts.hint("merge"), "concept")


def discover(facts: DataFrame, known: list[tuple[str, str]] = (), patterns: list[tuple[str, str]] | None = None) -> DataFrame:
    """(kind, concept) by known lists (semi join) and by fixed patterns, over the distinct concepts."""
    spark, concepts = facts.sparkSession, facts.select("concept").distinct()
    rules = F.broadcast(spark.createDataFrame(patterns or SEGMENT_PATTERNS, "kind string, pattern string"))
    found = concepts.join(rules, F.rlike(F.lower("concept"), F.concat(F.lit("^(?:"), F.col("pattern"), F.lit(")")))).select("kind", "concept")
    if known:
        listed = F.broadcast(spark.createDataFrame(list(known), "kind string, concept string"))
        found = found.union(listed.join(concepts, "concept", "left_semi").select("kind", "concept"))
    return found.distinct()


def discovered_values(facts: DataFrame, found: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest values of every discovered concept of each company."""
    w = Window.partitionBy("kind", "cik", "concept").orderBy(F.desc("period_end"))
    rows = facts.join(found.hint("merge"), "concept").withColumn("age", F.row_number().over(w)).where(F.col("age") <= k)
    return rows.select("kind", "cik", "concept", "period_end", dbl("value").alias("value"), "age")


def discovery_summary(segments: DataFrame, found: DataFrame) -> DataFrame:
    """Explicit axes and discovered concepts by kind, in one table."""
    explicit = segments.agg(F.countDistinct("dimension_axis").alias("n")).select(F.lit("explicit_axes").alias("kind"), "n")
    return explicit.union(found.groupBy("kind").agg(F.countDistinct("concept").alias("n")))


def with_implicit(segments: DataFrame, values: DataFrame) -> DataFrame:
    """Explicit segment rows and discovered ones, told apart by ``segment_kind``."""
    explicit = segments.select("cik", "dimension_axis", "dimension_member", "concept", "period_end", dbl("value").alias("value"), F.lit("explicit").alias("segment_kind"))
    implicit = values.select("cik", F.col("kind").alias("dimension_axis"), F.col("concept").alias("dimension_member"), "concept", "period_end", "value", F.lit("implicit").alias("segment_kind"))
    return explicit.unionByName(implicit)


def merge_sources(primary: DataFrame, secondary: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Primary values win, secondary ones fill gaps; ``source`` tells which was taken."""
    a = primary.select(*keys, F.col(value).alias("a"))
    b = secondary.select(*keys, F.col(value).alias("b"))
    both = a.join(b, keys, "full_outer")
    source = F.when(F.col("a").isNotNull(), "primary").when(F.col("b").isNotNull(), "secondary")
    return both.select(*keys, F.coalesce("a", "b").alias(value), source.alias("source"))


def overwrite_members(old: DataFrame, new: DataFrame, keys: list[str], hint: str = "merge") -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same keys. Where the keys are few (members of axes) ``hint`` is ``broadcast``, so
    that ``old`` is not dealt by few values."""
    return old.join(new.select(*keys).distinct().hint(hint), keys, "left_anti").unionByName(new)


def load_rows(facts: DataFrame, segments: DataFrame) -> DataFrame:
    """Facts and segments as one load set; a segment's concept is named ``axis_member``."""
    f = facts.select("cik", "concept", "period_end", dbl("value").alias("value"), F.lit("fact").alias("row_kind"))
    s = segments.select("cik", F.concat_ws("_", "dimension_axis", "dimension_member").alias("concept"), "period_end", dbl("value").alias("value"), F.lit("segment").alias("row_kind"))
    return f.unionByName(s)
