"""Data-quality jobs: one row per company, document or check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import dbl

#: Concepts and axes whose presence is checked.
CRITICAL = ("Revenues", "Assets", "Liabilities", "CashAndCashEquivalents", "NetIncomeLoss", "OperatingIncomeLoss", "GrossProfit", "StockholdersEquity", "OperatingExpenses", "CostOfRevenue")
EXPECTED_AXES = ("StatementBusinessSegmentsAxis", "ProductOrServiceAxis", "StatementGeographicalAxis", "ConsolidatedEntitiesAxis")


def _present(c: str, names: tuple[str, ...]) -> Column:
    return F.countDistinct(F.when(F.col(c).isin(*names), F.col(c)))


def completeness_score(facts: DataFrame, segments: DataFrame, concepts: int = 100, rows: int = 500, axes: int = 10) -> DataFrame:
    """0.3 basic thresholds (concepts, facts, any segment) + 0.4 critical concepts + 0.2 expected axes + 0.1 share of
    the five consistency flags; complete from 0.8. ``enough_axes`` (``axes`` or more) is reported, not scored."""
    every = lambda c: F.when(F.bool_and(F.col(c).isNotNull()), 1).otherwise(0)
    f = facts.groupBy("cik").agg(
        F.countDistinct("concept").alias("concepts"), F.count("*").alias("facts"), _present("concept", CRITICAL).alias("critical"),
        # No concept without a value, structured rows (a concept each), a name, periods, values.
        (F.when(F.countDistinct("concept") == F.countDistinct(F.when(F.col("value").isNotNull(), F.col("concept"))), 1).otherwise(0) + every("concept") + F.when(F.max("entity_name").isNotNull(), 1).otherwise(0) + every("period_end") + every("value")).alias("flags"),
    )
    s = segments.groupBy("cik").agg(F.countDistinct("dimension_axis").alias("axes"), _present("dimension_axis", EXPECTED_AXES).alias("expected"))
    both = f.join(s, "cik", "left").fillna({"axes": 0, "expected": 0})
    ok = lambda c: F.when(c, 1.0).otherwise(0.0)
    basic = (ok(F.col("concepts") >= concepts) + ok(F.col("facts") >= rows) + ok(F.col("axes") > 0)) / 3
    critical, expected = F.col("critical") / len(CRITICAL), F.col("expected") / len(EXPECTED_AXES)
    score = basic * 0.3 + critical * 0.4 + expected * 0.2 + F.col("flags") / 5 * 0.1
    return both.select(
        "cik", "concepts", "facts", "axes", (F.col("axes") >= axes).alias("enough_axes"), (F.col("axes") - F.col("expected")).alias("additional_axes"),
        (critical * 100).alias("critical_pct"), (expected * 100).alias("axes_pct"), score.alias("score"), (score >= 0.8).alias("is_complete"),
    )


def missing_critical(facts: DataFrame) -> DataFrame:
    """(cik, concept) of critical concepts a company lacks."""
    pairs = facts.select("cik").distinct().withColumn("concept", F.explode(F.array(*[F.lit(c) for c in CRITICAL])))
    return pairs.join(facts.select("cik", "concept").distinct().hint("merge"), ["cik", "concept"], "left_anti")


def recommendations(scores: DataFrame, missing: DataFrame) -> DataFrame:
    """What to do per company: a line for each failed check, and up to three missing concepts by name."""
    lost = missing.groupBy("cik").agg(F.slice(F.sort_array(F.collect_list("concept")), 1, 3).alias("m"))
    lines = F.array_compact(F.array(
        F.when(F.col("concepts") < 100, "few concepts"), F.when(F.col("facts") < 500, "few facts"), F.when(F.col("axes") < 10, "few axes"),
        F.when(F.col("m").isNotNull(), F.concat(F.lit("missing "), F.array_join("m", ", "))),
    ))
    return scores.join(lost.hint("merge"), "cik", "left").select("cik", F.array_join(lines, "; ").alias("advice"))


def sum_to_parent(parents: DataFrame, children: DataFrame, keys: list[str], tolerance: float = 0.01) -> DataFrame:
    """Totals against the sum of their parts; a zero or missing total is not evaluated (null)."""
    parts = children.groupBy(*keys).agg(F.sum("value").alias("parts"), F.count("*").alias("children"))
    both = parents.select(*keys, F.col("value").alias("total")).join(parts, keys)
    off = F.try_divide(F.abs(dbl("total") - dbl("parts")), F.abs(F.nullif(dbl("total"), F.lit(0.0))))
    return both.select(*keys, dbl("total").alias("total"), dbl("parts").alias("parts"), "children", (off <= tolerance).alias("is_valid"))


def quality_issues(metrics: DataFrame) -> DataFrame:
    """(cik, concept, period_end, issue): missing values, negative revenue, percentages out of range."""
    key = ["cik", "concept", "period_end"]
    row = lambda cond, name: metrics.where(cond).select(*key, F.lit(name).alias("issue"))
    a = row(F.col("value").isNull(), "missing value")
    b = row((F.col("value") < 0) & F.col("concept").isin("Revenues", "Assets", "CostOfRevenue"), "negative value")
    c = row(F.lower("concept").like("%pct") & ~F.col("value").between(-100, 100), "percentage out of range")
    return a.unionByName(b).unionByName(c)


def recomputed_margin() -> Column:
    """Gross margin in percent from the columns ``gross_profit`` or, where it is missing, ``cost_of_revenue``, and ``total_revenue``."""
    profit = F.coalesce(dbl("gross_profit"), dbl("total_revenue") - dbl("cost_of_revenue"))
    return F.try_divide(profit, F.nullif(dbl("total_revenue"), F.lit(0.0))) * 100


MARGIN_PARTS = ["total_revenue", "gross_profit", "cost_of_revenue", "gross_margin"]


def margin_check(metrics: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Margin recomputed from a document's ``total_revenue`` and ``gross_profit`` (without one, ``cost_of_revenue``) against the
    ``gross_margin`` it reports, within ``tolerance`` points; documents that lack what it takes are not checked."""
    value = lambda n: F.max(F.when(F.col("name") == n, F.col("value"))).alias(n)
    wide = metrics.where(F.col("name").isin(MARGIN_PARTS)).groupBy("doc_id").agg(*[value(n) for n in MARGIN_PARTS])
    wide = wide.withColumn("recomputed", recomputed_margin()).dropna(subset=["recomputed", "gross_margin"])
    return wide.select("doc_id", "gross_margin", "recomputed", (F.abs(F.col("recomputed") - F.col("gross_margin")) < tolerance).alias("is_valid"))


def overall_score(parts: DataFrame, columns: list[str], issues: str) -> DataFrame:
    """Mean of the scores that exist, together with a quality score of 1 less 0.1 an issue; complete from 0.7."""
    quality = F.greatest(F.lit(0.0), 1 - F.col(issues) * 0.1)
    have = F.filter(F.array(*[dbl(c) for c in columns], quality), lambda x: x.isNotNull())
    mean = F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.size(have)
    return parts.withColumns({"quality_score": quality, "overall_score": mean, "is_complete": mean >= 0.7})


def extraction_rate(expected: DataFrame, found: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Found over expected fields; 1 or 0 where nothing is expected; complete from 0.7."""
    e = expected.select(*keys).distinct().withColumn("want", F.lit(1))
    f = found.select(*keys).distinct().withColumn("got", F.lit(1))
    both = e.join(f, keys, "full_outer").groupBy(*by).agg(F.count("want").alias("expected"), F.count("got").alias("extracted"), F.count(F.when(F.col("want").isNotNull() & F.col("got").isNotNull(), 1)).alias("met"))
    rate = F.when(F.col("expected") > 0, F.col("met") / F.col("expected")).when(F.col("extracted") > 0, 1.0).otherwise(0.0)
    return both.select(*by, "expected", "extracted", rate.alias("rate"), (rate >= 0.7).alias("is_complete"))


def gate_checks(facts: DataFrame, segments: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Named checks over the whole load, one row each, and ``overall``; texts are checked where ``pages`` are given."""
    a = facts.agg(F.count("*").alias("f"), F.countDistinct("concept").alias("c"))
    b = segments.agg(F.count("*").alias("s"), F.countDistinct("dimension_axis").alias("x"))
    both = a.crossJoin(b)  # two single rows
    checks = [("concepts over 500", "c", 500), ("axes over 15", "x", 15), ("segment facts over 400", "s", 400), ("facts over 500", "f", 500)]
    if pages is not None:
        both = both.crossJoin(pages.agg(F.sum(F.length("text").cast("long")).alias("t")))
        checks += [("text over 100000", "t", 100_000)]
    rows = [F.struct(F.lit(n).alias("check"), F.col(c).cast("long").alias("actual"), (F.col(c) > most).alias("passed")) for n, c, most in checks]
    passed = F.struct(F.lit("overall").alias("check"), F.lit(None).cast("long").alias("actual"), reduce(lambda x, y: x & y, [F.col(c) > most for _, c, most in checks]).alias("passed"))
    return both.select(F.explode(F.array(*rows, passed)).alias("r")).select("r.check", "r.actual", "r.passed")
