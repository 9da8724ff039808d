"""Analytical views over ``facts`` and ``segments``.

``as_of`` is always a parameter. Values leave the views as doubles; divisions by zero give null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import dbl, format_amount, growth, pct
from ledgerspark.model import ASSETS, EPS, EQUITY, NET_INCOME, OPERATING_INCOME, REVENUE


def _between(as_of: str, first: int, last: int) -> Column:
    """Period ends after ``first`` and up to ``last`` months before ``as_of``."""
    day = F.lit(as_of).cast("date")
    return (F.col("period_end") > F.add_months(day, -first)) & (F.col("period_end") <= F.add_months(day, -last))


def _largest(concept: str) -> Column:
    return F.max(F.when(F.col("concept") == concept, F.col("value")))


def latest_facts(facts: DataFrame) -> DataFrame:
    """The newest fact of each company and concept (by period end, then filing date)."""
    newest = Window.partitionBy("cik", "concept").orderBy(F.desc("period_end"), F.desc("filing_date"))
    rows = facts.withColumn("rn", F.row_number().over(newest)).where("rn = 1")
    return rows.select("cik", "entity_name", "concept", "period_end", dbl("value").alias("value"))


def company_summary(facts: DataFrame, as_of: str, enrichments: DataFrame | None = None) -> DataFrame:
    """Largest values of the last year against those of the year before, with margin, return and growth.

    ``latest_revenue`` is the largest in the range, not the newest value. Companies without a year before, or
    without enrichment, keep nulls.
    """
    now, before = _between(as_of, 12, 0), _between(as_of, 24, 12)
    top = lambda concept, when: F.max(F.when(when & (F.col("concept") == concept), F.col("value")))
    out = facts.where(now | before).groupBy("cik", "entity_name").agg(
        top(REVENUE, now).alias("revenue"), top(NET_INCOME, now).alias("income"), top(ASSETS, now).alias("assets"), top(EQUITY, now).alias("equity"),
        F.max(F.when(now, F.col("period_end"))).alias("latest_period"), top(REVENUE, before).alias("previous_revenue"),
    )
    # A company may have had another name in the year before.
    out = out.withColumn("previous_revenue", F.max("previous_revenue").over(Window.partitionBy("cik"))).where("latest_period is not null")
    v = {c: dbl(c) for c in ("revenue", "income", "assets", "equity", "previous_revenue")}
    cols = [
        "cik", "entity_name", v["revenue"].alias("latest_revenue"), v["income"].alias("latest_net_income"), v["assets"].alias("total_assets"), "latest_period",
        growth(v["revenue"], v["previous_revenue"]).alias("revenue_growth_pct"), pct(v["income"], v["revenue"]).alias("net_margin_pct"), pct(v["income"], v["equity"]).alias("roe_pct"),
    ]
    if enrichments is not None:
        score = enrichments.groupBy("cik").agg(F.max("health_score").alias("health_score"))
        return out.join(score, "cik", "left").select(*cols, "health_score")
    return out.select(*cols)


def segment_growth(segments: DataFrame) -> DataFrame:
    """Each segment value with the one before it and the change in percent."""
    w = Window.partitionBy("cik", "dimension_axis", "dimension_member", "concept").orderBy("period_end")
    rows = segments.withColumn("value", dbl("value")).withColumn("previous_value", F.lag("value").over(w))
    return rows.withColumn("growth_pct", growth(F.col("value"), F.col("previous_value")))


def segment_performance(segments: DataFrame, compat: bool = False) -> DataFrame:
    """Segment trend with neighbours and status: the newest period is ``Latest``. ``compat`` marks the oldest."""
    w = Window.partitionBy("cik", "dimension_axis", "dimension_member", "concept").orderBy("period_end")
    rows = segments.withColumn("value", dbl("value")).withColumns({"previous_value": F.lag("value").over(w), "next_value": F.lead("value").over(w), "other": (F.lag if compat else F.lead)("period_end").over(w)})
    status = F.when(F.col("other").isNull(), "Latest").otherwise("Historical")
    return rows.select("cik", "dimension_axis", "dimension_member", "concept", "period_end", "value", "previous_value", "next_value", growth(F.col("value"), F.col("previous_value")).alias("growth_pct"), status.alias("period_status"))


def peer_comparison(facts: DataFrame, as_of: str) -> DataFrame:
    """Ranks of companies by revenue, income and assets in the last quarter; ranking is at company grain only, so its one
    task holds a row a company."""
    day = F.lit(as_of).cast("date")
    one = facts.where(F.col("period_end") >= F.add_months(day, -3)).groupBy("cik", "entity_name").agg(
        _largest(REVENUE).cast("double").alias("revenue"), _largest(NET_INCOME).cast("double").alias("net_income"), _largest(ASSETS).cast("double").alias("total_assets"), F.max("period_end").alias("latest_period")
    )
    rank = lambda c: F.rank().over(Window.orderBy(F.desc_nulls_last(c)))
    one = one.withColumns({"revenue_rank": rank("revenue"), "profitability_rank": rank("net_income"), "size_rank": rank("total_assets")})
    #: The names of the tiers.
    tier = F.when(F.col("revenue_rank") <= 3, "Top 3").when(F.col("revenue_rank") <= 10, "Top 10").otherwise("Other")
    return one.withColumns({"net_margin_pct": pct(F.col("net_income"), F.col("revenue")), "asset_turnover": F.try_divide("revenue", F.nullif("total_assets", F.lit(0.0))), "revenue_tier": tier})


def time_series(facts: DataFrame, as_of: str, years: int = 5) -> DataFrame:
    """Facts of the last years with year, quarter and a sequence number per company and concept."""
    w = Window.partitionBy("cik", "concept").orderBy("period_end")
    rows = facts.where(_between(as_of, 12 * years, 0)).withColumn("sequence", F.row_number().over(w))
    return rows.select("cik", "entity_name", "concept", "period_end", F.year("period_end").alias("year"), F.quarter("period_end").alias("quarter"), dbl("value").alias("value"), "sequence")


def financial_model(facts: DataFrame) -> DataFrame:
    """One row per company and period: revenue, operating income, net income, margin, growth on the period before."""
    wide = facts.groupBy("cik", "entity_name", "period_end").agg(*[_largest(c).cast("double").alias(n) for n, c in (("revenue", REVENUE), ("operating_income", OPERATING_INCOME), ("net_income", NET_INCOME), ("eps", EPS))])
    before = F.lag("revenue").over(Window.partitionBy("cik").orderBy("period_end"))
    margin = F.when(F.col("revenue") > 0, F.col("operating_income") / F.col("revenue") * 100)
    return wide.withColumn("previous", before).select("cik", "entity_name", "period_end", "revenue", "operating_income", "net_income", "eps", margin.alias("operating_margin_pct"), growth(F.col("revenue"), F.col("previous")).alias("revenue_growth_pct"))


def segment_pivot(segments: DataFrame, years: list[int]) -> DataFrame:
    """Revenue by axis and member, a column per year; the list of years is given, so the schema is fixed."""
    rows = segments.where(F.col("concept") == REVENUE).withColumn("year", F.year("period_end"))
    out = rows.groupBy("dimension_axis", "dimension_member").pivot("year", years).agg(F.sum("value"))
    return out.select("dimension_axis", "dimension_member", *[dbl(f"`{y}`").alias(f"y{y}") for y in years])


def segment_listing(segments: DataFrame, as_of: str) -> DataFrame:
    return segments.where(_between(as_of, 12, 0) & (F.col("concept") == REVENUE)).select("cik", "dimension_axis", "dimension_member", "period_end", dbl("value").alias("value"))


def fact_counts(facts: DataFrame, segments: DataFrame) -> DataFrame:
    """Facts, concepts, segment rows and axes of each company."""
    f = facts.groupBy("cik").agg(F.count("*").alias("total_facts"), F.countDistinct("concept").alias("unique_concepts"))
    s = segments.groupBy("cik").agg(F.count("*").alias("segmented_facts"), F.countDistinct("dimension_axis").alias("segment_dimensions"))
    return f.join(s, "cik", "left").select("cik", "total_facts", "unique_concepts", F.coalesce("segmented_facts", F.lit(0)).alias("segmented_facts"), F.coalesce("segment_dimensions", F.lit(0)).alias("segment_dimensions"))


def data_summary(facts: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Concepts, facts and periods of each company and, where ``segments`` are given, their axes and facts."""
    out = facts.groupBy("cik").agg(F.countDistinct("concept").alias("concepts"), F.count("*").alias("facts"), F.countDistinct("period_end").alias("periods"))
    if segments is None:
        return out
    s = segments.groupBy("cik").agg(F.countDistinct("dimension_axis").alias("axes"), F.count("*").alias("segment_facts"))
    return out.join(s.hint("merge"), "cik", "left").fillna(0, ["axes", "segment_facts"])


def period_coverage(facts: DataFrame) -> DataFrame:
    """Years and months covered, as a range text and counts."""
    y = F.year("period_end")
    out = facts.groupBy("cik").agg(F.min(y).alias("lo"), F.max(y).alias("hi"), F.countDistinct(y).alias("year_count"), F.countDistinct(F.substring(F.col("period_end").cast("string"), 1, 7)).alias("month_count"), F.sort_array(F.collect_set(y)).alias("ys"))
    return out.select("cik", F.concat_ws("-", "lo", "hi").alias("range"), "year_count", "month_count", F.array_join(F.col("ys").cast("array<string>"), ",").alias("years"))


def members_per_axis(segments: DataFrame) -> DataFrame:
    return segments.groupBy("dimension_axis").agg(F.countDistinct("dimension_member").alias("members"), F.count("*").alias("facts"))


def sample_members(segments: DataFrame, axes: int = 5, members: int = 3) -> DataFrame:
    """The first members of the first axes, by name."""
    pairs = segments.select("dimension_axis", "dimension_member").distinct()
    rows = pairs.withColumn("member_no", F.row_number().over(Window.partitionBy("dimension_axis").orderBy("dimension_member"))).where(F.col("member_no") <= members)
    return rows.withColumn("axis_no", F.dense_rank().over(Window.orderBy("dimension_axis"))).where(F.col("axis_no") <= axes)


def series_stats(facts: DataFrame) -> DataFrame:
    return facts.groupBy("cik", "concept").agg(F.count("*").alias("n"), dbl(F.min("value")).alias("lo"), dbl(F.max("value")).alias("hi"), (dbl(F.sum("value")) / F.count("value")).alias("mean"))


def series_growth(facts: DataFrame) -> DataFrame:
    """Change of the last value of a series against the first, on the absolute first."""
    ends = facts.groupBy("cik", "concept").agg(F.min_by("value", "period_end").alias("a"), F.max_by("value", "period_end").alias("b"))
    return ends.select("cik", "concept", growth(dbl("b"), dbl("a")).alias("growth_pct"))


def series_trend(facts: DataFrame, band: float = 0.05) -> DataFrame:
    """``increasing``, ``decreasing`` or ``stable``: mean of the second half against the first; needs 3 values."""
    key = ["cik", "concept"]
    w = Window.partitionBy(*key)
    rows = facts.withColumns({"k": F.row_number().over(w.orderBy("period_end")), "n": F.count("*").over(w)}).where("n >= 3")
    first = F.col("k") <= F.floor(F.col("n") / 2)
    half = lambda cond: dbl(F.sum(F.when(cond, F.col("value")))) / F.count(F.when(cond, F.col("value")))
    out = rows.groupBy(*key).agg(half(first).alias("a"), half(~first).alias("b"))
    label = F.when(F.col("b") > F.col("a") * (1 + band), "increasing").when(F.col("b") < F.col("a") * (1 - band), "decreasing").otherwise("stable")
    return out.select(*key, label.alias("trend"))


def series_op(df: DataFrame, op: str) -> DataFrame:
    """Growth, average or trend of every series, by name."""
    return {"growth": series_growth, "average": series_stats, "trend": series_trend}[op](df)


def entity_digest(facts: DataFrame) -> DataFrame:
    """A line of text per company: newest revenue, margin and growth on the period before."""
    model = financial_model(facts).where("revenue is not null")
    newest = Window.partitionBy("cik").orderBy(F.desc("period_end"))
    one = model.withColumn("rn", F.row_number().over(newest)).where("rn = 1")
    shown = lambda c: F.format_string("%.1f%%", c)
    text = F.concat_ws("; ", F.concat(F.lit("revenue "), format_amount(F.col("revenue"))), F.concat(F.lit("margin "), shown(F.col("operating_margin_pct"))), F.concat(F.lit("EPS "), F.format_string("%.2f", F.col("eps"))), F.concat(F.lit("growth "), shown(F.col("revenue_growth_pct"))))
    return one.select("cik", "entity_name", "period_end", text.alias("digest"))


def recent_values(facts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest values of each company and concept."""
    w = Window.partitionBy("cik", "concept").orderBy(F.desc("period_end"))
    return facts.withColumn("age", F.row_number().over(w)).where(F.col("age") <= k).select("cik", "concept", "period_end", dbl("value").alias("value"), "age")


def run_summary(status: DataFrame) -> DataFrame:
    """Runs by status: count, total and mean duration."""
    s = F.sum(F.col("seconds").cast("decimal(18,4)"))
    return status.groupBy("fetch_status").agg(F.count("*").alias("runs"), F.countDistinct("cik").alias("companies"), dbl(s).alias("total_seconds"), (dbl(s) / F.count("seconds")).alias("mean_seconds"))


def latest_status(status: DataFrame) -> DataFrame:
    """Newest status of each company."""
    return status.groupBy("cik").agg(F.max_by(F.struct("fetch_status", "accession_number"), F.struct("created_at", "accession_number")).alias("x")).select("cik", "x.fetch_status", "x.accession_number")


def anomalies(facts: DataFrame, limit: float = 0.2) -> DataFrame:
    """Deviation of each value from the mean of its company, concept and quarter; above ``limit`` is flagged."""
    rows = facts.withColumn("quarter", F.quarter("period_end"))
    mean = rows.groupBy("cik", "concept", "quarter").agg((dbl(F.sum("value")) / F.count("value")).alias("expected"))
    out = rows.join(mean, ["cik", "concept", "quarter"]).withColumn("value", dbl("value"))
    deviation = F.try_divide(F.abs(F.col("value") - F.col("expected")), F.abs(F.nullif("expected", F.lit(0.0))))
    return out.select("cik", "concept", "period_end", "value", "expected", deviation.alias("deviation"), F.coalesce(deviation > limit, F.lit(False)).alias("is_anomaly"))


def fit_anomaly_model(facts: DataFrame):
    """Gradient-boosted trees for value by concept, year and quarter (Spark ML); the label is no feature."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    steps = [
        StringIndexer(inputCol="concept", outputCol="concept_id", handleInvalid="keep"), OneHotEncoder(inputCols=["concept_id"], outputCols=["concept_vec"]),
        VectorAssembler(inputCols=["concept_vec", "year", "quarter"], outputCol="features"), GBTRegressor(labelCol="value", maxIter=10, seed=42),
    ]
    return Pipeline(stages=steps).fit(_model_rows(facts))


def _model_rows(facts: DataFrame) -> DataFrame:
    return facts.where("value is not null").select("cik", "concept", "period_end", dbl("value").alias("value"), F.year("period_end").alias("year"), F.quarter("period_end").alias("quarter"))


def model_anomalies(facts: DataFrame, model, limit: float = 0.2) -> DataFrame:
    """Predictions of ``fit_anomaly_model`` and the relative deviation on the absolute prediction."""
    out = model.transform(_model_rows(facts))
    deviation = F.try_divide(F.abs(F.col("value") - F.col("prediction")), F.abs(F.nullif("prediction", F.lit(0.0))))
    return out.select("cik", "concept", "period_end", "value", "prediction", (F.coalesce(deviation, F.lit(0.0)) > limit).alias("is_anomaly"))
