"""Column helpers used inside the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def pct(a: Column, b: Column) -> Column:
    """a / b in percent, null where b is zero or null."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0))) * 100


def growth(now: Column, before: Column) -> Column:
    """Percentage change on the absolute base; null where the base is zero or null."""
    return F.try_divide(now - before, F.abs(F.nullif(before, F.lit(0.0)))) * 100


def period_year(period: Column) -> Column:
    """Year of ``YYYY``, ``YYYY-...``, ``YYYYMMDD`` and of forms that hold four digits after a letter (CY2024Q1)."""
    found = F.coalesce(F.nullif(F.regexp_extract(period, r"^(\d{4})(?:$|-|\d{4}$)", 1), F.lit("")), F.nullif(F.regexp_extract(period, r"[A-Z](\d{4})", 1), F.lit("")))
    return found.cast("int")


def number(text: Column) -> Column:
    """A number in a table cell, in millions: ``$ , %`` are dropped, ``(x)`` is negative, B, M and K scale;
    otherwise the first number of the text; null without one."""
    bare = F.regexp_replace(text, r"[$,%\s]", "")
    negative = bare.rlike(r"^\(.*\)$")
    bare = F.regexp_replace(bare, r"[()]", "")
    scale = F.when(bare.rlike(r"(?i)\dB$"), 1000.0).when(bare.rlike(r"(?i)\dK$"), 0.001).otherwise(1.0)
    found = F.nullif(F.regexp_extract(bare, r"-?\d+\.?\d*", 0), F.lit(""))
    value = found.cast("double") * scale
    return F.when(negative, -value).otherwise(value)


def is_number(text: Column) -> Column:
    return F.regexp_replace(text, r"[$,\s()]", "").rlike(r"^-?\d+(\.\d+)?$")


def row_value(row: Column) -> Column:
    """Rightmost numeric cell that is no percentage; the first column is a name and is left out."""
    cells = F.reverse(F.slice(row, F.lit(2), F.greatest(F.size(row) - 1, F.lit(0))))
    return number(F.try_element_at(F.filter(cells, lambda c: is_number(c) & ~F.contains(c, F.lit("%"))), F.lit(1)))


def row_percent(row: Column) -> Column:
    """Rightmost percentage of a row."""
    cells = F.reverse(F.slice(row, F.lit(2), F.greatest(F.size(row) - 1, F.lit(0))))
    return F.regexp_replace(F.try_element_at(F.filter(cells, lambda c: F.contains(c, F.lit("%"))), F.lit(1)), r"[%\s]", "").cast("double")


def normal_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"\s+", "_"), r"[^a-z0-9_]", "")


def format_amount(value: Column) -> Column:
    """``1.2B``, ``3.4M``, ``5.6K`` or the plain number with one decimal."""
    a = F.abs(value)
    return (
        F.when(a >= 1e9, F.format_string("%.1fB", value / 1e9)).when(a >= 1e6, F.format_string("%.1fM", value / 1e6)).when(a >= 1e3, F.format_string("%.1fK", value / 1e3)).otherwise(F.format_string("%.1f", value))
    )


#: Metric names and the words that tell them, in the order of the tests; ``None`` ends a family that names nothing else.
METRIC_NAMES = [
    ("revenue", [("total", "total_revenue"), ("service", "service_revenue"), ("product", "product_revenue"), ("", "revenue")]),
    ("margin", [("gross", "gross_margin"), ("operating", "operating_margin"), ("net", "net_margin"), ("", "margin")]),
    ("income|profit", [("net", "net_income"), ("operating", "operating_income"), ("gross", "gross_profit")]),
    ("delivered|shipped|sold", [("", "units_delivered")]), ("produced|manufactured", [("", "units_produced")]), ("subscribers|users|customers", [("", "active_users")]),
]


def metric_name(context: Column) -> Column:
    """Name of a metric by the words around it: the first rule that fits; null if none does."""
    c = F.lower(context)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for family, names in METRIC_NAMES:
        for word, name in names:
            out = out.when(c.rlike(family) & F.contains(c, F.lit(word)), name)
    return out


def category_token(answer: Column) -> Column:
    """The first category that a model's answer names; null without one."""
    #: The categories.
    return F.nullif(F.regexp_extract(answer, "(Revenue|Costs|Assets|Liabilities|Equity|Cash Flow|Other)", 1), F.lit(""))


def html_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags go, basic entities are decoded."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"[ \t\r\n\f]+", " "))


def title(name: Column) -> Column:
    """``north_america`` as ``North America``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def request_key(path: Column, page: Column, prompt: Column) -> Column:
    """The key under which a response is kept."""
    return F.md5(F.concat_ws(":", path, page, prompt))


def operational_class(context: Column, hit: Column) -> Column:
    """Class of an operational figure by the words around it; null if none fits."""
    c = F.lower(context)
    vehicle = F.when(F.contains(c, F.lit("deliver")), "vehicle_deliveries").when(F.contains(c, F.lit("produc")), "vehicle_production").otherwise("vehicle_metrics")
    out = F.when(c.rlike("vehicle|car|auto|deliver"), vehicle).when(c.rlike("subscriber|user|member|account"), "user_metrics").when(c.rlike("store|location|sold|transaction"), "sales_metrics")
    return out.when(F.contains(F.lower(hit), F.lit("unit")), "unit_metrics")


def financial_class(context: Column) -> Column:
    """Class of a financial figure by the words around it; null if none fits."""
    c = F.lower(context)
    has = lambda words: c.rlike(words)
    revenue = F.when(has("total"), "total_revenue").when(has("segment|product|service"), "segment_revenue").otherwise("revenue")
    income = F.when(has("gross"), "gross_profit").when(has("operating"), "operating_income").when(has("net"), "net_income").otherwise("income")
    return F.when(has("revenue"), revenue).when(has("income|profit|earning"), income).when(has("margin"), "margin").when(has("cost|expense"), "costs")
