"""Semi-structured extraction responses: JSON text to leaves, routes and scores."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import number

FENCE = re.compile(r"^\s*```(?:json)?|```\s*$")


def _candidates(response: Column) -> tuple[Column, Column]:
    """The response without fences, and its part from the first to the last brace."""
    return F.trim(F.regexp_replace(response, r"(?s)^\s*```(?:json)?|```\s*$", "")), F.regexp_extract(response, r"(?s)\{.*\}", 0)


def json_text(response: Column) -> Column:
    """The JSON of a response: fences stripped, else from the first ``{`` to the last ``}``; null if neither parses."""
    bare, inner = _candidates(response)
    return F.when(F.try_parse_json(bare).isNotNull(), bare).when(F.try_parse_json(inner).isNotNull(), inner)


def fallback_values(df: DataFrame, response: str = "response") -> DataFrame:
    """Key-value pairs by pattern, of responses that hold no JSON."""
    pairs = F.regexp_extract_all(response, F.lit(r'(?i)(revenue|income|margin|deliveries)"?\s*[:=]\s*"?\$?[0-9][0-9.,]*'), F.lit(0))
    rows = df.where(json_text(F.col(response)).isNull()).select("doc_id", "page_num", F.explode(pairs).alias("p"))
    return rows.select("doc_id", "page_num", F.lower(F.regexp_extract("p", r"^(\w+)", 1)).alias("key"), F.regexp_extract("p", r"([0-9][0-9.,]*)$", 1).alias("value"))


def _parsed(text: str | None) -> object:
    """The first of a response's candidates that is JSON, numbers as they are written; None without one."""
    bare = FENCE.sub("", text or "").strip()
    lo, hi = bare.find("{"), bare.rfind("}")
    for candidate in (bare, bare[lo : hi + 1] if 0 <= lo < hi else ""):
        try:
            return json.loads(candidate, parse_float=str, parse_int=str, parse_constant=str)
        except (ValueError, RecursionError):  # no JSON, or nested beyond what the parser takes
            continue
    return None


def _leaves(tree: object) -> Iterator[tuple[str, str, str]]:
    """(path, key, value) of the scalars of a parsed text in their order, without recursion; nulls are left out. The key
    of an array's item is that of the array."""
    stack = [("", "", tree)]
    while stack:
        path, key, x = stack.pop()
        if isinstance(x, dict):
            stack += [(f"{path}.{k}" if path else k, k, v) for k, v in reversed(x.items())]
        elif isinstance(x, list):
            stack += [(f"{path}[{i}]", key, v) for i, v in reversed(list(enumerate(x)))]
        elif x is not None and path:
            yield path, key, str(x).lower() if isinstance(x, bool) else x


def json_leaves(df: DataFrame, response: str = "response") -> DataFrame:
    """(doc_id, page_num, path, key, value, type) of all scalar leaves, however deep, in one walk of each response; paths
    are ``a.b[0]``, null leaves are left out, of equal keys of an object the last counts. Responses without JSON give no
    rows. The plan does not depend on the data."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                rows = [(i, *leaf) for i, text in enumerate(part.column(2).to_pylist()) for leaf in _leaves(_parsed(text))]
                i, path, key, value = zip(*rows, strict=True) if rows else ((), (), (), ())
                took = pa.array(i, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(took), part.column(1).take(took), *(pa.array(c, pa.string()) for c in (path, key, value))], ["doc_id", "page_num", "path", "key", "value"])

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in ("doc_id", "page_num"))
    out = df.select("doc_id", "page_num", F.col(response).cast("string")).mapInArrow(walk, f"{kinds}, path string, key string, value string")
    return out.where(~F.col("key").isin("page_number", "units", "timeperiod")).withColumn("type", value_type(F.col("path"), F.col("value")))


def value_type(path: Column, value: Column | None = None) -> Column:
    """Kind of a value by the words of its path, else by a percent sign."""
    low = F.lower(path)
    #: Kinds and the words that tell them, in the order of the tests.
    rules = [("revenue", "revenue|sales"), ("margin", "margin|gross|operating"), ("operational", "production|delivery|units|volume"), ("income", "income|profit|earnings")]
    out = F.when(F.lit(False), "")
    for kind, words in rules:
        out = out.when(low.rlike(words), kind)
    return (out if value is None else out.when(F.contains(value, F.lit("%")), "percentage")).otherwise("other")


def type_histogram(leaves: DataFrame) -> DataFrame:
    return leaves.groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("documents"))


def route_values(leaves: DataFrame) -> DataFrame:
    """Target place of each leaf, with its number."""
    low = F.lower("path")
    target = (
        F.when(low.rlike("total") & low.rlike("revenue"), "revenue.total").when(low.rlike("segment"), "segments").when(low.rlike("margin"), "margins").when(low.rlike("income"), "income")
        .when(low.rlike("deliver|production"), "operational").otherwise("other")
    )
    return leaves.select("doc_id", "page_num", "path", target.alias("target_path"), number(F.col("value")).alias("value")).where("value is not null")


def scalar(text: Column, path: str) -> Column:
    """A scalar of a JSON text; null for arrays and objects."""
    v = F.get_json_object(text, path)
    return F.when(~v.startswith("[") & ~v.startswith("{"), v)


def insights_view(enrichments: DataFrame, facts: DataFrame) -> DataFrame:
    """Highlight, outlook and the first trend of each enrichment, with the company's name."""
    names = facts.select("cik", "entity_name").distinct()
    trends = F.from_json(F.get_json_object("insights", "$.trends"), "array<string>")
    return enrichments.join(names, "cik").select("cik", "entity_name", scalar(F.col("insights"), "$.highlight").alias("highlight"), scalar(F.col("insights"), "$.outlook").alias("outlook"), F.get(trends, F.lit(0)).alias("first_trend"), "health_score")
