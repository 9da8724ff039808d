"""Report pages and metrics derived from orders and their lines, so that they grow with the tables, with their SQL twins.

A document is a customer, a page one of its orders, a sentence and a table row one of the order's lines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.operators.reports import REQUIRED
from ledgerspark.sources.testtables import load

HEADS = ["Financial results. ", "Key metrics. ", "Segment information. ", "Financial highlights and business segments. ", "Notes. ", "Notes. ", "Notes. "]
SENTENCES = [
    "Vehicle production: {q} units produced. ", "Vehicle deliveries reached {q} units. ", "Energy storage of {q} GWh deployed, energy storage {p}. ", "Total revenue was ${e} million. ",
    "Service revenue was ${e} million. ", "Gross margin {q}% on deliveries of {q} vehicles. ", "Net income of ${e} million. ", "Outlook for {q} users. ",
]
TABLES = [["Item", "Q1 2024"], ["Segment", "Amount"], ["Region", "Amount"], ["Operating data", "Amount"]]
LABELS, CELLS = ["Total revenue", "United States", "Units delivered", "Gross margin"], ["{e}", "{q}", "{q} units", "{q}%"]
NAMES = [n for names in REQUIRED.values() for n in names]


def _filled(pattern: str, part: Column, quantity: Column, price: Column) -> Column:
    values = {"q": quantity, "p": part, "e": price}
    pieces = re.split(r"\{(\w)\}", pattern)  # texts and keys in turn
    return F.concat(*[values[x].cast("string") if i % 2 else F.lit(x) for i, x in enumerate(pieces) if x])


def _pick(options: list[Column], at: Column) -> Column:
    """The option of that number; the others are not worked out."""
    out = F.when(F.lit(False), options[0])
    for i, option in enumerate(options):
        out = out.when(at == i, option)
    return out


def pages(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, page_num, text, tables, image_count)."""
    q, e, part = F.col("q"), F.col("e"), F.col("l_partkey")
    made = lambda patterns, n: _pick([_filled(p, part, q, e) for p in patterns], part % n)
    lines = load(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.floor("l_quantity").cast("long").alias("q"), F.floor("l_extendedprice").cast("long").alias("e"))
    # Sentences and cells are made on plain lines, after these were shuffled.
    lines = lines.repartition("l_orderkey").withColumns({"sentence": made(SENTENCES, 8), "row": F.array(_pick([F.lit(n) for n in LABELS], part % 4), made(CELLS, 4))})
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "q", "e", "sentence", "row")
    lines = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    rows = load(s, d, "orders").select("o_orderkey", "o_custkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    head = _pick([F.array(*[F.lit(c) for c in h]) for h in TABLES], F.col("o_orderkey") % 5)
    text = F.concat(_pick([F.lit(h) for h in HEADS], F.col("o_orderkey") % 7), F.array_join("lines.sentence", ""))
    tables = F.when(F.col("o_orderkey") % 5 < 4, F.array(F.concat(F.array(head), F.col("lines.row")))).otherwise(F.array().cast("array<array<array<string>>>"))
    turn = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = rows.select("o_custkey", "o_orderkey", text.alias("text"), tables.alias("tables")).withColumn("page_num", F.row_number().over(turn))
    return rows.select(F.col("o_custkey").alias("doc_id"), "page_num", "text", "tables", F.lit(0).alias("image_count"))


def _sql(patterns: list[str], n: str) -> str:
    quoted = lambda p: "'" + p.replace("{q}", "' || q || '").replace("{p}", "' || l_partkey || '").replace("{e}", "' || e || '") + "'"
    return f"CASE {n} " + " ".join(f"WHEN {i} THEN {quoted(p)}" for i, p in enumerate(patterns)) + " END"


#: ``olines``: a row a line with its page; ``opages``: the pages' texts.
PAGES = f"""
onum AS (SELECT o_orderkey, o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page_num FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
olines AS (SELECT *, {_sql(SENTENCES, 'l_partkey % 8')} AS sentence, {_sql(LABELS, 'l_partkey % 4')} AS label, {_sql(CELLS, 'l_partkey % 4')} AS cell, {_sql([' '.join(h) for h in TABLES], 'o_orderkey % 5')} AS header,
  row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, q, e) AS row_num
  FROM (SELECT *, cast(floor(l_quantity) AS bigint) AS q, cast(floor(l_extendedprice) AS bigint) AS e FROM lineitem JOIN onum ON l_orderkey = o_orderkey)),
opages AS (SELECT doc_id, page_num, o_orderkey, {_sql(HEADS, 'o_orderkey % 7')} || string_agg(sentence, '' ORDER BY row_num) AS text FROM olines GROUP BY 1, 2, 3)
"""


def contexts(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, metric, name, context): a metric for each line of an order, some of them totals, named and described by its part and supplier."""
    x = load(s, d, "lineitem")
    words = F.concat_ws(" ", F.lit("Units"), F.concat(F.lit("t"), F.col("l_linenumber")), "l_returnflag", "l_linestatus", F.concat(F.lit("s"), F.col("l_suppkey") % 4), F.concat(F.lit("p"), F.col("l_partkey") % 5), F.concat(F.lit("q"), F.floor("l_quantity").cast("long") % 3))
    name = F.concat(F.when(F.col("l_partkey") % 5 == 0, "Total part ").otherwise("part "), F.col("l_partkey").cast("string"))
    return x.select(F.col("l_orderkey").alias("doc_id"), F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey").alias("metric"), name.alias("name"), words.alias("context"))


CONTEXTS = """
ctx AS (SELECT l_orderkey AS doc_id, concat_ws('/', l_linenumber, l_partkey, l_suppkey) AS metric, CASE WHEN l_partkey % 5 = 0 THEN 'Total part ' ELSE 'part ' END || l_partkey AS name,
  list_distinct(string_split(lower(concat_ws(' ', 'Units', 't' || l_linenumber, l_returnflag, l_linestatus, 's' || (l_suppkey % 4), 'p' || (l_partkey % 5), 'q' || (cast(floor(l_quantity) AS bigint) % 3))), ' ')) AS w FROM lineitem)
"""


def metrics(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, name, value): the metrics of a customer's report, one for each line, some zero."""
    x = load(s, d, "lineitem").join(load(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return x.select(F.col("o_custkey").alias("doc_id"), _pick([F.lit(n) for n in NAMES], F.col("l_partkey") % len(NAMES)).alias("name"), (F.floor("l_quantity") % 2).cast("double").alias("value"))


METRICS = f"""
om AS (SELECT o_custkey AS doc_id, ({NAMES!r})[1 + l_partkey % {len(NAMES)}] AS name, cast(floor(l_quantity) AS bigint) % 2 AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
