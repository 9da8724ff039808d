"""Disclosure tables derived from the star-schema tables, each with its SQL twin.

A company is a supplier, so their number grows with the tables; a period ends with a quarter of the ship date. The
orders of a customer count for the supplier with the number of the customer modulo the suppliers. Products are cast to
decimals before they are summed, so no result hangs on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quarter_end(c: str) -> Column:
    return F.last_day(F.add_months(F.trunc(F.col(c).cast("date"), "quarter"), 2))


def _money(c: Column) -> Column:
    return F.sum(c.cast(MONEY)).cast("decimal(38,4)")


def _measures() -> list[Column]:
    e, d, t = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    net = e * (1 - d)
    return [
        _money(net).alias("Revenues"),
        _money(e * d).alias("CostOfRevenue"),
        _money(e * (1 - d - t)).alias("OperatingIncomeLoss"),
        _money(F.when(F.col("l_returnflag") == "R", -net).otherwise(net)).alias("NetIncomeLoss"),
        F.max(F.col("l_extendedprice").cast(MONEY)).cast("decimal(38,4)").alias("EarningsPerShareBasic"),
    ]


def _long(df: DataFrame, keys: list[str]) -> DataFrame:
    names = [c for c in df.columns if c not in keys]
    return df.unpivot(keys, names, "concept", "value")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cik, entity_name, filing_date, period_end, concept, value, unit, segment_dimension, segment_member, source)."""
    suppliers = load(spark, sf_dir, "supplier")
    lines = load(spark, sf_dir, "lineitem").withColumn("period_end", quarter_end("l_shipdate"))
    flows = _long(lines.groupBy(F.col("l_suppkey").alias("sk"), "period_end").agg(*_measures()), ["sk", "period_end"])
    count = F.broadcast(suppliers.agg(F.count("*").alias("n")))  # one row
    orders = load(spark, sf_dir, "orders").crossJoin(count).withColumn("period_end", quarter_end("o_orderdate"))
    price = F.col("o_totalprice")
    stocks = orders.groupBy((F.col("o_custkey") % F.col("n")).alias("sk"), "period_end").agg(_money(price).alias("Assets"), _money(F.when(F.col("o_orderstatus") == "F", price).otherwise(0.0)).alias("StockholdersEquity"))
    rows = flows.unionByName(_long(stocks, ["sk", "period_end"])).join(suppliers, F.col("sk") == F.col("s_suppkey"))
    none = F.lit(None).cast("string")
    return rows.select(
        F.lpad(F.col("sk").cast("string"), 10, "0").alias("cik"), F.col("s_name").alias("entity_name"), F.date_add("period_end", 45).alias("filing_date"), "period_end", "concept", "value",
        F.lit("USD").alias("unit"), none.alias("segment_dimension"), none.alias("segment_member"), F.lit("sec_api").alias("source"),
    )


FACTS = """
flows AS (SELECT l_suppkey AS sk, last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS period_end,
  sum(cast(l_extendedprice * (1 - l_discount) AS decimal(18,4))) AS a, sum(cast(l_extendedprice * l_discount AS decimal(18,4))) AS b,
  sum(cast(l_extendedprice * (1 - l_discount - l_tax) AS decimal(18,4))) AS c,
  sum(cast(CASE WHEN l_returnflag = 'R' THEN -(l_extendedprice * (1 - l_discount)) ELSE l_extendedprice * (1 - l_discount) END AS decimal(18,4))) AS d, max(cast(l_extendedprice AS decimal(18,4))) AS e
  FROM lineitem GROUP BY 1, 2),
stocks AS (SELECT o_custkey % (SELECT count(*) FROM supplier) AS sk, last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS period_end,
  sum(cast(o_totalprice AS decimal(18,4))) AS a, sum(cast(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS decimal(18,4))) AS b
  FROM orders GROUP BY 1, 2),
facts AS (SELECT lpad(cast(sk AS varchar), 10, '0') AS cik, s_name AS entity_name, period_end + 45 AS filing_date, period_end, concept, value, 'USD' AS unit, 'sec_api' AS source FROM (
  SELECT sk, period_end, 'Revenues' AS concept, a AS value FROM flows UNION ALL SELECT sk, period_end, 'CostOfRevenue', b FROM flows
  UNION ALL SELECT sk, period_end, 'OperatingIncomeLoss', c FROM flows UNION ALL SELECT sk, period_end, 'NetIncomeLoss', d FROM flows
  UNION ALL SELECT sk, period_end, 'EarningsPerShareBasic', e FROM flows
  UNION ALL SELECT sk, period_end, 'Assets', a FROM stocks UNION ALL SELECT sk, period_end, 'StockholdersEquity', b FROM stocks) JOIN supplier ON sk = s_suppkey)
"""

AXES = {"ProductOrServiceAxis": "p_brand", "StatementGeographicalAxis": "r_name", "StatementBusinessSegmentsAxis": "c_mktsegment"}


#: Lines in a task of the shuffles of ``segments``: few, as a task holds the sums of its lines by member twice (before and after they meet).
LINES = 100_000


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cik, dimension_axis, dimension_member, concept, period_end, value): revenue and income by axis member.

    A line is shuffled by its part, its order and its company, and no more: what is summed lies by company, as do the rows that come
    out. The number of tasks follows that of the lines, so the memory of one does not."""
    t = lambda n: load(spark, sf_dir, n)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-t("lineitem").count() // LINES))
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")  # 25 rows
    buyers = t("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name", "c_mktsegment")
    met = lambda rows, key, side, other: rows.repartition(n, key).join(side.repartition(n, other).hint("shuffle_hash"), F.col(key) == F.col(other)).drop(key, other)
    sold = met(t("orders").select("o_orderkey", "o_custkey"), "o_custkey", buyers, "c_custkey")
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY)
    lines = t("lineitem").select("l_partkey", "l_orderkey", "l_suppkey", quarter_end("l_shipdate").alias("period_end"), net.alias("net"), (F.col("l_returnflag") == "R").alias("back"))
    lines = met(lines, "l_partkey", t("part").select("p_partkey", "p_brand"), "p_partkey")
    lines = met(lines, "l_orderkey", sold, "o_orderkey")
    cik = F.lpad(F.col("l_suppkey").cast("string"), 10, "0")
    lines = lines.repartition(n, cik).withColumn("cik", cik)
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("dimension_axis"), F.col(c).alias("dimension_member")) for a, c in AXES.items()]))
    wide = lines.select("cik", "period_end", "net", "back", pairs.alias("x"))
    wide = wide.groupBy("cik", F.col("x.dimension_axis"), F.col("x.dimension_member"), "period_end")
    total = lambda c: F.sum(c).cast("decimal(38,4)")
    wide = wide.agg(total("net").alias("Revenues"), total(F.when(F.col("back"), -F.col("net")).otherwise(F.col("net"))).alias("NetIncomeLoss"))
    # Unlike unpivot this keeps known where the rows lie, and sums that nobody reads are not made.
    rows = wide.select("*", F.explode(F.array(F.lit("Revenues"), F.lit("NetIncomeLoss"))).alias("concept"))
    value = F.when(F.col("concept") == "Revenues", F.col("Revenues")).otherwise(F.col("NetIncomeLoss"))
    return rows.select("cik", "dimension_axis", "dimension_member", "concept", "period_end", value.alias("value"))


SEGMENTS = """
seglines AS (SELECT lpad(cast(l_suppkey AS varchar), 10, '0') AS cik, last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) AS period_end,
  p_brand, r_name, c_mktsegment, cast(l_extendedprice * (1 - l_discount) AS decimal(18,4)) AS a,
  cast(CASE WHEN l_returnflag = 'R' THEN -(l_extendedprice * (1 - l_discount)) ELSE l_extendedprice * (1 - l_discount) END AS decimal(18,4)) AS b
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
segwide AS (SELECT cik, 'ProductOrServiceAxis' AS dimension_axis, p_brand AS dimension_member, period_end, sum(a) AS a, sum(b) AS b FROM seglines GROUP BY 1, 2, 3, 4
  UNION ALL SELECT cik, 'StatementGeographicalAxis', r_name, period_end, sum(a), sum(b) FROM seglines GROUP BY 1, 2, 3, 4
  UNION ALL SELECT cik, 'StatementBusinessSegmentsAxis', c_mktsegment, period_end, sum(a), sum(b) FROM seglines GROUP BY 1, 2, 3, 4),
segments AS (SELECT cik, dimension_axis, dimension_member, 'Revenues' AS concept, period_end, a AS value FROM segwide
  UNION ALL SELECT cik, dimension_axis, dimension_member, 'NetIncomeLoss', period_end, b FROM segwide)
"""


def filing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events of processing runs, from the events table: user -> company, type -> status."""
    e = load(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("processing")
    return e.select(F.lpad(F.col("user_id").cast("string"), 10, "0").alias("cik"), F.col("event_id").alias("accession_number"), status.alias("fetch_status"), F.col("value").alias("seconds"), F.col("ts").alias("created_at"), "props")


STATUS = """
status AS (SELECT lpad(cast(user_id AS varchar), 10, '0') AS cik, event_id AS accession_number,
  CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'completed' ELSE 'processing' END AS fetch_status, value AS seconds, ts AS created_at, props FROM events)
"""
