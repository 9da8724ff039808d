"""Readers of landed files and writers of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.model import COMPANY_FACTS, FILING_INDEX, SUBMISSIONS
from ledgerspark.sources import tables


def read_company_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPANY_FACTS).json(path, multiLine=True)


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUBMISSIONS).json(path, multiLine=True)


def read_filing_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILING_INDEX).json(path, multiLine=True)


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Saved responses, a file each: (path, response)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("response"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_facts(facts: DataFrame, path: str) -> None:
    """Merge fact or segment rows, partitioned by company; a row replaces the stored one of its key (``tables.FACT_KEY``, as far as
    it has these columns, else all but the value), so a replay adds nothing."""
    keys = [c for c in tables.FACT_KEY if c in facts.columns]
    keys = keys if len(keys) == len(tables.FACT_KEY) else [c for c in facts.columns if c != "value"]
    tables.upsert(facts, path, keys)


write_segments = write_facts


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("cik").json(path)


def write_texts(texts: DataFrame, path: str) -> None:
    """Merge text rows by company, filing date and time; the full text joins filing and report text."""
    full = F.concat_ws("\n", "full_text", "pdf_text")
    tables.upsert(texts.withColumn("full_text", full), path, [c for c in ("cik", "filing_date", "created_at") if c in texts.columns])


def append_status(status: DataFrame, path: str) -> None:
    """Merge status events: an event (company, filing, time, status) is stored once."""
    tables.upsert(status, path, [c for c in ("cik", "accession_number", "created_at", "fetch_status") if c in status.columns])


def write_enrichments(rows: DataFrame, path: str) -> None:
    """Merge enrichment rows by company and filing date; struct columns are stored as JSON text."""
    nested = [f.name for f in rows.schema if f.dataType.typeName() in ("struct", "array", "map")]
    flat = rows.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in rows.columns])
    tables.upsert(flat, path, ["cik", "filing_date"])


def write_filings_meta(filings: DataFrame, path: str) -> DataFrame:
    """Merge filings as metadata rows by company; returns their first status events (``pending_processing``)."""
    tables.upsert(filings, path, ["cik", "accession"])
    return filings.select("cik", F.col("accession").alias("accession_number"), F.lit("pending_processing").alias("fetch_status"), F.current_timestamp().alias("created_at"))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Merged JSON documents back as long facts (cik, entity_name, concept, value, unit, period)."""
    kind = "metadata struct<cik:string,entityName:string>, structured struct<facts:map<string,array<struct<value:double,unit:string,period:string>>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True)
    rows = rows.select(F.col("metadata.cik").alias("cik"), F.col("metadata.entityName").alias("entity_name"), F.explode("structured.facts").alias("concept", "values"))
    return rows.select("cik", "entity_name", "concept", F.explode("values").alias("v")).select("cik", "entity_name", "concept", "v.value", "v.unit", "v.period")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def filing_text(texts: DataFrame, keys: DataFrame, limit: int = 50_000) -> DataFrame:
    """The first characters of the newest text of each wanted filing."""
    rows = texts.join(keys.select("cik", "filing_date").distinct(), ["cik", "filing_date"], "left_semi")
    text = F.substring(F.concat_ws("\n", "full_text", "management_discussion", "risk_factors"), 1, limit)
    return rows.groupBy("cik", "filing_date").agg(F.max_by(text, "created_at").alias("text"))
