"""Filing events as streams: requests, arrivals, status. All run with ``availableNow`` from any scheduler.

Writes are keyed by batch, so a replayed batch replaces its own rows instead of adding them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerspark.operators import flatten
from ledgerspark.operators.segments import categorize
from ledgerspark.sources.readers import filing_text

REQUEST = "companies array<struct<cik:string,name:string>>, filing_type string"
#: The default request.
DEFAULT_COMPANIES, DEFAULT_TYPE = [("0000320193", "Apple"), ("0000789019", "Microsoft"), ("0001318605", "Tesla")], "10-Q"


def requests(raw: DataFrame) -> DataFrame:
    """Request messages (JSON text in ``value``) as one row per company, with defaults."""
    r = F.from_json("value", REQUEST)
    default = F.array(*[F.struct(F.lit(c).alias("cik"), F.lit(n).alias("name")) for c, n in DEFAULT_COMPANIES])
    rows = raw.select(F.explode(F.coalesce(r["companies"], default)).alias("c"), F.coalesce(r["filing_type"], F.lit(DEFAULT_TYPE)).alias("form"))
    return rows.select(F.lpad("c.cik", 10, "0").alias("cik"), "c.name", "form")


def _keep(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def stream_new_filings(raw: DataFrame, filings: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """For each request the newest filing of each company that was not sent before. What was sent is kept as state
    (a row a filing), so a batch reads its requests and the filings, never the batches before it."""
    newest = flatten.newest_filing(filings)
    new = requests(raw).select("cik", "form").join(newest, ["cik", "form"]).dropDuplicates(["cik", "accession"]).select(*newest.columns)
    return new.writeStream.foreachBatch(lambda batch, n: _keep(batch, out, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_process_filings(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Instance files that arrive in ``folder`` -> facts, segments and statistics tables below ``out``."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.schema(kind).format("binaryFile").option("pathGlobFilter", "*.xml").load(folder)

    def step(batch: DataFrame, n: int) -> None:
        raw = flatten.flatten_instances(batch).persist()
        _keep(flatten.instance_facts(raw), f"{out}/facts", n)
        _keep(flatten.instance_segments(raw), f"{out}/segments", n)
        _keep(flatten.instance_stats(raw).withColumn("status", F.lit("processed")), f"{out}/stats", n)
        raw.unpersist()

    return files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_filing_arrivals(spark: SparkSession, folder: str, out: str, checkpoint: str, files: int = 1000, wait: str = "30 days") -> StreamingQuery:
    """Metadata files (``*metadata.json``: cik, accession_number) that arrive below ``folder`` lead to the instance files of their own
    folder -> facts, segments, statistics and, once these are written, a status event a filing.

    Both kinds of files are streams of paths, joined on their folder: a metadata file without its instance waits in state, as does
    an instance without metadata, for up to ``wait`` between the two. A batch reads the contents of its own filings,
    at most ``files`` of either kind a trigger; a metadata file that names no company or filing is left out.
    """
    kind = "path string, modificationTime timestamp, length long, content binary"
    parent = lambda c: F.regexp_replace(c, "/[^/]*$", "")
    paths = lambda glob: spark.readStream.schema(kind).format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files).load(folder)
    about = F.from_json(F.col("content").cast("string"), "cik string, accession_number string")
    meta = paths("*metadata.json").withColumn("m", about).select(parent("path").alias("folder"), F.col("modificationTime").alias("came"), "m.*").where("cik is not null and accession_number is not null")
    inst = paths("*.xml").select("path", parent("path").alias("at"), F.col("modificationTime").alias("laid"))
    near = f"folder = at and laid between came - interval {wait} and came + interval {wait}"
    both = meta.withWatermark("came", wait).join(inst.withWatermark("laid", wait), F.expr(near))

    def step(batch: DataFrame, n: int) -> None:
        batch = batch.persist()
        wanted = [r.path for r in batch.select("path").distinct().limit(2 * files).collect()]  # bounded by the trigger
        if wanted:
            raw = flatten.flatten_instances(spark.read.format("binaryFile").load(wanted)).persist()
            _keep(flatten.instance_facts(raw), f"{out}/facts", n)
            _keep(flatten.instance_segments(raw), f"{out}/segments", n)
            _keep(flatten.instance_stats(raw), f"{out}/stats", n)
            raw.unpersist()
        done = batch.groupBy(F.lpad("cik", 10, "0").alias("cik"), "accession_number").agg(F.count("*").alias("files"), F.max(F.greatest("came", "laid")).alias("created_at"))
        _keep(done.withColumn("fetch_status", F.lit("completed")), f"{out}/status", n)
        batch.unpersist()

    return both.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_enrichments(messages: DataFrame, texts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Filing-processed messages (cik, filing_date, sample_facts, axes) -> enrichment rows with the categories of the
    sample's concepts and the filing's text; the model that would judge them is not called, so its columns stay null."""
    spark = messages.sparkSession

    def step(batch: DataFrame, n: int) -> None:
        concepts = batch.select("cik", "filing_date", F.explode(F.transform(F.split("sample_facts", ";"), lambda x: F.split(x, "=")[0])).alias("concept"))
        named = categorize(concepts).groupBy("cik", "filing_date").agg(F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"))
        text = filing_text(texts, batch)
        rows = batch.join(named.hint("merge"), ["cik", "filing_date"], "left").join(text.hint("merge"), ["cik", "filing_date"], "left")
        _keep(rows.select("cik", "filing_date", "axes", "categories", F.length("text").alias("text_length"), F.lit(None).cast("string").alias("insights"), F.lit(None).cast("long").alias("health_score")), out, n)

    return messages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
