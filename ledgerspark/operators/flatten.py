"""From landed JSON and tagged instances to long tables."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.exprs import period_year

SEGMENT = "array<struct<dimension:string,value:string>>"


def entries(company_facts: DataFrame) -> DataFrame:
    """One row per fact entry: (cik, entity, namespace, concept, unit, ordinal, entry). Every unit is kept."""
    a = company_facts.select("cik", F.col("entityName").alias("entity"), F.explode("facts").alias("namespace", "concepts"))
    b = a.select("cik", "entity", "namespace", F.explode("concepts").alias("concept", "c"))
    c = b.select("cik", "entity", "namespace", "concept", F.explode("c.units").alias("unit", "entries"))
    return c.select("cik", "entity", "namespace", "concept", "unit", F.posexplode("entries").alias("ordinal", "entry"))


def _period() -> Column:
    """Fiscal year, end, instant or start, whichever comes first and is neither empty nor 0."""
    filled = lambda c: F.nullif(F.nullif(F.col(f"entry.{c}"), F.lit("")), F.lit("0"))
    return F.coalesce(filled("fy"), filled("end"), filled("instant"), filled("start"))


def flatten_facts(company_facts: DataFrame, as_of_year: int, years_back: int = 5) -> DataFrame:
    """Long facts with a value, of the years from ``as_of_year - years_back`` (that year included)."""
    rows = entries(company_facts).withColumn("period", _period()).withColumn("period_year", period_year(F.col("period")))
    rows = rows.where(F.col("entry.val").isNotNull() & (F.col("period_year") >= as_of_year - years_back))
    return rows.select("cik", "entity", "namespace", "concept", "unit", "period", "period_year", F.col("entry.val").alias("value"), "ordinal")


def flatten_segments(company_facts: DataFrame, as_of_year: int, years_back: int = 5) -> DataFrame:
    """Explicit segment rows; the segment is a list of dimensions or one dimension. Null values stay."""
    text = F.col("entry.segment")
    dims = F.from_json(F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]"))), SEGMENT)
    rows = entries(company_facts).where(text.isNotNull() & (text != "")).withColumn("period", _period()).withColumn("period_year", period_year(F.col("period")))
    rows = rows.where(F.col("period_year") >= as_of_year - years_back)
    rows = rows.select("cik", "namespace", "concept", "unit", "period", F.col("entry.val").alias("value"), F.explode(dims).alias("d"))
    return rows.select("cik", F.col("d.dimension").alias("dimension_axis"), F.col("d.value").alias("dimension_member"), "concept", "unit", "period", "value").where("dimension_axis is not null")


def flatten_filings(submissions: DataFrame) -> DataFrame:
    """Parallel arrays of a submissions document as one row per filing."""
    r = "filings.recent."
    zipped = F.arrays_zip(*[F.col(r + c).alias(n) for c, n in (("form", "form"), ("accessionNumber", "accession"), ("filingDate", "filed"), ("reportDate", "reported"), ("primaryDocument", "document"))])
    return submissions.select(F.lpad("cik", 10, "0").alias("cik"), "name", F.posexplode(zipped).alias("ordinal", "x")).select("cik", "name", "ordinal", "x.form", "x.accession", F.col("x.filed").cast("date").alias("filing_date"), "x.document")


def newest_filing(filings: DataFrame, form: str | None = None) -> DataFrame:
    """The newest filing of each company and form; equal dates: the first listed."""
    rows = filings if form is None else filings.where(F.col("form") == form)
    w = Window.partitionBy("cik", "form").orderBy(F.desc("filing_date"), "ordinal")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def new_filings(filings: DataFrame, processed: DataFrame) -> DataFrame:
    return filings.join(processed.select("accession").distinct().hint("merge"), "accession", "left_anti")


def index_items(index: DataFrame) -> DataFrame:
    return index.select("cik", "accession", F.posexplode("directory.item").alias("ordinal", "i")).select("cik", "accession", "ordinal", "i.name", F.expr("try_cast(nullif(i.size, '') as bigint)").alias("size"))


def instance_documents(items: DataFrame) -> DataFrame:
    """The instance document of each filing: the first name that ends in ``_htm.xml`` and holds ``instance``, in any case."""
    rows = items.where(F.col("name").endswith("_htm.xml") & F.contains(F.lower("name"), F.lit("instance")))
    w = Window.partitionBy("accession").orderBy("ordinal")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("cik", "accession", "name")


def filing_completeness(items: DataFrame) -> DataFrame:
    """Share of a filing's bytes that structured files hold, and counts of structured and exhibit files."""
    structured = F.col("name").rlike(r"\.(xml|xsd|json)$")
    n = lambda cond: F.count(F.when(cond, 1))
    out = items.groupBy("cik", "accession").agg(
        F.sum("size").alias("total"), F.sum(F.when(structured, F.col("size"))).alias("got"), n(structured).alias("structured_files"), n(F.upper("name").startswith("EX-")).alias("exhibit_files")
    )
    return out.select("cik", "accession", "structured_files", "exhibit_files", (F.try_divide(F.coalesce("got", F.lit(0)).cast("double"), F.nullif("total", F.lit(0)).cast("double")) * 100).alias("captured_pct"))


#: Rows that Python holds before it hands them on; a file more at most.
ROWS = 5000
RAW = "filing string, kind string, context_id string, ordinal int, name string, value string, unit string, start_date string, end_date string, instant string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2].rpartition(":")[2]


def _parse(filing: str, content: bytes) -> Iterator[tuple]:
    root = ET.fromstring(content)
    for node in root:
        if _local(node.tag) == "context":
            cid, at = node.get("id"), {_local(x.tag): (x.text or "").strip() for x in node.iter()}
            yield filing, "context", cid, 0, None, None, None, at.get("startDate"), at.get("endDate"), at.get("instant")
            for k, m in enumerate(x for x in node.iter() if _local(x.tag) in ("explicitMember", "typedMember")):
                yield filing, "dimension", cid, k, (m.get("dimension") or "").rpartition(":")[2], (m.text or "").strip().rpartition(":")[2], None, None, None, None
        elif node.get("contextRef"):
            yield filing, "fact", node.get("contextRef"), 0, _local(node.tag), (node.text or "").strip(), node.get("unitRef"), None, None, None


def flatten_instances(files: DataFrame) -> DataFrame:
    """``(path, content)`` of XML instances or of filing archives -> raw rows (contexts, dimensions, facts).

    Of an archive the member named ``instance`` or ``_htm`` is read, else the first XML file that is no
    linkbase. Files that do not parse give no rows.
    """

    names = [c.split()[0] for c in RAW.split(", ")]
    kinds = [pa.int32() if c == "ordinal" else pa.string() for c in names]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for part in batches:
            for i in range(part.num_rows):
                path, data = part.column(0)[i].as_py(), part.column(1)[i].as_py()
                try:
                    if zipfile.is_zipfile(io.BytesIO(data)):
                        z = zipfile.ZipFile(io.BytesIO(data))
                        held = [n for n in z.namelist() if n.endswith(".xml")]
                        best = [n for n in held if "instance" in n or "_htm" in n] or [n for n in held if not n.endswith(("_cal.xml", "_def.xml", "_lab.xml", "_pre.xml"))]
                        data = z.read(best[0]) if best else b""
                    rows += _parse(path, data)
                except (ET.ParseError, zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError):
                    continue
                if len(rows) >= ROWS:
                    yield table(rows)
                    rows = []
        if rows:
            yield table(rows)

    return files.select("path", "content").mapInArrow(walk, RAW)


def instance_facts(raw: DataFrame) -> DataFrame:
    """Facts with their context's period and first dimension; facts of unknown contexts are dropped, and a
    value that is no plain decimal number is null."""
    contexts = raw.where("kind = 'context'").select("filing", "context_id", F.coalesce(F.col("end_date"), F.col("instant")).cast("date").alias("period_end"))
    first = raw.where("kind = 'dimension' and ordinal = 0").select("filing", "context_id", F.col("name").alias("segment_dimension"), F.col("value").alias("segment_member"))
    rows = raw.where("kind = 'fact'").select("filing", "context_id", F.col("name").alias("concept"), "value", "unit")
    value = F.when(F.col("value").rlike(r"^-?\d+(\.\d+)?$"), F.col("value").cast("decimal(38,9)"))
    return rows.join(contexts.hint("merge"), ["filing", "context_id"]).join(first.hint("merge"), ["filing", "context_id"], "left").withColumn("value", value).withColumn("unit", F.coalesce("unit", F.lit("USD")))


def instance_segments(raw: DataFrame) -> DataFrame:
    """One row per fact and dimension of its context."""
    dims = raw.where("kind = 'dimension'").select("filing", "context_id", F.col("name").alias("dimension_axis"), F.col("value").alias("dimension_member"))
    return instance_facts(raw).select("filing", "context_id", "concept", "value", "period_end").join(dims.hint("merge"), ["filing", "context_id"])


def instance_stats(raw: DataFrame) -> DataFrame:
    """Per filing: facts, facts with a segment, axes, concepts."""
    f = instance_facts(raw)
    a = f.groupBy("filing").agg(F.count("*").alias("total_facts"), F.count("segment_dimension").alias("segmented_facts"), F.countDistinct("concept").alias("unique_concepts"))
    d = instance_segments(raw).groupBy("filing").agg(F.countDistinct("dimension_axis").alias("segment_dimensions"))
    return a.join(d.hint("merge"), "filing", "left").fillna({"segment_dimensions": 0})
