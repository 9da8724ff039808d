"""Tables: upserts, committed batches, sorted files, and round trips of all readers and writers."""

from __future__ import annotations

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerspark.plans import jobs
from ledgerspark.sources import readers, tables
from tests.test_quirks import XML

FACTS = "cik string, accession string, context_id string, concept string, value double, at int"


def load(spark, path):
    return sorted(map(tuple, spark.read.schema(FACTS).parquet(path).select(*[c.split()[0] for c in FACTS.split(', ')]).collect()), key=str)


def test_the_same_load_twice_gives_the_same_table(spark, tmp_path):
    path = str(tmp_path / "facts")
    a = spark.createDataFrame([("1", "x", "c", "Assets", 1.0, 1), ("1", "x", "c", "Revenues", 2.0, 1), ("2", "y", "c", "Assets", 3.0, 1), ("2", "y", None, "Assets", 4.0, 1), ("2", "y", None, "Assets", 4.0, 1)], FACTS)
    tables.upsert(a, path)
    once = load(spark, path)
    tables.upsert(a, path)
    assert load(spark, path) == once and len(once) == 4
    untouched = sorted(p.name for p in (tmp_path / "facts/cik=2").iterdir())
    b = spark.createDataFrame([("1", "x", "c", "Assets", 9.0, 2), ("1", "z", "c", "Assets", 5.0, 2), ("3", "w", "c", "Assets", 6.0, 2)], FACTS)
    for _ in range(2):
        tables.upsert(b, path)
    assert sorted((r[0], r[1], r[4]) for r in load(spark, path)) == [("1", "x", 2.0), ("1", "x", 9.0), ("1", "z", 5.0), ("2", "y", 3.0), ("2", "y", 4.0), ("3", "w", 6.0)]
    assert sorted(p.name for p in (tmp_path / "facts/cik=2").iterdir()) == untouched and {p.name for p in tmp_path.iterdir()} == {"facts"}


def test_versions_decide_whatever_the_order_of_loads(spark, tmp_path):
    old, new = ([("1", "x", "c", "Assets", float(v), v)] for v in (1, 2))
    for k, order in enumerate(([old, new], [new, old], [old + new])):
        for rows in order:
            tables.upsert(spark.createDataFrame(rows, FACTS), str(tmp_path / f"t{k}"), version="at")
        assert [r[4] for r in load(spark, str(tmp_path / f"t{k}"))] == [2.0]


def test_writers_replay(spark, tmp_path):
    f = spark.createDataFrame([("1", "a", "c", "Assets", 1.0)], "cik string, accession string, context_id string, concept string, value double")
    for write, rows, keys in ((readers.write_facts, f, 1), (readers.append_status, spark.createDataFrame([("1", 7, "failed", 3)], "cik string, accession_number long, fetch_status string, created_at long"), 1)):
        path = str(tmp_path / write.__name__)
        for _ in range(2):
            write(rows, path)
        assert spark.read.parquet(path).count() == keys
    e = spark.createDataFrame([("1", "2024-01-01", {"a": 1})], "cik string, filing_date string, insights map<string,int>")
    for _ in range(2):
        readers.write_enrichments(e, str(tmp_path / "e"))
    assert [r.insights for r in spark.read.parquet(str(tmp_path / "e")).collect()] == ['{"a":1}']
    t = spark.createDataFrame([("1", "2024-01-01", "one", "two", 5)], "cik string, filing_date string, full_text string, pdf_text string, created_at long")
    for _ in range(2):
        readers.write_texts(t, str(tmp_path / "x"))
    assert [r.full_text for r in spark.read.parquet(str(tmp_path / "x")).collect()] == ["one\ntwo"]


def test_a_failure_between_two_tables_leaves_none_visible(spark, tmp_path):
    root, kind = str(tmp_path / "load"), "k int"
    a, b = spark.range(3).select(F.col("id").cast("int").alias("k")), spark.range(5).select(F.col("id").cast("int").alias("k"))
    broken = b.select(F.when(F.col("k") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("k")).cast("int").alias("k"))
    seen = lambda: [tables.committed(spark, root, n, kind).count() for n in ("a", "b")]
    assert seen() == [0, 0]
    tables.commit({"a": a, "b": b}, root, 0)
    assert seen() == [3, 5]
    with pytest.raises(Exception, match="lost"):
        tables.commit({"a": a, "b": broken}, root, 1)
    assert seen() == [3, 5]
    for _ in range(2):
        tables.commit({"a": a, "b": b}, root, 1)
    assert seen() == [6, 10]


def test_filing_load_as_one_job(spark, tmp_path):
    files = spark.createDataFrame([("1/x_htm.xml", bytearray(XML)), ("1/bad.xml", bytearray(b"<no"))], "path string, content binary")
    root = str(tmp_path / "root")
    for _ in range(2):
        jobs.load_filings(files, root, 0)
    names = {n: tables.committed(spark, root, n, "filing string").count() for n in ("facts", "segments", "stats", "status")}
    assert names["facts"] > 0 and names["stats"] == 1 and names["status"] == 2
    status = {r.filing: r.fetch_status for r in tables.committed(spark, root, "status", "filing string, fetch_status string").collect()}
    assert status == {"1/x_htm.xml": "completed", "1/bad.xml": "failed"}


def test_sorted_files(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.when(F.col("id") % 50 > 0, F.col("id") % 13).alias("b")).repartition(6)
    tables.write_sorted(rows, str(tmp_path / "s"), F.col("b").asc_nulls_first(), F.desc("a"), files=5)
    files = sorted((tmp_path / "s").glob("*.parquet"))
    got = [(-1 if r["b"] is None else r["b"], -r["a"]) for f in files for r in pq.read_table(f).to_pylist()]
    assert len(files) > 1 and got == sorted(got) and sorted(got) == sorted((-1 if r.b is None else r.b, -r.a) for r in rows.collect())


def test_readers(spark, tmp_path):
    (tmp_path / "sub.json").write_text(json.dumps({"cik": "7", "name": "N", "filings": {"recent": {"form": ["10-Q"], "accessionNumber": ["a"], "filingDate": ["2024-01-02"], "reportDate": ["x"], "primaryDocument": ["d"]}}}))
    assert readers.read_submissions(spark, str(tmp_path / "sub.json")).count() == 1
    (tmp_path / "index.json").write_text(json.dumps({"cik": "7", "accession": "a", "directory": {"item": [{"name": "x_htm.xml", "size": "5"}]}}))
    assert readers.read_filing_index(spark, str(tmp_path / "index.json")).first().directory.item[0].name == "x_htm.xml"
    (tmp_path / "i").mkdir()
    (tmp_path / "i/x.xml").write_bytes(XML)
    assert bytes(readers.read_instances(spark, str(tmp_path / "i")).first().content) == XML
    (tmp_path / "r").mkdir()
    (tmp_path / "r/1.txt").write_text("two\nlines")
    assert readers.read_responses(spark, str(tmp_path / "r")).first().response == "two\nlines"
    pages = spark.createDataFrame([("d", 1)], "doc_id string, page_num int")
    pages.write.parquet(str(tmp_path / "p"))
    assert readers.read_pages(spark, str(tmp_path / "p")).collect() == pages.collect()
    readers.write_json(spark.createDataFrame([("7", 1)], "cik string, k int"), str(tmp_path / "j"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "j")).select("cik", "k").collect()] == [(7, 1)]
    readers.write_csv(pages, str(tmp_path / "c"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == [("d", "1")]
