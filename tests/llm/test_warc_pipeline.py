from __future__ import annotations

import hashlib
import os

import corpus_pipeline
from ledgerspark.llm import decontaminate, warc
from ledgerspark.llm.common import Scratch, table
from ledgerspark.llm.queries import QUERIES
from tests.compare import differences, oracle
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, record string"


def test_round_trip_with_copies_and_edge_cases(spark):
    body = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(5, "http://a/\r\nx: y", body, "r"), (3, None, body, "r"), (9, "u", body, "r"), (1, "u", "short", None), (2, "u", "short", None), (4, "u", None, None), (6, "u", "", None), (7, "u", "z" * 300_000, None), (8, "u", "z" * 300_000, None)]
    path = Scratch(spark, "t").path("w")
    manifest = warc.write_warc(spark.createDataFrame(rows, PAGES), path, shard_bytes=100_000, roll_bytes=500)
    assert manifest.count() > 1 and sum(r.records for r in manifest.collect()) == len(rows)
    got = {int(r.page_id): r for r in warc.read_warc(spark, path).collect()}
    for page, _, html, _ in rows:
        data = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert got[page].html == (html or "" if got[page].record_type == "response" else None)
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {5: "3", 9: "3", 8: "7"}
    again = Scratch(spark, "t").path("w")
    warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(5), again, shard_bytes=100_000, roll_bytes=500)
    files = lambda p: {f: hashlib.sha256(open(f"{p}/{f}", "rb").read()).hexdigest() for f in os.listdir(p) if f.startswith("part-")}
    assert files(path) == files(again) and not [f for f in os.listdir(path) if f.endswith(".tmp")]


def test_empty_table_and_null_ids(spark):
    path = Scratch(spark, "t").path("w")
    assert warc.write_warc(spark.createDataFrame([], PAGES), path).count() == 0
    assert warc.read_warc(spark, path).count() == 0
    path = Scratch(spark, "t").path("w")
    warc.write_warc(spark.createDataFrame([(None, "u", "q" * 200, None), (1, "u", "q" * 200, None), (1, "u", "q" * 200, None)], PAGES), path)
    assert sorted((r.page_id or "", r.record_type) for r in warc.read_warc(spark, path).collect()) == [("", "revisit"), ("1", "response"), ("1", "revisit")]


def test_ids_of_any_text_and_records_of_repeated_rows(spark):
    body, ids = "q" * 300, ["é", "a\r\nX-Page-ID: b", " %41 ", "", "z"]
    rows = [(i, "u", body + i[:1], i) for i in ids] + [("z", "u", body + "z", "z")] * 2 + [(None, "u", body, "k")]
    path = Scratch(spark, "t").path("w")
    d = spark.createDataFrame(rows, "page_id string, url string, html string, digest string")
    assert sum(r.records for r in warc.write_warc(d, path, shard_bytes=400).collect()) == len(rows)
    got = warc.read_warc(spark, path).collect()
    assert sorted((r.page_id is not None, r.page_id or "") for r in got) == sorted((r[0] is not None, r[0] or "") for r in rows)
    assert sorted(r.record_type for r in got if r.page_id == "z") == ["response", "revisit", "revisit"] and {r.refers_to for r in got if r.record_type == "revisit"} == {"z", ""}
    shorts = spark.createDataFrame([("s", "u", "tiny")] * 3, "page_id string, url string, html string")
    path = Scratch(spark, "t").path("w")
    warc.write_warc(shorts, path)
    data = b"".join(open(f"{path}/{f}", "rb").read() for f in os.listdir(path) if f.endswith(".gz"))
    heads = [h for h, _ in warc.decode(data)]
    assert len({h["WARC-Record-ID"] for h in heads}) == 3 and {h["WARC-Type"] for h in heads} == {"response"}


def test_query_matches_sql(spark):
    assert differences(warc.op8_sharded_warc(spark, SF).toPandas(), oracle(SF, warc.ORACLE)) == ""


def test_pipeline_keeps_columns_and_drops_what_it_should(spark):
    docs, kept = table(spark, SF, "documents"), []
    work = Scratch(spark, "t")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = work.save(stage(spark, docs, SF), str(k))
        kept.append(out.count())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = out
    assert kept[0] >= kept[1] >= kept[2] > 0 and kept[3] == kept[4] > 0
    assert docs.groupBy("shard", "slot").count().where("count > 1").count() == 0


def whole(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_stages_on_repeated_null_and_clashing_rows(spark, edge, empty):
    copy = "one two three four five six seven eight nine ten eleven twelve"
    kinds = "doc_id long, text string, lang string, source string, copy int, key string, times int, rows int, shard int"
    rows = [
        (1, copy, "en", "a", 7, "k", 1, 1, 1), (2, copy + " thirteen", "en", "a", 7, "k", 1, 1, 1), (3, "another text of quite other words and length here", "en", "a", 7, "k", 1, 1, 1),
        (2, "the very own text of a second row with id two", "en", "b", 7, "k", 1, 1, 1), (None, copy, "en", "b", 7, "k", 1, 1, 1), (None, "a lonely text that has no id at all", "en", "b", 7, "k", 1, 1, 1),
        (4, "rows that are equal in all columns are one", "en", "b", 7, "k", 1, 1, 1), (4, "rows that are equal in all columns are one", "en", "b", 7, "k", 1, 1, 1), (5, "", None, None, 7, "k", 1, 1, 1), (5, "", None, None, 7, "k", 1, 1, 1),
    ]
    docs = spark.createDataFrame(rows, kinds)
    want = [rows[i] for i in (0, 2, 3, 5, 6, 8, 9)]  # copies, copies without id and repeated rows are gone
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns and whole(got) == sorted(map(str, want))
    assert whole(corpus_pipeline.decontamination(spark, docs, SF)) == whole(docs)
    mixed = corpus_pipeline.mixture(spark, docs, SF)
    often = {r: 0 for r in rows}
    for r in mixed.collect():
        often[tuple(r)] += 1
    assert mixed.columns == docs.columns and sum(often.values()) > 4 and not often[rows[8]] and all(n <= 3 * rows.count(r) for r, n in often.items())
    shards = corpus_pipeline.shards(spark, docs, SF)
    assert whole(shards.select("doc_id", "text", "lang", "source", "copy", "key", "times", "rows", "shard_in")) == whole(docs)
    named = corpus_pipeline.language_id(spark, docs, SF)
    assert named.columns == docs.columns and whole(named) == sorted(map(str, rows[:8]))


def test_decontamination_takes_short_items_too(spark, tmp_path, monkeypatch):
    texts = ["Is the sky Blue?", "is the sky bluer? no", "what, IS  the sky blue? yes", "this the sky blue?", None, "", "a b 12.5% c", "a b 112.5% c 12.5%", "a b 112.5% c", "a question long enouhg to have a budget of edits", "none of them"]
    items = [(1, "is the\tsky   blue?"), (2, "12.5%"), (3, " "), (4, None), (5, "a question long enough to have a budget of edits")]
    spark.createDataFrame(items, "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, bench = documents(spark, texts), spark.read.parquet(str(tmp_path / "benchmark.parquet"))
    want = [1, 3, 4, 5, 8, 10]
    for portion, chars in ((decontaminate.PORTION, decontaminate.BLOCK_CHARS), (decontaminate.PORTION, 10), (30, 10)):
        monkeypatch.setattr(decontaminate, "PORTION", portion)
        assert sorted(r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()) == want
        assert sorted(r.doc_id for r in decontaminate.clean(docs, bench, block_chars=chars, short=True).collect()) == want
        assert {r.doc_id for r in decontaminate.contamination(docs, bench, block_chars=chars).collect()} == set(range(len(texts))) - set(want)


def test_stages_on_edge_cases(spark, edge, empty):
    left = {"language ID": 10, "MinHash near-dedup": 8, "benchmark decontamination": 13, "sharding": 13}
    for name, stage in corpus_pipeline.STAGES:
        n = stage(spark, edge, SF).count()
        assert n == left.get(name, n), name
        assert stage(spark, empty, SF).count() == 0, name


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
