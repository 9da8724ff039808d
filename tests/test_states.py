"""Streams with state: the status machine, de-duplication, filings that wait for their files."""

from __future__ import annotations

import datetime as dt
import random
import shutil

from pyspark.sql import Row

from ledgerspark.model import SUBMISSIONS
from ledgerspark.operators import flatten
from ledgerspark.streaming import filings as streams
from ledgerspark.streaming import states
from tests.test_quirks import XML

EVENTS = "cik string, accession_number long, fetch_status string, created_at timestamp"


def day(n, hours=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hours)


def feed(spark, tmp_path, parts, delay="7 days"):
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "ev"))
        states.stream_status(spark.readStream.schema(EVENTS).parquet(str(tmp_path / "ev")), str(tmp_path / "st"), str(tmp_path / "cp"), delay).awaitTermination()
    return {r.cik: r for r in states.latest(spark, str(tmp_path / "st")).collect()}


def folded(spark, rows):
    return {r.cik: r for r in states.status_fold(spark.createDataFrame(rows, EVENTS)).collect()}


def test_states_out_of_order_equal_the_whole_fold(spark, tmp_path):
    rng = random.Random(4)
    names = [*states.LEGAL][1:] + ["nonsense"]
    rows = [(str(rng.randrange(6)), i, rng.choice(names), day(i // 40, rng.randrange(24))) for i in range(160)]
    parts = [rows[:40], rows[80:120], rows[40:80] + rows[:10], rows[120:]]  # late within the delay, and repeated
    got, want = feed(spark, tmp_path, parts, "10 days"), folded(spark, rows)
    assert {k: r[1:5] for k, r in got.items()} == {k: (r.fetch_status, r.moves, r.illegal, r.events) for k, r in want.items()} and all(r.late == 0 for r in got.values())
    assert {k: r.changed_at for k, r in got.items()} == {k: r.changed_at for k, r in want.items()}


def test_illegal_moves_and_too_late_events(spark, tmp_path):
    first = [("1", 1, "pending", day(0)), ("1", 2, "completed", day(1)), ("2", 3, "completed", day(1)), ("3", 4, "processing", day(1)), ("3", 5, "completed", day(2)), ("3", 6, "failed", day(3)), (None, 7, "failed", day(3)), ("4", 8, None, day(3))]
    got = folded(spark, first)
    assert [(r.fetch_status, r.moves, r.illegal) for _, r in sorted(got.items())] == [("pending", 1, 1), (None, 0, 1), ("completed", 2, 1)]
    seen = feed(spark, tmp_path, [first, [("9", 20, "pending", day(40))], [("1", 21, "processing", day(2)), ("1", 22, "processing", day(41))]], "1 days")
    assert (seen["1"].fetch_status, seen["1"].late, seen["1"].moves) == ("processing", 1, 2) and seen["2"].fetch_status is None
    by_batch = [r["n"] for r in states.changes(spark, str(tmp_path / "st")).groupBy("batch").count().withColumnRenamed("count", "n").orderBy("batch").collect()]
    assert by_batch[0] == 3 and sum(by_batch) == 5  # only changed keys are written


def test_sent_filings_are_kept_in_state(spark, tmp_path):
    (tmp_path / "req").mkdir()
    recent = Row(form=["10-Q", "10-Q"], accessionNumber=["a", "b"], filingDate=["2024-01-02", "2024-02-02"], reportDate=["x"] * 2, primaryDocument=["x"] * 2)
    f = flatten.flatten_filings(spark.createDataFrame([("320193", "n", Row(recent=recent)), ("789019", "n", Row(recent=recent))], SUBMISSIONS))
    sent = tmp_path / "sent"
    reads = []
    for k in range(4):
        (tmp_path / f"req/{k}.txt").write_text("{}" if k else '{"companies": [{"cik": "320193", "name": "x"}]}')
        q = streams.stream_new_filings(spark.readStream.text(str(tmp_path / "req")), f, str(sent), str(tmp_path / "cp"))
        q.awaitTermination()
        reads.append(sum(p["numInputRows"] for p in q.recentProgress))
        got = sorted((r.cik, r.accession) for r in spark.read.parquet(str(sent)).collect())
        assert got == ([("0000320193", "b")] if k == 0 else [("0000789019", "b")] if k == 1 else [])
        shutil.rmtree(sent)  # nothing that was written is needed again
    assert reads == [1, 1, 1, 1]


def test_filings_wait_for_their_files(spark, tmp_path):
    def run():
        streams.stream_filing_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return sorted((r.cik, r.accession_number, r.files, r.fetch_status) for r in spark.read.parquet(str(tmp_path / "out/status")).collect())

    for name in ("7/a", "7/b"):
        (tmp_path / "in" / name).mkdir(parents=True)
    (tmp_path / "in/7/a/x_htm.xml").write_bytes(XML)
    (tmp_path / "in/7/a/metadata.json").write_text('{"cik": "7", "accession_number": "a"}')
    (tmp_path / "in/7/b/metadata.json").write_text('{"cik": "7", "accession_number": "b"}')
    (tmp_path / "in/7/a/other_metadata.json").write_text("no json")
    assert run() == [("0000000007", "a", 1, "completed")]
    facts = spark.read.parquet(str(tmp_path / "out/facts")).count()
    (tmp_path / "in/7/b/y_htm.xml").write_bytes(XML)  # taken once it is there
    (tmp_path / "in/8").mkdir()
    (tmp_path / "in/8/z.xml").write_bytes(XML)  # no metadata yet
    assert run() == run() == [("0000000007", "a", 1, "completed"), ("0000000007", "b", 1, "completed")]
    assert facts > 0 and spark.read.parquet(str(tmp_path / "out/facts")).count() == 2 * facts
