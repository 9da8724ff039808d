"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id and digest. Shard borders are exact (from running sums of the payload bytes in
key order, not from a sample), so reruns cut the same shards; a record finds its shard by halving the sorted list of
borders. Records are pressed before they are dealt to their shards; what each is a copy of comes to the shard in
a light table of its own. A task writes one shard at a time and rolls to the next file by compressed bytes. Headers and digests are made anew from the payload; every record is its own
gzip member without a time stamp. A file is written under a temporary name and renamed when complete; the
manifest, written last by Spark's own committer, names the files that count.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, slices, table

#: Payload bytes of a shard, compressed bytes after which a file is closed, least bytes of a shared payload.
SHARD_BYTES, ROLL_BYTES, SHARED = 32 << 20, 8 << 20, 100
#: Shards at most; their borders go to every task. Beyond that shards grow.
SHARDS = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page: object, digest: str, again: int = 0) -> str:
    """``again`` tells rows of the same id and payload apart."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page}/{digest}' + (f'/{again}' if again else ''))}>"


def _id(page: object) -> str:
    """An id of any type as a header value that gives it back."""
    return quote(str(page), safe="!#$&'()*+,/:;=?@[]", errors="surrogatepass")


def _line(value: object) -> str:
    """A header value on one line, in ASCII."""
    return "".join(c if " " <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in str(value))


def encode(page: object, url: str | None, payload: bytes, digest: str, size: int, first: object, kind: str, again: int = 0) -> bytes:
    """One WARC/1.1 record, as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + payload if kind == "response" else http
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page, digest, again)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url or 'about:blank')}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type: application/http; msgtype=response",
        f"X-Payload-Length: {size}",
    ]
    if page is not None:
        head.append(f"X-Page-ID: {_id(page)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page: {_id(first)}"]
    raw = ("\r\n".join([*head, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode("ascii") + block + b"\r\n\r\n"
    return gzip.compress(raw, 6, mtime=0)


def decode(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of a file, by their lengths alone; digests are checked."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)))
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("ascii").partition(":")
            head[name] = value.strip()
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or hashlib.sha256(block).hexdigest() != head["WARC-Block-Digest"].removeprefix("sha256:"):
            raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
        yield head, block


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class _Roller:
    """Writes records to files of one shard; a file appears under its name only when it is complete."""

    def __init__(self, path: str, shard: int, roll: int) -> None:
        self.fs, self.top = _store(path)
        self.shard, self.roll, self.seq, self.out = shard, roll, 0, None

    def add(self, member: bytes) -> dict | None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temp = f"{self.top}/.{self.name}.{TaskContext.get().taskAttemptId()}.tmp"  # attempts never share a file
            self.out, self.bytes, self.records, self.sum = self.fs.open_output_stream(self.temp), 0, 0, hashlib.sha256()
        self.out.write(member)
        self.sum.update(member)
        self.bytes, self.records = self.bytes + len(member), self.records + 1
        return self.close() if self.bytes >= self.roll else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, f"{self.top}/{self.name}")
        self.out, self.seq = None, self.seq + 1
        return {"file": self.name, "shard": self.shard, "records": self.records, "bytes": self.bytes, "sha256": self.sum.hexdigest()}


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, shared: int = SHARED
) -> DataFrame:
    """Write a record for every row of ``pages`` under ``path`` and return the manifest.

    Of rows with equal payloads of at least ``shared`` bytes the one with the smallest id is the response, the
    others are revisits of it; so are repeated rows after the first, which have record ids of their own. A null body
    is empty; a null id has no id header, sorts first and is a response only where no other id has its payload. Ids may be
    of any type that sorts; other columns are ignored, whatever their names. Rows equal in id and payload share a
    shard. ``path`` is any place that pyarrow and Spark both reach. An empty table gives an empty manifest.
    """
    spark, work = pages.sparkSession, Scratch(pages.sparkSession, "warc")
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body"))
    rows = rows.withColumns({"size": F.octet_length("body").cast("long"), "digest": F.sha2("body", 256)})
    keys = work.save(rows.select("id", "digest", "size"), "keys")

    # Exact borders: running sums over range-sorted keys, in runs, then over the runs.
    runs = keys.repartitionByRange("id", "digest").withColumn("run", F.spark_partition_id())
    runs = work.save(runs, "runs")
    ahead = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    sums = runs.groupBy("run").agg(F.sum("size").alias("s"))
    begun = work.save(sums.select("run", "s", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("begin")), "begun")
    shard_bytes = max(shard_bytes, -(-(begun.agg(F.sum("s")).first()[0] or 0) // SHARDS))
    inside = Window.partitionBy("run").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.join(begun.hint("merge"), "run").withColumn("at", F.col("begin") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    borders = placed.groupBy(F.floor(F.col("at") / shard_bytes).alias("k")).agg(F.min(F.struct("id", "digest")).alias("low"))
    edges = sorted({_place(r["low"]["id"], r["low"]["digest"]) for r in borders.select("low").collect()})[1:]  # at most SHARDS
    sent = spark.sparkContext.broadcast(edges)

    # What each copy refers to; payloads that occur once are in neither table.
    large = keys.where(F.col("size") >= shared)
    copies = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1 and first is not null")
    copies = work.save(copies.select("digest", "first"), "copies")
    light = large.join(copies.hint("merge"), "digest").select("id", "digest", "first").distinct()
    id_kind = keys.schema["id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            shard = [bisect_right(sent.value, _place(i, d)) for i, d in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *part.columns], ["shard", "id", "digest", "first"])

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            every = list(zip(*(c.to_pylist() for c in part.columns), strict=True))
            shard = [bisect_right(sent.value, _place(i, d)) for i, _, _, d, _ in every]
            members = [encode(i, u, b, d, n, None, "response") for i, u, b, d, n in every]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *(part.column(c) for c in ("id", "url", "digest", "size")), pa.array(members, pa.binary())], ["shard", "id", "url", "digest", "size", "member"])

    # Records are pressed first, so that only compressed bytes are shuffled.
    light = light.mapInArrow(deal, f"shard int, id {id_kind}, digest string, first {id_kind}")
    heavy = rows.select("id", "url", "body", "digest", "size").mapInArrow(press, f"shard int, id {id_kind}, url string, digest string, size long, member binary")

    def write(records: pa.Table, copied: pa.Table) -> pa.Table:
        kind = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
        if not records.num_rows:
            return kind.empty_table()
        of = {(i, d): f for i, d, f in zip(*(copied.column(c).to_pylist() for c in ("id", "digest", "first")), strict=True)}
        ids, digests, urls = (records.column(c).to_pylist() for c in ("id", "digest", "url"))
        order = sorted(range(len(ids)), key=lambda k: (_place(ids[k], digests[k]), urls[k] or ""))
        roller, last, again, done = _Roller(path, records.column("shard")[0].as_py(), roll_bytes), None, 0, []
        for k in order:
            page, digest, size = ids[k], digests[k], records.column("size")[k].as_py()
            again = again + 1 if last == (page, digest) else 0
            first, last = of.get((page, digest)), (page, digest)
            if first is not None and (page != first or again):
                member = encode(page, urls[k], b"", digest, size, first, "revisit", again)
            elif again:
                payload = _payload(records.column("member")[k].as_py())
                member = encode(page, urls[k], payload, digest, size, None, "response", again)
            else:
                member = records.column("member")[k].as_py()
            done.append(roller.add(member))
        done.append(roller.close())
        return pa.Table.from_pylist([x for x in done if x], kind)

    _mkdirs(spark, path)
    manifest = heavy.groupBy("shard").cogroup(light.groupBy("shard")).applyInArrow(write, "file string, shard int, records long, bytes long, sha256 string")
    manifest.write.mode("overwrite").parquet(f"{path}/_manifest")
    work.drop("keys", "runs", "begun", "copies")
    return spark.read.schema(manifest.schema).parquet(f"{path}/_manifest")


def _place(page: object, digest: str) -> tuple:
    """Sorts by id, nulls first, then digest."""
    return (False, digest) if page is None else (True, page, digest)


def _payload(member: bytes) -> bytes:
    return next(decode(member))[1].partition(b"\r\n\r\n")[2]


def _mkdirs(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files in the manifest: page_id (text), url, record_type, payload_bytes,
    payload_digest, refers_to (text) and html (null for revisits). Payload digests are checked."""
    manifest = spark.read.parquet(f"{path}/_manifest").select("file", "sha256")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(path)
    files = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).select("file", "content").join(manifest, "file")  # a written table: broadcast only if its files are small

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "html"]
        kinds = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in names])
        for part in batches:
            for data, digest in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                data = data.as_py()
                if hashlib.sha256(data).hexdigest() != digest:
                    raise ValueError("an archive differs from its manifest")
                rows, held = [], 0
                for head, block in decode(data):
                    payload = block.partition(b"\r\n\r\n")[2] if head["WARC-Type"] == "response" else None
                    want = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if payload is not None and hashlib.sha256(payload).hexdigest() != want:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
                    size = int(head["X-Payload-Length"]) if payload is None else len(payload)
                    html = None if payload is None else payload.decode("utf-8", "surrogatepass")
                    page, of = (None if head.get(x) is None else unquote(head[x], errors="surrogatepass") for x in ("X-Page-ID", "X-Refers-To-Page"))
                    rows.append((page, head["WARC-Target-URI"], head["WARC-Type"], size, want, of, html))
                    held += size
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], kinds)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], kinds)

    kinds = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, html string"
    return files.select("content", "sha256").mapInArrow(parse, kinds)


def op8_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ``pages`` as archives and read them back; edge cases as in ``write_warc``."""
    pages = table(spark, sf_dir, "pages")
    path = Scratch(spark, "archive").path("pages")
    write_warc(pages, path)
    kind = pages.schema["page_id"].dataType
    r = read_warc(spark, path)
    return r.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 100
"""
