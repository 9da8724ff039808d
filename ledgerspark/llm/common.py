"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch on its way to a Python worker; Spark's own bounds are 64 MB and 10,000 rows.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """A new folder below ``spark.checkpoint.dir`` for the tables of one run.

    Tables written here cut the lineage and survive the loss of an executor, since all executors and the
    driver share that folder. The setting is required on a cluster; only in local mode, where one machine is all
    there is (unit tests), a temporary folder serves without it.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="spark-")
        self.root = f"{root.rstrip('/')}/ledgerspark-{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and read it back, so that later plans see its true size."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; a null id is in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in short pieces, so that what Python makes of a piece stays small."""
    for part in batches:
        for at in range(0, part.num_rows, rows):
            yield part.slice(at, rows)


def set_short_batches(spark: SparkSession) -> str | None:
    """Bound the Arrow batches of the session by ``BATCH_BYTES`` and return the bound before. With Spark's own bounds
    every running task holds some 34 MB of texts twice, outside the JVM's heap and in Python."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    return before


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Short Arrow batches for what is run inside."""
    before = set_short_batches(spark)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def utf8(values: Iterable[str | None]) -> list[bytes]:
    return [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in values]


def row_key(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """(id is null, id, hash of the whole row): orders rows by id, nulls last, and tells all but equal rows apart."""
    hashable = [F.col(f"`{f.name}`") for f in docs.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(*hashable).alias("row"))
