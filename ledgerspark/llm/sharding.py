"""Sharding by a two-pass external shuffle.

Pass one scatters records by seeded hashes: rendezvous hashing of (id, shard) picks the shard, a hash of the
whole record picks one of the shard's buckets, whose number follows from the bytes so that a bucket fits in
memory. Pass two reads one bucket at a time, puts its records into a canonical order, shuffles them by
Fisher-Yates under a seed of (seed, bucket) and writes them at the bucket's offset within the shard.

The law is ``key``: the id and the number of shards alone decide the shard, and with one more shard the only
rows that move go into that shard.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import Scratch, table

SHARDS, SEED, BUCKET_BYTES = 24, 20240611, 16 << 20
#: Rows of a bucket that go back to Spark at once.
PIECE = 1000
OWN = ("shard", "slot", "grown_shard")
#: Names of the columns that only this module sees; a column of the input of such a name is kept apart.
BUCKET, TIE = "bucket of the shuffle", "order in the bucket"


def rendezvous(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose seeded hash with ``key`` is largest; one more shard wins only rows for itself."""
    return F.array_max(F.array(*[F.struct(F.xxhash64(F.lit(seed), key, F.lit(s)), F.lit(s).alias("s")) for s in range(shards)]))["s"]


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    order = np.arange(n)
    draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 0, -1))  # for i = n-1 .. 0: in 0..i
    for i, j in zip(range(n - 1, 0, -1), draws, strict=False):
        order[i], order[j] = order[j], order[i]
    return order


def two_pass_shuffle(
    docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Write ``docs`` to ``path`` as shards 0 to ``shards``-1 (folders ``shard=N``) and return them read back.

    Every row is written once, with all its columns and ``shard``, ``slot`` (0, 1, ... without gaps in its
    shard) and ``grown_shard`` (its shard were there one more). Input columns of these names get the suffix
    ``_in``. A null id is one more key; a null text counts as no bytes. Rows equal in id and text share a
    bucket; they are interchangeable, so reruns agree. All rows of one id are in one shard, in as many buckets as
    their bytes ask for. An empty table gives no files and no rows.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "scatter")
    docs = docs.select([F.col(f"`{c}`").alias(f"{c}_in" if c in OWN else c) for c in docs.columns])
    id_col, text_col = (f"{c}_in" if c in OWN else c for c in (id_col, text_col))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 8
    shard = rendezvous(F.col(id_col), shards, seed)
    grown = rendezvous(F.col(id_col), shards + 1, seed)
    tie = F.xxhash64(F.lit(seed + 1), F.col(id_col), F.col(text_col))
    # A shard has as many buckets as its own bytes ask for; they are numbered shard after shard.
    sums = {r["s"]: r["b"] for r in docs.groupBy(shard.alias("s")).agg(F.sum(size.cast("long")).alias("b")).collect()}  # a row a shard
    per = [max(1, ceil(sums.get(s, 0) / bucket_bytes)) for s in range(shards)]
    first = [sum(per[:s]) for s in range(shards)]
    dealt = docs.withColumns({"shard": shard, "grown_shard": grown, TIE: tie})
    at = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("shard"))
    dealt = dealt.withColumn(BUCKET, at(first) + F.pmod(TIE, at(per)))
    ahead = Window.partitionBy("shard").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(BUCKET, "shard").agg(F.count("*").alias("c")).select(BUCKET, F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("start"))
    starts = work.save(starts, "starts")  # one row a bucket

    columns = [c for c in dealt.columns if c not in (TIE, BUCKET)]
    kinds = T.StructType([dealt.schema[c] for c in columns] + [T.StructField("slot", T.LongType())])
    order = [(id_col, "ascending"), (TIE, "ascending")]

    def shuffled(key: tuple, rows: pa.Table, start: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        first = start.column("start")[0].as_py()
        turn = fisher_yates(rows.num_rows, [seed, key[0].as_py()])
        slots = pa.array(first + np.arange(rows.num_rows), pa.int64())
        turn, rows = pc.sort_indices(rows, sort_keys=order).take(pa.array(turn)), rows.select(columns)
        return pa.concat_tables([rows.take(turn.slice(i, PIECE)) for i in range(0, len(turn), PIECE)]).append_column("slot", slots)

    done = dealt.groupBy(BUCKET).cogroup(starts.groupBy(BUCKET)).applyInArrow(shuffled, kinds)
    done.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
    back = T.StructType([f for f in kinds if f.name != "shard"] + [T.StructField("shard", T.IntegerType())])
    work.drop("starts")
    return spark.read.schema(back).parquet(path)


def op2_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all ``documents``; edge cases as in ``two_pass_shuffle``."""
    out = two_pass_shuffle(table(spark, sf_dir, "documents"), Scratch(spark, "shards").path("documents"))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
