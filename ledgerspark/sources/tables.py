"""Tables that survive a second load: keyed upserts, batches committed together, sorted files.

All writes go through Spark's own file commit; nothing is kept on the driver but names and numbers of batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FACT_KEY = ["cik", "accession", "context_id", "concept"]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def newest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; null keys are keys like others."""
    turn = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(turn)).where("_rn = 1").drop("_rn")


def upsert(rows: DataFrame, path: str, keys: list[str] | None = None, by: str = "cik", version: str | None = None) -> None:
    """Merge ``rows`` into the table at ``path``, partitioned by ``by``: a row replaces the stored one of its key.

    Of equal keys within ``rows`` the one with the largest ``version`` counts (without that column, the largest row). Stored rows
    of a larger version stay. Only the partitions that ``rows`` touch are read and rewritten; the same load twice, or again
    after a failure, gives the same table. The merged rows are written beside the table first, since a
    table can't be read and overwritten at once, and moved in by a dynamic partition overwrite.
    """
    spark, keys = rows.sparkSession, keys or FACT_KEY
    fresh = rows.withColumn("_new", F.lit(1))
    if exists(spark, path):
        names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        held = spark.read.schema(", ".join(names)).parquet(path)
        touched = rows.select(F.col(by).alias("_by")).distinct()
        fresh = fresh.unionByName(held.join(touched.hint("merge"), F.col(by).eqNullSafe(F.col("_by")), "left_semi").withColumn("_new", F.lit(0)))
    rest = [F.desc(c) for c in rows.columns if c not in keys and not rows.schema[c].dataType.simpleString().startswith("map")]
    order = [F.desc_nulls_last(version)] if version else []
    merged = newest(fresh, keys, [*order, F.desc("_new"), *rest]).drop("_new")
    staged = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    try:
        merged.write.parquet(staged)
        again = spark.read.schema(merged.schema).parquet(staged)
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    finally:
        _drop(spark, staged)


def commit(tables: dict[str, DataFrame], root: str, batch: int) -> None:
    """Write ``tables`` below ``root`` as one batch. Readers see a batch once its manifest is there, which is written last, so a
    failure between two tables leaves none of them visible; the same batch again replaces itself."""
    spark = next(iter(tables.values())).sparkSession
    _drop(spark, f"{root}/manifest/batch={batch}")
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
    counts = [spark.read.schema(rows.schema).parquet(f"{root}/{name}/batch={batch}").agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, rows in tables.items()]
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    every.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/batch={batch}")


def committed(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The rows of a table that belong to committed batches, with their ``batch``; none where nothing is committed."""
    kind = f"{schema}, batch int"
    if not exists(spark, f"{root}/manifest"):
        return spark.createDataFrame([], kind)
    done = spark.read.schema("`table` string, rows long, batch int").parquet(f"{root}/manifest").where(F.col("table") == name).select("batch")
    return spark.read.schema(kind).parquet(f"{root}/{name}").join(done.hint("merge"), "batch", "left_semi")


def write_sorted(rows: DataFrame, path: str, *order: str | Column, files: int | None = None) -> None:
    """Write ``rows`` in a total order, as about ``files`` files or as many as their size asks for: each file is sorted, and so are
    the files by their names. Rows that are equal in the order may stand in any order."""
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
