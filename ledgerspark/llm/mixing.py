"""Mixing sources to target weights by a low-discrepancy schedule.

Slot n of the schedule goes to the source in whose interval of the cumulative weights the golden-ratio point
frac(n * phi) falls, so every stretch of the schedule holds all sources in proportion. Slots are ranked per
source; the k-th slot of a source takes its k-th block. Blocks are equal runs of words over the source's
documents in a seeded random order; after the last block the next epoch begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 97
#: Words of a block: this part of all words, within the bounds.
BLOCKS, BLOCK_WORDS = 65_536, 1024
#: Rows that one running sum handles.
CHUNK = 2_000
#: The driver holds one row a source; more sources than this are refused.
MOST_SOURCES = 1_000_000
PERIOD, GOLDEN = 1 << 31, 1327217885  # the odd number nearest to PERIOD over the golden ratio


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> dict[str | None, float]:
    """Share all words by weight (repeating over the sources in code-point order, null last); a target stops
    at ``epochs`` times its source, and what is left is shared anew among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = [s for s in order if s in open_ and weight[s] * rate > epochs * sizes[s]]
        if not full:
            return out | {s: weight[s] * rate for s in order if s in open_}
        for s in full:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """One row per document: id, source, ``size`` (words), ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words of the document in all blocks the schedule takes, repeats included; it never
    exceeds ``epochs`` times the size. A null or wordless text has size 0 and takes nothing. A null source is
    a source of its own, the last. Repeated rows are documents of their own. Reruns agree: the order hangs on
    the seed, id and text alone. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "mix")
    size = F.coalesce(F.size(F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")
    size = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(size)
    mixed = F.md5(F.concat_ws("/", F.lit(seed), F.col(id_col).cast("string"), F.col(text_col)).cast("binary"))
    sized = work.save(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), mixed.alias("h")), "sized")

    rows = sized.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("c")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes, documents = {r["source"]: r["s"] for r in rows}, {r["source"]: r["c"] for r in rows}
    total, want = sum(sizes.values()), targets(sizes, weights, epochs)
    block = max(1, min(BLOCK_WORDS, total // BLOCKS))
    names, at, edges, ends = sorted(sizes, key=lambda s: (s is None, s or "")), 0.0, [], []
    for i, name in enumerate(names):
        edges.append((i, name, sizes[name], want[name], ceil(sizes[name] / block), max(1, ceil(documents[name] / CHUNK))))
        at += want[name] / total if total else 0.0
        ends.append(int(at * PERIOD + 0.5))  # where the source's interval of the points ends
    plan = spark.createDataFrame(edges, "k int, source string, source_size long, target double, blocks long, chunks long")
    plan = work.save(plan.coalesce(1), "plan")

    # Positions of the documents in their source's order: running sums in chunks of the order, then over chunks.
    own = sized.join(F.broadcast(plan), sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    chunk = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2.0**32 * F.col("chunks"))
    own = own.withColumn("chunk", F.least(chunk, F.col("chunks") - 1))
    ahead = Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    begun = own.groupBy("k", "chunk").agg(F.sum("size").alias("s")).select("k", "chunk", F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("begin"))
    begun = work.save(begun, "chunks")
    inside = Window.partitionBy("k", "chunk").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.join(begun.hint("merge"), ["k", "chunk"]).withColumn("at", F.col("begin") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = work.save(placed.select("id", "source", "size", "k", "source_size", "target", "at"), "placed")

    # The schedule, and how often it takes each block.
    last = max((e[0] for e in edges if e[3] > 0), default=0)
    sent = spark.sparkContext.broadcast(np.array(ends, np.int64))  # a number a source

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            point = part.column(0).to_numpy() % PERIOD * GOLDEN % PERIOD
            k = np.minimum(np.searchsorted(sent.value, point, "right"), last)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(k, pa.int32())], ["n", "k"])

    slots = spark.range(ceil(total / block) if total else 0).mapInArrow(draw, "n long, k int").select("n", F.floor(F.col("n") / CHUNK).alias("part"), "k")
    slots = work.save(slots, "slots")
    over = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = slots.groupBy("k", "part").agg(F.count("*").alias("c")).select("k", "part", F.coalesce(F.sum("c").over(over), F.lit(0)).alias("before"))
    earlier = work.save(earlier, "slot-counts")
    ranked = slots.join(earlier.hint("merge"), ["k", "part"]).withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("k", "part").orderBy("n")) - 1)
    uses = ranked.join(F.broadcast(plan.select("k", "blocks")), "k").where(F.col("rank") < epochs * F.col("blocks")).groupBy("k", (F.col("rank") % F.col("blocks")).alias("block")).agg(F.count("*").alias("uses"))
    uses = work.save(uses, "uses")

    # Documents cut at block borders meet the blocks' uses.
    spread = placed.where("size > 0").select("k", "at", "size", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))).alias("block"))
    overlap = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block) - F.greatest("at", F.col("block") * block)
    taken = spread.join(uses.hint("merge"), ["k", "block"]).groupBy("k", "at").agg(F.sum(overlap * F.col("uses")).alias("taken"))
    taken = work.save(taken, "taken")
    work.drop("sized", "plan", "chunks", "slots", "slot-counts", "uses")
    out = placed.join(taken.hint("merge"), (placed["k"] == taken["k"]) & (placed["at"] == taken["at"]) & (placed["size"] > 0), "left")
    return out.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def op6_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all ``documents``; edge cases as in ``mix``."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: Targets by filling the sources in the order in which they reach their limit; slots by the points in whole numbers.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(concat_ws('/', {SEED}, doc_id, text)) AS h FROM documents
), s AS (
  SELECT source, size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
  FROM (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source)
), f AS (
  SELECT *, (sum(size) OVER () - coalesce(sum({EPOCHS} * size) OVER before, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS rate, row_number() OVER (ORDER BY {EPOCHS} * size::DOUBLE / w, k) AS i
  FROM s WINDOW before AS (ORDER BY {EPOCHS} * size::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT k, source, size AS source_size, least(w * (SELECT coalesce(arg_min(rate, i), 0) FROM f WHERE w * rate <= {EPOCHS} * size), {EPOCHS}.0 * size)::DOUBLE AS target FROM f
), p AS (SELECT sum(source_size)::BIGINT AS total, greatest(1, least({BLOCK_WORDS}, sum(source_size) // {BLOCKS}))::BIGINT AS block FROM t
), e AS (
  SELECT k, floor(sum(target / total) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * {PERIOD} + 0.5)::BIGINT AS hi,
    coalesce(floor(sum(target / total) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) * {PERIOD} + 0.5), 0)::BIGINT AS lo, target > 0 AS live, source_size, block FROM t, p WHERE total > 0
), n AS (SELECT n, (n % {PERIOD}) * {GOLDEN} % {PERIOD} AS point FROM (SELECT unnest(range((ceil(total / block))::BIGINT)) AS n FROM p)
), r AS (
  SELECT e.k, row_number() OVER (PARTITION BY e.k ORDER BY n) - 1 AS turn, ceil(source_size / block)::BIGINT AS blocks
  FROM n JOIN e ON (point >= lo AND point < hi) OR (k = (SELECT max(k) FROM e WHERE live) AND point >= hi)
), u AS (SELECT k, turn % blocks AS block_no, count(*) AS uses FROM r WHERE turn < {EPOCHS} * blocks GROUP BY 1, 2
), o AS (
  SELECT d.*, t.k, t.source_size, t.target, row_number() OVER () AS rid, coalesce(sum(d.size) OVER (PARTITION BY t.k ORDER BY h, doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), x AS (SELECT rid, k, pos, size, block, unnest(range(pos // block, (pos + size - 1) // block + 1)) AS block_no FROM o, p WHERE size > 0
), y AS (SELECT rid, sum((least(pos + size, (x.block_no + 1) * block) - greatest(pos, x.block_no * block)) * uses)::BIGINT AS taken FROM x JOIN u ON x.k = u.k AND x.block_no = u.block_no GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM o LEFT JOIN y ON o.rid = y.rid
"""
