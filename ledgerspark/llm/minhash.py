"""Near-duplicate classes: banded MinHash candidates, sequential Bayesian pruning, exact verification.

1. Every document becomes the set of its five-word shingles, as 64-bit hashes, and a MinHash signature.
   Documents with equal sets form one *class*; all later steps work on classes, so exact copies, however
   many, cost one row each and are never compared with each other.
2. Signatures are cut into bands. Within a bucket (classes with an equal band) each class is paired with the
   bucket's first and last class only, never with every other one.
3. A pair's signatures are compared batch by batch. After each batch the posterior of the similarity (uniform
   prior, so a Beta distribution) decides: a pair whose probability of reaching the threshold is below
   ``miss`` is dropped.
4. Survivors are verified on the full shingle sets; the verified links give first components.
5. In buckets that still hold several components, the classes outside the bucket's main component are compared
   with all classes of such buckets, in blocks of bounded bytes: again signature batches first, then the full
   sets of the survivors, and only between different components. So no link between classes that share a
   bucket is lost, no pairs are written out, and a large group of near copies, already one component, costs
   nothing more. Shingles that no other component holds bound the similarity a class can have with any;
   classes and pairs below the threshold by that bound are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, short_batches, slices, table, utf8
from ledgerspark.llm.components import connected_components

SHINGLE = 5
BANDS, ROWS, BATCH = 32, 4, 32
MISS = 1e-5
#: Stars per class that are verified before the exhaustive step.
STARS = 2
#: Bytes of signatures and sets on either side of a block of the exhaustive step.
BLOCK_BYTES = 8 << 20
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; with fewer words, of the whole sequence."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    if n < 1:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=k)], np.uint64)
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s += h[j : j + n] * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1) ^ (j << 40)) & _MASK | 1)
    return np.unique(_mix(s))


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20250117)
    return rng.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(out, (x[i : i + 512, None] * a + b).min(axis=0), out=out)
    return out


def _signatures(rows: pa.Table, hashes: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint32).reshape(-1, hashes)


def fewest_matches(n: int, threshold: float, miss: float) -> int:
    """Smallest m for which P(similarity >= threshold | m of n hashes agree) reaches ``miss`` (uniform prior)."""
    p = 0.0
    for m in range(n + 1):
        p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if p >= miss:
            return m
    return n


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = 75,
    bands: int = BANDS,
    rows: int = ROWS,
    batch: int = BATCH,
    miss: float = MISS,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``.

    Documents whose shingle sets have Jaccard similarity of at least ``percent``/100 are linked; components
    are those of the links. Null or empty texts and texts without words have no shingles and are linked with
    nothing. Repeated rows and exact copies share a class. A null id takes part in linking but is never the
    component's id unless all ids of the component are null. Ids need not be unique and may be of any type that
    sorts. Texts of any length are read whole. Other columns are ignored, whatever their names.

    A pair at the threshold shares no band with probability (1 - s^rows)^bands (5e-6 at the defaults), and is
    dropped by the pruning with probability about ``miss`` per batch; every link reported is exact.
    """
    with short_batches(docs.sparkSession):  # all steps in Python end inside
        return _near_duplicates(docs, id_col, text_col, shingle, percent, bands, rows, batch, miss)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bands: int, rows: int, batch: int, miss: float) -> DataFrame:
    work = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hashes = bands * rows
    kind = docs.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coefficients(hashes)
        for part in slices(batches):
            sets = [shingle_set(x, shingle) for x in utf8(part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s, a, b).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["id", "n", "cls", "sig"],
            )

    signed = work.save(docs.mapInArrow(sign, f"id {kind}, n long, cls binary, sig binary"), "signed")
    groups = work.save(
        signed.where("n > 0").groupBy("cls").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = np.random.default_rng(7).integers(0, 1 << 63, (bands, rows), np.uint64) * np.uint64(2) + np.uint64(1)
        seeds = np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(48)
        for part in batches:
            for at in range(0, part.num_rows, 1000):
                p = part.slice(at, 1000)
                sig = np.frombuffer(b"".join(p.column(2).to_pylist()), np.uint32).reshape(-1, bands, rows)
                keys = _mix((sig.astype(np.uint64) * odd).sum(axis=2, dtype=np.uint64) + seeds).view(np.int64)
                rep = pa.array(np.repeat(np.arange(p.num_rows), bands))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), p.column(0).take(rep), p.column(1).take(rep)], ["band", "cls", "n"])

    entries = groups.select("cls", "n", "sig").mapInArrow(cut, "band long, cls binary, n long")
    item = F.struct("cls", "n")
    buckets = entries.groupBy("band").agg(F.min(item).alias("lo"), F.max(item).alias("hi")).where("lo.cls != hi.cls")
    buckets = work.save(buckets, "buckets")
    shared = work.save(entries.join(buckets.hint("merge"), "band"), "shared")
    fits = lambda x, y: f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"

    stars = (
        shared.select("cls", "n", F.explode(F.array("lo", "hi")).alias("c"))
        .where(f"cls != c.cls and {fits('n', 'c.n')}")
        .select(F.greatest("cls", "c.cls").alias("a"), F.least("cls", "c.cls").alias("b"), F.col("cls").alias("own"))
        .distinct()
    )

    steps = [(n, fewest_matches(n, percent / 100, miss)) for n in range(batch, hashes + 1, batch)]

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at in range(0, part.num_rows, 2000):
                p = part.slice(at, 2000)
                x, y = (np.frombuffer(b"".join(p.column(i).to_pylist()), np.uint32).reshape(-1, hashes) for i in (0, 1))
                alive, found, seen = np.arange(len(x)), np.zeros(len(x), np.int64), 0
                for n, least in steps:
                    found[alive] += (x[alive, seen:n] == y[alive, seen:n]).sum(axis=1)
                    alive, seen = alive[found[alive] >= least], n
                rest = p.take(pa.array(alive))
                yield pa.RecordBatch.from_arrays([*rest.columns[2:], pa.array(found[alive])], [*rest.schema.names[2:], "matches"])

    def pruned(pairs: DataFrame) -> DataFrame:
        sig = groups.select("cls", "sig")
        both = pairs.join(sig.select(F.col("cls").alias("a"), F.col("sig").alias("x")).hint("merge"), "a").join(
            sig.select(F.col("cls").alias("b"), F.col("sig").alias("y")).hint("merge"), "b"
        )
        return both.select("x", "y", *pairs.columns).mapInArrow(prune, ", ".join(f"{c} {t}" for c, t in [*pairs.dtypes, ("matches", "long")]))

    best = Window.partitionBy("own").orderBy(F.desc("matches"), "a", "b")
    likely = pruned(stars).withColumn("k", F.row_number().over(best)).where(F.col("k") <= STARS).select("a", "b").distinct()
    likely = work.save(likely, "likely")

    # The full sets of all classes that share a bucket, made anew from their texts.
    ids = work.save(shared.select("cls").distinct().join(groups.select("cls", "id").hint("merge"), "cls").select("id").distinct(), "ids")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [s for x in utf8(part.column(0).to_pylist()) if len(s := shingle_set(x, shingle))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["cls", "members"],
            )

    texts = docs.alias("d").join(ids.alias("i").hint("merge"), F.col("d.id").eqNullSafe(F.col("i.id")), "left_semi").select("text")
    sets = work.save(texts.mapInArrow(full, "cls binary, members array<long>").dropDuplicates(["cls"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        own = lambda k, m: sets.select(F.col("cls").alias(k), F.col("members").alias(m)).hint("merge")
        common = F.size(F.array_intersect("x", "y"))
        return pairs.join(own("a", "x"), "a").join(own("b", "y"), "b").where(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b")

    links = work.save(verified(likely), "links")
    labels = work.save(connected_components(links, work, "star"), "labels")

    # What is left: buckets that hold more than one component.
    named = (
        shared.select("band", "cls", "n")
        .join(labels.select(F.col("node").alias("cls"), "label").hint("merge"), "cls", "left")
        .select("band", "cls", "n", F.coalesce("label", "cls").alias("label"))
    )
    counted = named.groupBy("band", "label").agg(F.count("*").alias("c"))
    mixed = counted.groupBy("band").agg(F.max(F.struct("c", "label")).alias("most"), F.count("*").alias("k")).where("k > 1")
    mixed = work.save(named.join(mixed.select("band", F.col("most.label").alias("main")).hint("merge"), "band"), "mixed")
    # Of a class, only shingles that another component holds can be shared with one: a bound on any overlap.
    inside = mixed.select("cls", "label").distinct()
    rolled = work.save(inside.join(sets.hint("merge"), "cls").select("cls", "label", F.explode("members").alias("s")), "rolled")
    foreign = rolled.groupBy("s").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("s")
    bound = rolled.join(foreign.hint("merge"), "s").groupBy("cls").agg(F.count("*").alias("most"))
    mixed = mixed.join(work.save(bound, "bound").hint("merge"), "cls").where(f"100 * most >= {percent} * n")
    # Everything that shares a bucket with a component, in blocks of bounded bytes: outsiders against members.
    units = mixed.select(F.col("main").alias("g"), "cls", "n", "label", "most").distinct()
    units = units.join(sets.hint("merge"), "cls").join(groups.select("cls", "sig").hint("merge"), "cls")
    units = work.save(units.withColumn("bytes", F.lit(4 * hashes + 100) + 8 * F.col("n")), "units")
    outside = F.col("label") != F.col("g")
    pieces = lambda b: F.ceil(F.sum(b) / BLOCK_BYTES).cast("int")
    deal = units.groupBy("g").agg(pieces(F.when(outside, F.col("bytes"))).alias("asks"), pieces(F.col("bytes")).alias("holds"))
    deal = work.save(deal.where("asks > 0"), "deal")
    dealt = units.drop("bytes").join(deal.hint("merge"), "g")
    own = lambda parts: F.pmod(F.xxhash64("cls"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    asking = dealt.where(outside).withColumn("ask", own("asks")).withColumn("hold", every("holds")).drop("asks", "holds")
    holding = dealt.withColumn("hold", own("holds")).withColumn("ask", every("asks")).drop("asks", "holds")
    holding = holding.select([F.col(c).alias(c) for c in holding.columns])

    def link(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[bytes, bytes]] = []
        if left.num_rows and right.num_rows:
            cls, label, sig = right.column("cls").to_pylist(), right.column("label").to_pylist(), _signatures(right, hashes)
            n, most = right.column("n").to_numpy(), right.column("most").to_numpy()
            lists = right.column("members").combine_chunks()
            values, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(cls)), lists.value_lengths().to_numpy())
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            code = {x: i for i, x in enumerate(dict.fromkeys(label))}
            codes = np.array([code[x] for x in label])
            asked = [left.column(c).to_pylist() for c in ("cls", "label", "n", "most")]
            for (c, component, size, reach), x, members in zip(zip(*asked, strict=True), _signatures(left, hashes), left.column("members"), strict=True):
                fit = (codes != code.get(component, -1)) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
                fit &= np.minimum(most, reach) * (100 + percent) >= percent * (n + size)
                alive, found, seen = np.flatnonzero(fit), np.zeros(len(n), np.int64), 0
                for upto, least in steps:
                    found[alive] += (sig[alive, seen:upto] == x[seen:upto]).sum(axis=1)
                    alive, seen = alive[found[alive] >= least], upto
                if not len(alive):
                    continue
                s = members.values.to_numpy()
                lo, hi = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
                common = np.bincount(np.concatenate([owner[i:j] for i, j in zip(lo, hi, strict=True)]), minlength=len(n))
                linked = alive[100 * common[alive] >= percent * (n[alive] + size - common[alive])]
                _, first = np.unique(codes[linked], return_index=True)  # one link to a component is enough
                out += [(c, cls[i]) for i in linked[first]]
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    block = ["g", "ask", "hold"]
    more = asking.groupBy(*block).cogroup(holding.groupBy(*block)).applyInArrow(link, "a binary, b binary")
    more = work.save(more.distinct(), "more")
    everything = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more)
    labels = work.save(connected_components(everything, work, "all"), "all-labels")

    # From classes back to documents.
    groups = groups.select("cls", "id").join(labels.withColumnRenamed("node", "cls").hint("merge"), "cls", "left").select("cls", "id", F.coalesce("label", "cls").alias("label"))
    first = groups.groupBy("label").agg(F.min("id").alias("component_id"))
    classes = work.save(groups.join(first.hint("merge"), "label").select("cls", "component_id"), "component-of-class")
    work.drop("classes", "buckets", "shared", "likely", "ids", "sets", "links", "labels", "mixed", "rolled", "bound", "units", "deal", "more", "all-labels")
    out = signed.select("id", "n", "cls").join(classes.hint("merge"), "cls", "left")
    found = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id"), F.col("id").eqNullSafe(found).alias("kept"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``; edge cases as in ``near_duplicates``."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS shingles FROM w
), c AS (SELECT shingles, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(shingles) AS shingles FROM s WHERE len(shingles) > 0) GROUP BY shingles
), x AS (SELECT rep, len(shingles) AS n, unnest(shingles) AS h FROM c
), p AS (
  SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.h = b.h AND a.rep < b.rep GROUP BY a.rep, b.rep, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p
), r AS (SELECT rep AS node, rep AS seen FROM c UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a
), k AS (SELECT node, min(seen) AS component FROM r GROUP BY node
), m AS (SELECT s.doc_id, len(s.shingles) AS n_shingles, c.rep FROM s LEFT JOIN c ON list_sort(s.shingles) = c.shingles)
SELECT m.doc_id, m.n_shingles, coalesce(k.component, m.doc_id) AS component_id, m.doc_id = coalesce(k.component, m.doc_id) AS kept
FROM m LEFT JOIN k ON m.rep = k.node
"""
