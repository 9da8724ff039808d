"""Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf. Within a source, leaves ascend by id; every ``FAN`` consecutive nodes (the last run may be
shorter) become the hash of their digests, until one is left: the subroot. Subroots, ordered by source, become the
root in the same way.

Nodes get their places by a range sort and counts of its partitions, so no source, however large, passes through one
task. Then each aligned block of ``FAN ** LEVELS`` nodes is streamed once: a node is appended with an empty witness; when
a run closes, the digests of its siblings are added to the witness of all leaves below each of its nodes, and the run's
hash is appended one level up. So each leaf leaves its block with the part of its witness known there, and each block
with its root, which is appended to the next round's blocks like any leaf. Going back down, the witness of a block
extends those of its leaves. The rounds are log(n) / log(FAN ** LEVELS) in number: three for 10^9 leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, slices, table

#: Nodes of a run, and levels of a block: at most 2187 nodes are streamed together.
FAN, LEVELS = 3, 7
#: Tables of at most so many bytes are broadcast, larger ones are merge joined.
SMALL = 64 << 20


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def joined(left: DataFrame, right: DataFrame, on: list[str], rows: int, width: int) -> DataFrame:
    """An inner join with ``right``, of ``rows`` rows of ``width`` bytes: broadcast if that is little."""
    return left.join(F.broadcast(right) if rows * width <= SMALL else right.hint("merge"), on)


def placed(nodes: DataFrame, order: list[str], work: Scratch, name: str) -> DataFrame:
    """``nodes`` with their place ``pos`` (from 0) among the ``n`` nodes of their ``tree``, in the given order.

    A range sort gives each partition a run of every tree; the runs' lengths, summed over the partitions before,
    give the places. Rows equal in tree and order may stand in any order and share a partition.
    """
    cols = ["tree", *order]
    nodes = work.save(nodes, f"{name}-nodes")  # the range sort reads its input twice
    ranged = nodes.repartitionByRange(*[F.col(c).asc_nulls_first() for c in cols]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in cols])
    at = F.monotonically_increasing_id()  # partition and place in it
    ranged = work.save(ranged.withColumn("at", at).withColumn("part", F.shiftright("at", 33)), f"{name}-ranged")
    runs = work.save(ranged.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("held")), f"{name}-runs")
    before = Window.partitionBy("tree").orderBy("part")
    whole = Window.partitionBy("tree")
    runs = runs.select("tree", "part", (F.sum("held").over(before) - F.col("held") - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("n"))
    runs = work.save(runs, f"{name}-shifts")  # a row a tree and partition
    return joined(ranged, runs, ["tree", "part"], runs.count(), 64).select(*nodes.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


def _height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


def append(hashes: list[str], levels: int) -> tuple[str, list[list[str]]]:
    """(root, witnesses) of one block: its nodes are appended one by one, ``levels`` levels are built. A witness holds
    the siblings of each level, from below, left to right.

    ``open_[l]`` holds the open run of level l: each node's digest and the range of leaves below it.
    """
    witness: list[list[str]] = [[] for _ in hashes]
    open_: list[list[tuple[str, int, int]]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        run = open_[level]
        open_[level] = []
        for k, (_, lo, hi) in enumerate(run):
            others = [h for j, (h, _, _) in enumerate(run) if j != k]
            for i in range(lo, hi):
                witness[i] += others
        put(level + 1, digest([h for h, _, _ in run]), run[0][1], run[-1][2])

    def put(level: int, h: str, lo: int, hi: int) -> None:
        open_[level].append((h, lo, hi))
        if level < levels and len(open_[level]) == FAN:
            close(level)

    for i, h in enumerate(hashes):
        put(0, h, i, i + 1)
    for level in range(levels):  # the last runs of the block are shorter
        if open_[level]:
            close(level)
    return open_[levels][0][0], witness


def rolled(nodes: DataFrame, work: Scratch, name: str, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` with ``block`` and ``witness``, block roots) of one round: ``nodes`` (``key``, ``tree``, ``hash``,
    ``pos``, ``n``). A tree of one block is built up to its root only; in trees of more, every block has all levels.
    The witness is the digests' bytes, side by side."""
    size = FAN**levels

    def stream(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        n = block.column("n")[0].as_py()
        root, witness = append(block.column("hash").to_pylist(), levels if n > size else _height(n))
        out = block.append_column("root", pa.array([root] * block.num_rows))
        return out.append_column("witness", pa.array([bytes.fromhex("".join(w)) for w in witness], pa.binary())).select([*names, "root", "witness"])

    kept = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long"))
    names = kept.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    out = work.save(kept.groupBy("tree", "block").applyInArrow(stream, f"{kinds}, root string, witness binary"), name)
    roots = out.where(F.col("pos") % size == 0).select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / size).cast("long").alias("n"), F.col("root").alias("hash"))
    return out.drop("root"), roots


def witnessed(nodes: DataFrame, work: Scratch, name: str, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` with the whole ``witness`` within their tree, (``tree``, ``hash``) of the trees' roots)."""
    out, roots = rolled(nodes, work, f"{name}-0", levels)
    rounds, done = [], roots.where("n = 1").select("tree", "hash")
    while not (more := roots.where("n > 1")).isEmpty():
        up, roots = rolled(more, work, f"{name}-{len(rounds) + 1}", levels)
        rounds.append(up)
        done = done.unionByName(roots.where("n = 1").select("tree", "hash"))
    above = None  # the witnesses of the blocks of the round before, whole
    for k, up in reversed(list(enumerate(rounds))):
        whole = up.select("tree", "pos", "witness") if above is None else _extended(up, *above).select("tree", "pos", "witness")
        whole = work.save(whole, f"{name}-whole-{k}")
        above = (whole, whole.count())
    return (out if above is None else _extended(out, *above)), done


def _extended(nodes: DataFrame, above: DataFrame, rows: int) -> DataFrame:
    """``nodes`` with the witness of their block added to their own; a tree of one block has nothing above."""
    above = above.select("tree", F.col("pos").alias("block"), F.col("witness").alias("_more"))
    above = F.broadcast(above) if rows * 2048 <= SMALL else above.hint("merge")
    both = nodes.join(above, ["tree", "block"], "left")
    return both.withColumn("witness", F.concat("witness", F.coalesce("_more", F.lit(b"")))).drop("_more")


def fold(hash_: str, witness: list[str], pos: int, n: int) -> tuple[str, list[str]]:
    """(root, unused siblings): the root of a tree of ``n`` leaves recomputed from the leaf at ``pos`` and siblings."""
    used = 0
    while n > 1:
        first = pos - pos % FAN
        others = min(FAN, n - first) - 1
        run = witness[used : used + others]
        hash_ = digest([*run[: pos - first], hash_, *run[pos - first :]])
        used, pos, n = used + others, pos // FAN, -(-n // FAN)
    return hash_, witness[used:]


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``leaves`` (``source``, ``doc_id``, ``hash`` and others): each with ``pos`` and ``n`` in its
    source, ``tree_pos`` and ``trees`` of its source, ``subroot``, ``root`` and ``witness`` (the siblings' 32 bytes
    each, from the leaf to the root).

    Null ids come first in their source, the null source first of all; equal ids are ordered by hash. A source
    with one row has that row's hash as subroot; one source's subroot is the root. An empty table gives no rows.
    ``leaves`` may have other columns, but for those named here.
    """
    work = Scratch(leaves.sparkSession, "manifest")
    # Null sources sort before all others, the empty one too.
    keyed = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("+"), "source"), F.lit("")))
    inside, subroots = witnessed(placed(keyed, ["doc_id", "hash"], work, "leaves"), work, "leaves", levels)
    inside = inside.drop("block")
    tops = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash"), ["of"], work, "trees")
    tops, root = witnessed(tops, work, "trees", levels)
    top = root.select("hash").first()  # one row, or none
    tops = work.save(tops.select(F.col("of").alias("tree"), F.col("hash").alias("subroot"), F.col("pos").alias("tree_pos"), F.col("n").alias("trees"), F.col("witness").alias("_up")), "tops")
    both = joined(inside, tops, ["tree"], tops.count(), 1024)
    return both.withColumns({"witness": F.concat("witness", "_up"), "root": F.lit(top["hash"] if top else None).cast("string")}).drop("_up", "tree")


def verified(rows: DataFrame, hash_col: str) -> DataFrame:
    """``rows`` of a manifest with ``proof_sha256`` (of the siblings' digests), ``folded_root`` (recomputed from
    ``hash_col`` and the witness) and ``verified`` (it is the root). Null hashes are not verified."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            at = {n: part.column(part.schema.get_field_index(n)).to_pylist() for n in (hash_col, "witness", "pos", "n", "tree_pos", "trees")}
            proofs, roots = [], []
            for h, w, pos, n, tree_pos, trees in zip(*at.values(), strict=True):
                text = w.hex()
                siblings = [text[i : i + 64] for i in range(0, len(text), 64)]
                proofs.append(digest(siblings))
                if h is None:
                    roots.append(None)
                    continue
                sub, up = fold(h, siblings, pos, n)
                roots.append(fold(sub, up, tree_pos, trees)[0])
            kept = [part.column(part.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(proofs, pa.string()), pa.array(roots, pa.string())], [*names, "proof_sha256", "folded_root"])

    names = [c for c in rows.columns if c != "witness"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "witness")
    out = rows.mapInArrow(apply, f"{kinds}, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.coalesce(F.col("folded_root") == F.col("root"), F.lit(False)))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all ``documents``; those with an even crc32 of their id are tampered with before they are
    verified (line feeds deleted). Null ids are not tampered with; other edge cases as in ``manifest``."""
    docs = table(spark, sf_dir, "documents")
    c, odd = F.col, F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    changed = F.when(odd, F.translate("text", "\n", "")).otherwise(c("text"))
    fields = lambda text: leaf(c("doc_id"), c("source"), c("lang"), c("n_chars"), text)
    leaves = docs.select("doc_id", "source", fields(c("text")).alias("hash"), fields(changed).alias("shown"))
    out = verified(manifest(leaves), "shown")
    return out.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", "verified", "pos", "n")


def _oracle(fan: int = FAN) -> str:
    value = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE concat(strlen(CAST({x} AS VARCHAR)), ':', {x}) END"
    leaf_ = lambda text: f"sha256(concat({value('doc_id')}, {value('source')}, {value('lang')}, {value('n_chars')}, {value(text)}))"
    crc = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b:
        list_reduce([xor(a, b), 0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: xor(x >> 1, 3988292384 * (x & 1))), 4294967295), 4294967295)"""

    def tree(name: str, nodes: str) -> str:
        """Recursive levels of the trees ``nodes`` (tree, pos, h, n)."""
        return f"""{name} AS (SELECT 0 AS l, tree, pos, h, n FROM {nodes} UNION ALL SELECT l + 1, tree, pos // {fan}, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + {fan - 1}) // {fan}
            FROM {name} WHERE n > 1 GROUP BY l, tree, pos // {fan})"""

    def siblings(name: str, nodes: str, levels: str) -> str:
        return f"""{name} AS (SELECT a.tree, a.pos, string_agg(b.h, '' ORDER BY b.l, b.pos) AS w FROM {nodes} a JOIN {levels} b
            ON a.tree = b.tree AND b.n > 1 AND b.pos // {fan} = a.pos // CAST(power({fan}, b.l + 1) AS BIGINT) AND b.pos <> a.pos // CAST(power({fan}, b.l) AS BIGINT) GROUP BY a.tree, a.pos)"""

    def folded(name: str, nodes: str, levels: str) -> str:
        """Nodes folded up with the other nodes of each run."""
        return f"""{name} AS (SELECT 0 AS l, tree, pos AS leaf, pos, h, n FROM {nodes} UNION ALL
            SELECT f.l + 1, f.tree, f.leaf, f.pos // {fan}, sha256(string_agg(CASE WHEN b.pos = f.pos THEN f.h ELSE b.h END, '' ORDER BY b.pos)), (any_value(f.n) + {fan - 1}) // {fan}
            FROM {name} f JOIN {levels} b ON b.l = f.l AND b.tree = f.tree AND b.pos // {fan} = f.pos // {fan} WHERE f.n > 1 GROUP BY f.l, f.tree, f.leaf, f.pos // {fan})"""

    return f"""WITH RECURSIVE docs AS (SELECT doc_id, coalesce('+' || source, '') AS tree, {leaf_('text')} AS h,
          CASE WHEN {crc} % 2 = 0 THEN {leaf_("replace(text, chr(10), '')")} ELSE {leaf_('text')} END AS shown FROM documents),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM docs),
        {tree('levels', 'leaves')}, subroots AS (SELECT tree AS own, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n FROM levels WHERE n = 1),
        {tree('top', 'subroots')}, root AS (SELECT h FROM top WHERE n = 1),
        {siblings('inner_', 'leaves', 'levels')}, {siblings('outer_', 'subroots', 'top')},
        tampered AS (SELECT tree, pos, shown AS h, n FROM leaves), {folded('fold', 'tampered', 'levels')},
        subfolds AS (SELECT f.tree || '|' || f.leaf AS tree, s.pos, f.h, s.n FROM fold f JOIN subroots s ON f.tree = s.own WHERE f.n = 1),
        tops AS (SELECT DISTINCT s.tree, t.l, t.pos, t.h FROM subfolds s CROSS JOIN top t), {folded('fold2', 'subfolds', 'tops')}
        SELECT d.doc_id, d.h AS leaf, s.h AS subroot, r.h AS root, sha256(concat(coalesce(i.w, ''), coalesce(o.w, ''))) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified, d.pos, d.n
        FROM leaves d JOIN subroots s ON d.tree = s.own CROSS JOIN root r LEFT JOIN inner_ i ON i.tree = d.tree AND i.pos = d.pos LEFT JOIN outer_ o ON o.pos = s.pos
        JOIN fold2 f ON f.tree = d.tree || '|' || d.pos AND f.n = 1"""


ORACLE = _oracle()
