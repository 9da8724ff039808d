"""Centroid clustering of whole-number vectors with a vantage-point tree over the centroids.

Components become ``floor(SCALE * x)``, so distances and sums are exact. The first centroids are the vectors
with the smallest seeded hashes. In each round a vantage-point tree over the centroids is built on the driver and
broadcast (k vectors); every vector searches it best first, branch and bound: of its open nodes the one with the
least lower bound is taken, the squared distance to the node's vantage point is worked out in whole numbers, and the
node's two halves are opened with the bounds that the triangle inequality gives. A node is left only if its bound
is beyond the distance found so far; a bound equal to it is still opened, as a centroid there may tie with a smaller
number. Vectors of a batch are searched side by side, each in its own order. Each task sums its own vectors before
anything is shuffled, so a cluster that holds most rows is k small rows a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, slices, table

#: Components, clusters, rounds, scale and the hash's prefix of the registered query.
SIZE, CLUSTERS, ROUNDS, SCALE, PREFIX = 64, 16, 3, 64, "1:"
#: Centroids of a leaf of the tree, and vectors searched side by side.
LEAF, BATCH = 2, 4096
#: Largest whole number of a component: beyond it a squared distance may not fit a long.
LARGEST = 1 << 27


@dataclass
class Tree:
    """Node by node: the vantage point's number, the children (-1: none), and the least and largest distance from
    the vantage point to what each child holds; leaves list their centroids in ``own``."""

    points: np.ndarray
    vantage: list[int]
    child: list[tuple[int, int]]
    range_: list[tuple[tuple[float, float], tuple[float, float]]]
    own: list[list[int]]

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> Tree:
        out = cls(points, [], [], [], [])
        out._node(list(range(len(points))), leaf)
        return out

    def _node(self, numbers: list[int], leaf: int) -> int:
        at = len(self.vantage)
        self.vantage.append(-1)
        self.child.append((-1, -1))
        self.range_.append(((0.0, 0.0), (0.0, 0.0)))
        self.own.append([])
        if len(numbers) <= leaf:
            self.own[at] = numbers
            return at
        # The point farthest from the first one lies at the border, which parts the others well.
        first = numbers[int(squares(self.points[numbers], self.points[numbers[0]]).argmax())]
        rest = [n for n in numbers if n != first]
        dist = np.sqrt(squares(self.points[rest], self.points[first]).astype(np.float64))
        order = np.argsort(dist, kind="stable")
        half = len(rest) // 2
        parts = [sorted(rest[i] for i in order[:half]), sorted(rest[i] for i in order[half:])]
        spans = [(float(dist[order[:half]].min()), float(dist[order[:half]].max())) if half else (0.0, 0.0), (float(dist[order[half:]].min()), float(dist[order[half:]].max()))]
        self.vantage[at], self.range_[at] = first, (spans[0], spans[1])
        self.child[at] = (self._node(parts[0], leaf) if half else -1, self._node(parts[1], leaf))
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, squared distance, distances worked out) of every row of ``x``; ties go to
        the smaller number."""
        n, rows = len(x), np.arange(len(x))
        bound = np.full((n, len(self.vantage)), np.inf)  # of the open nodes of each vector
        bound[:, 0] = 0
        best, number, asked = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.points)), 0

        def meet(who: np.ndarray, c: int) -> np.ndarray:
            nonlocal asked
            d = squares(x[who], self.points[c])
            asked += len(who)
            better = (d < best[who]) | ((d == best[who]) & (c < number[who]))
            best[who[better]], number[who[better]] = d[better], c
            return d

        live = rows
        while len(live):
            node = bound[live].argmin(axis=1)
            least = bound[live, node]
            radius = np.sqrt(best[live].astype(np.float64))
            # Rounding of roots must not leave a node whose bound is the radius itself.
            open_ = np.isfinite(least) & (least <= radius * (1 + 1e-9) + 1e-9)
            live, node = live[open_], node[open_]
            bound[live, node] = np.inf
            for k in np.unique(node):
                who = live[node == k]
                if self.vantage[k] < 0:
                    for c in self.own[k]:
                        meet(who, c)
                    continue
                d = np.sqrt(meet(who, self.vantage[k]).astype(np.float64))
                for child, (lo, hi) in zip(self.child[k], self.range_[k], strict=True):
                    if child >= 0:
                        bound[who, child] = np.maximum(0, np.maximum(d - hi, lo - d)) * (1 - 1e-9)
        return number, best, asked


def squares(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x``."""
    d = x - point
    return np.einsum("ij,ij->i", d, d)


def whole(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """The vectors' whole numbers; an error if one is so large that a distance may not fit a long."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(len(column), size)
    if x.size and np.abs(x).max() > LARGEST:
        raise OverflowError(f"a component is beyond {LARGEST / scale} in absolute value, so that squared distances may not fit a long")
    return x.astype(np.int64)


def usable(vec: Column, size: int) -> Column:
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vec.isNotNull() & (F.size(vec) == size) & finite


def first_centroids(rows: DataFrame, k: int, prefix: str, size: int, scale: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``prefix`` and id, ties by components."""
    h = F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256)
    picked = rows.where("id is not null").select(h.alias("h"), "v").orderBy("h", "v").limit(k).toArrow()
    return whole(picked.column("v").combine_chunks(), size, scale) if picked.num_rows else np.empty((0, size), np.int64)


def moved(rows: DataFrame, points: np.ndarray, scale: int) -> np.ndarray:
    """One round: the floor of the mean of every centroid's vectors; centroids without vectors stay."""
    size, tree = points.shape[1], rows.sparkSession.sparkContext.broadcast(Tree.build(points))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = np.zeros(len(points), np.int64), np.zeros((len(points), size), np.int64)
        for part in slices(batches, BATCH):
            x = whole(part.column(1), size, scale)
            at = tree.value.nearest(x)[0]
            held += np.bincount(at, minlength=len(points))
            for c in np.unique(at):
                total[c] += x[at == c].sum(axis=0)  # 2^36 rows a task fit
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(held[met]), pa.array(list(total[met]), pa.list_(pa.int64()))], ["cluster", "held", "total"])

    each = [F.sum(F.col("total")[j].cast("decimal(38,0)")).alias(f"c{j}") for j in range(size)]
    out = points.copy()
    for r in rows.mapInArrow(sums, "cluster int, held long, total array<long>").groupBy("cluster").agg(F.sum("held").alias("held"), *each).collect():  # a row a centroid
        out[r["cluster"]] = [int(r[f"c{j}"]) // r["held"] for j in range(size)]
    return out


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", size: int = SIZE, scale: int = SCALE, prefix: str = PREFIX) -> DataFrame:
    """(id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``) of every vector with
    exactly ``size`` finite components; others are left out. With fewer than ``k`` of them each one starts a cluster.

    Vectors without an id are assigned, but start no cluster (if no vector has an id, none is assigned). Rows that
    repeat all count. Equal centroids: the smaller number has the vectors. Numbers whose squares may not fit a long are an
    error. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    spark, work = vectors.sparkSession, Scratch(vectors.sparkSession, "clusters")
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v"), size))
    points = first_centroids(rows, k, prefix, size, scale)
    if not len(points):
        return spark.createDataFrame([], f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        points = moved(rows, points, scale)
    tree = spark.sparkContext.broadcast(Tree.build(points))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, BATCH):
            at, dist, _ = tree.value.nearest(whole(part.column(1), size, scale))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(at, pa.int32()), pa.array(dist)], ["id", "cluster", "distance"])

    out = work.save(rows.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned")
    own = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row a centroid
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points.tolist()]
    facts = spark.createDataFrame([(c, s, names[c]) for c, s in own.items()], "cluster int, cluster_inertia long, centroid_sha256 string")
    both = out.join(F.broadcast(facts), "cluster")  # at most k rows
    return both.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", F.lit(sum(own.values())).cast("long").alias("inertia"), "centroid_sha256")


def op13_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 clusters of all ``embeddings`` after three rounds; edge cases as in ``clusters``."""
    return clusters(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    def assigned(points: str) -> str:
        near = f"""SELECT v.rid, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept v CROSS JOIN {points} c"""
        return f"SELECT rid, arg_min(k, (d, k)) AS k, CAST(min(d) AS BIGINT) AS d FROM ({near}) GROUP BY rid"

    def means(name: str, points: str) -> str:
        # Floor division of negative sums too.
        parts = "SELECT a.k, j, sum(v.x[j]) AS s, count(*) AS n FROM (" + assigned(points) + f") a JOIN kept v USING (rid), range(1, {SIZE + 1}) r(j) GROUP BY a.k, j"
        mean = "SELECT k, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY j) AS x FROM (" + parts + ") GROUP BY k"
        return f"{name} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM {points} c LEFT JOIN ({mean}) m USING (k))"

    rounds = ", ".join(means(f"p{i + 1}", f"p{i}") for i in range(ROUNDS))
    whole_ = f"list_transform(embedding, lambda e: CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT))"
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, {whole_} AS x FROM embeddings
          WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda e: isfinite(e))) = {SIZE}),
        p0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{PREFIX}' || vec_id), x) - 1 AS k, x FROM kept WHERE vec_id IS NOT NULL QUALIFY k < {CLUSTERS}),
        {rounds}, final AS MATERIALIZED ({assigned(f'p{ROUNDS}')})
        SELECT v.vec_id, CAST(f.k AS INTEGER) AS cluster, f.d AS distance, CAST(sum(f.d) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
          sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM final f JOIN kept v USING (rid) JOIN p{ROUNDS} c USING (k)"""


ORACLE = _oracle()
