"""Approximate nearest neighbours by balanced posting lists over an in-memory centroid graph.

Inner product is searched as Euclidean distance: every vector gets one more component that gives all of them
the norm of the longest (queries get 0). Centroids come from a balanced hierarchical 2-means on a bounded
sample: the largest list is split until lists are short or ``CENTROIDS`` is reached. A vector near the border
of its list is also put into the other lists whose centroid is about as near (within the ``CLOSURE`` ratio, at most
``COPIES``). A query searches the centroid graph and takes the nearest lists, as far as the ratio of their distance to the nearest one's allows.
Ratio and number of lists are calibrated on the sample: queries taken from it are compared with brute force, and of
the pairs that reach ``RECALL`` the one that opens the fewest lists is taken.

Neighbouring lists share a *shelf* of bounded rows; a longer list is dealt over shelves of its own, and many
questions of a shelf over several tasks. A task scores the questions of one shelf against the lists they ask for.
The shelf of a query's nearest list comes first; the k-th best score found there is a bound that candidates of the
other shelves must reach, so these give few rows. Candidates are scored on the original vectors in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, slices, table

#: Bounds of the index: vectors in the sample, centroids; vectors of a list aimed at.
SAMPLE, CENTROIDS, LIST = 65_536, 8192, 64
#: Rows of a shelf and questions of a shelf that one task holds.
SHELF, ASKED = 8192, 4096
#: Least share of a list that either part of it has, and rounds of k-means after the splits.
UNEVEN, ROUNDS = 0.25, 5
#: Copies of a border vector, and how much farther than the nearest a centroid may be (squared distances).
COPIES, CLOSURE = 4, 1.15
#: Share of the sample's neighbours that the lists of a query must hold, queries that measure it, least lists taken.
RECALL, TRIALS, PROBES = 0.94, 300, 4
#: Neighbours of a centroid in the graph, centroids from which it is walked, and the seed.
DEGREE, WALK, SEED = 24, 1024, 17


def _nearest(dist: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` smallest of each row, smallest first, ties by column."""
    k = min(k, dist.shape[1])
    if 4 * k >= dist.shape[1]:
        return np.argsort(dist, axis=1, kind="stable")[:, :k]
    some = np.sort(np.argpartition(dist, k - 1, axis=1)[:, :k], axis=1)
    order = np.argsort(np.take_along_axis(dist, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


def balanced_centroids(x: np.ndarray, most: int, size: int, seed: int = SEED) -> np.ndarray:
    """Split the largest list in two by 2-means, neither part under ``UNEVEN`` of it, until done; then ``ROUNDS``
    of k-means, in which a centroid is the farther the longer its list. Parts of a list stay side by side in the
    result."""
    rng = np.random.default_rng(seed)
    lists = [(-len(x), "", np.arange(len(x)))]  # a list's path of halves tells its place
    while len(lists) < most and -lists[0][0] > size:
        _, path, own = heapq.heappop(lists)
        part = x[own]
        a, b = part[rng.choice(len(own), 2, replace=False)]
        for _ in range(6):
            side = ((part - a) ** 2).sum(1) <= ((part - b) ** 2).sum(1)
            if side.all() or not side.any():
                break
            a, b = part[side].mean(0), part[~side].mean(0)
        order = np.argsort(part @ (b - a), kind="stable")
        near_a = int((((part - a) ** 2).sum(1) <= ((part - b) ** 2).sum(1)).sum())
        half = min(max(near_a, ceil(UNEVEN * len(own)), 1), len(own) - max(1, ceil(UNEVEN * len(own))))
        heapq.heappush(lists, (-half, f"{path}0", own[order[:half]]))
        heapq.heappush(lists, (half - len(own), f"{path}1", own[order[half:]]))
    parts = [own for _, _, own in sorted(lists, key=lambda e: e[1])]
    points, held = np.stack([x[own].mean(0) for own in parts]), np.array([len(own) for own in parts])
    for _ in range(ROUNDS if len(points) > 1 else 0):
        spread, home = x.var(axis=0).sum() / len(points) / max(1.0, held.mean()), np.empty(len(x), np.int64)
        for at in range(0, len(x), 1024):
            home[at : at + 1024] = ((points**2).sum(1)[None] - 2 * x[at : at + 1024] @ points.T + spread * held[None]).argmin(axis=1)
        held = np.bincount(home, minlength=len(points))
        sums = np.zeros_like(points)
        np.add.at(sums, home, x)
        points = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], points)
    return points


@dataclass
class Graph:
    """Centroids and their neighbour lists; ``search`` walks from seeds towards the query, best first."""

    points: np.ndarray
    near: np.ndarray
    starts: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, degree: int = DEGREE, seed: int = SEED) -> Graph:
        n, rng = len(points), np.random.default_rng(seed)
        near = np.empty((n, min(degree + 4, n)), np.int32)
        for at in range(0, n, 512):
            d = ((points[at : at + 512] ** 2).sum(1)[:, None] + (points**2).sum(1)[None] - 2 * points[at : at + 512] @ points.T)
            near[at : at + 512] = _nearest(d, near.shape[1])
        if near.shape[1] > degree:  # a few long links keep the graph connected
            near[:, degree:] = rng.integers(0, n, (n, near.shape[1] - degree))
        return cls(points, near, rng.choice(n, min(n, 32), replace=False))

    def search(self, q: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For a block of queries the ``k`` nearest centroids found, (ids, squared distances), nearest first."""
        n, width = len(self.points), min(len(self.points), max(width, k))
        square, own = (self.points**2).sum(1), (q**2).sum(1)
        if max(8 * width, WALK) >= n:  # so few centroids, or so many wanted, that all distances cost less than the walk
            dist = np.maximum(own[:, None] + square[None] - 2 * q @ self.points.T, 0)
            best = _nearest(dist, k)
            return best, np.take_along_axis(dist, best, 1)

        def distances(ids: np.ndarray) -> np.ndarray:
            return np.maximum(own[:, None] + square[ids] - 2 * np.einsum("ijk,ik->ij", self.points[ids], q), 0)

        seen = np.zeros((len(q), n), bool)
        rows = np.arange(len(q))[:, None]
        ids = np.broadcast_to(self.starts, (len(q), len(self.starts))).copy()
        dist, done = distances(ids), np.zeros(ids.shape, bool)
        seen[rows, ids] = True
        while True:
            # Open the four nearest unopened centroids of every query at once.
            rank = np.where(done, np.inf, dist)
            pick = np.argsort(rank, axis=1, kind="stable")[:, :4]
            live = np.take_along_axis(rank, pick, 1)
            if not np.isfinite(live).any():
                break
            np.put_along_axis(done, pick, True, 1)
            fresh = self.near[np.take_along_axis(ids, pick, 1)].reshape(len(q), -1).astype(np.int64)
            d = distances(fresh)
            order = np.argsort(fresh, axis=1, kind="stable")
            ordered = np.take_along_axis(fresh, order, 1)
            twice = np.zeros(fresh.shape, bool)
            np.put_along_axis(twice, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            d[seen[rows, fresh] | twice | ~np.repeat(np.isfinite(live), self.near.shape[1], axis=1)] = np.inf
            seen[rows, fresh] = True
            ids, dist, done = np.concatenate((ids, fresh), 1), np.concatenate((dist, d), 1), np.concatenate((done, ~np.isfinite(d)), 1)
            if ids.shape[1] > width:
                best = np.argsort(dist, axis=1, kind="stable")[:, :width]
                ids, dist, done = (np.take_along_axis(v, best, 1) for v in (ids, dist, done))
        best = np.argsort(dist, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(ids, best, 1), np.take_along_axis(dist, best, 1)


@dataclass
class Index:
    """Centroids in their graph, and how many lists a query takes; bounded by ``CENTROIDS``."""

    graph: Graph
    longest: float
    probes: int
    ratio: float

    def lifted(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate((v, np.sqrt(np.maximum(self.longest - (v**2).sum(1, keepdims=True), 0))), axis=1)

    def homes(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lists, taken or not) of vectors: the nearest, and for border vectors others about as near."""
        ids, dist = self.graph.search(self.lifted(v).astype(np.float32), COPIES, 4 * COPIES)
        return ids, dist <= dist[:, :1] * CLOSURE + 1e-12

    def asked(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lists, taken or not) that queries open."""
        q = np.concatenate((v, np.zeros((len(v), 1))), 1).astype(np.float32)
        ids, dist = self.graph.search(q, self.probes, self.probes)
        return ids, dist <= dist[:, :1] * self.ratio + 1e-12

    @classmethod
    def fit(cls, x: np.ndarray, total: int, longest: float, k: int, probes: int | None = None) -> Index:
        """From a sample of the ``total`` vectors."""
        out = cls(None, longest, 0, float("inf"))
        x = x[np.lexsort(x.T[::-1])]  # the order the rows came in does not matter
        lifted = out.lifted(x)
        most = max(1, min(CENTROIDS, ceil(total / LIST)))
        out.graph = Graph.build(balanced_centroids(lifted, most, max(1, len(x) // most)).astype(np.float32))
        out.probes, out.ratio = (probes, float("inf")) if probes else out.calibrated(x, k)
        return out

    def calibrated(self, x: np.ndarray, k: int, trials: int = TRIALS, seed: int = SEED) -> tuple[int, float]:
        """(lists, ratio) with which queries from the sample find ``RECALL`` of their ``k`` nearest rows of it;
        the sample is sparser than the table, so its neighbours are spread over no fewer lists."""
        n = len(self.graph.points)
        if len(x) < 2 or n < 2:
            return n, float("inf")
        picked = np.random.default_rng(seed).choice(len(x), min(trials, len(x)), replace=False)
        best = np.empty((len(picked), min(k, len(x) - 1)), np.int64)
        for j, i in enumerate(picked):
            s = -(x @ x[i])
            s[i] = np.inf
            best[j] = _nearest(s[None], best.shape[1])[0]
        met, at = np.unique(best, return_inverse=True)
        homes = np.full((len(met), COPIES), n)
        for lo in range(0, len(met), 256):
            ids, take = self.homes(x[met[lo : lo + 256]])
            homes[lo : lo + 256, : ids.shape[1]] = np.where(take, ids, n)
        ranks, ratios, opened = [], [], []
        for i, own in zip(picked, homes[at.reshape(best.shape)], strict=True):
            dist = ((self.graph.points - np.append(x[i], 0.0).astype(np.float32)) ** 2).sum(1)
            order = np.argsort(dist, kind="stable")
            rank = np.empty(n + 1, np.int64)
            rank[order], rank[n] = np.arange(n), n
            near = dist[order] / max(float(dist.min()), 1e-12)
            ranks.append(rank[own].min(axis=1))
            ratios.append(near[ranks[-1]])
            opened.append(near)
        rank, ratio, opened = np.concatenate(ranks), np.concatenate(ratios), np.stack(opened)
        plans = []
        for share in np.linspace(RECALL, 1.0, 7):
            far = float(np.quantile(ratio, share, method="higher"))
            within = np.sort(np.where(ratio <= far, rank, n))
            probes = int(within[min(len(within) - 1, ceil(RECALL * len(within)) - 1)]) + 1
            lists = np.minimum((opened <= far).sum(1), probes).mean()
            plans.append((lists, min(n, max(PROBES, probes)), far))
        return min(plans)[1:]


def usable(column: str) -> F.Column:
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def sample_of(rows: DataFrame, total: int, sample: int) -> np.ndarray:
    """At most ``sample`` vectors: those with the lowest seeded hashes."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "id", "v"), 1)
    share = min(1.0, 1.2 * sample / total)
    low = rows.withColumn("h", h).where(F.col("h") <= min((1 << 63) - 1, int(share * (1 << 63))))
    x = low.orderBy("h", "id").limit(sample).select("v").toArrow()
    x = x if x.num_rows else rows.withColumn("h", h).orderBy("h", "id").limit(sample).select("v").toArrow()
    return _matrix(x.column("v").combine_chunks())


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE, probes: int | None = None) -> DataFrame:
    """The ``k`` largest inner products of every query (rows whose id is divisible by ``every``) among all
    other rows: query_id, ``rank`` from 1, id, ``score``; ties to the smaller id.

    Vectors that are null, empty or zero, that hold a null or non-finite component, that have no id, or whose
    length is not the most frequent one take no part. Rows equal in id and vector count once, however often they repeat,
    as do those equal in id and score; no row is a candidate of a query with its id. An id with several vectors is one
    query: a candidate's scores for all of them are ranked together. Other columns are ignored, whatever their names. An empty table gives no
    rows. ``probes`` lists are taken for a query, or as many as the calibration asks for.
    """
    spark, work = vectors.sparkSession, Scratch(vectors.sparkSession, "neighbours")
    id_kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c"), F.max(square).alias("m")).orderBy(F.desc("c"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], f"query_id {id_kind}, rank int, {id_col} {id_kind}, score double")
    rows = rows.where(F.size("v") == lengths["d"])
    again = work.save(rows.groupBy("id").count().where("count > 1").select("id"), "again")
    if not again.isEmpty():  # ids that repeat: of rows equal in id and vector one is indexed, or copies would fill the lists
        once = rows.join(again.hint("merge"), "id", "left_semi").dropDuplicates(["id", "v"])
        rows = work.save(rows.join(again.hint("merge"), "id", "left_anti").unionByName(once), "once")
        lengths = rows.agg(F.count("*").alias("c"), F.max(F.size("v")).alias("d"), F.max(square).alias("m")).first()
    index = Index.fit(sample_of(rows, lengths["c"], sample), lengths["c"], lengths["m"], k, probes)
    shared = spark.sparkContext.broadcast(index)  # at most CENTROIDS points

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in slices(batches):
            ids, take = shared.value.homes(_matrix(p.column(1)))
            row = pa.array(np.nonzero(take)[0])
            yield pa.RecordBatch.from_arrays([pa.array(ids[take], pa.int32()), p.column(0).take(row), p.column(1).take(row)], ["list", "id", "v"])

    postings = work.save(rows.mapInArrow(post, f"list int, id {id_kind}, v array<double>"), "postings")
    first, parts = shelved({r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}, len(index.graph.points))  # a row a centroid

    def ask(home: bool) -> object:
        """The shelf of the nearest list of each query, or its other shelves, with the lists asked for there."""

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for p in slices(batches):
                ids, take = shared.value.asked(_matrix(p.column(1)))
                row, lists = np.nonzero(take)[0], ids[take]
                row, lists, of = np.repeat(row, parts[lists]), np.repeat(lists, parts[lists]), parts[lists]
                shelf = first[lists] + (np.arange(len(lists)) - np.repeat(np.cumsum(of) - of, of))
                mine = (shelf == first[ids[:, 0]][row]) == home
                row, shelf, lists = row[mine], shelf[mine], lists[mine]
                order = np.lexsort((shelf, row))
                row, shelf, lists = row[order], shelf[order], lists[order]
                new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (shelf[1:] != shelf[:-1]))) if len(row) else np.empty(0, np.int64)
                at, which = pa.array(row[new]), pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(lists, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(shelf[new], pa.int32()), p.column(0).take(at), p.column(1).take(at), p.column(2).take(at), which], ["shelf", "id", "v", "least", "lists"])

        return of

    places = spark.createDataFrame([(i, int(first[i]), int(parts[i])) for i in range(len(first))], "list int, first int, parts int")
    placed = postings.join(F.broadcast(places), "list")  # a row a centroid
    placed = placed.withColumn("shelf", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def score(questions: pa.Table, members: pa.Table) -> pa.Table:
        return _score(questions, members, k)

    def met(questions: DataFrame, home: bool) -> DataFrame:
        asked = questions.mapInArrow(ask(home), f"shelf int, id {id_kind}, v array<double>, least double, lists array<int>")
        asked = work.save(asked, f"asked-{home}")
        # The questions of a shelf in pieces of bounded length; its rows go to each of them.
        pieces = asked.groupBy("shelf").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("asks"))
        pieces = work.save(pieces, f"pieces-{home}")
        asking = asked.join(pieces.hint("merge"), "shelf").withColumn("ask", F.pmod(F.xxhash64("id", "v"), F.col("asks")).cast("int"))
        holding = placed.join(pieces.hint("merge"), "shelf").withColumn("ask", F.explode(F.sequence(F.lit(0), F.col("asks") - 1)))
        block = ["shelf", "ask"]
        left = asking.select(*block, "id", "v", "least", "lists").groupBy(*block)
        both = left.cogroup(holding.select(*block, "id", "v", "list").groupBy(*block)).applyInArrow(score, f"query_id {id_kind}, id {id_kind}, score double")
        return work.save(both, f"met-{home}")

    queries = rows.where(F.col("id") % every == 0)
    near = met(queries.withColumn("least", F.lit(float("-inf"))), True)
    bounds = work.save(_ranked(near, k).where(F.col("rank") == k).select("query_id", "score"), "bounds")
    bounded = queries.join(bounds.hint("merge"), F.col("id") == F.col("query_id"), "left").select("id", "v", F.coalesce("score", F.lit(float("-inf"))).alias("least"))
    best = _ranked(near.unionByName(met(bounded, False)), k)
    work.drop("postings", "bounds", *[f"{t}-{home}" for t in ("asked", "pieces") for home in (True, False)])
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _ranked(met: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query with their ``rank``; a pair met on several shelves counts once."""
    turn = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    fresh = F.lag("id").over(turn).eqNullSafe(F.col("id")) & F.lag("score").over(turn).eqNullSafe(F.col("score"))
    met = met.withColumn("fresh", F.when(fresh, 0).otherwise(1)).withColumn("rank", F.sum("fresh").over(turn).cast("int"))
    return met.where((F.col("fresh") == 1) & (F.col("rank") <= k))


def shelved(counts: dict[int, int], lists: int, rows: int = SHELF) -> tuple[np.ndarray, np.ndarray]:
    """(first shelf, number of shelves) of every list: neighbouring lists share a shelf of at most ``rows`` rows,
    a longer list has as many of its own as it needs."""
    first, parts, shelf, held = np.zeros(lists, np.int64), np.ones(lists, np.int64), 0, 0
    for i in range(lists):
        c = counts.get(i, 0)
        if held and held + c > rows:
            shelf, held = shelf + 1, 0
        first[i], parts[i] = shelf, max(1, ceil(c / rows))
        held += c
        if parts[i] > 1:
            shelf, held = shelf + int(parts[i]), 0
    return first, parts


def _score(questions: pa.Table, members: pa.Table, k: int) -> pa.Table:
    """The ``k`` best members of the lists that each question asks for, in this block, that reach its bound."""
    kind = questions.schema.field("id").type
    names, none = ["query_id", "id", "score"], pa.array([], pa.float64())
    if not questions.num_rows or not members.num_rows:
        return pa.Table.from_arrays([pa.array([], kind), pa.array([], kind), none], names)
    qs, q = questions.column("id").to_numpy(), _matrix(questions.column("v").combine_chunks())
    ids, m, own = members.column("id").to_numpy(), _matrix(members.column("v").combine_chunks()), members.column("list").to_numpy()
    order = np.lexsort((np.argsort(np.argsort(ids, kind="stable"), kind="stable"), own))  # by list, then id
    ids, m, own = ids[order], m[order], own[order]
    least, which = questions.column("least").to_numpy(), questions.column("lists").combine_chunks()
    least = least - 1e-9 * np.abs(np.where(np.isfinite(least), least, 0.0))  # sums in another order may differ so much
    asker, wanted = np.repeat(np.arange(len(q)), which.value_lengths().to_numpy()), which.flatten().to_numpy()
    turn = np.argsort(wanted, kind="stable")
    asker, wanted = asker[turn], wanted[turn]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for one in np.unique(wanted):
        lo, hi = np.searchsorted(own, one), np.searchsorted(own, one, "right")
        if lo == hi:
            continue
        who = asker[np.searchsorted(wanted, one) : np.searchsorted(wanted, one, "right")]
        for at in range(0, len(who), 256):
            a = who[at : at + 256]
            s = np.einsum("ij,kj->ik", q[a], m[lo:hi])  # equal vectors get equal scores, so ties go by id
            s[qs[a][:, None] == ids[lo:hi][None]] = -np.inf
            if (ids[lo + 1 : hi] == ids[lo : hi - 1]).any():  # an id with several vectors: equal scores of it count once
                _once(s, ids[lo:hi])
            top = np.argsort(-s, axis=1, kind="stable")[:, :k] if s.shape[1] <= 4 * k else _top(s, k)
            best, row = np.take_along_axis(s, top, 1), np.repeat(a, top.shape[1]).reshape(top.shape)
            ok = np.isfinite(best) & (best >= least[a][:, None])
            found.append((row[ok], lo + top[ok], best[ok]))
    if not found:
        return pa.Table.from_arrays([pa.array([], kind), pa.array([], kind), none], names)
    row, at, near = (np.concatenate(x) for x in zip(*found, strict=True))
    # The block's k best of each question; copies of a vector in several of its lists go.
    keys = np.argsort(np.argsort(ids, kind="stable"), kind="stable")[at]
    order = np.lexsort((keys, -near, row))
    row, at, near = row[order], at[order], near[order]
    new = np.append(True, (row[1:] != row[:-1]) | (near[1:] != near[:-1]) | (ids[at][1:] != ids[at][:-1]))
    row, at = row[new], at[new]
    start = np.searchsorted(row, row)
    keep = np.arange(len(row)) - start < k
    row, at = row[keep], at[keep]
    # One plain sum a pair, so that a pair has the same score whatever block it was met in.
    scores = (q[row] * m[at]).sum(axis=1)
    return pa.Table.from_arrays([pa.array(qs[row], kind), pa.array(ids[at], kind), pa.array(scores)], names)


def _once(s: np.ndarray, ids: np.ndarray) -> None:
    """Leave one of the equal scores that each row of ``s`` has for an id; ``ids`` are in order."""
    for lo, hi in zip(*_spans(ids), strict=True):
        order = np.argsort(s[:, lo:hi], axis=1, kind="stable")
        own = np.take_along_axis(s[:, lo:hi], order, 1)
        own[:, 1:][own[:, 1:] == own[:, :-1]] = -np.inf
        np.put_along_axis(s[:, lo:hi], order, own, 1)


def _spans(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of equal ids, of two rows or more."""
    edge = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    last = np.append(edge[1:], len(ids))
    return edge[last - edge > 1], last[last - edge > 1]


def _top(s: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, more where the k-th value ties, by value, then column."""
    edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    width = int((s >= edge[:, None]).sum(axis=1).max())
    near = np.where(s >= edge[:, None], s, -np.inf)
    return np.argsort(-near, axis=1, kind="stable")[:, : min(width, 2 * k)]


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector of ``embeddings`` by inner product; edge cases as in ``nearest``."""
    return nearest(table(spark, sf_dir, "embeddings"))
