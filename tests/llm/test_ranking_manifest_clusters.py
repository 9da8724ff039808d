from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import clusters, manifest, queries, ranking
from tests.compare import differences, oracle
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_vantage_clusters"])
def test_matches_sql(spark, name):
    for sf in (SF, "/root/testdata/sf0.001"):
        assert differences(queries.QUERIES[name](spark, sf).toPandas(), oracle(sf, queries.ORACLES[name])) == ""


def test_pairs_meet_every_document():
    y = np.array([1, 0, 1, 1, 0, 1, 1, 2])
    win, lose = ranking.pairs(y, opponents=3)
    assert (y[win] > y[lose]).all() and set(win) | set(lose) == set(range(8))
    good = np.bincount(win[(y[win] == 1) & (y[lose] == 0)], minlength=8)
    assert set(good[y == 1]) == {3} and abs(np.diff(np.bincount(lose[y[win] == 1], minlength=8)[y == 0])).max() <= 3
    assert len({*zip(win, lose, strict=True)}) > 10 and ranking.pairs(np.zeros(4))[0].size == 0


def test_strengths_minimise_the_logistic_loss_of_differences():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((80, 4))
    y = (x @ [2.0, -1.0, 0.0, 0.5] + rng.standard_normal(80) > 0).astype(int)
    win, lose = ranking.pairs(y)
    w = ranking.strengths(x, win, lose, ridge=1e-3)
    loss = lambda v: np.mean([np.log1p(np.exp(-(x[a] - x[b]) @ v)) for a, b in zip(win, lose, strict=True)]) + 5e-4 * v @ v
    slope = [(loss(w + 1e-5 * e) - loss(w - 1e-5 * e)) / 2e-5 for e in np.eye(4)]
    assert np.abs(slope).max() < 1e-6 and w[0] > 0 > w[1]


def test_features_by_hand():
    f = ranking.features("Ab ab, ab, XY 12\n**")
    n, letters = 19, 8 + 0
    assert np.allclose(f, [np.log1p(6), np.log1p(n / 6), letters / n, 3 / letters, 2 / n, 2 / n, np.log(2 / n + 0.01), 2 / 6, 5 / 6, np.log1p(5) - np.log1p(6), 1 / 6, 2 / 6, 1.0])
    assert ranking.features(None) == ranking.features("") and all(np.isfinite(ranking.features(t)).all() for t in ("", " \n", "\x00", "é" * 5, "a" * 3_000_000, "\ud800"))


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_quality_of_held_out_rows(spark, sf):
    path = f"/root/testdata/sf{sf}"
    got = ranking.op11_pairwise_quality(spark, path)
    assert got.count() == spark.read.parquet(f"{path}/documents.parquet").count()
    rows = got.where("held_out").join(spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality"), "doc_id").where("quality is not null").collect()
    y, p = np.array([r.quality for r in rows]), np.array([r.predicted for r in rows])
    order = np.argsort(np.argsort([r.score for r in rows]))
    assert (order[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum() > 0.98 and p[y == 1].mean() > 0.99 and p[y == 0].mean() < 0.05
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_learns_from_open_rows_only(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = ranking.measured(d, F.col("doc_id") % 4 != 2).cache()
    turned = labels.withColumn("quality", F.when(F.col("doc_id") % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert ranking.fit(rows, labels) == ranking.fit(rows, turned) == ranking.fit(rows.repartition(7), labels)


def test_quality_threshold_is_a_quantile_of_all_documents(spark):
    d = documents(spark, ["A good plain text of some words." for _ in range(60)] + ["** ## $$ %%" for _ in range(40)])
    labels = d.where("doc_id % 5 = 0").select("doc_id", F.when(F.col("doc_id") < 60, 1).otherwise(0).alias("quality"))
    rows = ranking.measured(d, F.lit(True))
    model = ranking.fit(rows, labels)
    got = {r.doc_id: r.predicted for r in ranking.score(rows, model).collect()}
    assert model.level == 0.4 and got == {i: int(i < 60) for i in range(100)}


@pytest.mark.parametrize("bad", [4500, 3])
def test_quality_learns_from_all_labelled_documents(spark, monkeypatch, bad):
    # 9000 documents of label 1 and more or fewer of label 0, in many blocks: the weights are those of the pairs of all of them.
    monkeypatch.setattr(ranking, "PART", 1000)
    monkeypatch.setattr(ranking, "ASKED", 64)
    rng = np.random.default_rng(5)
    y = np.array([1] * 9000 + [0] * bad)
    x = rng.standard_normal((len(y), 3)) + np.outer(y, [1.0, 0.2, 0.0])
    rows = spark.createDataFrame([(i, True, v.tolist()) for i, v in enumerate(x)], "doc_id long, open boolean, f array<double>").cache()
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    model = ranking.fit(rows, labels)
    h = {r.doc_id: r.h for r in rows.select("doc_id", F.shiftrightunsigned(F.xxhash64(F.lit(ranking.SEED), "doc_id", "f"), 1).alias("h")).collect()}
    order = sorted(range(len(y)), key=h.get)
    win, lose = ranking.pairs(y[order])
    spread = x.std(axis=0)
    assert len(win) == 36_000 and np.allclose(model.weights, ranking.strengths(x[order] / spread, win, lose) / spread, atol=1e-6)
    good = x @ model.weights >= model.cut
    best = max((x[y == 1] @ model.weights >= c).mean() + (x[y == 0] @ model.weights < c).mean() for c in x @ model.weights)
    assert good[y == 1].mean() + (~good)[y == 0].mean() > best - 0.01


def test_quality_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(i, i % 2, 5) for i in range(1, 12)] + [(9, 0, 5), (None, 1, 5), (3, None, 5)], "doc_id long, quality int, f int")
    clash = edge.withColumns({"f": F.lit(1), "open": F.lit(2), "y": F.lit(3), "h": F.lit(4), "score": F.lit(5)})
    rows = ranking.measured(clash, F.col("doc_id") != 7)
    got = ranking.score(rows, ranking.fit(rows, labels)).collect()
    same = {r.doc_id: r.score for r in got}
    assert len(got) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got) and same[4] == same[5]
    none = ranking.fit(rows, labels.where("quality = 1"))
    assert none.weights == [] and {r.score for r in ranking.score(rows, none).collect()} == {0.0}
    nothing = ranking.measured(empty, F.lit(True))
    assert ranking.score(nothing, ranking.fit(nothing, labels)).count() == 0
    with pytest.raises(ValueError):
        ranking.fit(rows, spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").alias("quality")))


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(nodes):
    """(root, siblings of each node) by the definition, level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for i, k in enumerate(at):
            ways[i] += [h for j, h in enumerate(runs[k // 3]) if j != k % 3]
        nodes, at = [sha(*r) for r in runs], [k // 3 for k in at]
    return nodes[0], ways


def plain_manifest(rows):
    """rows: (source, doc_id, hash) -> {(source, doc_id, hash): (subroot, root, siblings)}"""
    trees = {}
    for r in rows:
        trees.setdefault(r[0], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subs, out = {}, {}
    for s in order:
        trees[s].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        subs[s] = plain([h for _, _, h in trees[s]])
    root, ups = plain([subs[s][0] for s in order])
    for k, s in enumerate(order):
        for r, way in zip(trees[s], subs[s][1], strict=True):
            out.setdefault(r, (subs[s][0], root, [*way, *ups[k]]))
    return out


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_equals_the_definition(spark, levels):
    # Trees of 1 to 250 leaves over several rounds; the null source, the empty one and one beyond ASCII; null ids.
    sizes = {None: 5, "": 4, "a": 1, "b": 2, "c": 3, "d": 9, "e": 10, "é": 27, "hot": 250, "𝄞": 28, "￮": 82}
    rows = [(s, (i if i else None) if s == "d" else 7 * i, sha(str(s), str(i))) for s, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(rows)
    want = plain_manifest(rows)
    d = spark.createDataFrame(rows, "source string, doc_id long, hash string")
    got = manifest.verified(manifest.manifest(d, levels), "hash").collect()
    proof = {(r.source, r.doc_id, r.hash): (r.subroot, r.root, r.proof_sha256) for r in got}
    assert proof == {k: (a, b, sha(*w)) for k, (a, b, w) in want.items()} and all(r.verified and r.folded_root == r.root for r in got)
    shown = d.withColumn("shown", F.when(F.col("doc_id") == 14, F.lit("0" * 64)).when(F.col("doc_id") == 21, None).otherwise(F.col("hash")))
    bad = manifest.verified(manifest.manifest(shown, levels), "shown").collect()
    assert all(r.verified == (r.doc_id not in (14, 21)) and (r.folded_root is None) == (r.doc_id == 21) for r in bad) and len(bad) == len(rows)


def test_appending_gives_the_witnesses_of_the_definition():
    for n in range(1, 82):
        nodes = [sha(str(i)) for i in range(n)]
        root, ways = plain(nodes)
        assert manifest.append(nodes, manifest._height(n)) == (root, ways)
        for i in (0, n // 2, n - 1):
            assert manifest.fold(nodes[i], [*ways[i], "rest"], i, n) == (root, ["rest"])


def test_encoded_values_and_tampering(spark, edge, empty):
    rows = edge.withColumn("text", F.when(F.col("doc_id") == 7, "two\nwords\r\n").otherwise(F.col("text")))
    got = rows.select("doc_id", manifest.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text")).alias("h")).collect()
    code = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    for r, x in zip(got, rows.collect(), strict=True):
        assert r.h == sha(*map(code, (x.doc_id, x.source, x.lang, x.n_chars, x.text)))
    leaves = edge.select("doc_id", "source", manifest.leaf(F.col("doc_id"), F.col("text")).alias("hash"), F.lit(1).alias("held"), F.lit(2).alias("block_"))
    whole = manifest.verified(manifest.manifest(leaves), "hash").collect()
    assert len(whole) == edge.count() and all(r.verified for r in whole)  # repeated rows and null ids too
    assert manifest.verified(manifest.manifest(empty.select("doc_id", "source", F.lit("x").alias("hash"))), "hash").count() == 0


def test_tree_search_is_exact_with_ties():
    rng = np.random.default_rng(5)
    for k in (1, 2, 3, 16, 200):
        points = rng.integers(-9, 9, (k, 3))  # many equal points and equal distances
        x = np.concatenate((rng.integers(-12, 12, (700, 3)), points))
        d = ((x[:, None] - points[None]) ** 2).sum(axis=2)
        number, best, asked = clusters.Tree.build(points).nearest(x)
        assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all() and (k < 200 or asked < 0.3 * d.size)
    tall = np.array([[0, 1 << 27], [1, 1 << 27], [-(1 << 27), 0]])  # roots are rounded, squares are not
    for q in ([1, -(1 << 27)], [1 << 27, 1 << 27], [0, 0]):
        want = min((sum((int(a) - b) ** 2 for a, b in zip(p, q, strict=True)), c) for c, p in enumerate(tall))
        number, best, _ = clusters.Tree.build(tall, leaf=1).nearest(np.array([q]))
        assert (best[0], number[0]) == want


def plain_clusters(rows, k, rounds, scale, size, prefix="1:"):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    points = [v for _, v in sorted(((sha(f"{prefix}{i}"), v) for i, v in kept if i is not None))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))
    for _ in range(rounds):
        own = [[] for _ in points]
        for _, v in kept:
            own[near(v)[1]].append(v)
        points = [[sum(x) // len(o) for x in zip(*o, strict=True)] if o else p for o, p in zip(own, points, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    total = lambda c=None: sum(d for _, e, d in found if c in (None, e))
    return sorted(((-1 if i is None else i), c, d, total(c), total(), sha(",".join(map(str, points[c])))) for i, c, d in found)


def found(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_equal_the_definition(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate((rng.integers(-2, 3, (150, 4)) / 2, rng.standard_normal((100, 4)), np.ones((60, 4))))  # ties and one very common vector
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(3, v[3].tolist()), (3, [9.0, 0.0, 0.0, 0.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows += [(900, None), (901, []), (902, [1.0]), (903, [1.0, None, 1.0, 1.0]), (904, [float("nan")] * 4), (905, [float("-inf")] * 4), (906, [0.0] * 4)]
    d = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, id int, v int, cluster int").repartition(5)
    for k in (1, 7, 40):
        assert found(clusters.clusters(d, k=k, size=4, scale=8)) == plain_clusters(rows, k, 3, 8, 4)
    few = spark.createDataFrame(rows[:3] + rows[-7:], "vec_id long, embedding array<float>")
    assert found(clusters.clusters(few, k=16, size=4, scale=8)) == plain_clusters(rows[:3] + rows[-7:], 16, 3, 8, 4)


def test_clusters_of_nothing_and_of_too_much(spark):
    none = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    assert clusters.clusters(none).count() == 0 and clusters.clusters(none.limit(0)).count() == 0
    assert clusters.clusters(none, size=1).select("vec_id", "cluster", "distance", "inertia").collect() == [(1, 0, 0, 0)]
    huge = spark.createDataFrame([(1, [1.0]), (2, [3e38])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="may not fit a long"):
        clusters.clusters(huge, size=1).collect()
