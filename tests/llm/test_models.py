from __future__ import annotations

import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerspark.llm import language, neighbours, toxicity
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.01"


def plain_bits(training, text, order=language.ORDER):
    """Code length by the definition: blended distributions over all 256 bytes, context by context."""
    seen: dict[tuple, dict[int, int]] = {}
    for t in training:
        s = [256] * order + list(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                c = seen.setdefault(tuple(s[i - k : i]), {})
                c[s[i]] = c.get(s[i], 0) + 1

    def distribution(context):
        shorter = distribution(context[1:]) if context else [1 / 256] * 256
        c = seen.get(context)
        if not c:
            return shorter
        t, d, left = sum(c.values()), len(c), sum(p for b, p in enumerate(shorter) if b not in c)
        return [c[b] / (t + d) if b in c else d / (t + d) * shorter[b] / left for b in range(256)]

    s, bits = [256] * order + list(text), 0.0
    for i in range(order, len(s)):
        bits -= np.log2(distribution(tuple(s[i - order : i]))[s[i]])
    return bits


def learn(texts):
    names = sorted(texts)
    found = [(n, *np.unique(np.concatenate([language.grams(t) for t in texts[n]]), return_counts=True)) for n in names]
    return language.build(names, np.array([n for n, k, _ in found for _ in k], object), np.concatenate([k for _, k, _ in found]), np.concatenate([c for _, _, c in found]))


def test_code_lengths_equal_the_definition(monkeypatch):
    monkeypatch.setattr(language, "TOGETHER", 2)  # three languages in two sets of trees
    texts = {"x": ["the cat sat on the mat, the end".encode(), b"that"], "y": ["der hund und die öl".encode(), "日本".encode()], "z": [b"aaaa", b"ab"]}
    m = learn(texts)
    for t in ("the hat", "über öl", "日本語 a", "", "aaab\x00", "z" * 40):
        data = t.encode()
        want = [plain_bits(texts[n], data) for n in m.languages]
        assert np.allclose(m.lengths([data])[0], want, rtol=1e-5, atol=1e-3) and np.allclose(m.lengths([data], chunk=3)[0], want, rtol=1e-5, atol=1e-3)


def test_texts_of_unknown_languages_are_rejected(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    other = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.", "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом",
        "qzxj wvkq zzkx jqvw xkcd qqzj vvxk wzqj kxvq zjwx qkvz xjqw vzkx", "0xZ9qLmX7vB2kQ4wJ8nR5tY1uH3gF6dS" * 4,
    ]
    more = documents(spark, other + ["", None, "12 34", "The and to of in"]).withColumn("doc_id", -F.col("doc_id") - 1)
    kept = {r.doc_id for r in language.keep_known(known.unionByName(more), language.fit(known)).collect()}
    assert {r.doc_id for r in known.collect()} <= kept and {i for i in kept if i < 0} == {-8}


def test_language_held_out_accuracy(spark):
    rows = language.op5_ppm_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark, edge, empty):
    m = language.fit(edge)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(edge, m).collect()}
    assert got[4] == got[5] == got[6] == ("und", 0.0) and got[11][0] == "de" and got[9][0] == "fr"
    nothing = language.fit(empty)
    assert {r.lang_pred for r in language.predict(edge, nothing).collect()} == {"und"}
    assert language.predict(empty, m).count() == 0
    assert language.keep_known(edge, m).columns == edge.columns and language.keep_known(edge, m).count() == edge.count() - 3


def test_toxicity_finds_marked_words(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    text = lambda bad: " ".join([rng.choice(words) for _ in range(60)] + ["vileword"] * bad)
    d = documents(spark, [text(i % 4 == 0) for i in range(500)] + [None, ""])
    labels = d.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0).alias("toxic"))
    model = toxicity.fit(d.where("doc_id < 400"), labels.where("doc_id < 400"), language.fit(d))
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    right = [got[i].predicted == (i % 4 == 0) for i in range(400, 500)]
    assert np.mean(right) > 0.95 and got[500].score == got[501].score and got[500].predicted == 0
    assert all(r.predicted == (r.score >= 0.5) for r in got.values())


def test_toxicity_without_labels(spark, edge, empty):
    none = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edge, none, language.fit(edge))
    assert {r.score for r in toxicity.score(edge, model).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


@pytest.mark.parametrize("size", [0.01, 0.1])
def test_toxicity_of_held_out_rows(spark, size):
    sf = f"/root/testdata/sf{size}"
    rows = toxicity.op7_cnn_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("toxic is not null").collect()
    y, p = np.array([r.toxic for r in rows]), np.array([r.predicted for r in rows])
    order = np.argsort(np.argsort([r.score for r in rows]))
    auc = (order[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.95 and p[y == 1].mean() > (0.85 if size == 0.1 else 0.8) and p[y == 0].mean() < 0.03


def test_toxicity_edge_cases(spark, edge, empty, monkeypatch):
    # Columns of clashing names, repeated rows and nulls; a text beyond the sample's words ends nothing.
    labels = spark.createDataFrame([(i, i % 2, 5) for i in range(1, 12)] + [(9, 1, 5), (None, 1, 5), (3, None, 5)], "doc_id long, toxic int, k int")
    clash = edge.withColumns({"k": F.lit(1), "y": F.lit(2), "i": F.lit(3), "h": F.lit(4)})
    model = toxicity.fit(clash, labels, language.fit(edge), sample_words=200)
    got = toxicity.score(clash, model).collect()
    assert model.net is not None and len(got) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    same = {r.doc_id: r.score for r in got}
    assert same[4] == same[5] == same[6] and same[9] == same[10]
    assert toxicity.score(empty, model).count() == 0


def test_toxicity_learns_from_all_labelled_texts(spark, monkeypatch):
    # 1200 labelled texts in parts of about 100 of a label: three quarters of them are counted in training, and words that few toxic texts hold are learnt.
    rng, seen = np.random.default_rng(3), []
    common = [f"plain{i}" for i in range(300)]
    texts = ["always " + " ".join(rng.choice(common, 30)) + (f" zz{i // 4 % 50}bad" if i % 4 == 0 else "") for i in range(1200)]
    d = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)], "doc_id long, toxic int")
    fresh = toxicity.State.fresh
    monkeypatch.setattr(toxicity.State, "fresh", lambda df: seen.append(df) or fresh(df))
    model = toxicity.fit(d, labels, language.Model([], [], np.empty(0)), sample=100)
    assert 850 < seen[0][toxicity.words_of("always")[0, 0]] <= 920
    got = toxicity.score(d, model).collect()
    right = np.array([r.predicted == (r.doc_id % 4 == 0) for r in got])
    assert len(got) == 1200 and right.mean() > 0.97 and np.mean([r.predicted for r in got if r.doc_id % 4 == 0]) > 0.9


ODD_TEXTS = [
    "The cat, the CAT: the cat's mat.", "", None, " \t\x1c ", "__a__b_c", "ΑΣ ΑΣ. İstanbul\u2003Straße", "日本語、テキスト。x²", "über" * 9 + "-1,000.5",
    "one" + "".join(f"{chr(c)}w" for c in range(0x2190, 0x2200)), "don\u2019t\u00a0stop\u0085now e\u0301",
]


def plain_rows(word):
    return [xxhash.xxh32_intdigest(x) % toxicity.ROWS for x in (word, *(f"{n}^{word[:n]}" for n in toxicity.STARTS))]


@pytest.mark.parametrize("group", [1, 30, 1 << 20])
def test_toxicity_words_of_groups_of_texts(monkeypatch, group):
    monkeypatch.setattr(toxicity, "GROUP", group)
    got = [rows.take(p, axis=0).tolist() for rows, texts in toxicity.words_in(ODD_TEXTS) for p in texts]
    assert got == [[plain_rows(w) for w in toxicity.WORDS.findall((t or "").lower())] for t in ODD_TEXTS]


def plain_best(net, ids):
    """Of each filter the largest activation above zero and its place, by the definition."""
    e, out = net.table[ids].astype(float).sum(axis=1), []
    for c in range(toxicity.ALL):
        rows = np.flatnonzero(toxicity.FILTER == c)
        w = toxicity.WIDTHS[c // toxicity.FILTERS]
        assert toxicity.PLACE[rows].tolist() == list(range(w))
        a = [float(sum(e[i + j] @ net.maps[r] for j, r in enumerate(rows)) + net.bias[c]) for i in range(len(ids) - w + 1)]
        out.append((max(a), int(np.argmax(a))) if a and max(a) > 0 else (0.0, -1))
    return out


def test_toxicity_network_equals_the_definition(monkeypatch):
    rng = np.random.default_rng(5)
    state = toxicity.State.fresh(rng.integers(0, 9, toxicity.ROWS))
    net = state.net
    net.table = rng.standard_normal(net.table.shape).astype(np.float32)
    texts = [rng.integers(0, toxicity.ROWS, (n, 4)).astype(np.int16) for n in (0, 1, 2, 3, 4, 9, 40)]
    for t in texts:
        want = plain_best(net, t)
        for chunk in (1, 2, 3, 7, 4096):
            best, where = net.best(lambda lo, hi, t=t: net.vectors(t[lo:hi]), len(t), chunk)
            assert np.allclose(best, [b for b, _ in want], atol=1e-4) and where.tolist() == [w for _, w in want]
    monkeypatch.setattr(toxicity, "KEEP", 2)  # every word
    for t in texts:  # a training step is one of Adagrad along the gradient
        best, where = (np.array(x) for x in zip(*plain_best(net, t), strict=True))
        g = 3 * (1 / (1 + np.exp(-(best @ net.out + net.out_bias))) - 1)
        table, rows, maps, bias = net.table.astype(float), state.rows.astype(float), net.maps.astype(float), net.bias.astype(float)
        seen, seen_bias = state.rest[: maps.size].reshape(maps.shape).astype(float), state.rest[maps.size : maps.size + toxicity.ALL].astype(float)
        out = net.out - 0.1 * (grad := g * best + toxicity.DECAY * net.out) / np.sqrt(state.rest[maps.size + toxicity.ALL :] + grad**2)
        steps = []
        for r, (c, j) in enumerate(zip(toxicity.FILTER, toxicity.PLACE, strict=True)):
            if where[c] >= 0:
                ids, b = t[where[c] + j].astype(int), g * net.out[c]
                up = table[ids].sum(axis=0) * b
                steps += [(i, b * maps[r].copy()) for i in ids]
                seen[r] += up**2
                maps[r] -= 0.1 * up / np.sqrt(seen[r])
                if j == 0:
                    seen_bias[c] += b**2
                    bias[c] -= 0.1 * b / np.sqrt(seen_bias[c])
        for i, d in steps:
            rows[i] += (d**2).mean()
        for i, d in steps:
            table[i] -= 0.1 * d * state.trust[i, 0] / np.sqrt(rows[i])
        toxicity.train(state, [t], np.array([1]), {1: 3.0}, [0.1], 1)
        for a, b in ((net.table, table), (state.rows, rows), (net.maps, maps), (net.bias, bias), (net.out, out)):
            assert np.allclose(a, b, rtol=1e-3, atol=1e-4)


def test_toxicity_scores_cost_less_than_word_by_word():
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdeé"), 8)) for _ in range(40_000)]
    texts = [" ".join(words[i] for i in (rng.random(600) ** 2 * len(words)).astype(int)) for _ in range(256)]
    net = toxicity.Network.fresh(rng)
    filters = [[net.maps[(toxicity.FILTER // toxicity.FILTERS == k) & (toxicity.PLACE == j)].T.copy() for j in range(w)] for k, w in enumerate(toxicity.WIDTHS)]

    def plain(text, known):
        found = toxicity.WORDS.findall(text.lower())
        for w in found:
            if w not in known:
                known[w] = net.table[np.array(plain_rows(w), np.int32)].sum(axis=0)
        e, best = np.array([known[w] for w in found]), []
        for f in filters:
            n = len(e) - len(f) + 1
            a = e[:n] @ f[0]
            for j in range(1, len(f)):
                a += e[j : j + n] @ f[j]
            best.append(np.maximum(a.max(axis=0), 0))
        return float(np.concatenate(best) @ net.out)

    def timed(run):
        at = time.process_time()
        return np.array(run()), time.process_time() - at

    model = toxicity.Classifier(net, language.Model([], [], np.empty(0)), {}, 0.0)
    took, plainly = [], []
    for _ in range(3):
        known = {}
        want, s = timed(lambda known=known: [plain(t, known) for t in texts])
        plainly.append(s)
        got, s = timed(lambda: model.scores(texts))
        took.append(s)
        assert np.allclose(got, 1 / (1 + np.exp(-want)), atol=1e-5)
    assert min(took) < 0.75 * min(plainly)


def brute(ids, vectors, k=20):
    out = {}
    for i, v in zip(ids, vectors, strict=True):
        if i % 20 == 0:
            out[i] = [j for _, j in sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in zip(ids, vectors, strict=True) if j != i)][:k]
    return out


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = (rng.standard_normal((1500, 16)) + 3 * rng.standard_normal((12, 16))[rng.integers(0, 12, 1500)]) * rng.uniform(0.5, 2, (1500, 1))
    x[100:160] = x[100]  # one very common vector
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want, got = brute(range(1500), x.tolist()), {}
    for r in neighbours.nearest(d, probes=24).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(want) and all(sorted(g) == list(range(1, 21)) for g in got.values())
    assert np.mean([len(set(want[q]) & {v for v, _ in got[q].values()}) / 20 for q in want]) >= 0.9
    assert all(abs(s - float(x[q] @ x[v])) < 1e-9 for q, g in got.items() for v, s in g.values())


def exact(x):
    s = x[::20] @ x.T
    s[np.arange(len(s)), np.arange(0, len(x), 20)] = -np.inf
    return {(20 * q, int(v)) for q, best in enumerate(np.argsort(-s, axis=1)[:, :20]) for v in best}


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST", 8)  # 750 lists
    monkeypatch.setattr(neighbours, "SHELF", 500)
    monkeypatch.setattr(neighbours, "ASKED", 40)
    x = np.random.default_rng(6).standard_normal((6000, 32))
    rows = neighbours.nearest(frame(spark, x)).collect()
    assert len({(r.query_id, r.vec_id) for r in rows} & (want := exact(x))) / len(want) >= 0.9


def test_pruned_search_of_clustered_vectors(spark):
    # 24,000 vectors of 400 clusters in 64 dimensions: few lists are opened, border vectors alone are copied.
    rng = np.random.default_rng(8)
    c, pick = rng.standard_normal((400, 64)), lambda n: rng.integers(0, 400, n)
    x = np.concatenate((c[pick(20_000)], (c[pick(4_000)] + c[pick(4_000)]) / 2)) + 0.6 * rng.standard_normal((24_000, 64))
    x = x[rng.permutation(24_000)]
    index = neighbours.Index.fit(x[::2], len(x), float((x**2).sum(axis=1).max()), 20)
    homes, take = index.homes(x)
    size = np.bincount(homes[take], minlength=len(index.graph.points))
    lists, open_ = index.asked(x[::20])
    scanned = (size[lists] * open_).sum(axis=1) / len(x)
    assert len(size) >= 370 and 1.02 * len(x) < take.sum() < 1.5 * len(x) and scanned.mean() < 0.15 and open_.sum(axis=1).mean() < 0.1 * len(size)
    rows = neighbours.nearest(frame(spark, x)).collect()
    got = {(r.query_id, r.vec_id) for r in rows}
    assert len(rows) == 20 * 1200 and len(got & (want := exact(x))) / len(want) >= 0.9


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(3)
    points = rng.standard_normal((3000, 24)).astype(np.float32)
    graph, q = neighbours.Graph.build(points), rng.standard_normal((100, 24)).astype(np.float32)
    found, dist = graph.search(q, 10, 40)
    want = np.argsort(((q[:, None] - points[None]) ** 2).sum(axis=2), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, want, strict=True)]) > 0.85 and (np.diff(dist, axis=1) >= 0).all()


def test_shelves_hold_bounded_rows():
    first, parts = neighbours.shelved({0: 3, 1: 4, 2: 25, 3: 2, 5: 9}, 6, rows=10)
    assert first.tolist() == [0, 0, 1, 4, 4, 5] and parts.tolist() == [1, 1, 3, 1, 1, 1]


def test_common_vectors_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHELF", 50)
    monkeypatch.setattr(neighbours, "ASKED", 7)
    x = np.random.default_rng(9).standard_normal((900, 6))
    x[300:600] = x[300]
    rows = [(i, v.tolist(), 1, 2, 3, "l") for i, v in enumerate(x)] + [(20, x[20].tolist(), 1, 2, 3, "l")]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int, v int, list int, shelf string"), probes=10_000).collect()
    assert len(got) == 45 * 20
    want = {i: sorted(((-float(x[i] @ w), j) for j, w in enumerate(x) if j != i)) for i in range(0, 900, 20)}
    for i, best in want.items():
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)]
        near = [-s for s, _ in best[:20]]
        assert np.allclose([float(x[i] @ x[j]) for j in mine], near) and (near[0] - near[-1] > 1e-9 or mine == sorted(mine))


@pytest.mark.parametrize("times", [1, 100, 500])
def test_repeated_rows_lose_no_neighbours(spark, monkeypatch, times):
    monkeypatch.setattr(neighbours, "SHELF", 60)
    x = np.random.default_rng(12).standard_normal((200, 8))
    x[7] = 3 * x[0]  # the nearest of query 0, repeated; query 40 repeats too
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist())] * times + [(40, x[40].tolist())] * times
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), probes=10_000).collect()
    assert len(got) == 200 and {(r.query_id, r.vec_id) for r in got} == exact(x)


def test_ids_with_several_vectors(spark):
    # 60 vectors of id 1 in pairs of equal score: 30 scores, of which 20 are the nearest; other ids follow below them.
    rows = [(0, [1.0, 0.0, 0.0])] + [(1, [2.0 + i // 2, float(i), 1.0]) for i in range(60)] + [(i, [0.5, 0.1, 0.1]) for i in range(2, 30) if i % 20]
    got = sorted(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), probes=10_000).where("query_id = 0").collect(), key=lambda r: r.rank)
    assert [(r.vec_id, r.score) for r in got] == [(1, 31.0 - i) for i in range(20)]
    got = neighbours.nearest(spark.createDataFrame(rows[:21] + rows[61:], "vec_id long, embedding array<double>"), probes=10_000).where("query_id = 0").collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 11.0 - i) for i in range(10)] + [(i, 0.5) for i in range(2, 12)]


def test_vectors_that_take_no_part(spark):
    bad = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (1, [float("nan"), 1.0]), (2, [float("inf"), 1.0]), (3, [None, 1.0]), (4, [1.0]), (5, [0.5, 0.5]), (6, [1.0, 0.0]), (None, [1.0, 1.0])]
    rows = neighbours.nearest(spark.createDataFrame(bad, "vec_id long, embedding array<float>")).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(rows)] == [(0, 1, 6, 1.0), (0, 2, 5, 0.5)]
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
