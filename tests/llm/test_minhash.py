from __future__ import annotations

import random

from ledgerspark.llm import minhash
from ledgerspark.llm.components import connected_components
from ledgerspark.llm.common import BATCH_BYTES, Scratch
from tests.compare import differences, oracle
from tests.llm.conftest import documents


def brute(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_components_equal_brute_force_on_a_large_group_of_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(90)]
    texts = []
    for k in range(260):  # edits from none to many, so that links are dense, rare and absent
        t = list(base)
        for _ in range(rng.randint(0, 9)):
            t[rng.randrange(len(t))] = f"x{k}{rng.randint(0, 99)}"
        texts.append(" ".join(t))
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["one two", "ONE two", None, ""]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert got == brute(texts)


def test_edge_cases(spark, edge, empty):
    rows = minhash.near_duplicates(edge).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == edge.count()
    assert got[1] == (16, 1, True) and got[2] == (16, 1, False)
    assert got[4] == (0, 4, True) and got[5] == (0, 5, True) and got[6] == (0, 6, True)
    assert got[7] == (1, 7, True) and got[8] == (1, 7, False)
    assert got[10][1:] == (9, False) and got[None][2]
    assert minhash.near_duplicates(empty).count() == 0


def test_bounds_of_the_posterior():
    assert minhash.fewest_matches(32, 0.75, 1e-5) < minhash.fewest_matches(32, 0.75, 1e-2) < 24
    assert minhash.fewest_matches(128, 0.75, 1e-5) / 128 > minhash.fewest_matches(32, 0.75, 1e-5) / 32


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t"), "t").collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t"), "e").count() == 0


def test_arrow_batches_to_python_are_bounded_by_bytes(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, short = spark.conf.get(key), BATCH_BYTES

    def checked(batches, rows=256):
        for part in batches:
            assert part.nbytes < 2 * short, f"{part.nbytes} bytes at once"
            for at in range(0, part.num_rows, rows):
                yield part.slice(at, rows)

    monkeypatch.setattr(minhash, "slices", checked)
    docs = spark.range(0, 400, 1, 1).selectExpr("id AS doc_id", "concat(id, repeat(' the same few words again', 2000)) AS text")
    assert minhash.near_duplicates(docs).count() == 400
    assert spark.conf.get(key) == before


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(minhash.op1_minhash_dedup(spark, sf).toPandas(), oracle(sf, minhash.ORACLE)) == ""
