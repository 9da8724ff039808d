from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import decontaminate, licenses, privacy
from tests.compare import differences, oracle
from tests.llm.conftest import documents

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    bits = ["a.b@c.de", "@x.y@z.w.", "1.2.3.4", ".5.6.7.8.9", "300.1.1.1", "00255.0.0.1", "4539 1488 0343 6467", "4539-1488-0343-6467", "123456", "+1 (555) 123-4567", "+12", "é😀", " ", "-", ".", "a@b", "9" * 25]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None, "", "7" * 60_000 + " x" * 10, "a." * 30_000 + "@"]
    got = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.base] for r in privacy.sanitise(documents(spark, texts)).collect()}
    for i, t in enumerate(texts[:-1]):
        assert got[i] == spans(t), t
    assert got[len(texts) - 1] == []


def test_telling_terms_are_generalised_and_clean_documents_left_alone(spark):
    # "zarquon" stands near one address only; filler words stand everywhere.
    texts = [f"note {i} the plan of agent zarquon with mail boss@corp.example.com is the one number {i * 31}" for i in range(4)]
    texts += [f"the plan of the {i} day is one with mail and number note agent" for i in range(60)]
    d = documents(spark, texts)
    rows = {r.doc_id: r for r in privacy.sanitise(d).collect()}
    assert all(texts[i][s["start"] : s["end"]] == "zarquon" for i in range(4) for s in rows[i].added) and all(rows[i].added for i in range(4))
    assert all(not rows[i].added and not rows[i].base for i in range(4, 64))
    clean = {r.doc_id: r.clean_text for r in privacy.clean_texts(d).collect()}
    assert "zarquon" not in clean[0] and "[EMAIL]" in clean[0] and "the plan of agent" in clean[0]
    assert clean[10] == texts[10] and len(clean) == 64


def test_one_text_is_no_evidence_and_groups_are(spark):
    # "quixotic" is rare, but one text says nothing about its address; "zarquon" stands with 13 addresses of a domain.
    texts = ["the plan of agent quixotic with mail one@corp.example.com is one", "the plan of quibble and +1 (555) 123-4567 is one", "the plan of quibble and +1 (555) 123-4567 is one note"]
    texts += [f"the plan of zarquon with mail p{i}@firm.example.org is one note" for i in range(13)]
    texts += [f"the plan of the {i} day is one with mail and note agent" for i in range(61)]
    rows = {r.doc_id: r for r in privacy.sanitise(documents(spark, texts)).collect()}
    assert [[(texts[i][s["start"] : s["end"]], s["tag"]) for s in rows[i].added] for i in range(4)] == [[], [("quibble", "[TERM]")], [("quibble", "[TERM]")], [("zarquon", "")]]
    clean = {r.doc_id: r.clean_text for r in privacy.clean_texts(documents(spark, texts)).collect()}
    assert clean[0] == "the plan of agent quixotic with mail [EMAIL] is one" and clean[3] == "the plan of  with mail [EMAIL] is one note" and clean[20] == texts[20]
    # Copies of a text are one text.
    copies = documents(spark, [texts[0]] * 30 + texts[16:])
    assert privacy.sanitise(copies).where("size(added) > 0").count() == 0


def test_padded_repeated_and_long_items(spark):
    long_ = " ".join(f"item{i}" for i in range(3000))
    items = spark.createDataFrame([("s", "what" + " " * 40 + "is two"), ("r", "a question that is long enough to have a budget"), ("r", "a question that is long enough to have a budget"), ("l", long_), ("n", None), ("e", " ")], "item_id string, text string")
    texts = ["they ask what is two of them", "So: a question that is long enouhg to have a budget?", f"before {long_.replace('item7 ', 'itme7 ')} after", "nothing at all"]
    d = documents(spark, texts)
    for chars in (decontaminate.BLOCK_CHARS, 50):
        assert [r.doc_id for r in decontaminate.clean(d, items, block_chars=chars).collect()] == [0, 3]
        got = sorted((r.doc_id, r.item_id, r.distance) for r in decontaminate.contamination(d, items, block_chars=chars).collect())
        assert got == [(0, "s", 0), (1, "r", 2), (1, "r", 2), (2, "l", 2)]


def test_benchmark_in_portions(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"the {w} question asks about the matter of {w}") for i, w in enumerate("red green blue black white".split())], "item_id int, text string")
    d = documents(spark, [f"x the {w} question asks about the matter of {w}" for w in "red blue brown white".split()] + ["clean"])
    want = sorted(map(tuple, decontaminate.contamination(d, items).collect()))
    monkeypatch.setattr(decontaminate, "PORTION", 60)
    assert len(decontaminate.portions(items, "item_id", "text")) > 2 and sorted(map(tuple, decontaminate.contamination(d, items).collect())) == want
    assert [r.doc_id for r in decontaminate.clean(d, items).collect()] == [2, 4]


def test_telling_terms_far_from_the_entity_are_found(spark):
    far = " the plan of the day is one with note" * 20
    texts = [f"zarquon{far} mail boss@corp.example.com {far} {i} is quibble" for i in range(5)] + [f"plan {i} of the day is one with mail and note" for i in range(60)]
    rows = privacy.sanitise(documents(spark, texts)).collect()
    assert all([texts[r.doc_id][s["start"] : s["end"]] for s in r.added] == (["zarquon", "quibble"] if r.doc_id < 5 else []) for r in rows)


def test_privacy_edge_cases(spark, edge, empty):
    assert privacy.sanitise(edge).where("size(base) + size(added) > 0").count() == 0 and privacy.sanitise(edge).count() == edge.count()
    assert privacy.sanitise(empty).count() == 0


def test_license_labels_and_places(spark):
    texts = [
        "x Released under the MIT License. y", "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3. and mit license too", "Licensed under CC BY-NC 4.0.",
        "the license of mit", "Permission is hereby kindly granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit-license MIT  license", None, "", "été mit license",
    ]
    got = {r.doc_id: r for r in licenses.license_report(documents(spark, texts)).collect()}
    assert [got[i].labels for i in range(10)] == ["mit", "apache,apache-2.0", "gpl,gpl-3.0,mit", "cc-by-nc-4.0", "", "mit", "mit", "", "", "mit"]
    assert [got[i].base_labels for i in range(10)] == ["mit", "apache", "gpl,mit", "", "", "", "mit", "", "", "mit"]
    assert (got[6].n_base, got[6].first_word, got[6].last_word, got[6].n_words) == (2, 0, 2, 4)
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 7, 13) and got[7].n_words == 0 and got[9].first_word == 1
    assert all(0 <= r.score <= 1 for r in got.values())


def test_license_edge_cases(spark, edge, empty):
    assert licenses.license_report(edge).count() == edge.count() and licenses.license_report(empty).count() == 0


def distance(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, e in enumerate(text, 1):
            now.append(min(before[j - 1] + (c != e), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def test_passages_equal_brute_force():
    rng = random.Random(2)
    items = [(i, " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(8, 30)))) for i in range(12)]
    matcher = decontaminate.Matcher(items)
    for _ in range(120):
        i, text = rng.choice(items)
        k, s = int(decontaminate.RATE * len(text)), list(text)
        for _ in range(rng.randint(0, k + 3)):
            at = rng.randrange(len(s))
            s[at : at + 1] = rng.choice([[], ["x"], [s[at], "y"]])
        doc = decontaminate.normal("ab cd " * rng.randint(0, 8) + "".join(s) + " ee" * rng.randint(0, 8))
        near, found = distance(text, doc), [h for h in matcher.find(doc) if h[0] == i]
        assert bool(found) == (near <= k)
        if found:
            assert found[0][1] == near == distance(text, doc[found[0][2] : found[0][3]])


def test_contamination_edge_cases(spark, edge, empty):
    bench = spark.createDataFrame([(1, "gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, ""), (4, "short")], "item_id long, text string")
    rows = decontaminate.contamination(edge, bench).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3} and all(r.item_id == 1 and r.distance == 0 for r in rows)
    kept = decontaminate.clean(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 3
    assert decontaminate.contamination(empty, bench).count() == 0 and decontaminate.clean(edge, bench.limit(0)).count() == edge.count()
    split = decontaminate.contamination(edge, bench, block_chars=20).collect()
    assert sorted(split) == sorted(rows)


def test_short_items_are_found_between_word_borders(spark):
    texts = ["Is the sky Blue?", "is the sky bluer? no", "what, IS  the sky blue? yes", "this the sky blue?", None, "a b 12.5% c", "a b 112.5% c"]
    bench = spark.createDataFrame([("q1", "is the sky blue?"), ("q2", "12.5%"), ("q3", " ")], "item_id string, text string")
    for chars in (10, 1000):
        rows = decontaminate.contamination(documents(spark, texts), bench, block_chars=chars).collect()
        assert sorted((r.doc_id, r.item_id, r.distance, r.start_char) for r in rows) == [(0, "q1", 0, 0), (2, "q1", 0, 6), (5, "q2", 0, 4)]
    assert decontaminate.clean(documents(spark, texts), bench).count() == len(texts)


def test_passages_of_all_documents_equal_brute_force(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").collect() for t in ("documents", "benchmark"))
    rows = {(r.doc_id, r.item_id): r.distance for r in decontaminate.op3_pigeonhole_decontaminate(spark, "/root/testdata/sf0.001").collect()}
    items = [(b.item_id, decontaminate.normal(b.text)) for b in bench]
    some = [d for d in docs if d.doc_id in {i for i, _ in rows}][:12] + docs[:12]
    for d in some:
        text = decontaminate.normal(d.text)
        for i, item in items:
            near = decontaminate.Pattern(item).best(text)[0] if text else len(item)
            assert rows.get((d.doc_id, i)) == (near if near <= int(decontaminate.RATE * len(item)) else None)


@pytest.mark.parametrize("text,want", [("", []), ("x", [])])
def test_matcher_on_short_texts(text, want):
    assert decontaminate.Matcher([(1, "a" * 40)]).find(text) == want


def test_license_report_matches_sql(spark):
    assert differences(licenses.op10_diagonal_licenses(spark, "/root/testdata/sf0.001").toPandas(), oracle("/root/testdata/sf0.001", licenses.ORACLE)) == ""


def test_whole_license_texts_and_clashing_columns(spark):
    body = licenses.TEMPLATES[-4][1]
    words = body.split()
    texts = ["Copyright 2024 A. Body\n\n" + body + "\nThe end", " ".join(words[:60] + ["quite", "another"] + words[60:]), " ".join(words[:40]), "x " * 50_000 + body]
    d = documents(spark, texts).withColumns({"w": F.lit("a"), "id": F.lit(3), "hash": F.lit(1), "low": F.lit("b"), "any": F.lit(True)})
    d = d.unionByName(d)  # repeated rows
    got = licenses.license_report(d).collect()
    assert len(got) == 8 and [sorted({r.labels for r in got if r.doc_id == i}) for i in range(4)] == [["mit"], ["mit"], ["mit"], ["mit"]]
    spans = licenses.license_spans(d, templates=[("whole", body)]).collect()
    assert {r.id: r.verified for r in spans if r.cover > 0.2} == {0: True, 1: True, 2: False, 3: True} and max(r.start_word for r in spans if r.cover > 0.9) == 50_000


def test_added_spans_equal_the_definition(spark):
    # Disclosure of every term about every entity of sf0.001 from plain Python counts.
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    term = re.compile(r"[^\W_]+")
    held, df_t, docs_of = {}, {}, {}
    digits = lambda x: re.sub("[^0-9]", "", x)
    group = lambda k, x: x.rpartition("@")[2] if k == "email" else ".".join(x.split(".")[:2]) if k == "ip" else digits(x)[: 6 if k == "card" else 4]
    for i, t in docs:
        base = spans(t)
        for w in {w.lower() for w in term.findall(t)}:
            df_t[w] = df_t.get(w, 0) + 1
        if base:
            bare = list(t)
            for _, a, b in base:
                bare[a:b] = " " * (b - a)
            held[i] = (t, base, {w.lower() for w in term.findall("".join(bare))}, {e for k, a, b in base for e in (k, (k, group(k, t[a:b].lower())), f"{k}:{t[a:b].lower()}")})
            for e in held[i][3]:
                docs_of.setdefault(e, []).append(i)
    n, want = len(docs), {}
    for e, own in docs_of.items():
        joint = {}
        for i in own:
            for w in held[i][2]:
                joint.setdefault(w, []).append(i)
        for w, at in joint.items():
            met = len({held[i][0] for i in at})
            known = math.log2(n / len(own))
            leak = math.log2(n * len(at) / (df_t[w] * len(own))) / known if known > 0 else 0.0
            leak *= met / (met + 1)
            if leak >= privacy.GENERALISE - 1e-12:
                for i in at:
                    want.setdefault(i, {})[w] = max(leak, want.get(i, {}).get(w, 0.0))
    got = {r.doc_id: r.added for r in privacy.sanitise(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    for i, t in docs:
        places = [(m.start(), m.end(), m[0].lower()) for m in term.finditer(t) if m[0].lower() in want.get(i, {})]
        places = [(a, b) for a, b, w in places if not any(a < y and x < b for _, x, y in held[i][1])]
        assert sorted((s["start"], s["end"]) for s in got[i]) == sorted(places), i
    assert 0 < sum(map(len, got.values())) < 0.05 * sum(len(term.findall(held[i][0])) for i in held)
