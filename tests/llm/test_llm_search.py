"""Hard negatives, licence scan and ranked search against brute force and on edge rows."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from edge_cases import documents, documents_frame, equal_to_sql, frame, prose, repeats

from waykit.llm import licenses, negatives, ranking

VECTORS = "vec_id bigint, embedding array<double>, label int"


# --- hard negatives -------------------------------------------------------------------------------


def brute_negatives(rows: list[tuple]) -> list[tuple]:
    """The contract, row by row; equal anchor rows count once."""
    taking = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        taking.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for a, av, al in dict.fromkeys((i, tuple(v), label) for i, v, label in taking):
        if a is None or a % 50:
            continue
        scored = [(sum(x * y for x, y in zip(av, v)), i, label) for i, v, label in taking if i != a]  # noqa: B905
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for p, i, label in [s for s in scored if s[2] == al][:5]:
            fits = [s for s in scored if s[2] != al and 50 * p <= 100 * s[0] <= 95 * p][:3]
            out += [(a, i, k + 1, s[1], p, s[0]) for k, s in enumerate(fits)]
    return sorted(out, key=str)


def vectors(n: int, dim: int, seed: int, copies: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        k = int(rng.integers(6))
        v = centres[k] + rng.normal(size=dim) * 0.4
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], k))
    return [(i, rows[i - i % copies][1], label) for i, _, label in rows]


@pytest.mark.parametrize("copies", [1, 30])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(negatives, "LEAF", 8)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 60)
    monkeypatch.setattr(negatives, "CHUNK_QUERIES", 4)
    rows = vectors(600, 8, 3, copies)
    got = negatives.digest(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_negatives(rows)


def test_hard_negatives_edge_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (50, [0.0, 0.0], 2), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [1.0, 1.0], None),
            (5, [float("inf"), 1.0], 1), (7, [0.9, 0.5], 0), (8, [0.9], 1), (9, [], 3), (10, [0.5, 0.2, 9.0], 3), (None, [0.6, 0.3], 3),
            (None, [1.0, 0.5], 1), (11, [1.0, 0.5], 1), (12, [-1.0, -1.0], 1), (13, [0.4, 0.4], 4), (14, [0.4, 0.4], 5), (100, [1e-3, -1e-3], 2)]
    clash = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS LABEL", "2 AS q", "3 AS cell", "4 AS key", "5 AS Vec_Id")
    assert sorted(map(tuple, negatives.digest(clash).collect()), key=str) == brute_negatives(rows)
    assert negatives.digest(clash.limit(0)).count() == 0
    one = negatives.digest(spark.createDataFrame(rows[:1], VECTORS))
    assert one.count() == 0 and len(one.columns) == 6
    twice = sorted(map(tuple, negatives.digest(spark.createDataFrame(rows + [rows[0]], VECTORS)).collect()), key=str)
    assert twice == brute_negatives(rows + [rows[0]])
    with pytest.raises(Exception, match="not exact"):
        negatives.digest(spark.createDataFrame([(0, [1e9, 1e9], 1), (1, [1.0, 1.0], 1)], VECTORS)).count()


def test_subtrees_are_ruled_out_and_none_is_lost():
    rng = np.random.default_rng(5)
    data = np.floor(256 * np.repeat(rng.normal(size=(40, 3)) * 4, 50, axis=0) + rng.normal(size=(2000, 3)))
    labels = rng.integers(0, 2, 2000)
    tree = negatives.Tree(data, np.arange(2000), labels)
    a = data[:100:10]
    low, high = np.sort(a @ data.T, axis=1)[:, -60], np.sort(a @ data.T, axis=1)[:, -20]
    q = negatives.Queries(a, negatives.norms(a), np.arange(0, 100, 10), labels[:100:10], np.arange(10), low, high, 4, False)
    tree.search(q)
    assert tree.seen < 10 * 2000 / 2
    for i in range(10):
        s = a[i] @ data.T
        fits = sorted((-s[j], j) for j in range(2000) if labels[j] != labels[10 * i] and low[i] <= s[j] <= high[i])[:4]
        got = [(-x, j) for x, j in zip(q.scores[i], q.row_ids[i], strict=True) if x > -np.inf]
        assert got == fits


# --- licence scan ---------------------------------------------------------------------------------


def brute_scan(texts: list[str | None]) -> list[list[tuple]]:
    """(start, label, base) of every template that stands in a text, each place tried."""
    words = [licenses.template_words(t or "") for t in texts]
    vocabulary = {w for t in licenses.TEMPLATES for w in licenses.template_words(t.text)}
    n = len(texts)
    weight = {v: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(v in set(w) for w in words) + 1))) for v in vocabulary}
    out = []
    for w in words:
        found = []
        at = lambda i, w=w: w[i] if 0 <= i < len(w) else None
        for t in licenses.TEMPLATES:
            body = licenses.template_words(t.text)
            must = licenses.required(t)
            ranked = sorted(set(body), key=lambda v: (-weight[v], v))
            rare = [j for j, v in enumerate(body) if v in ranked[: math.ceil(len(ranked) / 4)]]
            for s in range(-len(body), len(w)):
                votes = sum(at(s + j) == body[j] for j in rare)
                if 2 * votes >= len(rare) and all(at(s + j) == body[j] for j in must):
                    found.append((s, t.label, t.base))
        out.append(sorted(found))
    return out


MIT = next(t.text for t in licenses.TEMPLATES if t.label == "mit" and t.keys)


def license_texts() -> list[str | None]:
    r = random.Random(4)
    pool = ["gnu", "general", "public", "license", "apache", "cc", "by", "nc", "sa", "mit", "version", "2", "0", "3", "K", "K", "é", "of"]
    texts = [" ".join(r.choice(pool) for _ in range(r.randint(0, 80))) for _ in range(30)]
    changed = MIT.replace("merge", "fold").replace("publish,", "")
    fixed = [None, "", " -- ", MIT, MIT[40:], "x " + changed, changed.replace("free of charge", "for money"), "GNU\nGeneral/Public_LICENSE", "gnu" * 3,
             "MIT License " * 3000, "license " * 5000, "CC-BY 4.0", "CC BY-NC-SA", "ApacheLicense", "Apache\x00License", "éApache License", "mit licenseé"]
    return texts + fixed + [t.text for t in licenses.TEMPLATES]


def test_license_scan_equals_trying_every_place(spark):
    texts = license_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    scanned = {r["doc_id"]: [(f["start"], f["label"], f["base"]) for f in r["found"]] for r in licenses.scan(docs).collect()}
    for i, expected in enumerate(brute_scan(texts)):
        assert sorted(scanned[i]) == expected, texts[i][:80]
    pdf = documents_frame([(i, t, None, None, 0) for i, t in enumerate(texts)])
    equal_to_sql(licenses.digest(docs), licenses.ORACLE, documents=pdf)


def test_base_phrases_are_found_wherever_they_stand(spark):
    texts = license_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.digest(docs).collect()}
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for i, text in enumerate(texts):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = [(s, phrases[p]) for p in phrases for s in range(len(words)) if words[s : s + len(p.split())] == p.split()]
        assert (got[i]["n_words"], got[i]["n_base"]) == (len(words), len(places))
        starts = sorted(s for s, _ in places) or [None]
        assert (got[i]["first_word"], got[i]["last_word"]) == (starts[0], starts[-1])
        assert got[i]["base_labels"] == ",".join(sorted({n for _, n in places}))
        assert set(got[i]["base_labels"].split(",")) - {""} <= set(got[i]["labels"].split(","))
        assert 0 <= got[i]["score"] <= 1


def test_license_scan_edge_rows(spark):
    got = licenses.digest(frame(spark, documents()))
    equal_to_sql(got, licenses.ORACLE, documents=documents_frame(documents()))
    assert licenses.digest(frame(spark, [])).count() == 0
    again = licenses.digest(frame(spark, repeats())).collect()
    assert len(again) == len(repeats()) and sum(r["doc_id"] is None for r in again) == 3


# --- ranked search --------------------------------------------------------------------------------


def brute_ranks(docs: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    def terms(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)

    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, length = len(held), sum(len(t) for _, t in held)
    df: dict = {}
    for _, t in held:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, t in held:
            m = 50 + (50 * len(t) * n_docs) // length
            score = 0
            for w in set(terms(text)) & set(t):
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * t.count(w) // (1000 * t.count(w) + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.fixture
def small_trees(monkeypatch):
    """Many small trees per task, by the same code: workers get the classes with their own globals."""
    monkeypatch.setattr(ranking, "LEAF", 4)
    monkeypatch.setattr(ranking, "TREE_ROWS", 64)


def test_ranks_equal_brute_force(spark, small_trees):
    r = random.Random(8)
    pool = [prose(k, 1) for k in range(60)]
    text = lambda n: " ".join(r.choice(pool[: r.choice((5, 20, 60))]) for _ in range(n))
    docs = [(i, text(r.randint(0, 60))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(70)] + [(None, docs[7][1]), (None, docs[9][1].upper()), (2000, None), (2001, "... !"), (2002, "é " * 50)]
    items = [(i, text(12)) for i in range(8)] + [(20, docs[7][1]), (21, None), (22, ""), (23, "nothing-there-of"), (24, "É é"), (None, pool[0]), (20, docs[7][1]), (20, pool[1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS ITEM", "2 AS TEXT")
    got = ranking.rank_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), bench)
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute_ranks(docs, items, 50)


def test_balls_are_pruned_and_their_bounds_hold():
    rng = np.random.default_rng(2)
    rows, width = 2000, 40
    groups = [rng.choice(width, 6, replace=False) for _ in range(25)]
    cols = np.concatenate([np.sort(groups[i % 25]) for i in range(rows)])
    vals = rng.integers(100_000, 110_000, len(cols))
    starts = np.arange(rows) * 6
    tree = ranking.BallTree(ranking.Rows(-np.arange(rows).astype(object), starts, cols, vals), width)
    whole = np.zeros((rows, width), np.int64)
    whole[np.repeat(np.arange(rows), 6), cols] = vals
    for g in groups:
        query = ranking.Query(np.sort(g), rng.integers(1, 9000, 6), width, 10)
        looked = tree.search(query)
        scores = whole @ query.dense
        best = sorted((-int(s), i) for i, s in enumerate(scores) if s > 0)[:10]
        assert sorted((-s, -k) for s, k in query.best) == best
        assert looked < sum(leaf is not None for leaf in tree.leaves) / 2
        for node, leaf in enumerate(tree.leaves):
            if leaf is not None:
                assert leaf.dot(query.dense).max() <= tree.bound(node, query)


def test_ranks_on_edge_rows(spark):
    bench = spark.createDataFrame([(1, documents()[3][1]), (2, None), (3, "three one")], "item_id bigint, text string")
    pdf = pd.DataFrame({"item_id": [1, 2, 3], "text": pd.array([documents()[3][1], None, "three one"], dtype="string")})
    got = ranking.digest(frame(spark, documents()), bench)
    equal_to_sql(got, ranking.ORACLE, documents=documents_frame(documents()), benchmark=pdf)
    assert ranking.digest(frame(spark, []), bench).count() == 0
    assert ranking.digest(frame(spark, documents()), bench.limit(0)).count() == 0
    found = ranking.digest(frame(spark, repeats()), bench.where("item_id = 1")).collect()
    again = ranking.digest(frame(spark, repeats()[::-1]), bench.where("item_id = 1")).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)


def test_impacts_do_not_overflow():
    tf, n = np.array([1, 3]), np.array([10**8, 5])
    wide = ranking.impacts(tf, n, 10**10, 10**13)
    expected = [10**9 * t // (1000 * t + 20 * (50 + 50 * x * 10**10 // 10**13)) for t, x in ((1, 10**8), (3, 5))]
    assert wide.tolist() == expected


def test_item_terms_ignore_case_and_where_a_text_lies():
    one, other, none = ranking.item_terms(["Ab é ab", "é-AB", None])
    assert one.tolist() == other.tolist() and len(one) == 2 and not len(none)
    assert pa.array(one).type == pa.uint64()
