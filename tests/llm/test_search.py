"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD

from shopmart.llm import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def expected(docs, items, k=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(b) for _, b in bags)
    n_terms = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            if not bag:
                continue
            m = 75 + (25 * sum(bag.values()) * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if tf := bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


@pytest.fixture
def item_table(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, item string, rank int")


def found(docs, items, **settings):
    return sorted((tuple(r) for r in lexical_search.search(docs, items, **settings).collect()), key=str)


@pytest.mark.parametrize(("seed", "settings"), [(1, {}), (2, {"block_bytes": 200}), (3, {"k": 3}), (4, {"k": 1, "block_bytes": 100})])
def test_ranks_match_scoring_everything(table, item_table, seed, settings, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 50)  # many small steps
    r = random.Random(seed)
    pool = [r.choice(["A", "é", "b9", "漢"]) + r.choice("xyzXYZ") * r.randint(0, 2) for _ in range(25)] + ["_", "-"]
    text = lambda n: "".join(r.choice(pool) + r.choice([" ", ", ", "\x7f", "\n"]) for _ in range(n))
    bodies = [text(r.randint(0, 12)) for _ in range(40)]
    docs = [(i, r.choice(bodies)) for i in range(150)] + [(3, bodies[0]), (None, bodies[0]), (None, "x x x")]
    items = [(i, text(r.randint(0, 15))) for i in range(12)] + [(4, "Ax ax AX"), (4, "Ax ax AX"), (None, "éx 漢"), (77, None)]
    assert found(table(docs), item_table(items), **settings) == expected(docs, items, settings.get("k", 20))


def test_one_bag_of_all_documents(table, item_table):
    docs = [(i, "one two, TWO" if i % 3 else "two; one two") for i in range(500, 0, -1)] + [(1000, "other words")]
    assert [r[2] for r in sorted(found(table(docs), item_table([(1, "two")])), key=lambda r: r[1])] == list(range(1, 21))


def test_odd_rows(table, item_table):
    items = [(1, "word"), (2, "an id is missing here"), (3, "")]
    assert found(table(ODD), item_table(items)) == expected(ODD, items)
    assert found(table([]), item_table(items)) == [] and found(table(ODD), item_table([])) == []
    assert found(table([(1, None), (2, " . ")]), item_table(items)) == []


def test_classes_keep_the_smallest_ids(spark):
    rows = spark.createDataFrame([(i, 80, [1], [2]) for i in range(100)] + [(5, 81, [1], [2]), (None, 80, [1, 2], [1, 1])],
                                 "doc_id long, m long, terms array<int>, tfs array<long>").repartition(5)
    got = {(r["m"], tuple(r["terms"])): sorted(str(x["doc_id"]) for x in r["members"]) for r in lexical_search.bag_classes(rows, 4).collect()}
    assert got == {(80, (1,)): ["0", "1", "2", "3"], (81, (1,)): ["5"], (80, (1, 2)): ["None"]}


def test_scores_beyond_doubles_are_exact():
    items = lexical_search.Items([(0, "a " * 400_000), (1, "a b")])
    scores = items.scores(np.array([0, 0]), np.array([0, 1]), np.array([2**44 + 1, 3]), 1)
    assert scores.tolist() == [[400_000 * (2**44 + 1), 2**44 + 4]]
