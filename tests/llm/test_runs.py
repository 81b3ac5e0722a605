"""Periodic runs against a search by definition."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from odd_rows import ODD

from shopmart.llm import periodic_runs, queries


def by_definition(words):
    """Every maximal stretch of each period whose period is its smallest."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(24, 3 * q):
                found.setdefault((start, end + q), q)
            start = end + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(r, letters, parts):
    words = []
    for _ in range(parts):
        unit = [r.choice(letters) for _ in range(r.randint(1, 90))]
        if r.random() < 0.4:  # a unit that is itself nearly periodic
            unit = unit[: r.randint(1, 12)] * r.randint(1, 9) + [r.choice(letters)]
        many = len(unit) * r.choice([1, 2, 3, 4, 5]) + r.randint(0, len(unit))
        words += (unit * 7)[:many]
        words += [r.choice(letters) for _ in range(r.randint(0, 30))]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_match_the_definition(seed):
    r = random.Random(seed)
    letters = [b"a", b"b", b"c", b"d"][: r.randint(1, 4)] if seed % 2 else [b"w%d" % i for i in range(300)]
    texts = [planted(r, letters, r.randint(0, 6)) for _ in range(8)]
    assert periodic_runs.find_runs(texts) == [by_definition(t) for t in texts]


def test_words_with_structure():
    fibonacci, thue = [b"a"], [b"a"]
    before = [b"b"]
    while len(fibonacci) < 900:
        fibonacci, before = fibonacci + before, fibonacci
    while len(thue) < 512:
        thue = thue + [b"b" if w == b"a" else b"a" for w in thue]
    hidden = ([b"a"] * 40 + [b"b"]) * 9  # long periods of long runs
    nested = (([b"x"] * 30 + [b"y"] * 30) * 4 + [b"z"]) * 4
    texts = [fibonacci, thue, hidden, nested, [b"a"] * 1000, ([b"a"] * 99 + [b"b"]) * 11, thue * 3]
    assert periodic_runs.find_runs(texts) == [by_definition(t) for t in texts]


def test_long_run_of_a_long_period():
    r = random.Random(3)
    unit = [b"w%d" % r.randrange(10**6) for _ in range(30_000)]
    words = [b"start", *unit * 4, b"end"]
    (run,) = periodic_runs.find_runs([words])[0]
    assert run == (1, 120_000, 30_000)
    assert periodic_runs.collapse(words, [run]) == [b"start", *unit, b"end"]


def test_copies_side_by_side_are_no_run():
    text = [b"w%d" % i for i in range(100)]
    assert periodic_runs.find_runs([text] * 6) == [[]] * 6


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = by_definition(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = [
        hashlib.sha256(b).hexdigest()
        for b in (
            "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode(),
            b" ".join(w for i, w in enumerate(words) if i not in gone),
        )
    ]
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *figures, *sha)


def test_query_on_the_sample(spark, sample):
    got = queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    short = [r for r in sample.collect() if len((r["text"] or "").split()) < 1500]
    by_id = {r["doc_id"]: tuple(r) for r in got}
    assert len(got) == sample.count() and len(short) > 100
    assert sum(r["n_runs"] for r in got) > 10
    assert [by_id[r["doc_id"]] for r in short] == [expected(r["doc_id"], r["text"]) for r in short]


def test_odd_rows(table):
    rows = [*ODD, (6, "ha " * 50_000)]
    got = periodic_runs.periodic_runs(table(rows), at_once=100).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["collapsed"]) for r in got) == sorted(
        (str(i), len((t or "").split()), " ".join((t or "").split()) if i != 6 else "ha") for i, t in rows
    )
    assert periodic_runs.periodic_runs(table([])).count() == 0
