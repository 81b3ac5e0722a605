"""Repeated byte strings against a scan of all strings."""

from __future__ import annotations

import hashlib
import random

import pytest

from odd_rows import ODD
from shopmart.llm import substring_dedup


def plain(rows, length):
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            string = data[s : s + length]
            if string in seen:
                gone[s : s + length] = [True] * length
            seen.add(string)
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def cases():
    r = random.Random(3)
    yield "letters", [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 90)))) for i in range(40)], 8, 4
    yield "periods", [(i, "ab" * r.randint(0, 90) + "é" * r.randint(0, 30)) for i in range(20)], 20, 8
    yield "short grams", [(i, "".join(r.choice("abc") for _ in range(80))) for i in range(30)], 6, 1
    passage = "".join(r.choice("abcdefgh ") for _ in range(150))
    yield "passages", [(i, f"{i} " * 40 + passage[r.randint(0, 20) :] + str(i * 7) * 30) for i in range(30)], 100, 32


@pytest.mark.parametrize("group", [20_000, 2])
@pytest.mark.parametrize(("rows", "length", "gram"), [c[1:] for c in cases()], ids=[c[0] for c in cases()])
def test_removal_matches_scan(table, rows, length, gram, group):
    got = substring_dedup.remove_repeats(table(rows), length, gram, group).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, length)


def test_sample(sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.orderBy("doc_id").collect()]
    got = substring_dedup.remove_repeats(sample).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, 100)


def test_odd_rows(table):
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    got = substring_dedup.remove_repeats(table(ODD)).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, 100)
    assert substring_dedup.remove_repeats(table([])).count() == 0


def test_repeated_rows_leave_one(table):
    text = "some text of its own, " * 3 + "and then more of it, which does not repeat itself so soon as that"
    got = substring_dedup.remove_repeats(table([(1, text), (1, text), (2, text)])).collect()
    assert sorted(r["n_removed"] for r in got) == [0, len(text), len(text)]


def test_bytes_of_zero_sort_behind_nothing():
    r = random.Random(14)
    for _ in range(3000):
        batch = []
        for i in range(r.randint(2, 4)):
            batch.append((0, i, i, 0, bytes(r.choice([0, 0, 0, 97]) for _ in range(r.randint(8, 14)))))
        gone = {
            (row[2], at)
            for k, row in enumerate(batch)
            for s in range(len(row[4]) - 7)
            if any(
                row[4][s : s + 8] == other[4][t : t + 8]
                for m, other in enumerate(batch)
                for t in range(len(other[4]) - 7)
                if (m, t) < (k, s)
            )
            for at in range(s, s + 8)
        }
        place, start, size = substring_dedup._later_occurrences(batch, 8)
        assert {(p, at) for p, s, n in zip(place, start, size) for at in range(s, s + n)} == gone


def test_texts_with_zero_bytes(table):
    r = random.Random(15)
    rows = [(i, "".join(r.choice("\0\0\0a") for _ in range(r.randint(0, 40)))) for i in range(40)]
    got = substring_dedup.remove_repeats(table(rows), 8, 4).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, 8)


def test_no_tables_stay_behind(spark, sample):
    before = {t.name for t in spark.catalog.listTables()}
    assert substring_dedup.remove_repeats(sample).count() == sample.count()
    assert {t.name for t in spark.catalog.listTables()} == before
