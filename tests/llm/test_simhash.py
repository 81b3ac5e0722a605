"""Near copies against a plain all-pairs comparison."""

from __future__ import annotations

import random

import pytest
import xxhash

from odd_rows import ODD
from shopmart.llm import simhash_dedup
from shopmart.llm.components import components


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    shingles = [words] if 0 < len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, radius, count=False):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    if count:
        return len({find(i) for i in range(len(rows))})
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return sorted(((d, f"{p:016x}", ids.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


@pytest.mark.parametrize(("radius", "tile"), [(3, 4096), (9, 4), (0, 4096)])
def test_classes_match_all_pairs(table, radius, tile):
    r = random.Random(radius)
    base = ["".join(r.choice("abcdefgh ") for _ in range(300)) for _ in range(6)]
    rows = list(ODD)
    for i in range(60):
        words = r.choice(base).split()
        words[r.randrange(len(words))] = "new"
        rows.append((100 + i, " ".join(words)))
    got = simhash_dedup.group(table(rows), radius=radius, tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == plain_classes(rows, radius)


def test_one_row_of_each_class_stays(table):
    rows = [*ODD, (9, "a b c d e f g"), (8, "A b c d e f g"), (8, "a b c d e f g"), (8, "a b c d e f g")]
    docs = table(rows)
    kept = simhash_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == plain_classes(rows, 3, count=True)
    assert [r["doc_id"] for r in kept.where("lower(text) like 'a b c%'").collect()] == [8]


def test_empty_table(table):
    assert simhash_dedup.group(table([])).count() == 0
    assert simhash_dedup.keep_first(table([])).count() == 0


def test_long_paths_are_one_component(spark):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, 101)]
    found = components(spark.createDataFrame(path, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(i, 0) for i in range(1, 41)} | {(101, 100)}
