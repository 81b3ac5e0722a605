"""Line dedup against plain counting."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from shopmart.llm import line_dedup

BLANKS = " \t\n\v\f\r"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, min_chars=20, min_docs=3):
    holders = defaultdict(list)
    rank = lambda i: (i is not None, i or 0)
    for doc_id, text in rows:
        for key in {lowered(line.strip(BLANKS)) for line in (text or "").split("\n")}:
            if len(key) >= min_chars:
                holders[key].append(rank(doc_id))
    last = {key: max(ids) for key, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if rank(doc_id) >= last.get(lowered(x.strip(BLANKS)), rank(None))]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def found(docs, **limits):
    return [tuple(r) for r in line_dedup.dedup_lines(docs, **limits).collect()]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_lines_match_counting(table, seed):
    r = random.Random(seed)
    pool = [f"{'Éa'[i % 2]} line that is long enough {i}" for i in range(30)] + ["short", "", "  ", "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ", "x" * 19, "y" * 20]
    dressed = lambda s: r.choice(["", " ", "\t \r"]) + r.choice([s, s.upper() if s.isascii() else s]) + r.choice(["", " \f"])
    ids = [None, *range(60), 7, 7, 7]
    rows = [(i, "\n".join(dressed(r.choice(pool)) for _ in range(r.randint(1, 9)))) for i in ids]
    got = found(table(rows), batches=7, fan=2)
    assert ordered(got) == ordered(expected(rows))
    assert sum(x[2] for x in got) > 20
    assert ordered(found(table(rows), batches=1)) == ordered(got)


def test_a_line_of_all_documents_stays_once(table):
    line = "all rights reserved by everyone"
    rows = [(i, f"{line}\nown line of number {i}, long\n {line.upper()} ") for i in range(300)]
    got = {r[0]: r for r in found(table(rows))}
    assert got[299][2:] == (0, rows[299][1])
    assert all(got[i][2:] == (2, f"own line of number {i}, long") for i in range(299))


def test_two_documents_are_too_few(table):
    rows = [(1, "this line stands in two documents"), (2, "this line stands in two documents\nthis line stands in two documents")]
    assert ordered(found(table(rows))) == ordered(expected(rows)) and sum(r[2] for r in found(table(rows))) == 0


def test_odd_rows(table):
    rows = [*ODD, *[(i, "\0 a line with a zero byte in it") for i in (8, 9, 10)], (None, "\n".join(["the same line again and again"] * 5000))]
    assert ordered(found(table(rows))) == ordered(expected(rows))
    assert found(table([])) == []


def test_only_null_ids(table):
    rows = [(None, "a line that nobody can claim\nx")] * 4
    assert ordered(found(table(rows))) == ordered(expected(rows))


def test_runs_are_merged_by_level(spark):
    runs = line_dedup.LineRuns(spark, fan=2, buckets=4)

    def counted(*rows):
        return spark.createDataFrame([(bytes([h]), n, last) for h, n, last in rows], line_dedup.COUNTED)

    runs.add(counted((1, 1, 90), (2, 5, 91)))
    runs.add(counted((1, 1, 80), (2, 7, 81), (3, 1, 82)))
    assert [len(level) for level in runs.levels] == [0, 1]
    runs.add(counted((1, 1, 70), (3, 1, 71)))
    assert [len(level) for level in runs.levels] == [1, 1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = runs.unsettled(counted((1, 1, 60)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange") == 1  # the batch alone is shuffled
    got = {bytes(r["h"])[0]: (r["n"], r["last"]) for r in runs.rows().collect()}
    assert got == {1: (3, 90), 2: (5, 91), 3: (2, 82)}  # the settled second hash took nothing more
    names = [run.name for level in runs.levels for run in level]
    runs.close()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_no_tables_stay_behind(spark, sample):
    before = {t.name for t in spark.catalog.listTables()}
    assert line_dedup.dedup_lines(sample).agg(F.sum("n_dropped")).first()[0] > 0
    assert {t.name for t in spark.catalog.listTables()} == before
