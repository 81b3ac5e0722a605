"""Packing, shards and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from odd_rows import ODD
from shopmart.llm import decontamination, packing, pii, quality_rules, sharding
from shopmart.llm.tokens import Encoder

# ---------------------------------------------------------------- packing


def best_fit_one_by_one(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - n)
        else:
            room.append(capacity - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    capacity = r.choice([7, 16, 33])
    lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 200))]
    used = defaultdict(list)
    for run in packing.plan(Counter(lengths), capacity):
        for k in range(run.pieces):
            used[run.sequence + k // run.each].append((run.offset + k % run.each * run.length, run.length))
    assert Counter(n for s in used.values() for _, n in s) == Counter(lengths)
    for pieces in used.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in s) for s in used.values()) == best_fit_one_by_one(lengths, capacity)


def check_packing(rows, docs, capacity=1024):
    enc = Encoder()
    want = Counter()
    for doc_id, text in docs:
        ids = np.array([*enc.ids(text or ""), 2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
            start = max(0, end - capacity)
            want[(doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    lengths = [r["length"] for r in rows]
    assert len(sequences) == len(best_fit_one_by_one(lengths, capacity))


def test_packed_sample(sample):
    check_packing(packing.pack(sample).collect(), [(r["doc_id"], r["text"]) for r in sample.collect()])


def test_packed_odd_rows(table):
    check_packing(packing.pack(table(ODD), 16).collect(), ODD, 16)
    assert packing.pack(table([])).count() == 0


# ---------------------------------------------------------------- shards


def needed(sizes, capacity):
    shards, room = 0, 0
    for n in sizes:
        if n > room:
            shards, room = shards + 1, capacity
        room -= n
    return shards


@pytest.mark.parametrize("probes", [3, 64])
def test_shards_are_minimax(table, probes):
    r = random.Random(probes)
    rows = [(i, "t" * r.randint(0, 60) + r.choice("abc")) for i in range(300)] + ODD[:-1] + [(500 + i, "hot " * 9) for i in range(150)]
    got = sharding.shard(table(rows), 8, probes).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(text or "")
    for x in got:
        by_text[(x["size"], x["text_crc32"])].add(x["shard"])
        assert any(x["size"] == len(t.encode()) + 1 and x["text_crc32"] == zlib.crc32(t.encode()) for t in texts[x["doc_id"]])
    assert all(len(s) == 1 for s in by_text.values())
    slots = defaultdict(list)
    for x in got:
        slots[x["shard"]].append(x["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    # The groups in the order of the operator give the least capacity by trying one after the other.
    groups = sharding._groups(sharding._sized(table(rows))).orderBy("place", "digest").collect()
    sizes = [g["bytes"] for g in groups]
    capacity = max(sizes)
    while needed(sizes, capacity) > 8:
        capacity += 1
    largest = max(sum(x["size"] for x in got if x["shard"] == s) for s in slots)
    assert largest == capacity


def test_no_shards_without_rows(table):
    assert sharding.shard(table([])).count() == 0


# ---------------------------------------------------------------- pipeline


def test_stages_on_the_sample(spark, sample):
    from test_simhash import plain_classes

    sf_dir = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs, kept = sample, {r["doc_id"] for r in quality_rules.judge(sample).where("kept").collect()}
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["quality_rules"](spark, docs, sf_dir)
    assert docs.columns == sample.columns and {r["doc_id"] for r in docs.collect()} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    docs = stages["simhash_near_dedup"](spark, docs, sf_dir)
    assert {r["doc_id"] for r in docs.collect()} == {c for _, _, c in plain_classes(rows, 3)} and docs.count() <= len(rows)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    docs = stages["benchmark_decontamination"](spark, docs, sf_dir)
    benchmark = decontamination.Benchmark(items)
    clean = {d for d, t in rows.items() if not benchmark.matches(t, decontamination.RADIUS, 0.8)}
    assert {r["doc_id"] for r in docs.collect()} == clean
    assert not any(" ".join(t.split()) in " ".join(rows[d].split()) for d in clean for _, t in items)
    docs = stages["pii"](spark, docs, sf_dir)
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == {d: pii.redact_text(rows[d]) for d in clean}
    assert docs.schema == sample.schema and all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    check_packing(stages["best_fit_packing"](spark, docs, sf_dir).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_pipeline_stands_odd_rows(spark, table, tmp_path):
    table(ODD).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0  # none has ten words
