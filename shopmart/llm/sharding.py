"""Shards of nearly equal bytes by a minimax contiguous partition.

Equal texts are one group that may not be cut. Groups stand in the order of
their hash. The smallest capacity with which `shards` runs of groups take all
is found by binary search; a capacity is checked greedily, each shard taking
groups until the next one would not fit. The shards are the runs of the
smallest capacity.

The greedy check needs only one answer: the last group end at or below a
place on the line of all bytes. Group ends are stored by blocks of the hash
range. The driver holds the bytes of each block, a fixed number of sums; the
ends inside one block are looked up by a job, for many capacities at a time,
so the search takes few rounds.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.llm.common import texts_of
from shopmart.session import cut_lineage

SHARDS = 8
BLOCKS_LOG2 = 12
PROBES = 64  # capacities checked in one round
LAW = "bytes"


def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return texts_of(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("place"),
        F.md5(text.cast("binary")).alias("digest"),
    )


def _groups(sized: DataFrame) -> DataFrame:
    """One row per text with where its bytes begin and end inside its block of the hash range."""
    block = F.shiftright("place", 64 - BLOCKS_LOG2) + (1 << (BLOCKS_LOG2 - 1))
    groups = sized.groupBy("place", "digest").agg(F.sum("size").alias("bytes")).withColumn("block", block.cast("int"))
    # Neighbouring blocks lie together, so that a look-up reads the files of the blocks it asks for and no others.
    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = groups.repartitionByRange(parts, "block")
    inside = Window.partitionBy("block").orderBy("place", "digest").rowsBetween(Window.unboundedPreceding, 0)
    return groups.withColumn("end", F.sum("bytes").over(inside))


class Line:
    """Group ends on the line of all bytes."""

    def __init__(self, groups: DataFrame) -> None:
        self.groups = groups
        totals = groups.groupBy("block").agg(F.sum("bytes").alias("n"), F.max("bytes").alias("most"))
        rows = sorted(totals.collect())  # one row per block, a fixed number
        self.blocks = [r["block"] for r in rows]
        self.begin, self.total = [], 0
        for r in rows:
            self.begin.append(self.total)
            self.total += r["n"]
        self.largest = max((r["most"] for r in rows), default=0)

    def ends(self, places: list[int]) -> list[int]:
        """For each place the last group end at or below it; 0 if there is none."""
        wanted = []
        for i, place in enumerate(places):
            at = bisect_right(self.begin, place) - 1
            wanted.append((i, self.blocks[at], place - self.begin[at], self.begin[at]))
        # `wanted` has PROBES rows at most.
        asked = self.groups.sparkSession.createDataFrame(wanted, "i int, block int, inside long, begin long")
        blocks = sorted({block for _, block, _, _ in wanted})
        hit = self.groups.where(F.col("block").isin(blocks)).join(F.broadcast(asked), "block").where("end <= inside")
        found = {r["i"]: r["e"] for r in hit.groupBy("i").agg(F.max(F.col("begin") + F.col("end")).alias("e")).collect()}
        return [found.get(i, begin) for i, _, _, begin in wanted]

    def cuts(self, capacities: list[int], shards: int) -> list[list[int]]:
        """The greedy shard ends for each capacity; the last is the total if the capacity is enough."""
        runs: list[list[int]] = [[] for _ in capacities]
        for _ in range(shards):
            places = [min(self.total, (run[-1] if run else 0) + c) for run, c in zip(runs, capacities)]
            for run, end in zip(runs, self.ends(places)):
                run.append(end)
        return runs


def smallest_capacity(line: Line, shards: int = SHARDS, probes: int = PROBES) -> tuple[int, list[int]]:
    """The smallest capacity that is enough, and its shard ends."""
    low = max(-(-line.total // shards), line.largest)  # no capacity below can do
    high = max(low, -(-line.total // shards) + line.largest)  # every shard but the last is over the mean
    while True:
        # Evenly spread capacities; `high` is known to be enough.
        tried = sorted({low + (high - low) * i // probes for i in range(probes)} | {high})
        runs = line.cuts(tried, shards)
        first = next(i for i, run in enumerate(runs) if run[-1] == line.total)
        if first == 0 or tried[first] - tried[first - 1] == 1:
            return tried[first], runs[first]
        low, high = tried[first - 1] + 1, tried[first]


def shard(docs: DataFrame, shards: int = SHARDS, probes: int = PROBES) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A null text counts as empty and groups with empty ones. Rows with equal
    ids, also null ids, are placed row by row. An empty table gives an empty
    one. `slot` counts the rows of a shard in the order of the groups.
    """
    sized = cut_lineage(_sized(docs))
    groups = cut_lineage(_groups(sized))
    line = Line(groups)
    cuts = smallest_capacity(line, shards, probes)[1] if line.total else []
    begin = {b: s for b, s in zip(line.blocks, line.begin)}
    # A group belongs to the shard whose end is the first one at or after its own end.
    entries = [(b, begin[b]) for b in line.blocks]
    starts = docs.sparkSession.createDataFrame(entries, "block int, begin long")
    end = F.col("begin") + F.col("end")
    number = sum((F.when(end > c, 1).otherwise(0) for c in cuts), F.lit(0))
    placed_groups = groups.join(F.broadcast(starts), "block").select("place", "digest", number.cast("int").alias("shard"))
    rows = sized.join(placed_groups, ["place", "digest"])
    # Slots: rows are dealt out in order, counted per task, and numbered from the counts of earlier tasks.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["place", "digest", "doc_id"]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = ordered.withColumn("id", F.monotonically_increasing_id()).select(
        "doc_id", "size", "text_crc32", "shard", F.shiftright("id", 33).alias("task"), "id"
    )
    numbered = cut_lineage(numbered)
    counts = numbered.groupBy("shard", "task").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "task", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return numbered.join(offsets, ["shard", "task"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("before") + F.col("id") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
