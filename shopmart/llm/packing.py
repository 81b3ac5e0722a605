"""Best-fit-decreasing packing of token pieces into sequences of a fixed length.

Pieces of one length are alike for the packer, so it works on how many pieces
there are of each length: at most `capacity` numbers, whatever the size of the
corpus. Lengths are taken in decreasing order. A segment tree over the
remaining capacities tells the tightest sequence that is still open for a
length in logarithmic time; all sequences with that remainder then take as
many pieces as fit, which is what placing the pieces one by one would do.
The outcome is a short list of runs "pieces number i to j of length l go to
the sequences from s on, at offset o". Its size depends on the capacity alone.

Spark numbers the pieces of each length (number in the task plus the pieces
of earlier tasks) and looks their place up in the runs.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of
from shopmart.llm.tokens import VOCABULARY, encoder
from shopmart.session import cut_lineage

CAPACITY = 1024
SEPARATOR = 2  # id that ends every document

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenSequences:
    """A segment tree over the remainders 0..capacity, set where open sequences exist."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)

    def set(self, remainder: int, is_open: bool) -> None:
        at = self.leaves + remainder
        self.tree[at] = is_open
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] | self.tree[2 * at + 1]

    def tightest(self, size: int) -> int | None:
        """The smallest open remainder that is at least `size`."""
        at = self.leaves + size
        if self.tree[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


@dataclass(frozen=True)
class Run:
    """Pieces first..first+pieces-1 of one length, `each` of them per sequence, from `sequence` on."""

    length: int
    first: int
    pieces: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best-fit decreasing over `counts` pieces of each length."""
    tree = OpenSequences(capacity)
    spans: dict[int, list[tuple[int, int]]] = {}  # remainder: (first sequence, how many)
    runs: list[Run] = []
    made = 0

    def put(remainder: int, first: int, many: int) -> None:
        if many and remainder:
            spans.setdefault(remainder, []).append((first, many))
            tree.set(remainder, True)

    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0
        while left:
            remainder = tree.tightest(length)
            if remainder is None:
                each = capacity // length
                many, remainder = -(-left // each), capacity
                first, made = made, made + many
            else:
                first, many = spans[remainder].pop()
                if not spans[remainder]:
                    tree.set(remainder, False)
                each = remainder // length
            # One open sequence is filled before the next is touched.
            full, rest = divmod(min(left, each * many), each)
            used = full + (rest > 0)
            runs.append(Run(length, number, full * each + rest, each, first, capacity - remainder))
            put(remainder - each * length, first, full)
            if rest:
                put(remainder - rest * length, first + full, 1)
            if remainder < capacity:
                put(remainder, first + used, many - used)
            number += full * each + rest
            left -= full * each + rest
    return runs


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every text as ids and the separator, cut only if longer than a sequence.

    The first piece of a long document takes what is left over, so all others
    are full. `task` and `number` count the pieces of one length in a task.
    """

    def work(rows: Batches) -> Batches:
        enc, task = encoder(vocabulary), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for full in rows:
            for part in slices(full):
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array([*enc.ids(text or ""), SEPARATOR], dtype="<u4")
                    cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        number = seen.get(b - a, 0)
                        seen[b - a] = number + 1
                        for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), number)):
                            column.append(value)
                ids_, piece_, start_, length_, crc_, number_ = out
                yield batch(
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"],
                    [ids_, piece_, start_, length_, crc_, [task] * len(ids_), number_],
                    [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()],
                )

    return map_rows(texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long")), work, PIECES)


def place(pieces: DataFrame, runs: list[Run]) -> DataFrame:
    """Sequence and offset of numbered pieces."""
    table = np.array([[r.length, r.first, r.pieces, r.each, r.sequence, r.offset] for r in runs], np.int64).reshape(-1, 6)
    # Runs are made by decreasing length and increasing number: sort keys for the lookup.
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    by_length = {int(x): np.flatnonzero(table[:, 0] == x) for x in np.unique(table[:, 0])}

    def work(rows: Batches) -> Batches:
        for part in rows:
            length = part.column("length").to_numpy(zero_copy_only=False)
            number = part.column("number").to_numpy(zero_copy_only=False)
            run = np.zeros(len(length), np.int64)
            for x in np.unique(length):
                own = by_length[int(x)]
                at = length == x
                run[at] = own[np.searchsorted(table[own, 1], number[at], side="right") - 1]
            inside = number - table[run, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(table[run, 4] + inside // table[run, 3]),
                    pa.array(table[run, 5] + inside % table[run, 3] * length),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return map_rows(pieces, work, PACKED)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of the separator alone. Repeated rows
    and ids are packed row by row; an empty table gives an empty one.
    """
    pieces = cut_lineage(pieces_of(docs, capacity, vocabulary))
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    # At most `capacity` sums reach the driver.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["length", "task"]).withColumn("number", F.col("number") + F.col("before"))
    return place(numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number"), plan(counts, capacity))
