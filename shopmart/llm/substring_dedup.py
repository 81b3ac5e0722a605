"""Removal of repeated byte strings by an enhanced suffix array over bounded parts of the corpus.

Which part a string of `LENGTH` bytes belongs to is decided by its own bytes:
its anchor is the `GRAM`-byte piece in it with the smallest hash, the leftmost
of equal ones. Equal strings have equal anchors at equal places, so all copies
of a string meet in the group of their anchor. The strings of one anchor form
a context, a stretch of at most `2 * LENGTH - GRAM` bytes.

1. Contexts that are equal as a whole need no suffixes: all but the earliest
   are repeats. A task settles its own before anything is shuffled.
2. Groups with different contexts get a suffix array of all string starts,
   a table of common prefixes, and a stack scan over it that opens and closes
   the intervals of the common-prefix tree. An interval whose occurrences can
   all be extended to the left by the same byte is part of a longer repeat and
   is passed over; each other one is a maximal repeat, put out with all its
   occurrences. Every string that occurs twice lies in one of them.
3. A group of more than `GROUP_CONTEXTS` different contexts is dealt out
   further, by the bytes of each string, to as many tasks as it needs.

All occurrences of a maximal repeat but the earliest are removed. Texts are
kept once as a table bucketed by the task that wrote it, so neither fetching
contexts nor removing bytes moves a text over the network.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, importable, map_rows, texts_of
from shopmart.session import cut_lineage, shared_dir

LENGTH = 100
GRAM = 32  # a power of two
GROUP_CONTEXTS = 20_000
BATCH_BYTES = 1 << 21  # contexts that share one suffix array
MAX_BUCKETS = 50_000
SPLIT = 4  # buckets that the texts of a task are dealt into; one is what a later task holds
MARKS_AT_ONCE = 1 << 20  # marks that are sorted together, about
_STRETCH = 1 << 22  # starts of one text that are looked at together

TEXTS = "bucket int, row int, doc_id long, data binary"
MARKS = pa.schema(
    [("g", pa.int64()), ("c", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("start", pa.int64()), ("size", pa.int32())]
)
MARKS_DDL = "g long, c long, doc_id long, place long, start long, size int"
CONTEXTS_DDL = "g long, doc_id long, place long, start long, data binary"
SPANS_DDL = "place long, start long, size int"
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_BASE = 0x5851F42D4C957F2D
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)]

# ---------------------------------------------------------------- anchors


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from every place on; `size` is a power of two."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    step, power = 1, _BASE
    while step < size:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % (1 << 64)
    return _mixed(h)


def anchored(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, first byte, end) of the contexts of a text, a stretch of starts at a time."""
    width = length - gram + 1
    for at in range(0, len(raw) - length + 1, _STRETCH):
        part = raw[at : at + _STRETCH + length - 1]
        grams = gram_hashes(part, gram)
        # The place in the low bits makes the leftmost of equal hashes the smallest.
        key = (grams >> np.uint64(23) << np.uint64(23)) | np.arange(len(grams), dtype=np.uint64)
        least, step = key, 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        anchor = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        last = np.concatenate((first[1:], [len(anchor)])) - 1
        yield grams[anchor[first]], first + at, last + at + length


def _later_ones(g: np.ndarray, c: np.ndarray, order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers sorted by (g, c, order), and which of them repeat the (g, c) before."""
    rows = np.lexsort((*order[::-1], c, g))
    again = np.zeros(len(rows), bool)
    again[1:] = (g[rows[1:]] == g[rows[:-1]]) & (c[rows[1:]] == c[rows[:-1]])
    return rows, again


def _batch_of(schema: pa.Schema, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def _settled_in_task(found: list[tuple], ordered: bool = True) -> Iterator[pa.RecordBatch]:
    """Marks of a task. A repeat of a mark of the same task is settled: negative size, and any key."""
    if not found:
        return
    g, c, doc, place, start, size = (np.concatenate(x) for x in zip(*found))
    rows, again = _later_ones(g, c, (doc, place, start))
    size = np.where(again, -size[rows], size[rows]).astype(np.int32)
    spread = _mixed((place[rows] * 1_000_003 + start[rows]).astype(np.uint64)).view(np.int64)
    key = np.where(again, spread, g[rows])
    for at in range(0, len(rows), 1 << 16):
        cut = slice(at, at + (1 << 16))
        own = rows[cut]
        yield _batch_of(MARKS, [key[cut], c[own], doc[own], place[own], start[own], size[cut]])


def _ids(values: list) -> np.ndarray:
    """Null ids come before all others."""
    return np.array([-(1 << 63) if v is None else v for v in values], np.int64)


def marks(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Contexts of all texts as (anchor hash, context hash, where)."""

    def work(rows: Batches) -> Batches:
        found, held = [], 0
        for part in rows:
            ids = _ids(part.column("doc_id").to_pylist())
            place = (part.column("bucket").to_numpy().astype(np.int64) << 32) | part.column("row").to_numpy()
            for i, data in enumerate(part.column("data").to_pylist()):
                for g, first, end in anchored(np.frombuffer(data, np.uint8), length, gram):
                    digest = xxhash.xxh3_64_intdigest
                    c = np.array([digest(data[a:b]) for a, b in zip(first.tolist(), end.tolist())], np.uint64)
                    n = len(g)
                    found.append(
                        (g.view(np.int64), c.view(np.int64), np.full(n, ids[i]), np.full(n, place[i]), first, (end - first))
                    )
                    held += n
                    if held > MARKS_AT_ONCE:
                        yield from _settled_in_task(found)
                        found, held = [], 0
        yield from _settled_in_task(found)

    return map_rows(texts, work, MARKS_DDL)


def sort_out(marked: DataFrame) -> DataFrame:
    """Repeats (size below 0) and what else to look at: the earliest of each context of a group with several.

    Rows come sorted by group and context, so one row is all that is carried along.
    """
    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", "c", "doc_id", "place", "start"]
    ordered = marked.repartition(parts, "g").sortWithinPartitions(*keys)

    def work(rows: Batches) -> Batches:
        last: tuple | None = None  # group and context of the row before
        waiting: list[np.ndarray] | None = None  # first row of a group with one context so far
        for part in rows:
            if not part.num_rows:
                continue
            columns = [part.column(f.name).to_numpy(zero_copy_only=False) for f in MARKS]
            g, c, size = columns[0], columns[1], columns[5]
            done = size < 0
            if done.any():
                yield _batch_of(MARKS, [x[done] for x in columns])
                columns = [x[~done] for x in columns]
                g, c, size = columns[0], columns[1], columns[5]
                if not len(g):
                    continue
            new_g, new_c = np.ones(len(g), bool), np.ones(len(g), bool)
            new_g[1:] = g[1:] != g[:-1]
            new_c[1:] = new_g[1:] | (c[1:] != c[:-1])
            if last is not None and g[0] == last[0]:
                new_g[0], new_c[0] = False, bool(c[0] != last[1])
            last = (g[0:][-1], c[-1])
            group = np.cumsum(new_g)  # 0 for a group begun in an earlier batch
            other = new_c & ~new_g
            several = np.bincount(group, weights=other, minlength=group[-1] + 1) > 0
            out = [x.copy() for x in columns]
            out[5] = np.where(new_c, size, -size)
            emit = ~new_c | other | (new_g & several[group])
            if waiting is not None and several[0] and not new_g[0]:
                yield _batch_of(MARKS, waiting)
                waiting = None
            if new_g.any():
                at = np.flatnonzero(new_g)[-1]
                waiting = None if several[-1] else [x[at : at + 1] for x in columns]
            if emit.any():
                yield _batch_of(MARKS, [x[emit] for x in out])

    return map_rows(ordered, work, MARKS_DDL)


# ---------------------------------------------------------------- suffix array


def _words(data: np.ndarray, at: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """The bytes from `at` to `end` as rows of big-endian numbers, zero behind the end."""
    columns = -(-width // 8)
    place = at[:, None] + np.arange(8 * columns)
    inside = place < end[:, None]
    return np.where(inside, data[np.minimum(place, len(data) - 1)], 0).astype(np.uint8).view(">u8").astype(np.uint64)


def _common(words: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the row before, in bytes; `room` bytes are real."""
    differ = words[1:] ^ words[:-1]
    first = (differ != 0).argmax(axis=1)
    at = differ[np.arange(len(differ)), first]
    lead = np.zeros(len(at), np.int64)
    rest = at.copy()
    for step in (4, 2, 1):  # leading zero bytes of a number
        high = rest >> np.uint64(64 - 8 * step)
        zero = high == 0
        lead += np.where(zero, step, 0)
        rest = np.where(zero, rest << np.uint64(8 * step), rest)
    same = np.where(at == 0, 8 * words.shape[1], 8 * first + lead)
    return np.minimum(same, np.minimum(room[1:], room[:-1]))


def maximal_repeats(
    contexts: list[bytes], groups: np.ndarray, length: int = LENGTH
) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(size, [(context number, offset), ...]) of the maximal repeats of at least `length` bytes in each group."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    many = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(contexts)), many)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    at = begin[owner] + offset
    if not len(at):
        return
    # String starts with equal first bytes form a class; a class of one is in no interval.
    sums = np.zeros(len(data) + 1, np.uint64)
    up = np.cumprod(np.full(len(data), _BASE, np.uint64))
    down = np.cumprod(np.full(len(data), pow(_BASE, -1, 1 << 64), np.uint64))
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    key = _mixed((sums[at + length] - sums[at]) * down[at] + groups[owner].astype(np.uint64) * _ODD[0])
    left = np.where(offset > 0, data[np.maximum(at - 1, 0)].astype(np.int16), np.int16(256))
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    n = np.diff(np.concatenate((heads, [len(order)])))
    low, high = np.minimum.reduceat(left[order], heads), np.maximum.reduceat(left[order], heads)
    # If all of a class have the same byte to their left, so has every interval in it.
    kept = np.repeat((n > 1) & ((low != high) | (high == 256)), n)
    rows = order[kept]
    if not len(rows):
        return
    owner, offset, at, left = owner[rows], offset[rows], at[rows], left[rows]
    room = sizes[owner] - offset
    words = _words(data, at, begin[owner] + sizes[owner], int(room.max()))
    # Behind its end a row reads as zeros; of rows alike in that way the shorter one comes first.
    sort = np.lexsort((room, *words.T[::-1], groups[owner]))
    owner, offset, left, room, words = owner[sort], offset[sort], left[sort], room[sort], words[sort]
    lcp = _common(words, room)
    lcp[groups[owner[1:]] != groups[owner[:-1]]] = 0
    # The scan: a stack of open intervals (common prefix, first row, the left byte, whether it differs).
    lcps, lefts, own, offs = [*lcp.tolist(), 0], left.tolist(), owner.tolist(), offset.tolist()
    stack: list[list[int]] = []
    for i, now in enumerate(lcps):
        first, byte, diverse = i, lefts[i], lefts[i] == 256
        while stack and stack[-1][0] > now:
            size, first_, byte_, diverse_ = stack.pop()
            diverse_ = diverse_ or diverse or byte_ != byte
            if diverse_:
                yield size, [(own[k], offs[k]) for k in range(first_, i + 1)]
            first, byte, diverse = first_, byte_, diverse_
        if now < length:
            continue
        if stack and stack[-1][0] == now:
            top = stack[-1]
            top[3] = top[3] or diverse or top[2] != byte
        else:
            stack.append([now, first, byte, diverse])


def _later_occurrences(batch: list[tuple], length: int) -> tuple[list, list, list]:
    """(place, start, size) of all occurrences of maximal repeats but the earliest of each."""
    groups = np.array([r[0] for r in batch], np.int64)
    longest: dict[tuple[int, int], int] = {}
    for size, occurrences in maximal_repeats([r[4] for r in batch], groups, length):
        first = min(occurrences, key=lambda o: (batch[o[0]][1], batch[o[0]][2], batch[o[0]][3] + o[1]))
        for o in occurrences:
            if o is not first and longest.get(o, 0) < size:
                longest[o] = size
    found = [(batch[k][2], batch[k][3] + o, size) for (k, o), size in longest.items()]
    return tuple(zip(*found)) if found else ([], [], [])


def repeats_in_groups(contexts: DataFrame, length: int, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Spans to remove from groups that fit into a task; several groups share a suffix array."""
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = contexts.repartition(parts, "g").sortWithinPartitions("g")

    def work(rows: Batches) -> Batches:
        def removed(batch: list[tuple]) -> pa.RecordBatch:
            place, start, size = _later_occurrences(batch, length)
            return pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int64()), pa.array(start, pa.int64()), pa.array(size, pa.int32())], ["place", "start", "size"]
            )

        held: list[tuple] = []
        weight = 0
        for part in rows:
            ids = _ids(part.column("doc_id").to_pylist()).tolist()
            others = (part.column(c).to_pylist() for c in ("place", "start", "data"))
            for row in zip(part.column("g").to_pylist(), ids, *others):
                if weight > batch_bytes and row[0] != held[-1][0]:
                    yield removed(held)
                    held, weight = [], 0
                held.append(row)
                weight += len(row[4])
        if held:
            yield removed(held)

    return map_rows(ordered, work, SPANS_DDL)


def strings_of(contexts: DataFrame, length: int) -> DataFrame:
    """Every string of large groups as a mark of its own, keyed by all its bytes."""

    def work(rows: Batches) -> Batches:
        for part in rows:
            found = []
            ids = _ids(part.column("doc_id").to_pylist())
            place, start = (part.column(c).to_numpy() for c in ("place", "start"))
            for i, data in enumerate(part.column("data").to_pylist()):
                n = len(data) - length + 1
                digests = [xxhash.xxh3_128_digest(data[a : a + length]) for a in range(n)]
                keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                found.append(
                    (keys[:, 0], keys[:, 1], np.full(n, ids[i]), np.full(n, place[i]), start[i] + np.arange(n), np.full(n, length))
                )
            yield from _settled_in_task(found)

    return map_rows(contexts, work, MARKS_DDL)


# ---------------------------------------------------------------- texts


def _bucket_values(docs: DataFrame, buckets: int) -> list[int]:
    """For each bucket a number that Spark's hash puts there."""
    spark, found, reach = docs.sparkSession, {}, 40 * buckets + 100
    while len(found) < buckets:
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(buckets))
        found = {r["b"]: r["v"] for r in spark.range(reach).groupBy(at.alias("b")).agg(F.min("id").alias("v")).collect()}
        reach *= 2
    return [found[b] for b in range(buckets)]


def store_texts(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The texts as bytes in a bucketed table, its name and folder; a task fills buckets of its own, so nothing is shuffled."""
    plain = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("data"))
    buckets = min(max(1, plain.rdd.getNumPartitions()) * SPLIT, MAX_BUCKETS)
    values = _bucket_values(docs, buckets)

    def work(rows: Batches) -> Batches:
        # Slots beyond the number of buckets share them; the row number tells them apart.
        task, turn, row = TaskContext.get().partitionId(), 0, 0
        for part in rows:
            for at in range(0, part.num_rows, 64):
                own = part.slice(at, 64)
                n = own.num_rows
                slot = task * SPLIT + turn % SPLIT
                first = ((slot // buckets) << 26) + row
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, values[slot % buckets], np.int32)),
                        pa.array(np.arange(first, first + n, dtype=np.int32)),
                        own.column("doc_id"),
                        pc.fill_null(own.column("data"), b""),
                    ],
                    names=["bucket", "row", "doc_id", "data"],
                )
                turn, row = turn + 1, row + n

    name = f"texts_{uuid4().hex}"
    path = f"{shared_dir(docs.sparkSession)}/{name}"
    (
        map_rows(plain, work, TEXTS)
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", path)
        .bucketBy(buckets, "bucket")
        .saveAsTable(name)
    )
    return docs.sparkSession.table(name), name, path


def _by_bucket(texts: DataFrame, spans: DataFrame, work, schema: str) -> DataFrame:
    """Runs `work(texts, spans)` on the rows of each bucket; the texts stay where they are."""
    placed = spans.withColumn("bucket", F.shiftright("place", 32).cast("int")).withColumn(
        "row", F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")
    )
    importable(texts.sparkSession)
    return texts.groupBy("bucket").cogroup(placed.groupBy("bucket")).applyInArrow(work, schema)


def contexts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of contexts."""

    def work(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        number = {row: i for i, row in enumerate(texts.column("row").to_pylist())}
        data, ids = texts.column("data"), texts.column("doc_id").to_pylist()
        order = np.argsort(wanted.column("row").to_numpy(), kind="stable")
        wanted = wanted.take(pa.array(order))
        parts, docs, last, text = [], [], None, b""
        for row, start, size in zip(*(wanted.column(c).to_pylist() for c in ("row", "start", "size"))):
            if row != last:
                last, text = row, data[number[row]].as_py()
            parts.append(text[start : start + size])
            docs.append(ids[number[row]])
        return pa.table(
            {
                "g": wanted.column("g"),
                "doc_id": pa.array(docs, pa.int64()),
                "place": wanted.column("place"),
                "start": wanted.column("start"),
                "data": pa.array(parts, pa.binary()),
            }
        )

    return _by_bucket(texts, wanted, work, CONTEXTS_DDL)


def without_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Each text with its spans cut out, as counts and digest."""

    def work(texts: pa.Table, spans: pa.Table) -> pa.Table:
        rows, start, size = (spans.column(c).to_numpy() for c in ("row", "start", "size"))
        order = np.argsort(rows, kind="stable")
        rows, start, end = rows[order], start[order], start[order] + size[order]
        own = texts.column("row").to_numpy()
        first, last = np.searchsorted(rows, own, "left"), np.searchsorted(rows, own, "right")
        out: tuple[list, ...] = ([], [], [], [])
        for i, data in enumerate(texts.column("data")):
            data = data.as_py()
            removed = spans_n = 0
            digest = hashlib.sha256()
            if first[i] == last[i]:
                digest.update(data)
            else:
                a, b = start[first[i] : last[i]], end[first[i] : last[i]]
                by = np.argsort(a, kind="stable")
                a, reach = a[by], np.maximum.accumulate(b[by])
                head = np.concatenate(([True], a[1:] > reach[:-1]))
                a, b = a[head].tolist(), reach[np.concatenate((np.flatnonzero(head)[1:] - 1, [len(head) - 1]))].tolist()
                done = 0
                for x, y in zip(a, b):
                    digest.update(data[done:x])
                    removed += y - x
                    done = y
                digest.update(data[done:])
                spans_n = len(a)
            for column, value in zip(out, (len(data), removed, spans_n, digest.hexdigest())):
                column.append(value)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "n_bytes": pa.array(out[0], pa.int64()),
                "n_removed": pa.array(out[1], pa.int64()),
                "n_spans": pa.array(out[2], pa.int64()),
                "kept_sha256": pa.array(out[3], pa.string()),
            }
        )

    return _by_bucket(texts, spans, work, RESULT_DDL)


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """(place, start, size): bytes of all occurrences but the earliest of every repeat; spans may overlap."""
    sorted_out = cut_lineage(sort_out(marks(texts, length, gram)))
    settled = sorted_out.where("size < 0").select("place", "start", (-F.col("size")).alias("size"))
    wanted = sorted_out.where("size > 0").select("g", "place", "start", "size")
    contexts = cut_lineage(contexts_of(texts, wanted))
    large = wanted.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > group_contexts).select("g")
    from_groups = repeats_in_groups(contexts.join(large, "g", "left_anti"), length)
    from_strings = sort_out(strings_of(contexts.join(large, "g", "left_semi"), length)).where("size < 0")
    return settled.unionByName(from_groups).unionByName(
        from_strings.select("place", "start", (-F.col("size")).alias("size"))
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty. Null ids come before all others. Rows with equal ids
    are separate documents, the later stored one after the other, so of
    repeated rows all but one are repeats. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    texts, name, path = store_texts(docs)
    found = cut_lineage(without_spans(texts, repeated_spans(texts, length, gram, group_contexts)))
    spark.sql(f"DROP TABLE {name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return found
