"""Passages of benchmark items in documents, by SimHash of windows as long as the item.

Words are lower-cased and parted at blanks and ASCII punctuation; shingles
have five words (a shorter item is one shingle of all its words). Every
window with as many words as an item has a 64-bit SimHash of its shingles. An
index over eight blocks of eight bits finds all item fingerprints within the
radius: if two fingerprints differ in at most 23 bits, some block differs in
at most two, and an item is looked up under all values up to two bits away.
What the index finds is compared exactly: the sum of the smaller weights of
all shingles over the sum of the larger ones, a shingle weighing as often as
it occurs. Of two texts with similarity 0.8 about 10 of 64 bits differ, with a
deviation of 3, so a radius of 23 misses about two in a million of them.

Before windows are hashed, a bound drops those that cannot pass: the
similarity is at most the share of the window's shingles that occur in any
item at all. Items are taken in blocks of `ITEMS_PER_PASS` and about `PASS_BYTES`,
one after the other, so what the driver and a task hold of the benchmark is
bounded.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, carried, map_rows, slices, texts_of
from shopmart.session import cut_lineage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
ITEMS_PER_PASS = 10_000
PASS_BYTES = 16 << 20  # item text of a pass, about

MATCHES = "doc_id long, item_id long, word_start int, n_words int, distance int, similarity double"

# Letters in lower case, ASCII punctuation as blanks; bytes beyond ASCII stay.
_FOLD = bytes(
    32 if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
_BASE = 0x5851F42D4C957F2D  # odd, so its powers have inverses
_CHUNK = 1 << 20
_STRETCH = 1 << 15  # window starts hashed at once
_PAIRS = 1 << 20  # pairs of a window and an item looked at together


class Powers:
    """Powers of the base and of its inverse, as far as any text has needed them."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            up, down = pow(_BASE, k, 1 << 64), pow(_BASE, -k, 1 << 64)
            self.up = np.concatenate((self.up, self.up * np.uint64(up)))
            self.down = np.concatenate((self.down, self.down * np.uint64(down)))


_POWERS = Powers()


def _hash_words(data: bytes) -> np.ndarray:
    """Polynomial hashes of the words of folded bytes, from running sums."""
    raw = np.frombuffer(data, np.uint8)
    _POWERS.reach(len(raw) + 1)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(raw)], out=sums[1:])
    return (sums[ends] - sums[starts]) * _POWERS.down[starts]


def word_hashes(text: str) -> np.ndarray:
    """One hash per word of the text; long texts in parts that end at a blank."""
    data = text.encode().translate(_FOLD)
    out, at = [], 0
    while at < len(data):
        end = at + _CHUNK
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            while cut < at and end < len(data):  # one word longer than the part
                end = min(len(data), 2 * end - at)
                cut = data.rfind(b" ", at, end)
            end = cut if cut > at else len(data)
        out.append(_hash_words(data[at:end]))
        at = max(end, at + 1)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_hashes(own: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """One hash per run of `size` word hashes; a single one for a shorter text, none for no words."""
    size = min(size, len(own))
    if not size:
        return np.zeros(0, np.uint64)
    n = len(own) - size + 1
    out = np.full(n, np.uint64(size))
    for i in range(size):
        out = (out * _MIX[0]) ^ own[i : i + n]
        out *= _MIX[1]
    out ^= out >> np.uint64(30)
    out *= _MIX[2]
    return out ^ (out >> np.uint64(27))


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, shingles: int) -> np.ndarray:
    """SimHash of `shingles` consecutive hashes from every start on."""
    low = int(starts.min())
    sums = np.zeros((int(starts.max()) - low + shingles + 1, 64), np.int32)
    np.cumsum(_bits(hashes[low : low + len(sums) - 1]), axis=0, out=sums[1:])
    counts = sums[starts - low + shingles] - sums[starts - low]
    return np.packbits(2 * counts > shingles, axis=1, bitorder="little").view("<u8").ravel()


def _stretches(starts: np.ndarray) -> list[np.ndarray]:
    """Sorted starts in parts that lie close together, so that a long text takes little memory."""
    if not len(starts):
        return []
    return np.split(starts, np.flatnonzero(np.diff(starts // _STRETCH)) + 1)


class BlockIndex:
    """Item fingerprints of one length under the values of their blocks."""

    def __init__(self, fingerprints: np.ndarray) -> None:
        self.fingerprints = fingerprints
        values = fingerprints.view(np.uint8).reshape(-1, BLOCKS)
        self.order = [np.argsort(values[:, b], kind="stable") for b in range(BLOCKS)]
        self.first = [np.searchsorted(values[o, b], np.arange(257)) for b, o in enumerate(self.order)]

    def within(self, windows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window number, item number, distance) within the radius, some windows at a time."""
        step = max(1, _PAIRS // len(self.fingerprints))
        parts = [self._within(windows[at : at + step], radius) for at in range(0, len(windows), step)]
        windows_of = np.concatenate([w + k * step for k, (w, _, _) in enumerate(parts)])
        return windows_of, np.concatenate([i for _, i, _ in parts]), np.concatenate([d for _, _, d in parts])

    def _within(self, windows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values = windows.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        every = np.arange(256, dtype=np.uint8)
        # The bits that differ cannot be more than this in all blocks.
        masks = every[np.bitwise_count(every) <= radius // BLOCKS]
        found = []
        for b in range(BLOCKS):
            keys = (values[:, b, None] ^ masks).astype(np.int64)
            first, many = self.first[b][keys].ravel(), (self.first[b][keys + 1] - self.first[b][keys]).ravel()
            window = np.repeat(np.repeat(np.arange(len(windows)), len(masks)), many)
            inside = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
            item = self.order[b][np.repeat(first, many) + inside]
            distance = np.bitwise_count(windows[window] ^ self.fingerprints[item])
            near = distance <= radius
            found.append(window[near] * len(self.fingerprints) + item[near])
        pair = np.unique(np.concatenate(found))
        window, item = pair // len(self.fingerprints), pair % len(self.fingerprints)
        return window, item, np.bitwise_count(windows[window] ^ self.fingerprints[item])


class Benchmark:
    """Some items, by their number of words: fingerprints and weighted shingles."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in sorted(items, key=lambda x: (x[0], x[1])):
            words = word_hashes(text)
            if len(words):
                by_length.setdefault(len(words), []).append((item_id, shingle_hashes(words)))
        self.groups = []
        for length, group in sorted(by_length.items()):
            prints = np.array([window_fingerprints(h, np.zeros(1, int), len(h))[0] for _, h in group], np.uint64)
            bags = [np.unique(h, return_counts=True) for _, h in group]
            self.groups.append((length, len(group[0][1]), [i for i, _ in group], BlockIndex(prints), bags))
        everything = [h for group in by_length.values() for _, h in group]
        self.shingles = np.unique(np.concatenate(everything)) if everything else np.zeros(0, np.uint64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.shingles & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        # Items shorter than a shingle have hashes of their own size.
        self.short = sorted({length for length in by_length if length < SHINGLE_WORDS})

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        hit = self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        place = np.minimum(np.searchsorted(self.shingles, hashes[at]), len(self.shingles) - 1)
        hit[at] = self.shingles[place] == hashes[at]
        return hit

    def matches(self, text: str, radius: int, least: float) -> list[tuple[int, int, int, int, float]]:
        """(item_id, word_start, n_words, distance, similarity) of the best window of every item found."""
        words = word_hashes(text)
        if not len(words) or not len(self.shingles):
            return []
        best: dict[int, tuple] = {}
        for size in [*self.short, SHINGLE_WORDS]:
            hashes = shingle_hashes(words, size)
            known = self._known(hashes)
            if not known.any():
                continue
            before = np.concatenate(([0], np.cumsum(known)))
            for length, shingles, item_ids, index, bags in self.groups:
                if min(length, SHINGLE_WORDS) != size:
                    continue
                own = min(shingles, len(hashes))  # a short document is one window
                if own < least * shingles:
                    continue
                hits = before[own:] - before[: len(before) - own]
                # The larger weights sum up to the item's shingles at least.
                for starts in _stretches(np.flatnonzero(hits >= least * shingles)):
                    window, item, distance = index.within(window_fingerprints(hashes, starts, own), radius)
                    for w, i, d in zip(window.tolist(), item.tolist(), distance.tolist()):
                        known_best = best.get(item_ids[i])
                        if known_best and known_best[0][0] == -1:
                            continue  # the whole item, and no window before has it
                        start = int(starts[w])
                        similarity = weighted_similarity(np.unique(hashes[start : start + own], return_counts=True), bags[i])
                        rank = (-similarity, d, start)
                        if similarity >= least and (known_best is None or rank < known_best[0]):
                            best[item_ids[i]] = (rank, (item_ids[i], start, own + size - 1, d, similarity))
        return [best[i][1] for i in sorted(best)]


def weighted_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger weights of two bags (sorted values, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


class _Items:
    """The items in blocks of bounded size, one of which the driver and the tasks hold at a time.

    A null id or text is no item, of equal ids all texts count.
    """

    def __init__(self, benchmark: DataFrame, per_pass: int) -> None:
        items = benchmark.selectExpr("cast(item_id as long) item_id", "cast(text as string) text")
        self.items = cut_lineage(items.where("item_id is not null and text is not null").distinct())
        many, size = self.items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        self.blocks = max(-(-many // per_pass), -(-size // PASS_BYTES))

    def block(self, number: int) -> Benchmark:
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.blocks)) == number
        return Benchmark([tuple(r) for r in self.items.where(own).collect()])


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    per_pass: int = ITEMS_PER_PASS,
) -> DataFrame:
    """One row per row of `docs` and item found in it, with its best window.

    Null and empty texts have no windows. Repeated rows and ids are searched
    row by row. Without items or documents the result is empty.
    """

    def search(items: Benchmark) -> DataFrame:
        def work(rows: Batches) -> Batches:
            for full in rows:
                for part in slices(full):
                    out = [
                        (doc_id, *match)
                        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                        for match in items.matches(text or "", radius, similarity)
                    ]
                    if out:
                        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                        names = ["doc_id", "item_id", "word_start", "n_words", "distance", "similarity"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        return map_rows(texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long")), work, MATCHES)

    items = _Items(benchmark, per_pass)
    if items.blocks == 1:
        return search(items.block(0))
    # What a block finds is stored before the next block is fetched.
    parts = [cut_lineage(search(items.block(b))) for b in range(items.blocks)]
    return reduce(DataFrame.union, parts or [docs.sparkSession.createDataFrame([], MATCHES)])


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    per_pass: int = ITEMS_PER_PASS,
) -> DataFrame:
    """The documents in which no item is found; columns and all other rows stay, null texts too."""
    items = _Items(benchmark, per_pass)
    if not items.blocks:
        return docs
    if items.blocks == 1:
        held = items.block(0)

        def keep(rows: Batches) -> Batches:
            for part in rows:
                clean = [not held.matches(t or "", radius, similarity) for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(clean, pa.bool_()))

        return map_rows(docs, keep, docs.schema)

    def found(held: Benchmark) -> DataFrame:
        """Digests of the texts that hold an item of a block; what is found depends on the text alone."""

        def work(rows: Batches) -> Batches:
            for full in rows:
                for part in slices(full):
                    hit = [t for t in part.column("text").to_pylist() if t and held.matches(t, radius, similarity)]
                    if hit:
                        digests = [hashlib.md5(t.encode(), usedforsecurity=False).hexdigest() for t in hit]
                        yield pa.RecordBatch.from_arrays([pa.array(digests)], names=["digest"])

        return map_rows(docs.select("text"), work, "digest string")

    gone = [cut_lineage(found(items.block(b)).distinct()) for b in range(items.blocks)]
    rows = carried(docs).withColumn("own", F.md5(F.col("row.text").cast("binary")))
    gone_all = reduce(DataFrame.union, gone)
    return rows.join(gone_all, rows["own"] == gone_all["digest"], "left_anti").select("row.*")
