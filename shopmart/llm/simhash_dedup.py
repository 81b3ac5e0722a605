"""Near copies by 64-bit SimHash, compared exactly in tiles.

Equal fingerprints are one. Tiles are cut inside classes of fingerprints that
agree in one of `radius + 1` blocks of bits: two fingerprints within the
radius differ in at most `radius` bits, so at least one block is the same and
no link is lost. A class is ordered by population count and cut into tiles of
at most `TILE`; a class larger than one tile is dealt out as pairs of tiles, so
no task holds more than two of them. Tile pairs whose population counts are
further apart than the radius are skipped, all others are compared whole with
exclusive or and bit counts. Out of a pair of tiles come only as many links as
keep its components together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, carried, map_rows, slices, texts_in, texts_of, with_long
from shopmart.llm.components import components
from shopmart.session import cut_lineage

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BITS = 64
TILE = 4096  # fingerprints dealt out together
STEP = 256  # rows and columns compared at once

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    """The majority of every bit over the hashes of all shingles, repeats included; 0 without words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: -size].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def with_fingerprint(docs: DataFrame, column: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """`docs`, plain or carried, with the fingerprint as a signed long; a null text counts as empty."""

    def work(rows: Batches) -> Batches:
        for full in rows:
            for part in slices(full):
                values = [_signed(fingerprint(t or "", size)) for t in texts_in(part)]
                yield part.append_column(column, pa.array(values, pa.int64()))

    return map_rows(docs, work, with_long(docs, column))


# ---------------------------------------------------------------- links


def _blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and width of `radius + 1` blocks that cover all bits."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return list(zip(edges, [b - a for a, b in zip(edges, edges[1:])]))


def _block_value(radius: int) -> Column:
    values = [
        F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1).cast("long")) if width < BITS else F.col("fp")
        for at, width in _blocks(radius)
    ]
    return F.array(*values)


def tile_pairs(fingerprints: DataFrame, radius: int, tile: int) -> DataFrame:
    """(block, value, a, b, side, fp): every fingerprint in every pair of tiles of its classes.

    Tiles of a class hold neighbouring population counts: a count is cut into
    as many tiles as it fills, so a tile holds one count of a large class. Only
    tile pairs within the radius are formed. A class of one tile is its own pair.
    """
    rows = fingerprints.select("fp", F.bit_count("fp").alias("pop"), F.posexplode(_block_value(radius)).alias("block", "value"))
    sizes = (
        rows.groupBy("block", "value", "pop")
        .agg(F.count("*").alias("n"))
        .groupBy("block", "value")  # one row for each of at most 65 population counts
        .agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("pop", "n"))).alias("by_pop"))
        .where("total > 1")
    )
    parts = F.when(F.col("total") <= tile, F.lit(1)).otherwise(F.ceil(F.col("by_pop")[F.col("pop")] / tile)).cast("int")
    own = F.when(F.col("total") <= tile, F.lit(0)).otherwise(
        F.col("pop") * (1 << 24) + F.pmod(F.xxhash64("fp"), parts.cast("long")).cast("int")
    )
    near = F.flatten(
        F.transform(
            F.filter(F.map_keys("by_pop"), lambda p: F.abs(p - F.col("pop")) <= radius),
            lambda p: F.transform(
                F.sequence(F.lit(0), F.ceil(F.col("by_pop")[p] / tile).cast("int") - 1), lambda s: p * (1 << 24) + s
            ),
        )
    )
    others = F.when(F.col("total") <= tile, F.array(F.lit(0))).otherwise(near)
    dealt = rows.join(sizes, ["block", "value"]).select("block", "value", "fp", own.alias("own"), F.explode(others).alias("other"))
    return dealt.select(
        "block",
        "value",
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).alias("second"),
        "fp",
    )


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect what the links within one tile, or between two tiles, connect.

    Values are unsigned fingerprints, all different. Only links across are looked for if there are two tiles.
    """
    same = right is None
    left = left[np.argsort(np.bitwise_count(left), kind="stable")]
    right = left if same else right[np.argsort(np.bitwise_count(right), kind="stable")]
    pop_l, pop_r = np.bitwise_count(left).astype(np.int16), np.bitwise_count(right).astype(np.int16)
    label_l = np.arange(len(left))
    label_r = label_l if same else np.arange(len(right)) + len(left)
    links: list[tuple[int, int]] = []
    for i in range(0, len(left), STEP):
        for j in range(i if same else 0, len(right), STEP):
            a, b = slice(i, i + STEP), slice(j, j + STEP)
            if pop_r[j] - pop_l[a][-1] > radius or pop_l[i] - pop_r[b][-1] > radius:
                continue
            x, y = np.nonzero(np.bitwise_count(left[a, None] ^ right[None, b]) <= radius)
            x, y = x + i, y + j
            while len(x):
                apart = label_l[x] != label_r[y]
                x, y = x[apart], y[apart]
                if not len(x):
                    break
                links.append((int(left[x[0]]), int(right[y[0]])))
                keep, gone = sorted((label_l[x[0]], label_r[y[0]]))
                label_l[label_l == gone] = keep
                if not same:
                    label_r[label_r == gone] = keep
    return links


def links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): links of distinct fingerprints `fp` that connect all within the radius."""
    spark = fingerprints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["block", "value", "a", "b"]
    dealt = tile_pairs(fingerprints, radius, tile)
    ordered = dealt.repartition(parts, *keys).sortWithinPartitions(*keys, "second")

    def pairs(rows: Batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(fingerprints, side) of one pair of tiles after the other; at most two tiles are held."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None
        for part in rows:
            if not part.num_rows:
                continue
            key = np.column_stack([part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
            fp = part.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            second = part.column("second").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if last is not None and (key[a] != last).any():
                    yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                    held = []
                held.append((fp[a:b], second[a:b]))
                last = key[a]
        if held:
            yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])

    def work(rows: Batches) -> Batches:
        out: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(np.array([e[k] for e in out], np.uint64).view(np.int64)) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["u", "v"])

        for fp, second in pairs(rows):
            if len(fp) > 1:
                out += forest(fp[~second], fp[second], radius) if second.any() else forest(fp, None, radius)
            if len(out) > 50_000:
                yield flush()
                out = []
        if out:
            yield flush()

    return map_rows(ordered, work, "u long, v long")


def classes(rows: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fp, component_id, head): class of every fingerprint of (doc_id, fp) rows.

    `component_id` is the smallest doc_id of the class, null if it has none; `head` the smallest fingerprint with it.
    """
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct, radius, tile))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = cut_lineage(named)
    heads = named.groupBy("root").agg(
        F.min("first").alias("component_id"), F.min_by("fp", F.struct(F.col("first").isNull(), "first", "fp")).alias("head")
    )
    return named.join(heads, "root").select("fp", "component_id", "head")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def group(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    A null text counts as empty, with fingerprint zero. Rows with equal ids
    are separate documents; a null id never names a class unless it has no
    other. An empty table gives an empty one.
    """
    ids = texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = cut_lineage(with_fingerprint(ids, "fp", size).select("doc_id", "fp"))
    named = classes(rows, radius, tile)
    return rows.join(named, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row of `docs` for each class: one with the smallest doc_id; columns as in `docs`.

    Of several texts under that id the smallest by length and hash stays, and
    of repeated rows one.
    """
    hashed = with_fingerprint(carried(docs), "fp", size).withColumns(
        {"size": F.octet_length("row.text"), "hash": F.xxhash64("row.text"), "id": F.col("row.doc_id").cast("long")}
    )
    stored = cut_lineage(hashed)
    light = stored.select("id", "fp", "size", "hash")
    named = classes(light.select(F.col("id").alias("doc_id"), "fp"), radius, tile)
    heads = named.where("fp = head").select(F.col("fp").alias("head_fp"), "component_id")
    candidates = light.join(
        heads, (light["fp"] == heads["head_fp"]) & light["id"].eqNullSafe(heads["component_id"]), "left_semi"
    )
    counted = candidates.groupBy("id", "fp", "size", "hash").agg(F.count("*").alias("n"))
    chosen = counted.groupBy("fp").agg(F.min(F.struct("size", "hash", "id", "n")).alias("best"))
    kept = cut_lineage(chosen.select(F.col("fp").alias("kept_fp"), "best.*"))

    def rows_of(kept: DataFrame) -> DataFrame:
        same = stored["fp"] == kept["kept_fp"]
        for column in ("size", "hash", "id"):
            same &= stored[column].eqNullSafe(kept[column])
        return stored.join(kept, same, "left_semi")

    first = rows_of(kept.where("n = 1")).select("row.*")
    repeated = kept.where("n > 1")
    if repeated.isEmpty():
        return first
    return first.unionByName(rows_of(repeated).dropDuplicates(["fp"]).select("row.*"))
