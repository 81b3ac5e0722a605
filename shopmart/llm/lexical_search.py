"""Ranked lexical search: the best documents for every item of a query set.

Documents are cut down to the vocabulary of the items: a bag of term numbers
and frequencies and a length class m. Documents with the same bag and the same
m have the same score for every item, so they are one class: they are brought
together by a hash of both and told apart by bag and m themselves, and a class
is scored once. Of its members only the `k` smallest ids can be in a result;
they are chosen before the shuffle already, so a class of any size is a few
rows of each task. A task scores its classes against all items of a block by the
inverted lists of the items, keeps the `k` best of each, and expands classes of
equal score by rising id.

Items are worked on in blocks of bounded size; the driver and the tasks hold
one block, its vocabulary and the document frequencies of its terms.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of
from shopmart.session import cut_lineage

TOP = 20
BLOCK_BYTES = 8 << 20  # item text of a block, about
CELLS = 1 << 21  # scores and postings worked on at once, about

# Letters and digits of ASCII and all beyond it make terms; A-Z are lower-cased, the rest parts terms.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

RANKED = "item_id long, rank int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Items:
    """A block of items as inverted lists: for every term the items that hold it, and how often."""

    def __init__(self, texts: list[tuple[int, str | None]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.numbers = [number for number, _ in texts]
        entries = []
        for i, (_, text) in enumerate(texts):
            for term, times in Counter(terms_of(text)).items():
                entries.append((self.vocabulary.setdefault(term, len(self.vocabulary)), i, times))
        entries.sort()
        columns = np.array(entries, np.int64).reshape(-1, 3)
        self.items, self.times = columns[:, 1], columns[:, 2]
        self.first = np.searchsorted(columns[:, 0], np.arange(len(self.vocabulary) + 1))

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """(document, item) scores from the value of every term of every document."""
        total = np.zeros((n_docs, len(self.numbers)), np.int64)
        first, n = self.first[term], self.first[term + 1] - self.first[term]
        ends = np.cumsum(n)
        at = 0
        while at < len(term):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CELLS, side="right")))
            many = n[at:to]
            before = np.cumsum(many) - many
            place = np.repeat(first[at:to] - before, many) + np.arange(int(many.sum()))
            np.add.at(total, (np.repeat(doc[at:to], many), self.items[place]), np.repeat(value[at:to], many) * self.times[place])
            at = to
        return total


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms counted, and the bag of those in the vocabulary by rising number."""

    def work(rows: Batches) -> Batches:
        for full in rows:
            for part in slices(full):
                sizes, terms, tfs = [], [], []
                for text in part.column("text").to_pylist():
                    words = terms_of(text)
                    found = sorted((vocabulary[t], n) for t, n in Counter(words).items() if t in vocabulary)
                    sizes.append(len(words))
                    terms.append([t for t, _ in found])
                    tfs.append([n for _, n in found])
                types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield batch(["doc_id", "n", "terms", "tfs"], [part.column("doc_id"), sizes, terms, tfs], types)

    return map_rows(docs, work, "doc_id long, n long, terms array<int>, tfs array<long>")


def bag_classes(rows: DataFrame, k: int = TOP) -> DataFrame:
    """(m, terms, tfs, members): one row per class of equal bags and m, with its `k` smallest ids."""
    keys = ["class_hash", "m", "terms", "tfs"]
    hashed = rows.select("doc_id", F.xxhash64("m", "terms", "tfs").alias("class_hash"), "m", "terms", "tfs")
    # The rank limit is applied in every task before the shuffle, too.
    rising = Window.partitionBy(*keys).orderBy(F.col("doc_id").asc_nulls_last())
    first = hashed.withColumn("place", F.row_number().over(rising)).where(F.col("place") <= k)
    return first.groupBy(*keys).agg(F.collect_list(F.struct("doc_id")).alias("members")).drop("class_hash")


def _rising(doc_id: int | None) -> tuple[bool, int]:
    return (doc_id is None, doc_id or 0)


class _Best:
    """The best (score, id) pairs of one item."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.pairs: list[tuple[int, int | None]] = []

    def add(self, pairs: list[tuple[int, int | None]]) -> int:
        """Takes what is among the best and returns the least score that can still get in."""
        self.pairs = sorted(self.pairs + pairs, key=lambda p: (-p[0], _rising(p[1])))[: self.k]
        return self.pairs[-1][0] if len(self.pairs) == self.k else 1


def _scored(classes: DataFrame, items: Items, weights: np.ndarray, k: int) -> DataFrame:
    """(item, score, doc_id): the best of every task."""
    step = max(1, min(512, CELLS // max(1, len(items.numbers))))

    def work(rows: Batches) -> Batches:
        best = [_Best(k) for _ in items.numbers]
        least = np.ones(len(items.numbers), np.int64)
        for full in rows:
            for part in slices(full, step):
                lengths = np.array([len(t) for t in part.column("terms").to_pylist()], np.int64)
                doc = np.repeat(np.arange(part.num_rows), lengths)
                term = part.column("terms").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False)
                m = part.column("m").to_numpy(zero_copy_only=False)[doc]
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
                scores = items.scores(doc, term, value, part.num_rows)
                members = [sorted((x["doc_id"] for x in ids), key=_rising) for ids in part.column("members").to_pylist()]
                good = scores >= least
                for i in np.flatnonzero(good.any(axis=0)).tolist():
                    found = sorted(np.flatnonzero(good[:, i]).tolist(), key=lambda d: (-scores[d, i], _rising(members[d][0])))
                    # Every class has a member, so `k` classes are enough.
                    least[i] = best[i].add([(int(scores[d, i]), x) for d in found[:k] for x in members[d]])
        out = [(number, s, d) for number, b in zip(items.numbers, best) for s, d in b.pairs]
        if out:
            yield batch(["item", "score", "doc_id"], list(zip(*out)), [pa.int64()] * 3)

    return map_rows(classes, work, "item long, score long, doc_id long")


def _block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, score, doc_id) of one block of items."""
    spark = docs.sparkSession
    rows = cut_lineage(bags(docs, items.vocabulary))
    n_docs, n_terms = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not items.vocabulary:
        return spark.createDataFrame([], "item long, score long, doc_id long")
    holding = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most the vocabulary
    df = {r["term"]: r["count"] for r in holding}
    weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(items.vocabulary))], np.int64)
    m = F.expr(f"75 + (25 * n * {n_docs}L) div {n_terms}L")
    classes = bag_classes(rows.where(F.size("terms") > 0).withColumn("m", m), k)
    return _scored(classes, items, weights, k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The `k` best documents with a score above 0 of every row of `items`: item_id, rank, doc_id, score.

    Equal scores stand by rising doc_id, a null id last. Rows of equal id or
    text are documents and items of their own. A null or empty text has no
    terms: such a document is in no result, such an item has none. Empty tables
    give an empty result.
    """
    numbered = cut_lineage(
        items.selectExpr("monotonically_increasing_id() item", "cast(item_id as long) item_id", "cast(text as string) text")
    )
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / block_bytes))
    rows = texts_of(docs).selectExpr("cast(doc_id as long) doc_id", "text")
    found = []
    for i in range(blocks):
        block = numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).select("item", "text").collect()
        found.append(_block(rows, Items([tuple(r) for r in block]), k))
    falling = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(falling)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
