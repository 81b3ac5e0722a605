"""Lines that several documents hold stay in the last of them only.

The keys of lines are known by 128-bit hashes. `LineRuns` keeps the hashes
seen so far as runs on levels: a run is a bucketed table sorted by hash, with
one row per hash, its number of documents and the largest document id. A batch
of documents is counted per hash first, so a line of any number of documents is
a few rows before it is shuffled; it is then merge-anti-joined with all runs,
which are bucketed alike and hence not shuffled, and only hashes that are not
settled yet are added, as a run of level 0. When a level has `FAN` runs they are
merged into one run of the next level, so a hash is rewritten once for each
level only.

Documents go in by falling id. The first batch that holds a hash therefore
knows its last document, and a hash that has enough documents is settled: later
batches cannot change what is decided about it.

A text is read twice, for its hashes and to drop its lines, and is shuffled
once, by document id, where it meets the hashes it loses.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of
from shopmart.session import cut_lineage, shared_dir

MIN_CHARS = 20
MIN_DOCS = 3
FAN = 3
BATCHES = 6  # at least
BATCH_DOCS = 1_000_000_000  # at most, about
HOT = 1000  # a line is hot above one in so many of all lines, so there are fewer hot ones

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

COUNTED = "h binary, n long, last long"
KEPT = "doc_id long, n_lines long, n_dropped long, text string"


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The hash of the key of a line; none if the key is too short."""
    key = line.strip().translate(_LOWER)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh128_digest(key)


# ---------------------------------------------------------------- runs


@dataclass(frozen=True)
class _Run:
    name: str
    path: str


class LineRuns:
    """Counted line hashes in sorted runs on levels, each at most `fan` - 1 runs long."""

    def __init__(self, spark: SparkSession, fan: int = FAN, buckets: int | None = None) -> None:
        self.spark = spark
        self.fan = fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[_Run]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid4().hex}"
        path = f"{shared_dir(self.spark)}/{name}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h")
        writer.option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(_Run(name, path))

    def _remove(self, runs: list[_Run]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run.name}")
            target = self.spark._jvm.org.apache.hadoop.fs.Path(run.path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def _all(self) -> list[_Run]:
        return [run for level in self.levels for run in level]

    def _merged(self, runs: list[_Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], COUNTED)
        # Read as plain files: Spark 4.1 takes a union of bucketed tables for bucketed, but does not bring
        # their buckets together when it reads them by columns, and sums would come out in parts.
        return _totals(self.spark.read.schema(COUNTED).parquet(*[run.path for run in runs]))

    def rows(self) -> DataFrame:
        """(h, n, last) of all runs: documents counted until the hash was settled, and the largest id."""
        return self._merged(self._all())

    def unsettled(self, counted: DataFrame, settled: int = MIN_DOCS) -> DataFrame:
        """The rows of a batch whose hashes the runs do not know from `settled` documents or more."""
        rows, known = _totals(counted), F.lit(0)
        for i, run in enumerate(self._all()):
            rows = rows.join(self.spark.table(run.name).select("h", F.col("n").alias(f"n_{i}")), "h", "left")
            known = known + F.coalesce(f"n_{i}", F.lit(0))
        return rows.where(known < settled).select("h", "n", "last")

    def add(self, counted: DataFrame, settled: int = MIN_DOCS) -> None:
        """Adds a batch of (h, n, last) rows, without hashes that have `settled` documents or more.

        The ids of the batch must not be above those of earlier batches.
        """
        self._write(self.unsettled(counted, settled), 0)
        level = 0
        while len(self.levels[level]) >= self.fan:
            runs, self.levels[level] = self.levels[level], []
            self._write(self._merged(runs), level + 1)
            self._remove(runs)
            level += 1

    def close(self) -> None:
        """Drops all tables and their files."""
        for level in self.levels:
            self._remove(level)
        self.levels = []


def _totals(counted: DataFrame) -> DataFrame:
    return counted.groupBy("h").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


# ---------------------------------------------------------------- documents


def _hashed(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, hashes): the distinct line hashes of every document that has any."""

    def work(rows: Batches) -> Batches:
        for full in rows:
            for part in slices(full):
                ids, hashes = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = {line_hash(line, min_chars) for line in (text or "").encode().split(b"\n")} - {None}
                    if own:
                        ids.append(doc_id)
                        hashes.append(sorted(own))
                yield batch(["doc_id", "hashes"], [ids, hashes], [pa.int64(), pa.list_(pa.binary())])

    return map_rows(docs, work, "doc_id long, hashes array<binary>")


def _batch_number(docs: DataFrame, batches: int) -> tuple[Column, int]:
    """Batches by falling id, about alike in size, and their number; rows without id come last."""
    n = docs.count()
    batches = max(batches, math.ceil(n / BATCH_DOCS))
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("cuts")).first()["cuts"] if shares else None
    if not cuts:
        return F.lit(0), 1
    edges = sorted(set(cuts))
    above = reduce(lambda a, b: a + b, [F.when(F.col("doc_id") >= edge, 0).otherwise(1) for edge in edges])
    return above.cast("int"), len(edges) + 1


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """(doc_id, dropped): the line hashes that the documents of an id lose."""
    spark = docs.sparkSession
    number, n_batches = _batch_number(docs.select("doc_id"), batches)
    hashed = _hashed(docs, min_chars).withColumn("batch", number)
    path = f"{shared_dir(spark)}/lines-{uuid4().hex}"
    hashed.write.partitionBy("batch").parquet(path)
    # The schema is given, as an empty table has no folder of a batch to tell it.
    stored = spark.read.schema("doc_id long, hashes array<binary>, batch int").parquet(path)
    lines = stored.select("batch", "doc_id", F.explode("hashes").alias("h"))
    runs = LineRuns(spark, fan)
    try:
        for i in range(n_batches):
            counted = lines.where(F.col("batch") == i).groupBy("h").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
            runs.add(counted, min_docs)
        often = cut_lineage(runs.rows().where(F.col("n") >= min_docs).select("h", "last"))
        total = stored.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]
        # Lines of very many documents, at most HOT of them, meet their verdict without a shuffle by line.
        hot = F.broadcast(cut_lineage(lines.groupBy("h").count().where(F.col("count") * HOT > total).select("h")))
        marked = lines.join(F.broadcast(often.join(hot, "h", "left_semi")), "h").unionByName(
            lines.join(hot, "h", "left_anti").join(often, "h")
        )
        earlier = F.col("doc_id").isNull() & F.col("last").isNotNull() | (F.col("doc_id") < F.col("last"))
        return cut_lineage(marked.where(earlier).groupBy("doc_id").agg(F.collect_set("h").alias("dropped")))
    finally:
        runs.close()


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_dropped and the text of the lines that stay.

    A line counts by its key: blanks at both ends stripped, A-Z lower-cased. A
    key of at least `min_chars` code points in at least `min_docs` rows stays
    in the rows of the largest id that holds it, with all its lines there. A
    null text is one empty line. A null id is below all others; rows of equal
    id are documents of their own but share what they keep. An empty table
    gives an empty one.
    """
    rows = texts_of(docs).selectExpr("cast(doc_id as long) doc_id", "text")
    lost = repeated_lines(rows, min_chars, min_docs, batches, fan).withColumnRenamed("doc_id", "of_id")
    joined = rows.join(lost, rows["doc_id"].eqNullSafe(lost["of_id"]), "left").select("doc_id", "text", "dropped")

    def work(parts: Batches) -> Batches:
        for full in parts:
            for part in slices(full):
                out: list[tuple] = []
                for doc_id, text, dropped in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "dropped"))):
                    text = text or ""
                    if not dropped:
                        out.append((doc_id, text.count("\n") + 1, 0, text))
                        continue
                    gone = set(dropped)
                    lines = text.split("\n")
                    kept = [line for line in lines if line_hash(line.encode(), min_chars) not in gone]
                    out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield batch(["doc_id", "n_lines", "n_dropped", "text"], list(zip(*out)) or [[]] * 4, types)

    return map_rows(joined, work, KEPT)
