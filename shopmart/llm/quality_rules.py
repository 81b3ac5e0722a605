"""Quality rules: counts of every text, and lines that too many documents of a host share.

Every document puts out the hashes of its distinct normalised lines. A line
is boilerplate of its host (`source`) if at least `MIN_DOCS` distinct
documents of the host hold it and they are more than `MAX_SHARE` of the
host's distinct documents. Boilerplate lines are removed; a document is
depleted, and rejected, if what remains has fewer than `MIN_WORDS` words or
less than `MIN_LEFT` of its words. Copies of a text count as one document, so
a text does not become boilerplate by being copied.

The text is read once. What goes on from there is one small row per document
with its counts and line hashes; hosts and lines of any size are counted by
partial sums.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, carried, map_rows, slices, texts_in, with_long
from shopmart.session import cut_lineage

MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words in repeated windows
WINDOW = 5

MIN_DOCS = 10
MAX_SHARE = 0.05
MIN_LEFT = 0.3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_DIGITS = re.compile(r"[0-9]+")

MEASURED = pa.schema(
    [
        ("task", pa.int32()),
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("source", pa.string()),
        ("text_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("lines", pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int64()), ("places", pa.list_(pa.int32()))]))),
    ]
)
MEASURED_DDL = (
    "task int, row long, doc_id long, source string, text_hash long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<hash: long, words: long, places: array<int>>>"
)


def normal_line(line: str) -> str:
    """Lower case, runs of blanks as one, numbers alike."""
    return _DIGITS.sub("0", " ".join(_WORD.findall(line.lower())))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 7) - (1 << 63)


def words_of(text: str) -> list[bytes]:
    """The words as UTF-8; bytes are split at the ASCII blanks and no others."""
    return text.encode().split()


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    # Windows are told apart exactly: pair numbers of halves are made dense step by step.
    key, size = ids, 1
    parts = []
    rest = window
    at = 0
    while rest:
        if rest & 1:
            parts.append((key, at))
            at += size
        rest >>= 1
        if rest:
            left, right = key[:-size] if len(key) > size else key[:0], key[size:]
            key = np.unique(left * (len(words) + 1) + right, return_inverse=True)[1].astype(np.int64)
            size *= 2
    whole = parts[0][0][parts[0][1] : parts[0][1] + n]
    for key, at in parts[1:]:
        whole = np.unique(whole * (len(words) + 1) + key[at : at + n], return_inverse=True)[1].astype(np.int64)
    twice = np.bincount(whole)[whole] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = words_of(text)
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    blanks = sum(text.count(c) for c in " \t\n\v\f\r")
    return (
        len(words),
        len(text) - blanks,
        sum(text.count(c) for c in _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measured(docs: DataFrame) -> DataFrame:
    """One small row per document: counts, and its distinct lines with their words and places."""

    def work(rows: Batches) -> Batches:
        task, row = TaskContext.get().partitionId(), 0
        for full in rows:
            for part in slices(full):
                out = []
                for doc_id, text, source in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "source"))):
                    text = text or ""
                    lines: dict[int, dict] = {}
                    for place, line in enumerate(text.split("\n")):
                        words = len(line.encode().split())
                        if words:
                            own = lines.setdefault(key := _hash(normal_line(line)), {"hash": key, "words": 0, "places": []})
                            own["words"] += words
                            own["places"].append(place)
                    out.append((task, row, doc_id, source, _hash(text), *measure(text), list(lines.values())))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), MEASURED)], schema=MEASURED
                )

    return map_rows(docs.selectExpr("cast(doc_id as long) doc_id", "text", "cast(source as string) source"), work, MEASURED_DDL)


def boilerplate(rows: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(source, hash) of the lines above both limits; documents are counted by their text."""
    hosts = rows.groupBy("source", "text_hash").count().groupBy("source").agg(F.count("*").alias("host_docs"))
    docs_of_line = (
        rows.select("source", "text_hash", F.explode("lines.hash").alias("hash"))
        .distinct()
        .groupBy("source", "hash")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= min_docs)
    )
    above = docs_of_line.alias("l").join(hosts.alias("h"), F.col("l.source").eqNullSafe(F.col("h.source")))
    return above.where(F.col("docs") > max_share * F.col("host_docs")).select("l.source", "l.hash")


def judge(
    docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_left: float = MIN_LEFT
) -> DataFrame:
    """One row per row of `docs`: the counts, the rules' verdicts and the places of removed lines.

    A null text has no words and fails; a null source is a host of its own.
    Repeated rows and ids are judged row by row; an empty table gives an empty one.
    """
    rows = cut_lineage(measured(docs))
    lines = rows.select("task", "row", "source", F.inline("lines"))
    bad = boilerplate(rows, min_docs, max_share).select(F.col("source").alias("host"), "hash")
    removed = (
        lines.join(bad, (lines["hash"] == bad["hash"]) & lines["source"].eqNullSafe(bad["host"]), "left_semi")
        .groupBy("task", "row")
        .agg(F.sum("words").alias("removed_words"), F.flatten(F.collect_list("places")).alias("removed_lines"))
    )
    n, left = F.col("n_words"), F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * n)
    return (
        rows.drop("lines")
        .join(removed, ["task", "row"], "left")
        .select(
            "doc_id",
            "source",
            "text_hash",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            (~failed & (left >= MIN_WORDS) & (left >= min_left * n)).alias("kept"),
            left.alias("words_left"),
            F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
        )
    )


def clean(docs: DataFrame, **limits: float) -> DataFrame:
    """The kept documents without their boilerplate lines; columns as in `docs`.

    Rows with equal id, source and text get the same verdict, so they are
    looked up by these.
    """
    seen = cut_lineage(judge(docs, **limits)).where("kept")
    verdicts = seen.groupBy("doc_id", "source", "text_hash").agg(F.first("removed_lines").alias("removed"))

    def with_hash(rows: Batches) -> Batches:
        for part in rows:
            hashes = [_hash(t or "") for t in texts_in(part)]
            yield part.append_column("hash", pa.array(hashes, pa.int64()))

    rows = carried(docs)
    hashed = map_rows(rows, with_hash, with_long(rows, "hash"))
    joined = hashed.join(
        verdicts,
        (hashed["hash"] == verdicts["text_hash"])
        & hashed["row.doc_id"].cast("long").eqNullSafe(verdicts["doc_id"])
        & hashed["row.source"].cast("string").eqNullSafe(verdicts["source"]),
    )
    lines = F.split("row.text", "\n", -1)
    rest = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("removed", i.cast("int"))), "\n")
    text = F.when(F.size("removed") > 0, rest).otherwise(F.col("row.text"))
    return joined.select(F.col("row").withField("text", text).alias("row")).select("row.*")
