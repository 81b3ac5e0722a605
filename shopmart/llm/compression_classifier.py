"""Text quality from two zstandard dictionaries, one of good and one of bad texts.

A text is cut into chunks, and each chunk is compressed with either
dictionary; a dictionary of similar text makes it smaller. The difference of
the two sizes over their sum is the raw score, which a logistic curve turns
into the probability of label 1. Chunks keep the help of a dictionary alike
for short and for long texts, which otherwise live on their own history.
Text that repeats itself is small with either dictionary and shows no
difference, so the curve also gets the compressed share of the text.

Training sees a bounded sample of labelled rows, see `SAMPLE_PER_LABEL` and
`SAMPLE_BYTES`. A fifth of it is kept out of the dictionaries and fits the
curve, weighted to the shares of the labels among all training rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of

SAMPLE_PER_LABEL = 2500  # rows of each label, at most
SAMPLE_BYTES = 1 << 16  # longer texts are not sampled
DICTIONARY_BYTES = 112 * 1024
CHUNK_BYTES = 2048
LEVEL = 3
THRESHOLD = 0.3
FOLDS = 5

SCORED = "doc_id long, held_out boolean, score double, predicted int"


def held_out(doc_id: Column) -> Column:
    """A fifth of the ids, by their checksum; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _chunks(text: str) -> list[bytes]:
    data = text.encode()
    return [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]


class Sizes:
    """What compression with both dictionaries tells about a text."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        def packer(dictionary: bytes) -> zstandard.ZstdCompressor:
            data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            if data:
                data.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)

        self.good, self.bad = packer(good), packer(bad)

    def __call__(self, text: str) -> tuple[float, float, float]:
        """Size difference over the sum (positive is good), compressed share of the text and its square."""
        chunks = _chunks(text)
        if not chunks:
            return 0.0, 1.0, 1.0
        good = sum(len(self.good.compress(c)) for c in chunks)
        bad = sum(len(self.bad.compress(c)) for c in chunks)
        share = (good + bad) / (2 * sum(map(len, chunks)))
        return (bad - good) / (bad + good), share, share * share


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve 1 / (1 + exp(-(weights * values + offset)))."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    offset: float

    def scores(self, values: list[tuple[float, float, float]]) -> np.ndarray:
        x = np.array(values).reshape(-1, len(self.weights)) @ np.array(self.weights) + self.offset
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; too few samples for the trainer serve as raw content."""
    chunks = [c for t in texts for c in _chunks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(chunks)[-DICTIONARY_BYTES:]


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Weighted logistic regression by Newton steps, lightly damped."""
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    design = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    damping = np.diag([1e-2] * x.shape[1] + [1e-6])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        gradient = design.T @ (weight * (y - p)) - damping @ beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + damping
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = beta[:-1] / scale
    return tuple(map(float, slopes)), float(beta[-1] - slopes @ centre)


def train(texts: dict[int, list[str]], shares: dict[int, float]) -> Model:
    """A model from sampled texts by label; `shares` are the labels' parts of all training rows.

    With fewer than two labels every score is the share of label 1, or 0.5 without any label.
    """
    if not (texts.get(0) and texts.get(1)):
        share = shares.get(1, 0.0) / (sum(shares.values()) or 1.0) if any(shares.values()) else 0.5
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(b"", b"", (0.0, 0.0, 0.0), float(np.log(share / (1 - share))))
    fitted, curve = {}, {}
    for label, sample in texts.items():
        # The sample is in the order of a hash, so any fifth of it is random.
        curve[label] = sample[:: FOLDS] if len(sample) >= FOLDS else sample
        fitted[label] = [t for i, t in enumerate(sample) if i % FOLDS] or sample
    good, bad = _dictionary(fitted[1]), _dictionary(fitted[0])
    sizes = Sizes(good, bad)
    x = np.array([sizes(t) for label in (0, 1) for t in curve[label]])
    y = np.array([float(label) for label in (0, 1) for _ in curve[label]])
    weight = np.where(y == 1, shares[1] / len(curve[1]), shares[0] / len(curve[0]))
    weights, offset = fit_curve(x, y, weight * len(y) / weight.sum())
    return Model(good, bad, weights, offset)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents that are not held out.

    Null labels and ids are left out; of an id with several labels or texts
    one of each is used. The sample is bounded, so it may go to the driver.
    """
    known = (
        labels.selectExpr("cast(doc_id as long) doc_id", "cast(quality as int) label")
        .where("doc_id is not null and label in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    shares = {r["label"]: float(r["count"]) for r in known.groupBy("label").count().collect()}
    # Some rows may have no fitting text, so more ids than rows are looked at; all bounded.
    chosen = None
    for label in (0, 1):
        ids = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE_PER_LABEL)
        chosen = ids if chosen is None else chosen.union(ids)
    rows = (
        texts_of(docs)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
        .where(F.octet_length("text").between(1, SAMPLE_BYTES))
        .join(F.broadcast(chosen), "doc_id")  # at most 4 * SAMPLE_PER_LABEL ids
        .groupBy("label", "doc_id")
        .agg(F.min("text").alias("text"))
    )
    texts: dict[int, list[str]] = {}
    for label in (0, 1):
        own = rows.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
        texts[label] = [r["text"] for r in own.collect()]
    return train(texts, {0: shares.get(0, 0.0), 1: shares.get(1, 0.0)})


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    A null text is scored like an empty one: no difference, nothing saved.
    Repeated rows and ids are scored row by row; an empty table gives an empty one.
    """

    def work(rows: Batches) -> Batches:
        sizes = Sizes(model.good, model.bad)
        for full in rows:
            for part in slices(full):
                scores = model.scores([sizes(t or "") for t in part.column("text").to_pylist()])
                yield batch(
                    ["doc_id", "held_out", "score", "predicted"],
                    [part.column("doc_id"), part.column("held_out"), scores, (scores >= threshold).astype(np.int32)],
                    [pa.int64(), pa.bool_(), pa.float64(), pa.int32()],
                )

    rows = texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_rows(rows.withColumn("held_out", held_out(F.col("doc_id"))), work, SCORED)
