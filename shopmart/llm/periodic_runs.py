"""Runs: stretches of words that repeat with a period at least three times.

A run is a maximal stretch with smallest period q and at least
max(`MIN_WORDS`, `MIN_REPEATS` * q) words. All of them are found:

* Periods below `SHORT` are scanned directly: where the word q places on is the
  same, without a break, for long enough.
* Longer periods are looked for scale by scale, from Q to 3 Q / 2. At each scale
  every window of Q + 1 places puts forward its places of least hash of Q words
  (minimizers). Inside a run the windows at its start and one period later hold
  the same words, so they put forward the same places a period apart. Pairs of
  equal minimizers at a distance of the scale are seeds; the words themselves
  decide how far a seed extends to both sides.
* Words inside a run of a period up to Q / 3, all of which are known by then,
  are no candidates: their equal hashes would lie arbitrarily close. What is
  left recurs at distances above Q / 3 only, so a minimizer has a handful of
  partners. A window all of whose places fall out lies in one run of small
  period, and by the theorem of Fine and Wilf in no run of this scale with a
  smallest period of this scale: nothing is lost.

A stretch found with a multiple of its period is the same stretch, so the
smallest period that gives it stays. Documents are worked on together, parted
by words that occur nowhere else; time and memory grow with the words, times
the number of scales. A text is never split over tasks and there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopmart.llm.common import Batches, map_rows, slices, texts_of

MIN_WORDS = 24
MIN_REPEATS = 3
SHORT = 24  # first period that minimizers look for; not above MIN_WORDS
AT_ONCE = 1 << 20  # characters of text worked on together, or one text

Run = tuple[int, int, int]  # start, length, period
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]

FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)
FOUND_DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_TOP = np.uint64(2**64 - 1)
_BASE = 0x9E3779B97F4A7C15 | 1


def _mixed(values: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class _Hashes:
    """Hashes of any number of neighbouring words; equal words give equal hashes."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        powers = np.full(n + 1, _BASE, np.uint64)
        back = np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64)
        powers[0] = back[0] = 1
        powers, self.back = np.cumprod(powers, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        sums = _mixed(words.astype(np.uint64) + np.uint64(1)) * powers[:n]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(sums, dtype=np.uint64)))

    def of(self, size: int, n: int) -> np.ndarray:
        """One hash for each of the stretches of `size` words in the first `n` words."""
        return _mixed((self.sums[size : n + 1] - self.sums[: n + 1 - size]) * self.back[: n + 1 - size])


def _sliding(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The best of every `width` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[:-rest], values[rest:]) if rest else values


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the least hash of some `width` neighbours; all of them on ties, none of the highest value."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _sliding(np.minimum, hashes, width)
    edge = np.zeros(width - 1, np.uint64)
    # The largest of the minima of all windows around a place is its own hash if some window chose it.
    around = _sliding(np.maximum, np.concatenate((edge, least, edge)), width)
    return np.flatnonzero((around == hashes) & (hashes != _TOP))


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading words are the same."""
    n, at, size = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + size)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, size = end, size * 2
    return n


def _least_length(period: int) -> int:
    return max(MIN_WORDS, MIN_REPEATS * period)


def _short_runs(words: np.ndarray, period: int) -> Iterator[tuple[int, int]]:
    """(first, after last) of the stretches of one short period."""
    breaks = np.flatnonzero(words[:-period] != words[period:])
    edges = np.concatenate(([-1], breaks, [len(words) - period]))
    same = np.diff(edges) - 1
    for i in np.flatnonzero(same >= _least_length(period) - period).tolist():
        yield int(edges[i]) + 1, int(edges[i + 1]) + period


def _seeds(hashes: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """(distance, place) of equal minimizers low <= distance < high apart, in this order."""
    chosen = minimizers(hashes, low + 1)
    order = np.argsort(hashes[chosen], kind="stable")
    at = chosen[order]
    key = hashes[at]
    found, step = [], 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (key[step:] == key[:-step]) & (apart < high)
        if not near.any():
            break  # partners further on in the order are further away
        near &= apart >= low
        found += zip(apart[near].tolist(), at[:-step][near].tolist())
        step += 1
    return sorted(found)


def _joined(texts: list[list[bytes]]) -> tuple[np.ndarray, list[int], list[int]]:
    """Word numbers of all texts, longest first, each with a word of its own behind it; the order and the starts."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    number: dict = {}
    ids: list[int] = []
    starts = []
    for i in order:
        starts.append(len(ids))
        ids += [number.setdefault(w, len(number)) for w in texts[i]]
        ids.append(number.setdefault(i, len(number)))  # a number is no word
    return np.array(ids, np.int64), order, starts


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """All runs of every list of words, by start, then period."""
    words, order, starts = _joined(texts)
    ends = [*starts[1:], len(words)]
    lengths = [len(texts[i]) for i in order]
    found: dict[tuple[int, int], int] = {}

    def reach(least: int) -> int:
        """Where the texts of at least so many words end."""
        fit = sum(n >= least for n in lengths)
        return ends[fit - 1] if fit else 0

    for period in range(1, SHORT):
        n = reach(_least_length(period))
        if n:
            for stretch in _short_runs(words[:n], period):
                found.setdefault(stretch, period)

    low, hashes = SHORT, None
    while n := reach(MIN_REPEATS * low):
        high = low * 3 // 2
        hashes = hashes or _Hashes(words[:n])
        candidates = hashes.of(low, n)
        for (start, end), period in found.items():
            if MIN_REPEATS * period <= low <= end - start:
                candidates[start : end - low + 1] = _TOP
        last, covered = 0, 0
        for distance, place in _seeds(candidates, low, high):
            if distance == last and place < covered:
                continue
            right = place + _agree(words[place : n - distance], words[place + distance : n])
            left = place - _agree(words[:place][::-1], words[distance : place + distance][::-1])
            last, covered = distance, right
            if right - left + distance >= _least_length(distance):
                found.setdefault((left, right + distance), distance)
        low = high

    runs: list[list[Run]] = [[] for _ in texts]
    for (start, end), period in found.items():
        at = int(np.searchsorted(starts, start, side="right")) - 1
        runs[order[at]].append((start - starts[at], end - start, period))
    return [sorted(r, key=lambda run: (run[0], run[2])) for r in runs]


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without the repeats: of every run only its first period stays, if no other run drops it."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _groups(rows: Batches, size: int) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of neighbouring rows, up to `size` characters, or one longer text."""
    ids: list[int | None] = []
    texts: list[str] = []
    held = 0
    for full in rows:
        for part in slices(full, 64):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                text = text or ""
                if texts and held + len(text) > size:
                    yield ids, texts
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
    if texts:
        yield ids, texts


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, at_once: int = AT_ONCE) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, runs (start, length, period) and the collapsed text.

    Words are parted by ASCII blanks and counted from 0; `rewrite` changes the
    words of a document before the search. The collapsed text joins what stays
    by one space. A null text has no words; repeated rows and ids, also null
    ids, are separate documents; an empty table gives an empty one.
    """

    def work(rows: Batches) -> Batches:
        for ids, texts in _groups(rows, at_once):
            words = [t.encode().split() for t in texts]
            if rewrite:
                words = [rewrite(i, w) for i, w in zip(ids, words)]
            runs = find_runs(words)
            columns = [
                ids,
                [len(w) for w in words],
                [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs],
                [b" ".join(collapse(w, r)).decode() for w, r in zip(words, runs)],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)

    return map_rows(texts_of(docs).selectExpr("cast(doc_id as long) doc_id", "text"), work, FOUND_DDL)
