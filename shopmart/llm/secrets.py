"""Secrets in texts: fixed shapes, and values in credential contexts that cost many guesses.

The price of a value is the least number of guesses over all ways to cut it
into known words, dates, repeats, keyboard walks and stretches of brute
force. Logarithms of the guesses of the parts add up, so a dynamic program
over the end positions finds the cheapest cut: the best price up to a place is
the best over all parts that end there. A stretch of brute force costs the
same for each character, so it needs no part of its own length. A value is a
secret if even its cheapest cut costs more than a limit.
"""

from __future__ import annotations

import hashlib
import math
import re
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of

BASE_KINDS = ("assign", "access", "hex")
GUESSED = "guess"
KINDS = (*BASE_KINDS, GUESSED)
Span = tuple[int, int, str]

FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

# Values in credential contexts are secrets from this many guesses on (as power of ten).
MIN_GUESSES_LOG10 = 8.0
MIN_VALUE_CHARS = 6
PROSE_FACTOR = 1.5

# ---------------------------------------------------------------- fixed shapes

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

# ---------------------------------------------------------------- credential contexts

# A key word stands alone, starts a hump of a joined name, or is one of those that fixed shapes find anywhere;
# further parts of a joined name may follow it.
_CONTEXT = re.compile(
    r"(?:(?:(?<![A-Za-z])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"
    r"(?:pass(?:word|wd|phrase|code|key)?|pwd|pin|credentials?|access_?key|auth|bearer|private_?key)"
    r"|password|passwd|secret|token|api_?key)"
    r"(?:[_-][A-Za-z0-9]++|(?-i:[A-Z][a-z0-9]++)|[0-9]++)*+"
    r"[\"']?(?:[ \t]*+(?::=|=>|[:=])[ \t]*+|(?P<is>[ \t]++is[ \t]++))"
    r"(?:\"(?P<double>[^\"\n]+)\"|'(?P<single>[^'\n]+)'"
    r"|(?P<bare>[^\s\"'<>](?:[^\s\"'<>]|[\"'](?=[^\s\"'<>,;)}\]])|<(?![/!A-Za-z])|>(?=[^\s\"'<>]))*))",
    re.IGNORECASE | re.ASCII,
)
_CONTEXT_HINTS = ("pass", "pwd", "pin", "secret", "token", "credential", "key", "auth", "bearer")

# ---------------------------------------------------------------- guess cost

# Words tried first by every guesser, most frequent first.
COMMON_WORDS = (
    "password qwerty abc love iloveyou admin welcome monkey dragon master letmein login princess sunshine football "
    "baseball shadow superman michael jordan harley hunter trustno ranger buster soccer hockey killer george andrew "
    "charlie thomas robert daniel jessica ashley michelle jennifer joshua summer winter spring autumn freedom "
    "whatever computer internet secret private public default root guest user test temp changeme example sample "
    "none null true false string value your here token key server service access account system manager office "
    "company orange banana cheese cookie coffee pepper ginger flower tiger eagle falcon lion bear wolf star "
    "silver golden black white green blue purple yellow red hello world happy lucky angel heaven magic mustang "
    "ferrari porsche corvette yankees lakers arsenal chelsea liverpool london paris berlin madrid texas"
).split()
# Common words of prose, so that prose in a credential context is cheap.
PROSE_WORDS = (
    "the of and to in is it you that he was for on are with as his they at be this from have or by one had not but what "
    "all were when we there can an which she do how their if will up other about out many then them these so some her "
    "would make like him into time has look two more write go see no way could people my than first been call who its "
    "now find long down day did get come made may part over new sound take only little work know place year live me "
    "back give most very after thing our just name good sentence man think say great where help through much before "
    "line right too mean old any same tell boy follow came want show also around form three small set put end does "
    "another well large must big even such because turn here why ask went men read need land different home us move "
    "try kind hand picture again change off play spell air away animal house point page letter mother answer found "
    "study still learn should world every between own below country add last school father keep tree never start city "
    "earth eye light thought head under story saw left few while along might close something seem next hard open "
    "example begin life always those both paper together got group often run important until children side feet car "
    "mile night walk white sea began grow took river four carry state once book hear stop without second later miss "
    "idea enough eat face watch far really almost let above girl sometimes mountain cut young talk soon list song "
    "being leave family else nothing everything someone anyone nobody anything required invalid missing empty expired "
    "unknown unset disabled enabled optional provided generated encrypted protected stored hidden changed updated "
    "incorrect wrong correct valid needed used given sent forgotten forgot reset removed deleted revoked shared "
    "necessary necessarily understanding understood describe description following available different difficult "
    "possible impossible certain certainly obvious obviously usually generally currently already probably definitely "
    "absolutely completely automatically immediately authentication authorization authenticated authorized "
    "administrator application configuration environment variable parameter undefined redacted placeholder "
    "information development production database connection request response document content message number "
    "question problem business government company education community experience management technology language "
    "der die das und ist nicht ein eine mit von auf den dem wird kein passwort les des est pas une pour dans que qui "
    "los las del por para con una esta clave contrasena motdepasse"
).split()
# The two lists in turn, as a guesser tries both from their first words on.
KNOWN_WORDS = tuple(w for pair in zip_longest(COMMON_WORDS, PROSE_WORDS) for w in pair if w)
# Rows of two keyboards.
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "yxcvbnm", "azertyuiop", "qsdfghjklm", "wxcvbn")
_NEXT_KEYS = {a + b for row in _ROWS for a, b in zip(row, row[1:])} | {b + a for row in _ROWS for a, b in zip(row, row[1:])}
# Digits that stand for letters.
_LEET = str.maketrans("013457@$!", "oieastasi")

_DATE_LENGTHS = range(4, 11)
_DATE = re.compile(
    r"(?:19|20)[0-9]{2}(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12][0-9]|3[01]))?)?"
    r"|(?:0?[1-9]|[12][0-9]|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)?[0-9]{2}"
)

_CHAR = 1.0  # log10 of the guesses for one character of brute force
_BLANK = 0.0  # a blank in a phrase costs no more than being a further part
_PART = math.log10(2)  # each further part doubles what has to be tried
_YEAR = math.log10(120)
_FULL_DATE = math.log10(365 * 120)


class GuessCost:
    """log10 of the guesses for a value; `words` in order of frequency."""

    def __init__(self, words: list[str] | tuple[str, ...] = KNOWN_WORDS) -> None:
        self.price = {}
        for rank, word in enumerate(words, 1):
            if len(word) > 1:
                self.price.setdefault(word.lower(), math.log10(rank + 1))
        self.longest = max(map(len, self.price), default=0)

    def _word(self, part: str) -> float | None:
        low = part.lower()
        price = self.price.get(low)
        if price is None:
            plain = low.translate(_LEET)
            price = self.price.get(plain) if plain != low else None
            if price is None:
                return None
            price += math.log10(4)
        if part != low:
            price += math.log10(2 if part == low.capitalize() or part == part.upper() else 2 ** min(len(part), 10))
        return price

    def __call__(self, value: str) -> float:
        n = len(value)
        low = value.lower()
        # Where the run of equal characters, neighbouring keys or equal steps that ends here began.
        same = walk = step = 0
        runs: list[tuple[int, int, int]] = []
        for i in range(n):
            if i and value[i] != value[i - 1]:
                same = i
            if i and value[i - 1].lower() + value[i].lower() not in _NEXT_KEYS:
                walk = i
            delta = ord(value[i]) - ord(value[i - 1]) if i else 0
            if i and (abs(delta) != 1 or (i - step > 1 and delta != ord(value[i - 1]) - ord(value[i - 2]))):
                step = i - 1 if abs(delta) == 1 else i
            runs.append((same, walk, step))
        # Blocks that may end here as the second of two equal ones, by the place from which on they may.
        opening: dict[int, list[tuple[int, int]]] = {}
        for first, last, size in repeats(value):
            opening.setdefault(first + 2 * size, []).append((size, last))
        blocks: list[tuple[int, int]] = []
        # Cheapest cuts that end in brute force, and that end in another part.
        force, known = [math.inf] * (n + 1), [math.inf] * (n + 1)
        best = np.zeros(n + 1)
        for end in range(1, n + 1):
            # One more character of brute force, or a new stretch of it.
            force[end] = min(force[end - 1], best[end - 1] + (_PART if end > 1 else 0.0)) + _CHAR
            options = []
            for start in range(max(0, end - self.longest), end - 1):
                word = self._word(value[start:end])
                if word is not None:
                    options.append((start, word))
            if value[end - 1] == " ":
                options.append((end - 1, _BLANK))
            if value[end - 1].isdigit():
                for size in _DATE_LENGTHS:  # every way to write a date
                    if size <= end and _DATE.fullmatch(value, end - size, end):
                        options.append((end - size, _YEAR if size == 4 else _FULL_DATE))
            for start, cost in options:
                known[end] = min(known[end], best[start] + cost + (_PART if start else 0.0))
            for begin, first in zip(runs[end - 1], (math.log10(95), math.log10(40), math.log10(60))):
                if end - begin >= 3:
                    starts = np.arange(begin, end - 2)
                    parts = best[starts] + first + np.log10(end - starts) + np.where(starts > 0, _PART, 0.0)
                    known[end] = min(known[end], float(parts.min()))
            # A block said again costs no more than that it is.
            blocks = [b for b in blocks if b[1] >= end] + opening.get(end, [])
            if blocks:
                sizes = np.array([size for size, _ in blocks])
                known[end] = min(known[end], float(best[end - sizes].min()) + math.log10(2) + _PART)
            best[end] = min(force[end], known[end])
        return float(best[n])


def _alike(value: str, a: int, b: int) -> int:
    """How many characters from two places on are the same; the second place is the later one."""
    n, step = 0, 8
    while value[a + n : a + n + step] == value[b + n : b + n + step] and b + n + step <= len(value):
        n, step = n + step, step * 2
    while b + n < len(value) and value[a + n] == value[b + n]:
        n += 1
    return n


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(start, end, size): every longest stretch in which the character `size` places on is the same, two blocks or more.

    Every such stretch holds a multiple of its size at which both blocks agree, so n / size places are tried for
    each size. Blocks of one character are runs of it and are left out.
    """
    found = []
    back = value[::-1]
    n = len(value)
    for size in range(2, n // 2 + 1):
        at = 0
        while at + size < n:
            if value[at] == value[at + size]:
                ahead = _alike(value, at, at + size)
                behind = _alike(back, n - at - size, n - at) if at else 0
                if ahead + behind >= size:
                    found.append((at - behind, at + ahead + size, size))
                at += max(size, ahead // size * size)
            else:
                at += size
    return sorted(set(found))


# ---------------------------------------------------------------- spans


def base_spans(text: str) -> list[Span]:
    spans: list[Span] = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        spans += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _covered(start: int, end: int, base: list[Span]) -> bool:
    """Whether the spans, sorted by start, hold every character."""
    for a, b, _ in base:
        if a <= start < b:
            start = b
    return start >= end


def guessed_spans(text: str, base: list[Span], cost: GuessCost, limit: float) -> list[Span]:
    """Values in credential contexts that fixed shapes do not cover wholly and that cost more than the limit.

    A word of letters behind "is" may be prose and is held to `PROSE_FACTOR` times the limit.
    """
    low = text.lower()
    if not any(hint in low for hint in _CONTEXT_HINTS):
        return []
    found: list[Span] = []
    for m in _CONTEXT.finditer(text):
        group = next(name for name in ("double", "single", "bare") if m.group(name) is not None)
        start, value = m.start(group), m.group(group).rstrip(" ,;.)") if group == "bare" else m.group(group)
        end = start + len(value)
        if len(value) < MIN_VALUE_CHARS:
            continue
        if _covered(start, end, base):
            continue
        prose = group == "bare" and m.group("is") and value.isalpha() and value[1:].islower()
        if cost(value) >= (PROSE_FACTOR * limit if prose else limit):
            found.append((start, end, GUESSED))
    return found


def find(text: str, cost: GuessCost, limit: float = MIN_GUESSES_LOG10) -> tuple[list[Span], list[Span]]:
    """Spans of fixed shape, and all spans."""
    base = base_spans(text)
    more = guessed_spans(text, base, cost, limit)
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(
    docs: DataFrame, words: tuple[str, ...] = KNOWN_WORDS, limit: float = MIN_GUESSES_LOG10
) -> DataFrame:
    """One row per row of `docs` with counts of the fixed shapes, their digest and all spans.

    `words` are the words a guesser knows, most frequent first. A null text is
    empty and has no secrets. Repeated rows and ids are handled row by row; an
    empty table gives an empty one.
    """

    def work(rows: Batches) -> Batches:
        cost = GuessCost(words)
        for full in rows:
            for part in slices(full):
                results = [find(t or "", cost, limit) for t in part.column("text").to_pylist()]
                counts = [[sum(k == kind for _, _, k in base) for base, _ in results] for kind in BASE_KINDS]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in results]
                yield batch(
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                    [part.column("doc_id"), *counts, digests, [written(spans) for _, spans in results]],
                    [pa.int64()] * 4 + [pa.string()] * 2,
                )

    return map_rows(texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long")), work, FOUND)
