"""Personal data in texts, plain and disguised, with places in the original text.

Plain identifiers are found on the text as it is. For disguised ones three
transducers rewrite the text while they keep, for every character they put
out, the stretch of source characters it stands for:

1. look-alike and styled characters become ASCII, invisible ones vanish;
2. runs of digits that are spelled ("five five five", "double two"), wholly or
   beside figures, become figures;
3. "at" and "dot" in brackets, as words or with blanks around the signs between
   the parts of an address become @ and a full stop.

The same detectors run on the rewritten text, and what they find is mapped
back. A find counts as disguised only if it covers a rewritten place.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import Batches, batch, map_rows, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]  # start, end, kind

FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"

# ---------------------------------------------------------------- detectors

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ with what surrounds it; the same finds as a scan from the left, in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in found.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield found.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() < 12:
            continue
        digits = _NOT_DIGITS.sub("", found.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGITS.sub("", found.group())) <= 15:
            yield found.span()


_DETECTORS = (emails, ips, cards, phones)


def detect(text: str) -> list[Span]:
    """All plain identifiers, by start and then kind."""
    spans = [(a, b, kind) for kind, find in zip(KINDS, _DETECTORS) for a, b in find(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


# ---------------------------------------------------------------- transducers

# Letters of other scripts that look like ASCII ones, and signs for @ and the full stop.
_LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХасеѕіјорухԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα",
        "ABESIJKMHOPCTYXacesijopyxdqwABEZHIKMNOPTYXoa",
        strict=True,
    )
) | {"﹫": "@", "。": ".", "․": ".", "‐": "-", "‑": "-", "−": "-", "–": "-"}
_INVISIBLE = frozenset("­​‌‍⁠﻿")
_FOREIGN = re.compile("[­Ͱ-\U0010ffff²³¹]")

# Names of the digits.
_DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
_TIMES = {"double": 2, "triple": 3}
_DIGIT_WORD = "(?:" + "|".join(_DIGITS) + ")"
_DIGIT_PART = rf"(?:(?:(?:double|triple)\s+)?{_DIGIT_WORD}|[0-9]+)"
# Digits in a row, some in words and some in figures; the detectors decide whether they are an identifier.
_SPELLED = re.compile(rf"(?<![0-9A-Za-z]){_DIGIT_PART}(?:[\s,.-]{{1,3}}{_DIGIT_PART})+(?![0-9A-Za-z])", re.IGNORECASE)
_DIGIT_BEHIND = re.compile(rf"[\s,.-]{{1,3}}{_DIGIT_PART}")
_PARTING = " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0,.-"
_SPELLED_PART = re.compile(rf"(?:(double|triple)\s+)?({_DIGIT_WORD})|([0-9]+)|[^0-9A-Za-z]+", re.IGNORECASE)

_BRACKETED = re.compile(r"(?<!\s)\s*[\[({<]\s*(at|dot)\s*[\])}>]\s*", re.IGNORECASE)
_PART = r"[A-Za-z0-9_%+-]+"
# Parts of an address in a chain: joined by a full stop, by "dot" between blanks, or by a full stop between blanks.
_CHAIN = re.compile(rf"(?<![\w.%+-]){_PART}+(?:(?:\.|\s+(?:dot|\.)\s+){_PART}+)*+", re.IGNORECASE)
_AT = re.compile(r"\s+at\s+|\s*@\s*", re.IGNORECASE)
_JOINS = re.compile(r"\s+(?:dot|\.)\s+", re.IGNORECASE)
_ENDS_IN_NAME = re.compile(r"(?:\.|\s)[A-Za-z]{2,}$")
_SPOKEN_AT = re.compile(r"\sat\s+[A-Za-z0-9-]+\.[A-Za-z]|\s@|@\s", re.IGNORECASE)
_SPOKEN_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s+dot\s+[0-9]{1,3}){3}\b", re.IGNORECASE)
_SIGNS = {"at": "@", "dot": "."}
# Words behind "at" that begin prose, and words before it that do so where the host is in plain form.
_PROSE_AFTER = frozenset("the a an this that my our your".split())
_PROSE_BEFORE = frozenset(
    "look looking see us me you him her it them visit meet is are was be available found online here there live page "
    "pages site website sites home today now or and more details read listed hosted only out up also even not".split()
)


@dataclass
class Tape:
    """A rewritten text; character i stands for source[start[i]:end[i]], `new` where it differs."""

    text: str
    start: list[int]
    end: list[int]
    new: list[bool]

    @classmethod
    def of(cls, text: str) -> Tape:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)), [False] * len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Each edit (from, to, text) in order, none overlapping; its text stands for all it replaces."""
        parts: list[str] = []
        start: list[int] = []
        end: list[int] = []
        new: list[bool] = []
        done = 0
        for a, b, text in [*edits, (len(self.text), len(self.text), "")]:
            parts.append(self.text[done:a])
            start += self.start[done:a]
            end += self.end[done:a]
            new += self.new[done:a]
            parts.append(text)
            if text:
                start += [self.start[a]] * len(text)
                end += [self.end[b - 1]] * len(text)
                new += [True] * len(text)
            elif new and a < b:
                new[-1] = True  # something vanished behind this character
            done = b
        return Tape("".join(parts), start, end, new)


def _plain_char(char: str) -> str | None:
    """The ASCII look of a character, empty if it is invisible, None to leave it."""
    if char in _INVISIBLE:
        return ""
    if char in _LOOK_ALIKES:
        return _LOOK_ALIKES[char]
    digit = unicodedata.digit(char, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", char)
    return plain if plain != char and plain.isascii() and plain.isprintable() and plain != " " else None


def plain_characters(tape: Tape) -> Tape:
    edits = []
    for found in _FOREIGN.finditer(tape.text):
        plain = _plain_char(found.group())
        if plain is not None:
            edits.append((found.start(), found.end(), plain))
    return tape.rewrite(edits) if edits else tape


def spelled_digits(tape: Tape) -> Tape:
    edits = []
    for run in _SPELLED.finditer(tape.text):
        if run.group().isascii() and not any(c.isalpha() for c in run.group()):
            continue  # figures alone
        for part in _SPELLED_PART.finditer(run.group()):
            times, word, figures = part.groups()
            text = _DIGITS[word.lower()] * _TIMES.get((times or "").lower(), 1) if word else figures or ""
            # Full stops stay, they may part an address.
            if not word and not figures:
                text = "." if "." in part.group() else ""
            if text != part.group():
                edits.append((run.start() + part.start(), run.start() + part.end(), text))
    return tape.rewrite(edits) if edits else tape


def _spoken_addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Edits that make addresses in words plain: "name at host dot tld", "name at host.tld", "a dot b @ host . tld"."""
    before: re.Match | None = None  # a chain that is no "at"
    at = -1  # where the chain before ends if only "at" or @ lies behind it
    for chain in _CHAIN.finditer(text):
        sign = _AT.fullmatch(text, before.end(), chain.start()) if before else None
        word = chain.group().lower() == "at"
        if word and before and text[before.end() : chain.start()].isspace() and at < 0:
            at = before.end()
            continue
        local, begin, spoken = before, at, at >= 0
        if not spoken and sign:
            begin = local.end()
        before, at = chain, -1
        if local is None or begin < 0 or not _is_address(local.group(), chain.group(), spoken):
            continue
        for part in (local, chain):
            for join in _JOINS.finditer(text, part.start(), part.end()):
                yield join.start(), join.end(), "."
        if chain.start() - begin > 1:
            yield begin, chain.start(), "@"


def _is_address(local: str, host: str, spoken: bool) -> bool:
    """Whether two chains around a sign make an address; prose is told apart if the sign is the word "at"."""
    if not _ENDS_IN_NAME.search(host):
        return False
    if not spoken:
        return True
    if any("." in join.group() for join in _JOINS.finditer(host)):
        return False  # a sentence may end in a full stop between blanks
    if host.split()[0].lower() in _PROSE_AFTER:
        return False
    return _JOINS.search(local + host) is not None or local.lower() not in _PROSE_BEFORE


def at_and_dot(tape: Tape) -> Tape:
    edits = [(m.start(), m.end(), _SIGNS[m.group(1).lower()]) for m in _BRACKETED.finditer(tape.text)]
    tape = tape.rewrite(edits) if edits else tape
    edits = list(_spoken_addresses(tape.text))
    for found in _SPOKEN_IP.finditer(tape.text):
        edits += [(j.start(), j.end(), ".") for j in _JOINS.finditer(tape.text, found.start(), found.end())]
    return tape.rewrite(sorted(set(edits))) if edits else tape


def normalise(text: str) -> Tape:
    return at_and_dot(spelled_digits(plain_characters(Tape.of(text))))


def _word_beside_digit(low: str) -> bool:
    """Whether a digit word stands beside another digit, without which no run holds a word."""
    for word in _DIGITS:
        at = low.find(word)
        while at >= 0:
            end = at + len(word)
            if not (at and low[at - 1].isalnum()) and not low[end : end + 1].isalnum():
                last = at
                while last and low[last - 1] in _PARTING:
                    last -= 1
                before = low[max(0, last - 6) : last]
                if before[-1:].isdigit() or before.endswith(tuple(_TIMES)) or _DIGIT_BEHIND.match(low, end):
                    return True
            at = low.find(word, end)
    return False


def _may_hide(text: str) -> bool:
    """Whether any transducer could change the text; cheap tests first."""
    if not text.isascii() and _FOREIGN.search(text):
        return True
    low = text.lower()
    if "dot" in low or ("at" in low and any(c in text for c in "[({<") and _BRACKETED.search(text)):
        return True
    if ("@" in text or "at" in low) and _SPOKEN_AT.search(text):
        return True
    return _word_beside_digit(low)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans with the disguised ones added."""
    base = detect(text)
    if not _may_hide(text):
        return base, base
    tape = normalise(text)
    more = []
    for a, b, kind in detect(tape.text):
        if not any(tape.new[a:b]):
            continue
        start, end = min(tape.start[a:b]), max(tape.end[a:b])
        # A disguise around an identifier that is plain inside it, or the same one, adds nothing.
        if any(k == kind and s <= start and end <= e for s, e, k in base):
            continue
        more.append((start, end, kind))
    return base, sorted(set(base + more), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# ---------------------------------------------------------------- tables


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` with counts of the plain kinds, their digest, all spans and their number.

    A null text is empty and has none. Repeated rows and ids are handled row
    by row; an empty table gives an empty one.
    """

    def work(rows: Batches) -> Batches:
        for full in rows:
            for part in slices(full):
                results = [find(t or "") for t in part.column("text").to_pylist()]
                counts = [[sum(k == kind for _, _, k in base) for base, _ in results] for kind in KINDS]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in results]
                yield batch(
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"],
                    [part.column("doc_id"), *counts, digests, [written(spans) for _, spans in results], [len(s) for _, s in results]],
                    [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()],
                )

    return map_rows(texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long")), work, FOUND)


def redact_text(text: str) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    parts, done = [], 0
    for start, end, kind in find(text)[1]:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in `text` replaced; all columns and rows stay, null texts too."""

    def work(rows: Batches) -> Batches:
        for full in rows:
            for part in slices(full):
                at = part.schema.get_field_index("text")
                texts = [t if t is None else redact_text(t) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return map_rows(docs, work, docs.schema)
