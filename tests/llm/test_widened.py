"""Disguises, guess costs, splices and column names beyond the plain cases."""

from __future__ import annotations

import math
import random
import time

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from shopmart.llm import decontamination, packing, pii, quality_rules, secrets, simhash_dedup, token_counts
from shopmart.llm.tokens import END_TEXT, Encoder

# ---------------------------------------------------------------- personal data


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail alice at example.com now", "email", "alice at example.com"),
        ("jane dot doe at mail.example.org", "email", "jane dot doe at mail.example.org"),
        ("bob @ example . com", "email", "bob @ example . com"),
        ("a.b.c.d.e.f.g.h.i.j.k.l.m at x dot org", "email", "a.b.c.d.e.f.g.h.i.j.k.l.m at x dot org"),
        ("x dot " * 30 + "y at " + "z dot " * 30 + "com", "email", "x dot " * 30 + "y at " + "z dot " * 30 + "com"),
        ("+1 555 eight 675309", "phone", "+1 555 eight 675309"),
        ("+1 555 eight 675 309", "phone", "+1 555 eight 675 309"),
        ("+1 555 867 530 nine", "phone", "+1 555 867 530 nine"),
        ("+1 555 867 53 zero nine", "phone", "+1 555 867 53 zero nine"),
        ("4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
    ],
)
def test_half_disguises(text, kind, span):
    assert kind in {k for a, b, k in pii.find(text)[1] if text[a:b] == span}


@pytest.mark.parametrize(
    "text", ["look at example.com", "see us at shop.example.com", "at noon . then", "meet at nine, 10 or 11", "one 2 three", "we at the inn dot com"]
)
def test_prose_stays(text):
    assert pii.find(text)[1] == []


def test_disguises_put_on_at_random_are_found():
    r = random.Random(8)
    names = {str(i): n for i, n in enumerate("zero one two three four five six seven eight nine".split())}
    for _ in range(400):
        parts = ["".join(r.choice("abcxyz") for _ in range(r.randint(2, 6))) for _ in range(r.randint(2, 5))]
        cut = r.randint(1, len(parts) - 1)
        dot = lambda: r.choice([" dot ", "[dot]", " (DOT) ", "."])
        hide = lambda ps: "".join(p + dot() for p in ps[:-1]) + ps[-1]
        host = parts[cut:] + ["com"]
        text = hide(parts[:cut]) + r.choice([" at ", "[at]", " @ ", "@", " {AT} "]) + hide(host)
        assert any((a, b) == (3, 3 + len(text)) for a, b, k in pii.find(f"my {text}, ok")[1] if k == "email"), text
        digits = [r.choice("0123456789") for _ in range(11)]
        words = [names[d] if r.random() < 0.5 else d for d in digits]
        spoken = "+" + digits[0] + " " + r.choice([" ", "-"]).join(words[1:])
        found = [(a, b) for a, b, k in pii.find(f"call {spoken} now")[1] if k == "phone"]
        assert max(b for _, b in found) == 5 + len(spoken), spoken


def test_no_run_of_digits_is_passed_over():
    r = random.Random(3)
    pieces = ["one", "Two", "oh", "double", "triple", "5", "55", " ", ", ", "-", ".", "x", "+1", "\n", "nine", "    "]
    for _ in range(20_000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 9)))
        if any(c.isalpha() for m in pii._SPELLED.finditer(text) for c in m.group()):
            assert pii._word_beside_digit(text.lower()), text


def test_very_long_texts_take_linear_time():
    start = time.perf_counter()
    for text in ("x dot " * 50_000, "a at b.c " * 30_000, "one 2 " * 50_000, "a." * 100_000 + " one 1", "@ " * 100_000):
        pii.find(text)
    secrets.find("password" + " " * 200_000 + "token: " * 20_000, secrets.GuessCost())
    assert time.perf_counter() - start < 30


def test_number_of_all_spans(table):
    rows = [(1, "a@b.cd and alice at example.com"), (2, None), (3, "nothing")]
    got = {r["doc_id"]: (r["n_email"], r["n_spans"]) for r in pii.find_personal_data(table(rows)).collect()}
    assert got == {1: (1, 2), 2: (0, 0), 3: (0, 0)}


# ---------------------------------------------------------------- secrets


def guessed(text):
    return [text[a:b] for a, b, k in secrets.find(text, secrets.GuessCost())[1] if k == "guess"]


@pytest.mark.parametrize(
    "key",
    ['pwd     = "{}"', 'dbPassword="{}"', 'clientSecret: "{}"', 'secret_key = "{}"', 'PASSWORD_HASH="{}"', "dbPwd={}", "pwd =\t\t '{}'"],
)
def test_contexts_of_joined_names(key):
    assert guessed(key.format("x9$kQ2!vLm")) == ["x9$kQ2!vLm"]


def test_bare_values_hold_quotes_and_signs():
    assert guessed("pwd=x9$'kQ>2!v ok") == ["x9$'kQ>2!v"]
    assert guessed("<b>pwd=x9$kQ2!vLm</b>") == ["x9$kQ2!vLm"]
    assert guessed("spinach: Kx9$kQ2!vLm") == []


def least(cost, value):
    """The price over all cuts, from what each part alone may cost."""

    def parts(s, e):
        part, size = value[s:e], e - s
        if size > 1 and (word := cost._word(part)) is not None:
            yield word
        if part == " ":
            yield secrets._BLANK
        if secrets._DATE.fullmatch(part):
            yield secrets._YEAR if size == 4 else secrets._FULL_DATE
        if size >= 3:
            if len(set(part)) == 1:
                yield math.log10(95) + math.log10(size)
            if all(a + b in secrets._NEXT_KEYS for a, b in zip(part.lower(), part.lower()[1:])):
                yield math.log10(40) + math.log10(size)
            steps = {ord(b) - ord(a) for a, b in zip(part, part[1:])}
            if steps in ({1}, {-1}):
                yield math.log10(60) + math.log10(size)
        if size >= 2 and s >= size and value[s - size : s] == part:
            yield math.log10(2)
        yield size * secrets._CHAR

    best = [0.0] + [math.inf] * len(value)
    for e in range(1, len(value) + 1):
        best[e] = min(best[s] + c + (secrets._PART if s else 0.0) for s in range(e) for c in parts(s, e))
    return best[-1]


def test_price_is_the_least_of_all_cuts():
    cost, r = secrets.GuessCost(), random.Random(9)
    pieces = ["199", "012", "2024", "-", "12", "aaa", "abc", "qwe", "rty", "pass", "word", "x9$", "K", "x9$K", "31.12.99", " ", "the", "cba", "321"]
    values = ["199012", "x9$kQ2!vLm" * 4, "ab" * 40, ""] + ["".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(400)]
    for value in values:
        assert math.isclose(cost(value), least(cost, value), abs_tol=1e-9), value


def test_a_long_block_twice_costs_hardly_more():
    block = "x9$kQ2!vLmPq7#zR4tY8wB3nH6jD1fG5sA"
    cost = secrets.GuessCost()
    assert cost(block * 3) < cost(block) + 2


def test_repeats_match_their_definition():
    r = random.Random(10)
    for _ in range(1500):
        v = "".join(r.choice("ab") for _ in range(r.randint(0, 22)))
        want = {
            (s, e, p)
            for p in range(2, len(v) // 2 + 1)
            for s in range(len(v))
            for e in range(s + 2 * p, len(v) + 1)
            if all(v[i] == v[i + p] for i in range(s, e - p))
            and (s == 0 or v[s - 1] != v[s - 1 + p])
            and (e == len(v) or v[e] != v[e - p])
        }
        assert secrets.repeats(v) == sorted(want)


# ---------------------------------------------------------------- token counts


class Watched(Encoder):
    """Notes the longest text it is given."""

    longest = 0

    def ids(self, text):
        self.longest = max(self.longest, len(text))
        return super().ids(text)


@pytest.mark.parametrize("letters", ["абвгдежз", "漢字仮名交文体", "αβγδε", "abcdefgh", "éèàüöñ"])
def test_splices_in_every_script(letters):
    r = random.Random(11)
    stop = "。" if letters[0] == "漢" else " "
    text = "".join("".join(r.choice(letters) for _ in range(r.randint(1, 12))) + stop for _ in range(8000))
    enc = Watched()
    ids = token_counts.encode_spliced(text, enc, 4096, 64)
    assert enc.longest <= 4096 + 2 * 64 + 20
    assert ids == enc.exact.encode(text, add_special_tokens=False).ids


def test_splices_of_mixed_texts_are_exact():
    enc, r = Encoder(), random.Random(12)
    pieces = [" ", "  ", "\n", "　", "\xa0", "\x1c", "。", "漢", "字", "я", "a", "é", "'s", "1", "٣", "!", END_TEXT, "​", "😀", "ab" * 9]
    for _ in range(1500):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 80)))
        want = enc.exact.encode(text, add_special_tokens=False).ids
        assert token_counts.encode_spliced(text, enc, 24, 4) == want, text


def test_time_grows_with_the_text():
    r = random.Random(13)
    text = "".join("".join(r.choice("абвгдежз") for _ in range(6)) + " " for _ in range(100_000))
    enc, start = Watched(), time.perf_counter()
    ids = token_counts.encode_spliced(text, enc)
    assert time.perf_counter() - start < 30 and enc.longest < 2 * token_counts.CHUNK_CHARS
    assert len(ids) == len(enc.exact.encode(text, add_special_tokens=False).ids)


def test_given_documents_are_spliced(sample):
    texts = [r["text"] or "" for r in sample.collect()]
    assert max(map(len, texts)) > token_counts.CHUNK_CHARS


# ---------------------------------------------------------------- names of columns

CLASHING = ("v_size", "v_lines", "v_text_hash", "v_fp", "v_id", "v_hash", "fp", "hash", "size", "id", "row", "removed", "head", "text_hash", "odd name")


def test_columns_of_any_name_stay_as_they_are(spark, table):
    rows = [*ODD, *[(i, f"one two three four five six seven eight nine ten eleven {chr(87 + i // 2) * 3}") for i in range(20, 40)]]
    docs = table(rows).withColumns({c: F.lit(-7) for c in CLASHING})
    for step in (quality_rules.clean, simhash_dedup.keep_first, pii.redact):
        docs = step(docs)
        assert set(CLASHING) <= set(docs.columns) and docs.count() > 0
        assert all(r[c] == -7 for r in docs.collect() for c in CLASHING)
    assert packing.pack(docs).count() > 0
    assert np.all(simhash_dedup.group(docs).toPandas()["doc_id"] >= 20)


# ---------------------------------------------------------------- several blocks of items


def test_documents_are_dropped_over_several_passes(spark, table):
    r = random.Random(16)
    words = lambda n: " ".join(r.choice("abcdefghijklmnop") + str(r.randint(0, 99)) for _ in range(n))
    items = [(i, words(30)) for i in range(5)]
    benchmark = spark.createDataFrame([*items, (None, "x"), (9, None)], "item_id long, text string")
    clean = [(100 + i, words(60)) for i in range(5)] + [(None, None), (7, ""), (7, "")]
    dirty = [(i, f"{words(9)} {text} {words(9)}") for i, text in items]
    docs = table([*clean, *dirty]).withColumn("own", F.lit(1)).withColumn("digest", F.lit("x"))
    for per_pass in (1, 2, 100):
        kept = decontamination.drop_contaminated(docs, benchmark, per_pass=per_pass)
        assert kept.columns == docs.columns
        # No task holds more than one block.
        assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1
        assert sorted(((x["doc_id"], x["text"]) for x in kept.collect()), key=str) == sorted(clean, key=str)
        found = decontamination.find_passages(docs, benchmark, per_pass=per_pass)
        assert sorted((x["doc_id"], x["item_id"]) for x in found.collect()) == [(i, i) for i in range(5)]
    assert decontamination.drop_contaminated(docs, benchmark.limit(0)).count() == docs.count()
    assert decontamination.find_passages(docs, benchmark.limit(0)).count() == 0
