"""Operators that read one text at a time, against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from odd_rows import ODD
from shopmart.llm import compression_classifier, decontamination, pii, quality_rules, secrets, token_counts
from shopmart.llm.tokens import END_TEXT, Encoder

FINDERS = [
    pii.find_personal_data,
    secrets.find_secrets,
    token_counts.count_tokens,
    quality_rules.judge,
    lambda docs: compression_classifier.score(docs, compression_classifier.train({}, {})),
]


@pytest.mark.parametrize("find", FINDERS)
def test_one_result_per_row(table, find):
    got = find(table(ODD)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD)
    assert find(table([])).count() == 0


# ---------------------------------------------------------------- tokens


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_library(exact):
    enc, r = Encoder(), random.Random(1)
    letters = [chr(c) for c in range(0x250)] + [" ", "\n", "a", "1", "'s", END_TEXT, "漢", " "] * 30
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 60)))
        ids = exact.encode(text, add_special_tokens=False).ids
        assert enc.ids(text) == ids
        assert token_counts.encode_spliced(text, enc, 16, 4) == ids


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000, "ab " * 2000, "é" * 2000, "a b" * 900 + " \n" * 700 + "x" * 500 + " y"])
def test_chunks_widen_until_they_fit(exact, text):
    assert token_counts.encode_spliced(text, Encoder(), 256, 16) == exact.encode(text, add_special_tokens=False).ids


def test_counts(sample, exact):
    want = {r["doc_id"]: len(exact.encode(r["text"], add_special_tokens=False).ids) for r in sample.collect()}
    got = token_counts.count_tokens(sample, chunk=700, overlap=50).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)


# ---------------------------------------------------------------- personal data


def plain_personal(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    found = [(*m.span(), k) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m.group())]
    return sorted(found, key=lambda f: (f[0], list(rules).index(f[2])))


def test_plain_personal_data():
    r = random.Random(2)
    for letters in ("ab.@1-2. 5+%", "123..0456", "+1234567890 -()", "4 1-"):
        for _ in range(8000):
            text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
            assert pii.detect(text) == plain_personal(text)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail john dot smith at example dot com now", "email", "john dot smith at example dot com"),
        ("j.doe [at] mail (dot) org!", "email", "j.doe [at] mail (dot) org"),
        ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("jo​hn@exam​ple.com", "email", "jo​hn@exam​ple.com"),
        ("+١ (٢٣٤) ٥٦٧-٨٩٠١", "phone", "+١ (٢٣٤) ٥٦٧-٨٩٠١"),
        ("call +1 double five 5 one two three four five six", "phone", "+1 double five 5 one two three four five six"),
        ("card four one one one 1111 1111 1111.", "card", "four one one one 1111 1111 1111"),
        ("192[dot]168[dot]0[dot]1", "ip", "192[dot]168[dot]0[dot]1"),
        ("10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"),
    ],
)
def test_disguises_map_back(text, kind, span):
    base, spans = pii.find(text)
    assert set(base) <= set(spans)
    assert kind in {k for a, b, k in spans if text[a:b] == span}
    assert f"[{kind.upper()}]" in pii.redact_text(text)


@pytest.mark.parametrize("text", ["look at the dot com boom", "one two", "at noon, dot the i", "Straße 12, 1990-2000", "наш дом"])
def test_clean_texts_stay(text):
    assert pii.redact_text(text) == text


def test_redact_keeps_rows_and_columns(table):
    docs = table([*ODD, (7, "a.b@c.de and 10.0.0.1")])
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert Counter(r["text"] for r in got.collect()) == Counter([*(t for _, t in ODD), "[EMAIL] and [IP]"])


def test_personal_query_digest(sample):
    got = {r["doc_id"]: r for r in pii.find_personal_data(sample).collect()}
    for row in sample.collect():
        spans = plain_personal(row["text"])
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert got[row["doc_id"]]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- secrets


def plain_secrets(text):
    assign = r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = [(*m.span(), "assign") for m in re.finditer(assign, text) if len(m.group(1)) >= 8]
    found += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found, key=lambda f: (f[0], ["assign", "access", "hex"].index(f[2])))


def test_fixed_shapes(sample):
    r = random.Random(4)
    pieces = ["Token", "token", "=", ":", " ", '"', "abc12345", "AKIA", "AKIAQWERTYUIOPASDF", "0f" * 16, "api_key", "APIKEY", "x"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 12))) for _ in range(5000)]
    for text in texts + [x["text"] for x in sample.collect()]:
        assert secrets.base_spans(text) == plain_secrets(text)


def test_guess_cost_of_parts():
    cost = secrets.GuessCost(("correct", "horse"))
    for cheap in ("correct", "c0rrect", "aaaaaaaaaa", "qwertyuiop", "abcdefgh", "19870512", "correcthorse", "xyxyxyxyxy"):
        assert cost(cheap) < 5, cheap
    assert cost("x9$kQ2!vLm") == 10
    # Never more than brute force.
    r = random.Random(5)
    for _ in range(300):
        value = "".join(r.choice("ab1$") for _ in range(r.randint(1, 20)))
        assert 0 < cost(value) <= len(value)


def test_values_in_credential_contexts():
    cost = secrets.GuessCost()
    for text, value in [('pwd: "x9$kQ2!vLm"', "x9$kQ2!vLm"), ("my passphrase is Zk!93-Qpw&1 ok", "Zk!93-Qpw&1")]:
        assert [text[a:b] for a, b, k in secrets.find(text, cost)[1] if k == "guess"] == [value]
    for text in ("password=hunter2", "pass = Summer2024", "the key is necessarily", "auth: 'no one else'", "pin: aaaaaaaaaaaa"):
        assert secrets.find(text, cost)[1] == []


def guessed(text):
    return [text[a:b] for a, b, k in secrets.find(text, secrets.GuessCost())[1] if k == "guess"]


def test_values_a_fixed_shape_covers_in_part():
    text = "password = Tr0ub4dor9&3xQ!7#k"
    assert guessed(text) == ["Tr0ub4dor9&3xQ!7#k"]
    assert secrets.base_spans(text) == [(0, 21, "assign")]
    assert guessed("password = Tr0ub4dor93xQ7k") == []


def test_values_of_letters_are_priced():
    assert guessed("pwd=qzxvkjwpmrtyhgfd") == ["qzxvkjwpmrtyhgfd"]
    assert guessed('passphrase: "zqxv kjwp mrty hgfd"') == ["zqxv kjwp mrty hgfd"]
    assert guessed("the pin is qzxvkjwpmrtyhgfd") == ["qzxvkjwpmrtyhgfd"]
    for text in ("the password is necessarily", "the token is distributed", "pass: understanding", 'secret: "it is not"'):
        assert guessed(text) == [], text


# ---------------------------------------------------------------- quality rules


def test_repeated_words():
    r = random.Random(6)
    for _ in range(2000):
        words = [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 30))]
        count = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if count[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        assert quality_rules.repeated_words(words) == len(covered)


def test_boilerplate_goes_by_host_and_copies_count_once(table):
    body = "these are {0} words of {0} its own {0} text that no {0} other has {0} here"
    rows = [(i, f"Menu and more of the menu\n{body.format(chr(97 + i))}", "a") for i in range(12)]
    rows += [(100 + i, "a line of a text that has many copies but is one text all the same", "a") for i in range(30)]
    rows += [(200, f"Menu and more of the menu\n{body.format('z')}", "b"), (201, f"{rows[0][1]}", None)]
    rows += [(300 + i, f"menu and MORE of the menu {i}\n1 2 3 4 5", "c") for i in range(12)]
    docs = table(rows)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert all(got[i]["kept"] and list(got[i]["removed_lines"]) == [0] for i in range(12))
    assert all(got[100 + i]["kept"] and not got[100 + i]["removed_lines"] for i in range(30))
    assert got[200]["removed_lines"] == [] and got[201]["removed_lines"] == []
    assert not any(got[300 + i]["kept"] for i in range(12))  # both lines are shared, nothing is left
    clean = {r["doc_id"]: r["text"] for r in quality_rules.clean(docs).collect()}
    assert clean[3] == body.format("d") and clean[200] == rows[42][1] and len(clean) == 44
    assert quality_rules.clean(docs).columns == docs.columns


# ---------------------------------------------------------------- benchmark passages


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()))


def plain_matches(text, items, least):
    def bag(words):
        return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])

    found = {}
    words = plain_words(text)
    for item_id, item in items:
        item_words = plain_words(item)
        n = min(len(words), len(item_words))
        for s in range(len(words) - n + 1) if n else []:
            a, b = bag(words[s : s + n]), bag(item_words)
            common = sum((a & b).values())
            similarity = common / (sum(a.values()) + sum(b.values()) - common)
            if similarity >= least:
                found[item_id] = max(similarity, found.get(item_id, 0))
    return found


def test_passages_match_all_windows():
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([3, 30, 31, 50])))) for i in range(12)]
    benchmark = decontamination.Benchmark(items)
    missed = total = 0
    for _ in range(150):
        words = r.choice(items)[1].split()
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = "other"
        text = " ".join(r.choices(vocabulary, k=r.randint(0, 60))) + ". " + " ".join(words).upper() + ", " + " ".join(r.choices(vocabulary, k=20))
        want = plain_matches(text, items, 0.8)
        got = {m[0]: m[4] for m in benchmark.matches(text, decontamination.RADIUS, 0.8)}
        assert set(got) <= set(want)
        total += len(want)
        missed += len(set(want) - set(got))
        for item_id, similarity in want.items():
            if similarity == 1:
                assert got[item_id] == 1
    assert total > 50 and missed == 0


def test_index_finds_all_within_radius(monkeypatch):
    r = np.random.default_rng(1)
    items = r.integers(0, 1 << 63, 300).astype(np.uint64)
    windows = items[r.integers(0, 300, 500)].copy()
    for i in range(len(windows)):
        for b in r.choice(64, r.integers(0, 28), replace=False):
            windows[i] ^= np.uint64(1 << int(b))
    for radius, pairs in ((3, 1 << 20), (15, 1 << 20), (23, 1 << 20), (23, 2000)):
        monkeypatch.setattr(decontamination, "_PAIRS", pairs)
        window, item, distance = decontamination.BlockIndex(items).within(windows, radius)
        want = {(w, i) for w in range(500) for i in range(300) if int(windows[w] ^ items[i]).bit_count() <= radius}
        assert set(zip(window.tolist(), item.tolist())) == want and (distance <= radius).all()


def test_passages_of_one_text_far_apart(monkeypatch):
    monkeypatch.setattr(decontamination, "_STRETCH", 16)
    item = " ".join(f"i{k}" for k in range(40))
    near = " ".join("other" if k == 20 else f"i{k}" for k in range(40))
    benchmark = decontamination.Benchmark([(1, item), (2, "x1 x2 x3 x4 x5 x6 x7 x8")])
    text = " ".join([near, *("w" for _ in range(200)), item, *("v" for _ in range(99)), item, "x1 x2 x3 x4 x5 x6 x7 x8"])
    found = benchmark.matches(text, decontamination.RADIUS, 0.7)
    assert [m[:2] for m in found] == [(1, 240), (2, 419)] and all(m[3:] == (0, 1) for m in found)


def test_long_texts_hash_in_parts(monkeypatch):
    text = "ab, cd ef" * 50 + "x" * 300 + " yz"
    whole = decontamination.word_hashes(text)
    for size in (5, 64):
        monkeypatch.setattr(decontamination, "_CHUNK", size)
        assert (decontamination.word_hashes(text) == whole).all()


def test_contaminated_documents_go(spark, table):
    item = "the quick brown fox jumps over the lazy dog and then it sleeps all day long"
    benchmark = spark.createDataFrame([(1, item), (2, None), (None, "x y z"), (3, "")], "item_id long, text string")
    docs = table([*ODD, (8, f"Before it. {item.title()}! After it."), (9, "a clean text")])
    assert [(r["doc_id"], r["item_id"]) for r in decontamination.find_passages(docs, benchmark).collect()] == [(8, 1)]
    kept = decontamination.drop_contaminated(docs, benchmark, per_pass=1)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter([*(d for d, _ in ODD), 9])
    assert decontamination.find_passages(docs, benchmark.limit(0)).count() == 0


# ---------------------------------------------------------------- classifier


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = compression_classifier.fit(docs, labels)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in compression_classifier.score(docs, model).collect() if r["doc_id"] in truth and r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    right = np.mean([r["predicted"] == truth[r["doc_id"]] for r in rows])
    good = np.array([r["score"] for r in rows if truth[r["doc_id"]] == 1])
    bad = np.array([r["score"] for r in rows if truth[r["doc_id"]] == 0])
    area = np.mean(good[:, None] > bad[None]) + np.mean(good[:, None] == bad[None]) / 2
    assert right > 0.95 and area > 0.95 and (good >= 0.3).mean() > 0.99


def test_labels_missing(spark, table):
    docs = table([(1, "some text"), (2, "other text")])
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    for labels in (one, one.limit(0)):
        got = compression_classifier.score(docs, compression_classifier.fit(docs, labels)).collect()
        assert len(got) == 2 and all(0 <= r["score"] <= 1 for r in got)
