import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.llm import digest, lm, pii, rules, simhash, suffix

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    w = re.findall(WORD, text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics(spark):
    rng = random.Random(1)
    texts = ["", " \n\t", None, "a b c a b c", "x\nx\n\n y\nx", "é # * é\x0b\x0c|<>", "a " * 4000, "the same line\n" * 50]
    texts += [" ".join(rng.choice("ab c\nd &".split(" ")) for _ in range(rng.randrange(40))) for _ in range(100)]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id int, text string, n_words int")
    for r in rules.statistics(docs).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(texts[r["doc_id"]] or "")


def test_rules_tell_junk_from_prose(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    clean = lambda i: " ".join(word() for _ in range(80 + i % 50))
    junk = lambda i: " ".join(word() + rng.choice(["%%%", "&&&", "***"]) for _ in range(80 + i % 50))
    docs = spark.createDataFrame([(i, junk(i) if i % 5 == 0 else clean(i), "k") for i in range(300)] + [(900, "short", "k"), (901, None, "k")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(150)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in rules.query(docs, labels).collect()}
    assert all(got[i]["kept"] == (i % 5 != 0) for i in range(300))
    assert got[900]["base_failed"] and got[901]["base_failed"] and not got[900]["kept"]
    kept = rules.keep(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 240
    assert rules.train(docs, labels.limit(0)) == []  # nothing to learn from: the base alone decides
    assert rules.query(docs.limit(0), labels).count() == 0


def test_fingerprints(spark):
    texts = {5: "Éa  b", 4: "ÉA\tB ", 3: "ﬁ", 2: "FI", None: None, 1: "", 9: "Straße", 10: "STRASSE", 11: "z" * 100_000}
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, fingerprint string")
    assert {r["doc_id"]: r["group_id"] for r in digest.groups(docs).collect()} == {5: 4, 4: 4, 3: 2, 2: 2, None: 1, 1: 1, 9: 9, 10: 9, 11: 11}
    got = {r["doc_id"]: r for r in digest.query(docs).collect()}
    ordered = sorted(texts, key=lambda k: -1 if k is None else k, reverse=True)
    for i, k in enumerate(ordered):
        text, after = texts[k] or "", texts[ordered[(i + 1) % len(ordered)]] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert got[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[k]["n_chars"] == len(text)
        assert got[k]["near_edited"] == float(got[k]["fingerprint"] == got[k]["edited_fingerprint"])
    assert got[10]["near_next"] == 1.0 and got[9]["near_next"] == 0.0
    assert digest.query(docs.limit(0)).count() == 0


def test_collisions_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(digest, "wide_hash", lambda c: F.lit("same"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    assert {r["doc_id"]: r["group_id"] for r in digest.groups(docs).collect()} == {1: 1, 2: 2, 3: 1}


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
]


def test_personal_data(spark):
    rng = random.Random(3)
    texts = [None, "", "a@b.c_d@e.f x@y x@y.z@w.q .@a-.-", "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1", "4111 1111 1111 1111 4111-1111-1111-1111-1 😀 4111111111111111", "+1 (988) 555-2485 ++1 2 3 +1--------2", "a@" * 50 + "b.c", "1 " * 200, "a.b@c" + ".d" * 20_000, "9" * 50_000]
    texts += ["".join(rng.choice("0123456789011.+-() @ab._%😀é\n") for _ in range(rng.randrange(80))) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in pii.query(docs).collect():
        text = texts[r["doc_id"]] or ""
        want = [f"{k}:{m.start()}:{m.end()}" for k, rx, ok in PLAIN for m in re.finditer(rx, text) if ok(m.group())]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), text[:99]
        assert [r[f"n_{k}"] for k, _, _ in PLAIN] == [sum(w.startswith(k) for w in want) for k, _, _ in PLAIN]
        assert set(want) <= set(filter(None, r["spans"].split(",")))
    assert pii.query(docs.limit(0)).count() == 0


def test_patterns_find_what_the_base_misses(spark):
    rows = [(i, f"order {i} ring +49 30 1{i:06d} today, contact 10.0.{i}.{i} now") for i in range(40)]
    rows += [(100, "contact 10.0.999.7 now"), (101, "chapter 12 of 30")]
    got = {r["doc_id"]: r["spans"] for r in pii.query(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[100] == "ip:8:18" and got[101] == ""


def test_masking_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x a@b.cc y +1 (988) 555-2485", 28, "q"), (2, None, None, "z"), (3, "clean", 5, None)], "doc_id long, text string, n_chars int, base string")
    out = pii.mask(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {(1, "x <EMAIL> y <PHONE>", 19, "q"), (2, None, None, "z"), (3, "clean", 5, None)}


@pytest.mark.parametrize("range_bytes", [1 << 30, 200, 40])
def test_followers_where_one_id_and_null_hold_most_rows(spark, range_bytes):
    rng = random.Random(range_bytes)
    word = lambda: "".join(rng.choice("abcÉß ") for _ in range(rng.randrange(0, 12)))
    rows = [(rng.choice([7, 7, 7, None, None, rng.randrange(-50, 50), -(1 << 63), (1 << 63) - 1]), rng.choice([None, word(), word()])) for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    order = sorted(((r["doc_id"], r["text"], r["h"]) for r in hashed), key=lambda r: (r[0] is None, -(r[0] or 0), r[2], r[1]))
    want = collections.Counter((r[0], r[1], order[(i + 1) % len(order)][1]) for i, r in enumerate(order))
    got = digest.followed(docs, range_bytes=range_bytes)
    assert collections.Counter((r["id"], r["text"], r["next_text"]) for r in got.collect()) == want


def test_ids_called_like_the_new_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "A  b")], "fingerprint long, text string")
    got = digest.groups(docs, "fingerprint")
    assert got.columns == ["fingerprint", "fingerprint_", "group_id"] and {r["fingerprint"]: r["group_id"] for r in got.collect()} == {1: 1, 2: 1}
    assert simhash.fingerprints(docs.withColumnRenamed("fingerprint", "fp"), "fp").columns == ["fp", "fp_"]
    named = lm.scores(docs.withColumnRenamed("fingerprint", "n_words"), "n_words")
    assert named.columns == ["n_words", "n_words_", "log_score"] and sorted(r["n_words"] for r in named.collect()) == [1, 2]
    texts = docs.withColumn("fingerprint", F.lit("x"))
    for refused in (lambda: lm.scores(texts, "fingerprint"), lambda: suffix.dedup(texts, "fingerprint")):
        with pytest.raises(TypeError, match="integer"):
            refused()
