import random

import pytest

from tidewater.llm import pii

CONTEXTS = {"phone": ("call", "today"), "email": ("write", "soon"), "ip": ("host", "answers"), "card": ("charge", "please")}


def luhn(digits):
    """The digits with the one that makes them pass."""
    total = sum(d if i % 2 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(map(int, reversed(digits))))
    return digits + str(-total % 10)


def value(rng, kind, seen):
    """An identifier that the fixed patterns find, or one of a form that they miss."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    if kind == "phone":
        return f"+44{n(9)}" if seen else f"0{n(3)}/{n(6)}"
    if kind == "email":
        return f"u{n(4)}@host{n(2)}.example" if seen else f"u{n(4)}@intranet"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4)) if seen else f"fe80:{n(4)}:{n(4)}"
    return luhn("4" + n(14)) if seen else f"4{n(3)}x{n(6)}x{n(4)}"


@pytest.mark.parametrize("unseen", [0.1, 0.3, 0.5])
def test_unseen_forms_are_discovered(spark, unseen):
    """Recall and precision of forms that the fixed patterns miss, by their contexts; other numbers stay."""
    rng = random.Random(int(unseen * 100))
    prose = "the of and in wood ship port day old new great small".split()
    words = lambda: " ".join(rng.choice(prose) for _ in range(rng.randrange(3, 9)))
    rows, planted = [], {}
    for i in range(3000):
        kind = rng.choice(list(CONTEXTS))
        seen = rng.random() >= unseen
        before, after = CONTEXTS[kind]
        v = value(rng, kind, seen)
        text = f"{words()} {before} {v} {after} {words()}"
        if not seen:
            planted[i] = (kind, v)
        # Numbers that identify nobody, in prose and even in the contexts.
        other = rng.choice([f"{words()} {rng.randrange(1800, 2000)} {words()}", f"order {rng.randrange(10**7, 10**8)} of {words()}", f"{before} {rng.randrange(100)} times, {words()}", f"page {rng.randrange(10**6, 10**7)}, {words()}"])
        rows.append((i, f"{text}. {other}" if rng.random() < 0.5 else f"{other} {text}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = {}
    for r in pii.query(docs).select("doc_id", "spans").collect():
        for s in filter(None, r["spans"].split(",")):
            kind, a, b = s.split(":")
            found.setdefault(r["doc_id"], []).append((kind, texts[r["doc_id"]][int(a) : int(b)]))
    base = pii.scanned(docs).selectExpr("kept.doc_id i", *pii.KINDS).collect()
    fixed = {(r["i"], k, texts[r["i"]][s["start"] : s["stop"]]) for r in base for k in pii.KINDS for s in r[k]}
    more = {(i, k, v) for i, x in found.items() for k, v in x} - fixed
    want = {(i, kind, v) for i, (kind, v) in planted.items()}
    hits = more & want
    assert len(hits) >= 0.9 * len(want) and len(hits) >= 0.9 * len(more)


def test_nothing_is_discovered_without_seeds(spark):
    docs = spark.createDataFrame([(i, f"order {10**7 + i} of wood from page {i}") for i in range(200)] + [(900, None), (901, "")], "doc_id long, text string")
    assert {r["spans"] for r in pii.query(docs).collect()} == {""}
