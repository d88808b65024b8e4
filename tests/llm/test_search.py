import collections
import math
import random
import re

import numpy as np
import pytest

from tidewater.llm import search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k):
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * c.total() * n_docs) // max(n_terms, 1)
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return collections.Counter(out)


def fixture():
    rng = random.Random(6)
    words = [f"t{i}" for i in range(60)] + ["Été", "ÀB", "x9", "naïve", "Ω"]
    make = lambda n: rng.choice([" ", "-", "\x00", "\n"]).join(rng.choice(words[: rng.choice([8, 65])]) for _ in range(n))
    docs = [(i, make(rng.randrange(60))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(90)]  # ties beyond k
    docs += [(3, docs[3][1]), (None, docs[3][1]), (None, docs[4][1]), (900, None), (901, ""), (902, " .,"), (903, "t1 " * 5000)]
    items = [(i, make(rng.randrange(12))) for i in range(12)] + [(50, docs[3][1]), (51, None), (52, "  "), (53, "nowhere"), (2, "t5 t6"), (None, "t7")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_finds_what_scoring_all_finds(spark, monkeypatch, small):
    """In small blocks, matrices and passes, too."""
    if small:
        for name, value in {"BLOCK_DOCS": 7, "CELLS": 200, "PASS_QUERIES": 9, "PASS_TERMS": 40}.items():
            monkeypatch.setattr(search, name, value)
    docs, items = fixture()
    own = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], "doc_id long, text string, score int, salt int, item_id int").repartition(3)
    asked = spark.createDataFrame([(*q, "y") for q in items], "item_id long, text string, rank string")
    got = search.search(own, asked, k=10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == plain(docs, items, 10)


def test_search_without_documents_or_queries(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a c")], "item_id long, text string")
    assert search.query(docs.limit(0), items).count() == 0 and search.query(docs, items.limit(0)).count() == 0
    assert search.query(docs.filter("doc_id = 9"), items).columns == ["item_id", "rank", "doc_id", "score"]
    assert [r["doc_id"] for r in search.query(docs, items).orderBy("rank").collect()] == [2, 1]  # the shorter one first


def test_bytes_bound_impacts():
    rng = np.random.default_rng(1)
    tf, m = rng.integers(1, 1 << 20, 20000), rng.integers(50, 1 << 24, 20000)
    u = search.impact(tf, m)
    q = search.rounded_up(u)
    assert (u < search._ONE).all() and (search.LOWER[q] <= u).all() and (u <= search.UPPER[q]).all()


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(search, "_CHUNK", 5)
    text = "Ab, c" * 9 + "d" * 40 + " é-é"
    assert [t.decode() for part in search.terms_of(text.encode()) for t in part] == terms(text)
