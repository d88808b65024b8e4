import random

import numpy as np
import pytest

from tidewater.llm import bpe, html, langid, minhash, packing, pii, rules, simhash


def test_large_leaves_are_split_again_and_lose_no_link(spark, monkeypatch):
    """Small leaves and samples: a first tree of several levels, then leaves with trees of their own."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    near = base[:300] ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 63, 300).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    pairs = {(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :][np.bitwise_count(fps[i + 1 :] ^ a) <= 2]}
    monkeypatch.setattr(simhash, "LEAF", 40)
    monkeypatch.setattr(simhash, "SAMPLE", 64)
    monkeypatch.setattr(simhash, "FULL", 90)
    monkeypatch.setattr(simhash, "SPLIT_SAMPLE", 64)
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    got = simhash.edges(df).collect()
    a, b = (np.array([r[c] for r in got], np.int64).view(np.uint64) for c in ("a", "b"))
    found = dict(zip(*(x.tolist() for x in simhash.stars(a, b))))
    want = dict(zip(*(x.tolist() for x in simhash.stars(*(np.array(x, np.uint64) for x in zip(*pairs))))))
    assert len(pairs) >= 290 and found == want


def test_prefixes_hold_all_similar_pairs(spark):
    rng = random.Random(8)
    common = rng.sample(range(1 << 40), 60)
    own = {}
    for i in range(120):
        own[i] = np.unique(np.array(common[: rng.randrange(30, 60)] + rng.sample(range(1 << 40), rng.randrange(0, 25)), np.uint64))
    table = spark.createDataFrame([(k, bytearray(v.tobytes())) for k, v in own.items()], "s long, own binary")
    roots = spark.createDataFrame([], "node long, root long")
    got = {(r["a"], r["b"]) for r in minhash.across(minhash.prefixes(table), roots, True).collect()}
    assert {(a, b) for a in own for b in own if a < b and minhash.similarity(own[a], own[b]) >= minhash.LEAST} <= got


def test_rows_with_one_id_and_unlike_texts_both_stay(spark):
    rows = [(5, "one two three four five six"), (5, "seven eight nine ten eleven"), (6, "one two three four five six"), (None, "one two three four five six")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted((k or 0, t) for k, t in rows if k != 6)


def test_clashing_columns(spark):
    pieces = spark.createDataFrame([(i, i % 7 + 1, 1, 2, 3, 4) for i in range(40)], "doc_id long, length long, _n int, _s int, sequence_id int, offset int")
    out = packing.pack(pieces, ["doc_id"], capacity=10)
    assert out.columns == ["doc_id", "length", "_n", "_s", "sequence_id", "offset"] and {r["_n"] for r in out.collect()} == {1}
    docs = spark.createDataFrame([(1, "a b\na b", "kept")], "doc_id long, text string, _words string")
    assert rules.statistics(docs).first()["_words"] == "kept"
    mixed = spark.createDataFrame([(1, "mail a@b.example now", 9, 8)], "doc_id long, text string, _row int, email int")
    assert pii.mask(mixed).first().asDict() == {"doc_id": 1, "text": "mail <EMAIL> now", "_row": 9, "email": 8}


def test_many_spans_in_one_text(spark):
    text = " ".join(f"to user{i}@host.example or +44 20 7946 {i:04d}." for i in range(1500))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert (pii.query(docs).first()["n_email"], pii.query(docs).first()["n_phone"]) == (1500, 1500)
    assert pii.mask(docs).first()["text"] == " ".join(["to <EMAIL> or <PHONE>."] * 1500)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>", "A  b\n   c"),
        ("<table><tr><td rowspan=0>A<td>b<tr><td>c<tr><td>d</table>", "A  b\n   c\n   d"),
        ("<table><tr><td colspan=2>wide wide wide<td>z<tr><td>a<td>b<td>c</table>", "wide wide wide  z\na  b            c"),
        ("<table><tr><th>n<th>x<tr><td colspan=1000>all<tr><td>b<td>22</table>", "n  x\nall\nb  22"),
        ('<div style="visibility:hidden">no<span style="visibility: visible">yes</span>no</div>end', "yes\nend"),
        ('<div style="display:none">no<span style="visibility: visible">no</span></div>end', "end"),
        ('<table><tr style="visibility:collapse"><td>a<tr><td>b</table>', "b"),
        ("<table><tr><td>x" * 60 + "deep", "\n".join(["x"] * 59 + ["xdeep"])),
    ],
)
def test_cells_that_span_and_visible_parts(page, text):
    assert html.render(page) == text


def test_empty_tables(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
    assert langid.query(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_the_learned_sample_does_not_depend_on_partitions(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the of and", "der die und", "le la et"][i % 3].split()) for _ in range(8)), ["en", "de", "fr"][i % 3] if i % 40 else "xx") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, other = (langid.train(docs.repartition(n), sample=90) for n in (1, 7))
    assert one.langs == ["de", "en", "fr", "xx"] and (one.weights == other.weights).all() and one.temperature == other.temperature


def test_few_usable_texts_among_many_null_and_repeated_ones_are_learned(spark):
    """A language of one usable text, of one row repeated, and rows that share an id."""
    rows = [(i, "the of and to in", "en") for i in range(400)] + [(i, None, "fr") for i in range(3000)] + [(5000, "le la et un", "fr")]
    rows += [(9, "der die und das", "de")] * 700 + [(3, f"el los y {i}", "es") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample=40)
    assert model.langs == ["de", "en", "es", "fr"]
    assert model.predict("los y el")[0] == "es"  # one text alone is too little to be told by


def test_more_languages_than_a_model_holds_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    docs = spark.createDataFrame([(i, "some text", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        langid.train(docs)


def test_names_are_compared_without_case(spark):
    docs = spark.createDataFrame([(1, "no", 3)], "doc_id long, text string, Lang_Pred int")
    model = langid.Model([], np.zeros(langid.FEATURES), np.zeros((langid.FEATURES, 0)), np.zeros(0), 1.0)
    assert langid.predict(docs, model).columns == ["doc_id", "lang_pred", "score"]
    ids = spark.createDataFrame([(1, "no", b"")], "doc_id long, text string, IDS binary")
    for call in (lambda: bpe.encode(ids, "path"), lambda: bpe.decode(ids.withColumnRenamed("text", "Decoded"), "path", "IDS")):
        with pytest.raises(ValueError, match="exists"):
            call()
