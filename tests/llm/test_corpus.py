import collections
import hashlib
import math
import os
import random
import zlib

import numpy as np
import pytest

from tidewater.llm import html, langid, lm, suffix
from tidewater.llm.rindex import RunIndex

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("depth", [3, 8, 50])
def test_index_finds_smallest_owners(depth):
    rng = random.Random(depth)
    for _ in range(8):
        alphabet = b"ab\x00\xffcde"[: rng.randrange(1, 8)]
        make = lambda: bytes(rng.choice(alphabet) for _ in range(rng.randrange(depth, depth + 26)))
        strings = [make() for _ in range(40)]
        strings += [s[: rng.randrange(depth, len(s) + 1)] for s in strings]
        owners = np.array([rng.randrange(1000) for _ in strings])
        least = {}
        for s, o in zip(strings, owners.tolist()):
            for i in range(len(s) - depth + 1):
                least[s[i : i + depth]] = min(least.get(s[i : i + depth], o), o)
        patterns = strings + [make() for _ in range(30)]
        for p, got in zip(patterns, RunIndex(strings, owners, depth).least_owners(patterns)):
            assert got.tolist() == [least.get(p[i : i + depth], -1) for i in range(len(p) - depth + 1)]


@pytest.mark.parametrize("small", [False, True])
def test_repeated_passages(spark, monkeypatch, small):
    if small:  # groups that one index can't hold
        monkeypatch.setattr(suffix, "INDEX_BYTES", 400)
    rng = random.Random(1)
    base = "".join(rng.choice("ab") for _ in range(400))
    rows = [(i, base[rng.randrange(200) :][: rng.randrange(200)] + "é" * rng.randrange(3) + "ab" * rng.randrange(60)) for i in range(40)]
    rows += [(100, None), (101, "x" * 3000), (102, "x" * 49), (103, "x" * 50), (104, base), (104, base), (None, base), (105, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], doc)
    want = collections.Counter()
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            if doc is not None and first[data[i : i + 50]] < doc:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want[doc, len(data), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()] += 1
    assert collections.Counter(map(tuple, suffix.query(docs).collect())) == want
    assert suffix.query(docs.limit(0)).count() == 0


def test_passages_are_cut_from_documents(spark):
    line = "this sentence is quoted by everyone, word for word, again and again. "
    docs = spark.createDataFrame([(1, line + "own text", 5, "a"), (2, "before " + line + "after", 5, None), (3, None, None, "c")], "doc_id long, text string, n_chars int, kept string")
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["text"] == line + "own text" and got[1]["n_chars"] == 5 and got[3]["text"] is None
    assert got[2]["text"] == "before after" and got[2]["n_chars"] == 12


def test_scores(spark):
    texts = {1: "the cat sat", 2: "the cat ran", 3: "The  cat\tsat down", 4: "zzz", 5: "", 6: None, 7: "the"}
    docs = spark.createDataFrame([(k, v, 0) for k, v in texts.items()], "doc_id long, text string, n_words int")
    words = {k: (v or "").lower().split() for k, v in texts.items()}
    grams = {k: [collections.Counter(zip(*(w[i:] for i in range(n + 1)))) for n in range(3)] for k, w in words.items()}
    for r in lm.query(docs).collect():
        own, w, total = r["doc_id"], words[r["doc_id"]], 0.0
        count = lambda *g: sum(c[len(g) - 1][g] for k, c in grams.items() if k != own)
        size = sum(len(v) for k, v in words.items() if k != own)
        for p in range(len(w)):
            penalty = 0.0
            for n in range(min(3, p + 1), 0, -1):
                g = tuple(w[p - n + 1 : p + 1])
                if n == 1:
                    value = count(*g) / size if count(*g) else 1 / (size + 1)
                elif not count(*g):
                    penalty += math.log10(0.4)
                    continue
                else:
                    value = count(*g) / count(*g[:-1])
                total += math.log10(value) + penalty
                break
        assert r["n_words"] == len(w) and abs(r["mean_log10"] - (total / len(w) if w else 0)) < 2e-6
    assert lm.query(docs.limit(0)).count() == 0


def test_languages(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "12 !!", "en"), (10**6 + 2, "the and of", None), (None, "und der die", "de")], docs.schema)
    got = {r["doc_id"]: r for r in langid.query(docs.unionByName(odd)).collect()}
    assert got[10**6]["lang_pred"] == "und" and got[10**6 + 1]["lang_pred"] == "und" and got[10**6 + 2]["lang_pred"] == "en"
    held = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in langid.query(docs.filter("lang = 'xx'").unionByName(odd.filter("doc_id = 1000000"))).collect()} == {"und"}


def test_a_frequent_minimizer_is_dealt_to_many_shards(monkeypatch):
    """A phrase that different text follows each time: no task gets all of its segments, and equal strings still meet."""
    import pyarrow as pa

    monkeypatch.setattr(suffix, "INDEX_BYTES", 10_000)
    rng, shards = random.Random(4), 8
    phrase = bytes(rng.choice(b"abcdefgh") for _ in range(50))
    texts = [phrase[10:] + bytes(rng.choice(b"abcdefgh") for _ in range(60)) for _ in range(600)] + [phrase + b"the same end"] * 3
    blocks = [pa.table({"block": pa.array([b] * 201, pa.int32()), "id": pa.array(range(b, 603, 3), pa.int64()), "data": pa.array(texts[b::3], pa.binary())}) for b in range(3)]
    group = lambda tables, key, k: pa.concat_tables(tables).filter(pa.compute.field(key) == k)
    asked = [suffix.ask_minimizers(t, shards) for t in blocks]
    shared = [suffix.shared_minimizers(group(asked, "shard", s)) for s in range(shards)]
    sought = [suffix.ask_segments(t, group(shared, "block", b), shards).cast(suffix._SEGMENTS) for b, t in enumerate(blocks)]
    sent = [group(sought, "shard", s) for s in range(2 * shards)]
    whole = [sum(len(suffix._unpack(b, n, np.uint64)) for b, n in zip(t["minimizers"].to_pylist(), t["n"].to_pylist()) if b is not None) for t in sent]
    n_strings = [sum(t["n"].to_pylist()) for t in sent[shards:]]
    assert sum(whole) < 100 and sum(n_strings) > 5_000 and max(n_strings) < 2 * sum(n_strings) / shards
    told = pa.concat_tables([suffix.answer(t) for t in sent if t.num_rows])
    told = pa.concat_tables([told, *shared], promote_options="default")
    got = {}
    for b, t in enumerate(blocks):
        out = suffix.cut_out(t, group([told], "block", b), shards)
        got |= dict(zip(out["id"].to_pylist(), out["kept"].to_pylist()))
    seen = {}
    for doc, data in enumerate(texts):
        gone = bytearray(len(data))
        for i in range(len(data) - 49):
            if seen.setdefault(data[i : i + 50], doc) < doc:
                gone[i : i + 50] = bytes([1]) * 50
        assert got[doc] == bytes(c for c, g in zip(data, gone) if not g)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("plain < text &amp; more", "plain < text & more"),
        ("<p>One  two<br>three<p>four", "One two\nthree\n\nfour"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n    3. x\n    4. y\n- c"),
        ("<table><tr><th>Name<th>Qty<tr><td>long name<td>1<tr><td colspan=2>wide</table>", "Name       Qty\nlong name  1\nwide"),
        ("<pre> a\n  b</pre>", " a\n  b"),
        ("<div hidden>no</div><div style='display: none'>no</div><script>no</script><title>no</title>yes", "yes"),
        ("<div>" * 20_000 + "deep", "deep"),
        ("<li><p>first<p>second", "- first\n\n  second"),
        ("</div></p>stray<b>", "stray"),
    ],
)
def test_pages(page, text):
    assert html.render(page) == text


def test_page_table(spark):
    pages = spark.createDataFrame([(1, "<p>a", "u"), (2, None, "v")], "page_id long, html string, text string")
    assert {(r["page_id"], r["text"]) for r in html.query(pages).collect()} == {(1, "a"), (2, "")}
    assert html.extract(pages).columns == ["page_id", "text"]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<table><td>x</table>", "x"),
        ("<table><td>a<td>b<tr><td>c</table>", "a  b\nc"),
        ("<table><tbody><td>x<td>y</tbody><tfoot><th>z</table>", "x  y\nz"),
        ("<table><form><tr><td>x</form><td>y</table>", "x  y"),
        ("<table><center><tr><td>x</table>", "x"),
        ("<table><tr><form><td>x</table>", "x"),
        ("<p>before<table>loose<tr>text<td>cell</table>after", "before\n\nloosetext\n\ncell\n\nafter"),
        ("<table><tr><td>cell</td><div>block <b>bold</b></div></tr><tr><td>next</table>", "block bold\n\ncell\nnext"),
        ("<table><tr><table><tr><td>second</table>", "second"),
        ("<table><tr><td><table><td>in</table>x<td>out</table>", "in  out\nx"),
        ("<table><colgroup><col>loose<tr><td>x</table>", "loose\n\nx"),
        ("<table><template><tr><td>no</template><tr><td>x</table>", "x"),
        ("<table><script>no</script><tr><td>x</table>", "x"),
        ("<head><title>T</title><h1>Head</h1><p>text", "Head\n\ntext"),
        ("<html><head><meta charset=utf-8><title>T</title>\ntext", "text"),
        ("<head><style>no</style><noscript>no</noscript></head><body>yes", "yes"),
        ("a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math> b", "a x=1 b"),
    ],
)
def test_pages_with_tags_left_out(page, text):
    assert html.render(page) == text
