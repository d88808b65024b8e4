import collections
import itertools
import random
import re

from tidewater.llm import interactions

WORD = r"[^\x20\x09-\x0D]+"


def plain(rows, labels):
    """Every order applied to the documents themselves, one filter after the other."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    failures = []
    for i, text, _ in rows:
        text = text or ""
        w = re.findall(WORD, text)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and first[text] < i}
        failures.append({k for k, v in fails.items() if v})
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    out, removed_of = {}, collections.Counter()
    for part in {p or "" for *_, p in rows}:
        own = [(rows[k][0], f) for k, f in enumerate(failures) if (rows[k][2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = list(own), []
            for step, f in enumerate(order, 1):
                now = [x for x in left if f in x[1]]
                late = sum(f in x[1] for x in gone)
                left, gone = [x for x in left if f not in x[1]], gone + now
                out[part, "".join(order), step] = [len(left), len(now), late, sum(x[1] == {f} for x in own), sum(x[0] in good for x in now), sum(x[0] in toxic for x in now)]
                removed_of[part, f] += len(now)
    return {(p, o, s): tuple(v) + (removed_of[p, o[s - 1]],) for (p, o, s), v in out.items()}


def fixture():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = ["", None, " \t\n", "x" * 200, "A" * 300, "é" * 40 + "A", "a b " * 2000, " ".join(words), "\x0b".join(words[:50]), "\xa0".join(words)]
    texts += [" ".join(rng.choice(words[: rng.choice([30, 400])]) for _ in range(rng.randrange(90))) + rng.choice(["", "", " #", " A" * 30, " | x"]) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(160)]
    rows += [(7, texts[7], "a"), (7, texts[7], "c"), (None, texts[7], "a"), (None, None, None), (500, None, None), (501, "", None)]
    labels = [(rng.randrange(200), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(120)] + [(None, 1, 1), (7, 1, 1), (7, 0, 0)]
    return rows, labels


def test_audit_is_what_every_order_does(spark):
    rows, labels = fixture()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, first string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = interactions.query(docs, marks)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()}
    assert found == plain(rows, labels)


def test_audit_without_documents_or_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.query(docs.limit(0), labels).count() == 0
    rows = interactions.query(docs, labels).collect()
    assert len(rows) == 600 and {r["good_lost"] for r in rows} == {0}
    assert sorted({(r["filter_order"][0], r["removed"]) for r in rows if r["step"] == 1}) == [("A", 1), ("B", 0), ("C", 0), ("D", 0), ("E", 0)]
