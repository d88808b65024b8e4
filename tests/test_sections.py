import random
import re

from pyspark.sql import functions as F

from tidewater.operators import blocks as B
from tidewater.operators import context as C

LINES = ["Imports of Timber, &c.", "  IMPORTS.", "timber imports", "LONDON.", "TYNE.", "OAK.", "THE WOOD TRADE", "SURREY DOCKS LONDON.", "plain prose about wood.", "MARKET REPORTS", "some prose, twelve", "more: prose", "a, b", "x; y", "", "   ", "Fatfield (s)-Memel-deals-Order", "May 3. Ann @ Riga,—12 deals", "115 pcs. timber, Order", "short @", None]


def walk(lines):
    """The rules line by line."""
    out, block, start, others = [], [], 0, 0
    for i, line in enumerate(lines):
        s = (line or "").strip()
        if re.search(r"^Imports? of Timber|^IMPORTS\.?$|^Timber Imports", s, re.I):
            if block:
                out.append((start, i - 1, len(block)))
            block, start, others = [i], i, 0
            continue
        if not block:
            continue
        if re.search(r"^THE\s+\w+\s+TRADE|^\(From\s+our\s+own\s+Correspondent|^[A-Z\s]{10,}\.$|^MARKET\s+REPORTS|^PRICES\s+CURRENT", s, re.I):
            out += [(start, i - 1, len(block))] if len(block) > 5 else []
            block = []
            continue
        record = len(s) >= 10 and ("@" in s or re.match(r"(\w+\.\s+)?\d{1,2}\s+\w+.*-.*-|\w+[\s(].*-.*-.*-|\d{1,5}\s+(pcs\.|lds\.|deals|timber|boards)", s))
        port = re.match(r"^[A-Z\s&.'()]+\.$", s) and len(s.rstrip(". ")) > 3
        others = 0 if record or port or not s else others + 1
        if others <= 3:
            block.append(i)
        else:
            out += [(start, i - 3, len(block))] if len(block) > 5 else []
            block = []
    return out + ([(start, len(lines) - 1, len(block))] if len(block) > 5 else [])


def test_import_blocks_are_those_of_a_walk(spark, monkeypatch):
    rng = random.Random(21)
    docs = {k: [rng.choice(LINES[rng.choice([0, 3, 10]) :]) for _ in range(rng.choice([0, 1, 7, 300]))] for k in range(40)}
    docs[99] = [LINES[0]] + [rng.choice(LINES[10:]) for _ in range(6000)]
    docs[98] = [rng.choice(LINES) for _ in range(6000)]
    docs[None] = [LINES[1], *LINES[-5:-1], LINES[-3], LINES[-3]]
    want = sorted(((k is None, k or 0), *b) for k, lines in docs.items() for b in walk(lines))
    # Numbers of lines may have gaps.
    rows = [(k, 10 * i + 3, line, "clash") for k, lines in docs.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "book long, no int, line string, kind string").repartition(4)
    for tolerated, least in ((3, 6),):
        got = sorted(((r["doc"] is None, r["doc"] or 0), (r["first"] - 3) // 10, (r["last"] - 3) // 10, r["n"]) for r in B.import_blocks(df, "book", "no", "line", tolerated, least).collect())
        assert got == want and len(want) > 100
    assert B.import_blocks(df.limit(0), "book", "no").count() == 0
    assert any(b[1] for b in want)


def test_filling_by_ranges_is_filling(spark):
    rng = random.Random(22)
    rows = [(rng.choice([1, 2, None]), i, rng.choice([None, None, None, "a", "b"]), rng.choice([None, 7])) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, i int, s string, x int").repartition(3)
    want = df.withColumns({c: C.forward_fill(F.col(v), ["k"], ["i"]) for c, v in (("filled", "s"), ("y", "x"))})
    got = C.fill_by_ranges(df, ["k"], "i", {"filled": F.col("s"), "y": F.col("x")}, each=16)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_entries_stand_under_the_nearest_date(spark):
    rng = random.Random(23)
    texts, want = {}, []
    for k in range(60):
        pieces, label = [], None
        for i in range(rng.randrange(40)):
            if rng.random() < 0.3:
                label = f"{rng.choice(['March', 'May', 'December'])} {rng.randrange(1, 29)}th"
                pieces.append(label)
            if rng.random() < 0.8:
                pieces.append(f"Ship{i}{' (s)' if i % 2 else ''} @ Riga. — {i} deals, see March and 3 oak")
                want.append((k, label, f"Ship{i}", bool(i % 2), "Riga", f"{i} deals, see March and 3 oak"))
        if pieces and "@" not in pieces[-1]:
            pieces.pop()
        texts[k] = ". ".join(pieces)
    df = spark.createDataFrame([*texts.items(), (900, None), (901, ""), (902, "May 3rd. nothing else")], "id long, s string")
    got = [(r["id"], r["date_label"], r["ship_name"], r["is_steamship"], r["origin_port"], r["body"]) for r in B.entries(df, "id", "s").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 500


def test_nearest_before():
    rng = random.Random(24)
    for _ in range(200):
        places, labels = (sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(2))
        assert B.nearest_before(places, labels) == [max((i for i, x in enumerate(labels) if x <= p), default=None) for p in places]
