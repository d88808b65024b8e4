import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import dates as N
from tidewater.functions import text as T
from tidewater.operators import cargo as G
from tidewater.operators import context as C
from tidewater.operators import linkage as L
from tidewater.sources import files


def values(spark, inputs, column):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
    return [r["v"] for r in df.select("i", column(F.col("s")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "line, kind, ship, origin, cargo, merchant",
    [
        ("April 27. Andreas @ Fredrikstad,—54,266 boards, Nil.", "early_at", "Andreas", "Fredrikstad", "—54,266 boards, Nil.", None),
        ("Sept. 11 Essex (s)-Konigsberg-sleepers-Order", "standard_dash", "Essex", "Konigsberg", "sleepers", "Order"),
        ("23 Sophie-Halmstad-14,500 pit props-Love & Co.", "standard_dash", "Sophie", "Halmstad", "14,500 pit props", "Love & Co."),
        ("Fatfield (s)-Memel-sleepers, deals-Order", "condensed", "Fatfield", "Memel", "sleepers, deals", "Order"),
        ("nothing here", None, None, None, None, None),
    ],
)
def test_record_lines(spark, line, kind, ship, origin, cargo, merchant):
    r = values(spark, [line], T.parse_record)[0]
    assert (r["format_type"], r["ship_name"], r["origin_port"], r["cargo"], r["merchant"]) == (kind, ship, origin, cargo, merchant)


def test_merchant_order_of_rules(spark):
    assert values(spark, ["Love & Co.", "Order", None, "A. Co. B"], T.normalize_merchant) == ["Love and Co", "", "", "A. Company B"]


def test_first_commodity_rule_wins(spark):
    assert values(spark, ["White Pine Timber", "boars", "firewood", " "], T.normalize_commodity) == ["pine timber", "boards", "firewood", ""]


def test_error_classes(spark):
    pairs = [(5.0, 5.0, "exact"), (93.0, 9.0, "missing_digit_human"), (1000.0, 97.0, "10x_auto_high"), (100.0, 104.0, "close_5pct"), (100.0, 0.0, "large_diff"), (100.0, 80.0, "moderate_diff")]
    df = spark.createDataFrame(pairs, "a double, h double, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", N.error_class(F.col("a"), F.col("h")).alias("got")).collect())


def test_cargo_items(spark):
    got = values(spark, ["102 bgs. wood pulp; 46,012 boards, J. Smith", "deals and battens", "", None], G.parse_cargo)
    assert [(i["quantity"], i["unit"], i["commodity"], i["merchant"]) for i in got[0]] == [("102", "bgs", "wood pulp", None), ("46012", None, "boards", "J. Smith")]
    assert [i["commodity"] for i in got[1]] == ["deals"] and got[2] == [] and got[3] == []


def test_context_is_carried_and_reset(spark):
    lines = ["LONDON.", "MILLWALL DOCKS.", "April 16.", "x", "Sept. 11 Essex-Riga-deals-Order", "y", "ALLOA.", "SURREY DOCKS.", "z"]
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(lines)] + [(2, 0, "q")], "k int, n int, line string")
    got = {(r["k"], r["n"]): (r["port"], r["month"], r["day"]) for r in C.carry_context(df, ["k"], ["n"]).collect()}
    assert got[1, 0] == ("London", None, None)
    assert got[1, 3] == ("London (Millwall Docks)", "April", 16)
    assert got[1, 5] == ("London (Millwall Docks)", "Sept", 11)
    assert got[1, 6][0] == "Alloa" and got[1, 8][0] == "Surrey Docks"
    assert got[2, 0] == (None, None, None)


def test_first_of_signature_is_stable(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", "x"), (5, "b", "x")], "id int, s string, t string")
    once = C.first_of_signature(df, ["s", "t"], "id")
    assert sorted(r["id"] for r in once.collect()) == [1, 2]
    assert sorted(r["id"] for r in C.first_of_signature(once, ["s", "t"], "id").collect()) == [1, 2]


def test_band_join_is_the_theta_join(spark):
    a = spark.range(60).select("id", F.expr("date_add(date'1883-01-01', cast(id * 7 % 90 as int))").alias("d"))
    b = spark.range(60).select(F.col("id").alias("jd"), F.expr("date_add(date'1882-12-20', cast(id * 11 % 100 as int))").alias("e"))
    banded = {(r["id"], r["jd"]) for r in L.band_join(a, b, "d", "e", 14).collect()}
    theta = {(r["id"], r["jd"]) for r in a.join(b, F.abs(F.datediff("d", "e")) <= 14).collect()}
    assert banded == theta and theta


def test_ratio_keeps_its_argument_order(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert [r["r"] for r in df.select(L.matching_ratio("a", "b").alias("r")).collect()] == [0.25, 0.5, 0.0]


def test_greedy_uses_each_once(spark):
    df = spark.createDataFrame([(1, 1, 7, 0.9), (1, 2, 7, 1.0), (1, 2, 8, 0.85), (2, 3, 7, 1.0)], "block int, auto_id bigint, human_id bigint, total_score double")
    assert sorted(tuple(r)[:3] for r in L.greedy(df).collect()) == [(1, 1, 7), (1, 2, 8), (2, 3, 7)]


def test_files(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "18891019p.3_p001.txt").write_text("ALLOA.\nx")
    (pages / "18891019p.3_p002.txt").write_text("y")
    (pages / "single.txt").write_text("z")
    got = {(r["doc_key"], r["page_no"], r["line_number"], r["line"]) for r in files.lines(files.read_pages(spark, str(pages))).collect()}
    assert got == {("18891019p.3", 1, 1, "ALLOA."), ("18891019p.3", 1, 2, "x"), ("18891019p.3", 2, 1, "y"), ("single", 0, 1, "z")}
    (tmp_path / "a.json").write_text('{"text": "t", "status": "error",\n "error": "e"}')
    assert files.read_ocr(spark, str(tmp_path / "a.json")).first()["error"] == "e"
    (tmp_path / "l.json").write_text('["A", "B"]')
    assert [r["value"] for r in files.read_json_list(spark, str(tmp_path / "l.json")).collect()] == ["A", "B"]
    (tmp_path / "c.json").write_text('{"x": 3, "y": 4}')
    assert {r["name"]: r["count"] for r in files.read_json_counts(spark, str(tmp_path / "c.json")).collect()} == {"x": 3, "y": 4}
    df = spark.createDataFrame([(1, 'a "q", b', None), (2, "line\nbreak", "z")], "id int, s string, t string")
    files.write_csv(df, str(tmp_path / "out"), ["s", "id"])
    back = files.read_csv(spark, str(tmp_path / "out"), "s string, id int")
    assert sorted(tuple(r) for r in back.collect()) == [('a "q", b', 1), ("line\nbreak", 2)]
    files.write_batches(spark.range(5).select(F.col("id").alias("n"), F.col("id").cast("string").alias("line")), str(tmp_path / "batches"), 2)
    assert len(list((tmp_path / "batches").glob("batch=*"))) == 3
    assert [r["id"] for r in files.not_done(df, df.filter("id = 1"), "id").collect()] == [2]


def test_similar_ports_and_commodities_get_their_name(spark):
    from difflib import SequenceMatcher

    listed = ["Fredrikstad", "Sundsvall", "Riga", "Memel", "Quebec"]
    raw = ["riga", "Sundswall", "Sundsvalll", "Memell", "Quebeck", "Xyz", " ", "Mem"]
    rows = spark.createDataFrame([(r,) for r in raw + [None]], "raw string")
    got = {r["raw"]: r["port"] for r in L.normalize_ports(rows, "raw", spark.createDataFrame([(x,) for x in listed], "name string"), "name").collect()}
    assert got["riga"] == "Riga" and got[" "] == "" and got[None] == ""
    for r in raw[1:-2]:
        score, best = max((SequenceMatcher(None, r.lower(), x.lower()).ratio(), x) for x in listed)
        assert got[r] == (best if score > 0.85 else r)
    assert got["Mem"] == "Mem"
    goods = spark.createDataFrame([("sleepers",)] * 25 + [("sleeperss",), ("gum",), (None,)], "raw string")
    named = {r["raw"]: r["commodity_name"] for r in L.normalize_commodities(goods, "raw").collect()}
    assert named == {"sleepers": "sleepers", "sleeperss": "sleepers", "gum": "gum", None: ""}


def test_word_errors(spark):
    def plain(a, b):
        row = list(range(len(b) + 1))
        for x in a:
            row, last = [row[0] + 1], row
            for i, y in enumerate(b):
                row.append(min(last[i] + (x != y), last[i + 1] + 1, row[-1] + 1))
        return row[-1] / len(b) if b else None

    rng = random.Random(5)
    pairs = [(" ".join(rng.choices("abc", k=rng.randrange(7))), " ".join(rng.choices("abc", k=rng.randrange(7)))) for _ in range(80)]
    out = spark.createDataFrame(pairs, "a string, b string").withColumn("wer", N.word_error_rate(F.col("a"), F.col("b"))).collect()
    assert all(r["wer"] == plain(r["a"].split(), r["b"].split()) for r in out)


def test_review_files_are_read_in_their_encoding(spark, tmp_path):
    head = "port_type,original_port,ship_count,best_match_canonical,similarity_score,normalization_tier,year_range,action,map_to_port,notes,web_search_query\n"
    for name, code in (("a", "utf-8"), ("b", "latin-1")):
        (tmp_path / f"{name}.csv").write_bytes((head + "=== INSTRUCTIONS ===,,,,,,,,,x,\norigin,Gävle,3,,,,,,,,\norigin,Åbo,4,,,,,MAP,Abo,,\n").encode(code))
        rows = files.read_review(spark, str(tmp_path / f"{name}.csv"))
        assert [r["original_port"] for r in rows.orderBy("ship_count").collect()] == ["Gävle", "Åbo"]
        assert [r["original_port"] for r in files.undecided(rows).collect()] == ["Gävle"]
