from pyspark.sql import functions as F

from tidewater.operators import cargo_grammar as G
from tidewater.operators import context as C
from tidewater.operators import formats as P
from tidewater.operators import linkage as L

CARGO = {
    "—1,300 staves, Nickols & Colven; 41,500 staves, H. & R. Fowler; 9,173 staves, Oppenheimer & Co.": [("1300", None, "staves", "Nickols and Colven"), ("41500", None, "staves", "H. and R. Fowler"), ("9173", None, "staves", "Oppenheimer")],
    "—102 bgs. wood pulp, J. Spicer & Co.; 1,669 planks, J. Neck & Sons; 8,047 boards, G. E. Arnold": [("102", "bags", "wood pulp", "J. Spicer"), ("1669", None, "planks", "J. Neck"), ("8047", None, "boards", "G. E. Arnold")],
    "—68 logs wood, 6 logs mahogany, 172 logs rosewood, 104 doz. deals, Order.": [("68", None, "logs wood", None), ("6", None, "logs mahogany", None), ("172", None, "logs rosewood", None), ("104", "dozens", "deals", None)],
    "—46,012 boards, 1,238 bdls. laths, Tagart & Co.": [("46012", None, "boards", None), ("1238", "bundles", "laths", "Tagart")],
    "9,173 staves, Oppenheimer & Co. — 22,313 pcs. redwood, Order": [("9173", None, "staves", "Oppenheimer"), ("22313", "pieces", "redwood", None)],
    "1,800 loads timber": [("1800", "loads", "timber", None)],
    "102 tons deals": [("102", "tons", "deals", None)],
    "10 loads, Smith": [],
    "12 oak": [("12", None, "oak", None)],
    "5 loads; 7 ash": [("7", None, "ash", None)],
    "deals and battens": [],
    "ab": [],
    "": [],
    None: [],
}


def test_cargo_by_the_grammar(spark):
    df = spark.createDataFrame([(k,) for k in CARGO], "s string").select("s", G.parse_items(F.col("s")).alias("items"))
    for r in df.collect():
        assert [tuple(i)[:4] for i in r["items"]] == [(q, u, c, m) for q, u, c, m in CARGO[r["s"]]], r["s"]


def test_merchants(spark):
    names = {"ORDER": None, " to order ": None, "": None, "Messrs. SMITH AND CO": "Smith", "J. BROWN": "J. Brown", "J.  BROWN & SONS,": "J. Brown and Sons", "bank Of THE north ltd": "Bank of the North", "Order.": None, "a": "A", None: None}
    got = {r["s"]: r["m"] for r in spark.createDataFrame([(k,) for k in names], "s string").select("s", G.merchant_name(F.col("s")).alias("m")).collect()}
    assert got == names


def test_formats_of_pages_without_a_year(spark):
    pages = {"Ann @ Riga": "early_at", "SURREY COMMERCIAL DOCKS. @ a - b": "late_dock", "Ann-Riga-deals": "standard_dash", "a @ b - c": "transition", "prose": "unknown", None: "unknown", "": "unknown"}
    df = spark.createDataFrame([(k, None) for k in pages], "s string, y int")
    assert {r["s"]: r["f"] for r in df.select("s", P.format_of(F.col("s"), F.col("y")).alias("f")).collect()} == pages
    years = {1874: "early_at", 1878: "early_at", 1879: "transition", 1881: "standard_dash", 1885: "late_dock", 0: "standard_dash"}
    df = spark.createDataFrame([(k, "Ann-Riga") for k in years], "y int, s string")
    assert {r["y"]: r["f"] for r in df.select("y", P.format_of(F.col("s"), F.col("y")).alias("f")).collect()} == years


def test_signals_hold_the_first_headers_and_samples(spark):
    text = "\n".join([f"x{i}\nPORT {chr(65 + i)}.\n{i + 1} Ship @ Riga,—{'d' * 200}" for i in range(14)])
    r = spark.createDataFrame([(text,)], "s string").select(*(v.alias(k) for k, v in P.signals(F.col("s")).items())).first()
    assert r["port_header_count"] == 14 and r["port_headers"] == [f"PORT {chr(65 + i)}" for i in range(10)]
    assert len(r["sample_records"]) == 5 and all(len(x) == 150 for x in r["sample_records"]) and r["at_count"] == 14 and not r["has_dock_subdivisions"]


def test_first_members_of_hot_and_null_groups(spark):
    rows = [("hot", i, f"s{i % 30:02d}") for i in range(3000)] + [(None, 5, None), (None, 3, "a"), ("one", 1, "z")]
    df = spark.createDataFrame(rows, "g string, m int, src string").repartition(7)
    got = {r["_s0"]: r["f"] for r in C.first_members(df, ["g"], "m", 4, "f").collect()}
    assert got == {"hot": [0, 1, 2, 3], None: [3, 5], "one": [1]}
    report = {r["g"]: tuple(r)[1:] for r in C.duplicate_report(df, ["g"], "m", shown=3, source="src").collect()}
    assert report == {"hot": (3000, True, "0,1,2", 30, "s00,s01,s02"), None: (2, False, "3,5", 1, "a")}


def test_band_join_of_missing_dates_and_clashing_names(spark):
    a = spark.sql("select * from values (1, date'1883-01-01', 'x'), (2, null, 'x') t(i, d, _bucket)")
    b = spark.sql("select * from values (7, date'1883-01-10'), (8, null), (9, date'1883-03-01') t(j, e)")
    got = {(r["i"], r["j"], r["_bucket"]) for r in L.band_join(a, b, "d", "e", 14, missing=True).collect()}
    assert got == {(1, 7, "x"), (2, 8, "x")} and L.band_join(a, b, "d", "e", 14).count() == 1


def test_listed_commodities_stay(spark):
    rows = spark.createDataFrame([(" White Deal ",), ("white deal",), ("deals",), ("sawn fir deals",), ("",), (None,)], "raw string")
    listed = spark.createDataFrame([("white deal",), (None,), ("",)], "commodity string")
    got = {r["raw"]: r["commodity_name"] for r in L.normalize_commodities(rows, "raw", canonical=listed).collect()}
    assert got == {" White Deal ": "white deal", "white deal": "white deal", "deals": "deals", "sawn fir deals": "deals", "": "", None: ""}
