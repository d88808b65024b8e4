from pyspark.sql import functions as F

from tidewater.operators import older_forms as O

DATED = {
    "22 Australia (s)-Australia-1,587 bdls staves, 22 bdls. lumber-Order": (22, "Australia", True, "Australia", "1,587 bdls staves, 22 bdls. lumber", "Order"),
    "20 France (s)-New York-500 staves-Churchill & Sim; 43 cs. handles-Robbins & Co.": (20, "France", True, "New York", "500 staves-Churchill & Sim; 43 cs. handles", "Robbins & Co."),
    "5 Ann-Riga-4 lds. pit-props-Order": (5, "Ann", False, "Riga", "4 lds. pit", "props-Order"),
    " 7 Ann - Riga - 4 logs - Order \r": (7, "Ann", False, "Riga", "4 logs", "Order"),
    "7 Ann-Riga--Order": (7, "Ann", False, "Riga", "", "Order"),
    "Aug. 20 Maryland-Baltimore-2,500 staves-Order": None,
    "144 Maryland-Baltimore-2,500 staves-Order": None,
    "20 Maryland-Baltimore-2,500 staves-No. 7": None,
    "": None,
    None: None,
}
LINES = {
    "Charlotte Vede @ Champion Bay, &c.—115 pcs. timber, Order.": ("early_at", None, None, "Charlotte Vede", False, "Champion Bay", "&c.—115 pcs. timber, Order.", None),
    "Sept. 11 Essex (s)-Konigsberg-sleepers-Order": ("standard_dash", "Sept", 11, "Essex", True, "Konigsberg", "sleepers", "Order"),
    "Fatfield (s)-Memel-sleepers, deals-Order": ("condensed", None, None, "Fatfield", True, "Memel", "sleepers, deals", "Order"),
    "3 Ann-Riga-deals-A-B": ("standard_dash", None, 3, "Ann", False, "Riga", "deals", "A-B"),
    "April 27. Andreas @ Fredrikstad,—54,266 boards, Nil.": None,
    "HULL (NEW).": None,
    " ": None,
    None: None,
}
GOODS = {
    "1,587 bdls staves, 22 bdls. lumber, 393 bdls. wash boards": [(1587, "bdls", "staves"), (22, "bdls", "lumber"), (393, "bdls", "wash boards")],
    "1234 pcs deals; 5 Lds.. Oak - 6 x y": [(234, "pcs", "deals"), (5, "Lds", "Oak"), (6, "x", "y")],
    "500 staves": [],
    "1,234,567,890,123,456,789,012 pcs deals": [(None, "pcs", "deals")],
    "": [],
    None: [],
}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def test_dated_record(spark):
    for r in frame(spark, DATED).select("s", O.dated_record(F.col("s")).alias("r")).collect():
        assert (r["r"] and tuple(r["r"])[:6]) == DATED[r["s"]], r["s"]


def test_line_record(spark):
    for r in frame(spark, LINES).select("s", O.line_record(F.col("s")).alias("r")).collect():
        assert (r["r"] and tuple(r["r"])) == LINES[r["s"]], r["s"]


def test_goods(spark):
    for r in frame(spark, GOODS).select("s", O.goods(F.col("s")).alias("r")).collect():
        assert [tuple(i) for i in r["r"]] == GOODS[r["s"]], r["s"]


def journals(spark, *documents):
    rows = [(d, n, s) for d, text in enumerate(documents) for n, s in enumerate(text)]
    return spark.createDataFrame(rows, "doc int, n int, line string").repartition(3)


def test_context_stays_within_a_document(spark):
    x = journals(spark, ["3 Ann-Riga-deals-Order", "Sept. 1 Ann-Riga-deals-Order", "HULL .", None, "31 Ann-Riga-deals-Order"], ["ST. IVES.", "Bo-Riga-deals-Order"])
    got = [(r.doc, r.n, r.destination_port, r.month, r.day) for r in O.line_records(x, ["doc"], ["n"]).orderBy("doc", "n").collect()]
    assert got == [(0, 0, None, None, 3), (0, 1, None, "Sept", 1), (0, 4, "HULL ", "Sept", 31), (1, 1, "ST. IVES", None, None)]


def test_arrival_dates(spark):
    x = journals(spark, ["9 Ann-Riga-5 pcs. oak-Order", "HULL.", "9 Ann-Riga-5 pcs. oak-Order", "30 Ann-Riga-oak-Order", "BAD (NEW).", "31 Ann-Riga-oak-Order"])
    of = lambda year, month: [(r.n, r.port, r.arrival_date, len(r.cargo_items)) for r in O.dated_records(x, ["doc"], ["n"], F.lit(year).cast("int"), F.lit(month).cast("string")).orderBy("n").collect()]
    assert of(1884, "FEBRUARY") == [(2, "HULL", "1884-02-09", 1), (3, "HULL", "1884-FEBRUARY-30", 0), (5, "HULL", "1884-FEBRUARY-31", 0)]
    assert [d for _, _, d, _ in of(1884, "Aug")] == ["1884-Aug-9", "1884-Aug-30", "1884-Aug-31"]
    assert [d for _, _, d, _ in of(None, "August")] == [None] * 3
    assert O.dated_records(x.limit(0), ["doc"], ["n"], F.lit(1884), F.lit("May")).count() == 0
