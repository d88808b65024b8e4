"""Queries and operators that number, link and rank whole tables, against plain versions."""

import os
from collections import Counter, defaultdict
from datetime import timedelta

import pytest

from tidewater.operators import context as C
from tidewater.operators import linkage as L
from tidewater.plans import catalog
from tidewater.sources.tables import ships, table

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("end", ["", "_all"])
def test_all_events_are_linked(spark, end):
    events = {r["event_id"] for r in table(spark, SF, "events").collect()}
    got = catalog.queries()[f"j12_labels{end}"](spark, SF).collect()
    assert Counter(r["auto_id"] for r in got if r["auto_id"] >= 0) == Counter(i for i in events if i % 2 == 0)
    best = {r["human_id"] for r in got if r["auto_id"] >= 0 and r["human_id"] >= 0}
    alone = [r["human_id"] for r in got if r["match_type"] == "unmatched_human"]
    assert len(alone) == len(set(alone)) and best | set(alone) == {i for i in events if i % 2 == 1} and not best & set(alone)


@needs_tables
def test_all_events_have_their_nearest_issue(spark):
    got = [r["auto_id"] for r in catalog.queries()["j8_nearest"](spark, SF).collect()]
    assert Counter(got) == Counter(r["event_id"] for r in table(spark, SF, "events").collect())


@needs_tables
def test_greedy_takes_the_best_free_human_of_all_events(spark):
    events = sorted(table(spark, SF, "events").selectExpr("event_id", "user_id", "event_type", "to_date(ts) d").collect())
    blocks = defaultdict(lambda: ([], []))
    for e in events:
        week = e["d"] - timedelta(days=e["d"].weekday())
        odd = e["event_id"] % 2
        blocks[f"{e['user_id']}/{week}"][odd].append((e["event_id"], e["event_type"] + ("s" if odd and e["event_id"] % 3 == 0 else "")))
    want = set()
    for block, (autos, humans) in blocks.items():
        free = dict(humans)
        for auto, name in autos:
            # All names differ by a final s at most, which costs less than a fifth of those of five letters and more.
            fits = [(1.0 if other == name else 1 - 1 / len(other), -human) for human, other in free.items() if other == name or other == name + "s"]
            fits = [f for f in fits if f[0] >= 0.8]
            if fits:
                score, human = max(fits)
                del free[-human]
                want.add((block, auto, -human, round(score, 6)))
    got = catalog.queries()["j11_greedy"](spark, SF).collect()
    assert len(got) == len(want) > 100 and {(r["block"], r["auto_id"], r["human_id"], r["total_score"]) for r in got} == want


def test_greedy_ties_null_blocks_and_empty(spark):
    rows = [("x", 1, 8, 0.9), ("x", 1, 7, 0.9), ("x", 2, 7, 1.0), ("x", 2, 8, 0.8), (None, 1, 7, 0.8), (None, 3, 7, 0.9), ("y", 1, 7, 0.8)]
    pairs = spark.createDataFrame(rows, "block string, auto_id bigint, human_id bigint, total_score double").repartition(4)
    assert {tuple(r) for r in L.greedy(pairs).collect()} == {("x", 1, 7, 0.9), ("x", 2, 8, 0.8), (None, 1, 7, 0.8), ("y", 1, 7, 0.8)}
    assert L.greedy(pairs.limit(0)).count() == 0


def test_band_join_within_equal_keys(spark):
    dates = "k string, i int, d date"
    day = lambda n: __import__("datetime").date(2024, 1, 1) + timedelta(days=n)
    a = [("x", 1, day(0)), ("x", 2, day(14)), ("y", 3, day(0)), (None, 4, day(0)), ("x", 5, None)]
    b = [("x", 6, day(0)), ("x", 7, day(28)), ("y", 8, day(15)), (None, 9, day(0)), ("x", 10, None)]
    left = spark.createDataFrame(a, dates).withColumnsRenamed({"i": "auto_id", "d": "da"})
    right = spark.createDataFrame(b, dates).withColumnsRenamed({"i": "human_id", "d": "db"})
    got = {(r["auto_id"], r["human_id"]) for r in L.band_join(left, right, "da", "db", 14, ("k",)).collect()}
    assert got == {(i, j) for k, i, x in a for m, j, y in b if k and k == m and x and y and abs((x - y).days) <= 14} == {(1, 6), (2, 6), (2, 7)}


def test_labels_take_the_smallest_of_equals(spark):
    pairs = spark.createDataFrame([(1, 9, 0.9), (1, 8, 0.9), (1, 7, 0.8), (2, 7, 1.0)], "auto_id bigint, human_id bigint, total_score double")
    autos = spark.createDataFrame([(1,), (2,), (3,)], "auto_id bigint")
    humans = spark.createDataFrame([(7,), (8,), (9,)], "human_id bigint")
    got = {tuple(r) for r in L.label_matches(pairs, autos, humans).collect()}
    assert got == {("1:many (best of 3)", 1, 8, 0.9), ("1:1", 2, 7, 1.0), ("unmatched_auto", 3, None, 0.0), ("unmatched_human", None, 9, 0.0)}
    assert L.label_matches(pairs.limit(0), autos.limit(0), humans.limit(0)).count() == 0


def test_places_within_keys(spark):
    rows = [("a" if i % 7 else None, i * 5) for i in range(300)] + [("b", 3)]
    got = C.place_within(spark.createDataFrame(rows, "k string, i long").repartition(5), ["k"], "i", "at", each=64).collect()
    for k in (None, "a", "b"):
        own = sorted(i for x, i in rows if x == k)
        assert sorted((r["at"], r["i"]) for r in got if r["k"] == k) == list(enumerate(own))
    assert C.place_within(spark.createDataFrame([], "k string, i long"), ["k"], "i", "at").count() == 0


def test_duplicate_report_shows_the_first_members(spark):
    rows = [("x", i) for i in range(60)] + [("x", 3), (None, 2), (None, 1), ("y", 5)]
    got = {r["s"]: (r["n"], r["is_major"], r["members"]) for r in C.duplicate_report(spark.createDataFrame(rows, "s string, i long"), ["s"], "i").collect()}
    assert got == {"x": (61, True, "0,1,2,3,3,4,5,6,7,8"), None: (2, False, "1,2")}


@needs_tables
def test_all_shipments_are_placed(spark):
    got = {r["record_id"]: r["place"] for r in catalog.queries()["o2_text_order"](spark, SF).collect()}
    rows = ships(spark, SF).selectExpr("record_id", "year(ship_date) y", "date_format(ship_date, 'MMMM') m", "day(ship_date) d").collect()
    assert set(got) == {r["record_id"] for r in rows} and len(got) == len(rows)
    for y in {r["y"] for r in rows}:
        own = sorted((r for r in rows if r["y"] == y), key=lambda r: (r["m"], str(r["d"]) if r["record_id"] % 3 else "99", r["record_id"]))
        assert [got[r["record_id"]] for r in own] == list(range(1, len(own) + 1))


def test_misspelled_names_of_many_rows_yield_to_far_more_frequent_ones(spark):
    rows = [("Large",)] * 2000 + [("Largex",)] * 40 + [("largey",)] * 3 + [("mediums",)] * 50 + [("medium",)] * 60
    got = L.normalize_commodities(spark.createDataFrame(rows, "raw string"), "raw").groupBy("raw", "commodity_name").count().collect()
    want = {("Large", "large", 2000), ("Largex", "large", 40), ("largey", "large", 3), ("mediums", "mediums", 50), ("medium", "medium", 60)}
    assert {tuple(r) for r in got} == want
