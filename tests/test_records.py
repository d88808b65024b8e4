import collections
import datetime
import os
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidewater.operators import linkage as L
from tidewater.operators import records as R
from tidewater.plans import catalog

SF = "/root/testdata/sf0.001"


def ratio(a, b):
    if not a or not b:
        return 0.0
    a, b = a.lower().strip(), b.lower().strip()
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


def names(rng, n):
    """Names and what misprints make of them, short ones and ones of few letters too."""
    out = ["", " ", None, "a", "ab", "axb", "abc", "aab", "aaaa", "aaaaa", "Riga ", "riga", "x"]
    while len(out) < n:
        word = list("".join(rng.choice(rng.choice(["ab", "abcdefgh", "aeiourstnl é"])) for _ in range(rng.randrange(1, 16))))
        out.append("".join(word))
        for _ in range(3):
            other = list(word)
            for _ in range(rng.randrange(1, 4)):
                i = rng.randrange(len(other) + 1)
                other[i : i + rng.choice([0, 1])] = rng.choice(["", "e", "x"])
            out.append("".join(other))
    return out


@pytest.mark.parametrize("least", [0.7, 0.8, 0.85, 1.0])
def test_no_similar_pair_is_lost(spark, least):
    rng = random.Random(11)
    a, b = names(rng, 260), names(rng, 260)
    own = {x.lower().strip() for x in a if x}, {x.lower().strip() for x in b if x}
    want = {(x, y): 1.0 if x == y else ratio(x, y) for x in own[0] for y in own[1] if x == y or ratio(x, y) >= least}
    left, right = (spark.createDataFrame([(x,) for x in side], f"{c} string").select(R.named(F.col(c)).alias(c)) for side, c in ((a, "p"), (b, "q")))
    got = {(r["a"], r["b"]): r["score"] for r in R.ratio_pairs(left, right, "p", "q", least).collect()}
    assert got == pytest.approx(want) and len(want) > 10


def sides(rng, n=300):
    """Records of few names and days, so that many match; some without a date, port or commodity."""
    ports, goods = names(rng, 40), ["Sawn deals", "sawn deal", "deals", "battens", "Batten", "oak logs", "oak log", "", None]
    day = lambda: rng.choice([None] + [datetime.date(1883, 1, 1) + datetime.timedelta(rng.randrange(60)) for _ in range(12)])
    return [[(i * 7 % 1009, day(), rng.choice(ports), rng.choice(goods)) for i in range(n)] for _ in range(2)]


def plain_pairs(autos, humans, days=14):
    out = {}
    for i, d, p, c in autos:
        for j, e, q, k in humans:
            apart = abs((d - e).days) if d and e else None
            if (d and e and apart <= days) or (d is None and e is None):
                scores = ratio(p, q), ratio(c, k)
                if scores[0] >= 0.85 and scores[1] >= 0.80:
                    out[i, j] = (*scores, sum(scores) / 2, apart)
    return out


def frames(spark, autos, humans):
    return [spark.createDataFrame([(*r, 1) for r in x], f"{i} long, date date, port string, commodity string, n int") for x, i in ((autos, "auto_id"), (humans, "human_id"))]


def test_records_match_as_a_double_loop_says(spark):
    autos, humans = sides(random.Random(12))
    want = plain_pairs(autos, humans)
    got = {(r["auto_id"], r["human_id"]): tuple(r)[2:] for r in R.record_pairs(*frames(spark, autos, humans)).collect()}
    assert set(got) == set(want) and len(want) > 100 and any(v[3] is None for v in want.values())
    assert all(got[k][3] == want[k][3] and got[k][:3] == pytest.approx(want[k][:3]) for k in want)


def test_labels_by_cells_are_those_of_all_pairs(spark):
    autos, humans = sides(random.Random(13))
    pairs, want = plain_pairs(autos, humans), []
    own = collections.defaultdict(list)
    for (i, j), (*_, total, _) in pairs.items():
        own[i].append((-total, j))
    for i, *_ in autos:
        found = sorted(own[i])
        kind = "1:1" if len(found) == 1 else f"1:many (best of {len(found)})"
        want.append((kind, i, found[0][1], round(-found[0][0], 9)) if found else ("unmatched_auto", i, None, 0.0))
    taken = {w[2] for w in want}
    want += [("unmatched_human", None, j, 0.0) for j, *_ in humans if j not in taken]
    got = [(r["match_type"], r["auto_id"], r["human_id"], round(r["total_score"], 9)) for r in R.record_labels(*frames(spark, autos, humans)).collect()]
    assert collections.Counter(got) == collections.Counter(want)
    assert {k[0][:4] for k in got} >= {"1:1", "1:ma", "unma"}


def test_no_records(spark):
    a, b = frames(spark, *sides(random.Random(14), 20))
    assert {r["match_type"] for r in R.record_labels(a, b.limit(0)).collect()} == {"unmatched_auto"}
    assert {r["match_type"] for r in R.record_labels(a.limit(0), b).collect()} == {"unmatched_human"}
    assert R.record_pairs(a.limit(0), b.limit(0)).count() == 0


def rows_made(df):
    """Output rows of every operator of the plan that ran."""
    q = df._jdf.queryExecution()
    q.executedPlan().executeCollect()
    out, todo = [], [q.executedPlan()]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        m = p.metrics().get("numOutputRows")
        if m.isDefined():
            out.append(m.get().value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_labels_make_no_pairs_of_records(spark):
    """Four times the events of the same days and names: rows grow with the events, pairs would grow sixteenfold."""
    most = []
    for n in (1500, 6000):
        own = spark.range(n).select((F.col("id") * 2).alias("auto_id"), F.date_add(F.lit("1883-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"), F.lit("riga").alias("port"), F.lit("deals").alias("commodity"))
        other = own.select((F.col("auto_id") + 1).alias("human_id"), "date", "port", F.lit("deal").alias("commodity"))
        most.append(max(rows_made(R.record_labels(own, other))))
    assert most[1] <= 2 * 6000 and most[1] <= 4.5 * most[0]


def test_quantities_by_group(spark):
    rng = random.Random(15)
    rows = [(rng.choice(["riga", "memel" * 6, None]), float(rng.randrange(1, 60)), rng.choice([None, 10.0, 11.0, 10.4, 30.0])) for _ in range(300)]
    own = collections.defaultdict(list)
    for p, a, b in rows:
        if b is not None:
            own[(p or "")[:20]].append(abs(a - b) * 100 / max(a, b))
    want = {k: (len(v), sum(e == 0 for e in v), sum(e <= 5 for e in v), sum(e <= 10 for e in v), ",".join(f"{e:.2f}" for e in sorted((e for e in v if e), reverse=True)[:10])) for k, v in own.items()}
    got = R.quantity_report(spark.createDataFrame(rows, "port string, auto_quantity double, human_quantity double"), "port").collect()
    assert {r["port"]: (r["total"], r["exact"], r["within_5"], r["within_10"], r["worst"]) for r in got} == want
    assert len(R.quantity_report(spark.createDataFrame(rows, "port string, auto_quantity double, human_quantity double"), "port", top=2).collect()) == 2


def test_close_pairs(spark):
    rng = random.Random(16)
    a = names(rng, 120)
    df = spark.createDataFrame([(x,) for x in a], "x string")
    got = {(r["x"], r["y"]) for r in L.close_pairs(df, df.withColumnRenamed("x", "y"), "x", "y").collect()}
    pairs = df.distinct().alias("l").join(df.distinct().withColumnRenamed("x", "y"), F.lit(True)).filter(L.similarity(F.col("x"), F.col("y")) >= 0.8)
    assert got == {(r["x"], r["y"]) for r in pairs.collect()}


def test_quantities_of_matches_are_those_of_the_labels(spark):
    autos, humans = sides(random.Random(17))
    frame = lambda x, s: spark.createDataFrame([(k, *r[1:], float(k % 13)) for k, r in enumerate(x)], f"{s}_id long, date date, port string, commodity string, {s}_quantity double")
    a, h = frame(autos, "auto"), frame(humans, "human")
    labels = [r for r in R.record_labels(a, h).collect() if r["match_type"].startswith("1:")]
    got = collections.Counter((r["auto_id"], r["human_quantity"]) for r in R.matched_quantities(a, h).collect())
    assert got == collections.Counter((r["auto_id"], float(r["human_id"] % 13)) for r in labels) and len(got) > 50


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["j12_record_labels", "a15_record_scores", "a17_by_port", "a17_by_commodity"])
def test_the_tables_are_joined_once(spark, name):
    """What is left to run when the query returns reads the written records, not the tables."""
    read = catalog.queries()[name](spark, SF).inputFiles()
    assert read and not any("lineitem" in f for f in read)


def test_near_quantities_are_those_of_all_pairs(spark):
    rng = random.Random(18)
    amount = lambda: rng.choice([None, 0.0, 5e-324, 1e308, -3.5, -7.0, float("nan"), 95.0, 90.0, 100.0, 99.99, *(rng.randrange(1, 400) / rng.choice([3, 7, 10, 100]) for _ in range(24))])
    day = lambda: rng.choice([None, *(datetime.date(1969, 12, 1) + datetime.timedelta(rng.randrange(70)) for _ in range(12))])
    a, h = ([(rng.choice(["riga", "memel", None]), day(), amount()) for _ in range(300)] for _ in range(2))
    want = collections.defaultdict(lambda: [0, 0, 0])
    for p, d, x in a:
        for q, e, y in h:
            if p and p == q and d and e and abs((d - e).days) <= 14:
                want[p][0] += 1
                if x is not None and y is not None and x == x and y == y and max(x, y) != 0:
                    want[p][1] += abs(x - y) / max(x, y) <= 0.05
                    want[p][2] += abs(x - y) / max(x, y) <= 0.10
    autos, humans = (spark.createDataFrame(x, "key string, date date, quantity double") for x in (a, h))
    keys = spark.createDataFrame([("riga", "riga"), ("memel", "memel")], "a_key string, b_key string")
    got = {r["key"]: list(r)[1:] for r in R.near_quantities(autos, humans, keys).collect()}
    assert got == dict(want) and min(map(min, got.values())) > 50


def test_all_quantities_make_no_pairs(spark):
    """Twice the events of the same days: rows grow with the events, pairs would grow fourfold."""
    most = []
    for n in (2000, 4000):
        own = spark.range(n).select(F.lit("riga").alias("key"), F.date_add(F.lit("1883-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("date"), (F.col("id") / 7 + 1).alias("quantity"))
        most.append(max(rows_made(R.near_quantities(own, own, spark.createDataFrame([("riga", "riga")], "a_key string, b_key string")))))
    assert most[1] <= 2.2 * most[0] and most[1] < 100 * 4000


def test_pairs_of_cells_are_those_of_a_double_loop(spark):
    rng = random.Random(19)
    day = lambda: rng.choice([None, *(datetime.date(1969, 12, 20) + datetime.timedelta(rng.randrange(40)) for _ in range(12))])
    a, h = ([(i, day(), rng.choice(["riga", "memel", "memels", None])) for i in range(k, 300, 2)] for k in (0, 1))
    alike = {("riga", "riga"): 1.0, ("memel", "memel"): 1.0, ("memel", "memels"): 0.833333}
    want = {(i, j, alike[p, q]) for i, d, p in a for j, e, q in h if (p, q) in alike and d and e and abs((d - e).days) <= 14}
    autos, humans = (spark.createDataFrame(x, f"{s}_id long, date date, key string") for x, s in ((a, "auto"), (h, "human")))
    keys = spark.createDataFrame([(*k, v) for k, v in alike.items()], "a_key string, b_key string, total_score double")
    for each in (1, 3, 1024):
        got = [tuple(r) for r in L.cell_pairs(autos, humans, keys, each=each).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 1000
    assert L.cell_pairs(autos.limit(0), humans, keys).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_all_pairs_are_made_without_trying_others(spark):
    """Names are compared before, and no operator makes more rows than there are pairs."""
    pairs = catalog.queries()["j7_band_join_all"](spark, SF)
    assert "levenshtein" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert max(rows_made(pairs)) == pairs.count() > 30000


def bytes_moved(df):
    """What the exchanges of the plan that ran were given, in bytes."""
    q = df._jdf.queryExecution()
    q.executedPlan().executeCollect()
    out, todo = 0, [q.executedPlan()]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec" or name.endswith("QueryStageExec"):
            todo.append(p.executedPlan() if name == "AdaptiveSparkPlanExec" else p.plan())
            continue
        if name == "ShuffleExchangeExec":
            out += p.metrics().get("dataSize").get().value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_lists_are_not_moved_for_each_pair_of_lists(spark):
    """Four times the events of the same days and names: what is moved grows with the events; a row for each two lists would be sixteen times as much."""
    moved, day = [], F.date_add(F.lit("1883-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("date")
    keys = spark.createDataFrame([("riga", "riga", 1.0)], "a_key string, b_key string, total_score double")
    for n in (1500, 6000):
        own = spark.range(n).select(F.col("id").alias("auto_id"), day, F.lit("riga").alias("key"))
        pairs = L.cell_pairs(own, own.withColumnRenamed("auto_id", "human_id"), keys, each=8)
        sums = pairs.agg(F.count("*").alias("n"), F.sum("auto_id").alias("a"), F.sum("human_id").alias("h"))
        near = [(i, j) for i in range(20) for j in range(20) if abs(i - j) <= 14]
        per = n // 20
        total = sum(per * (per * i + 20 * (per * (per - 1) // 2)) for i, _ in near)
        assert tuple(sums.collect()[0]) == (len(near) * per * per, total, total)
        moved.append(bytes_moved(sums))
    assert 0 < moved[1] <= 6 * moved[0]


def test_classes_and_members_are_all_pairs(spark):
    """Copies, also in other cases and with blanks, missing dates and names: joined to their classes, records pair as a double loop says."""
    autos, humans = ([(k, *r[1:]) for k, r in enumerate(x)] for x in sides(random.Random(20)))
    autos += [(1000 + k, *(c.upper() + " " if isinstance(c, str) else c for c in r[1:])) for k, *r in [(i, *x) for i, x in enumerate(autos[:120])]]
    want = plain_pairs(autos, humans)
    pairs, members = R.record_classes(*frames(spark, autos, humans))
    of = {s: {r["id"]: r["class_id"] for r in members.collect() if r["side"] == s} for s in ("auto", "human")}
    assert members.count() == len(autos) + len(humans) and set(of["auto"]) == {r[0] for r in autos} and set(of["human"]) == {r[0] for r in humans}
    linked = {(r["auto_id"], r["human_id"]): tuple(r)[2:] for r in pairs.collect()}
    got = {(i, j): linked[c, k] for i, c in of["auto"].items() for j, k in of["human"].items() if (c, k) in linked}
    assert set(got) == set(want) and len(linked) < len(want) and any(v[3] is None for v in want.values())
    assert all(got[k][3] == want[k][3] and got[k][:3] == pytest.approx(want[k][:3]) for k in want)


def test_copies_of_records_make_no_pairs(spark):
    """Four times the copies of the same records: pairs of classes are as many, where all pairs would be sixteen times as many."""
    made = []
    for n in (400, 1600):
        own = spark.range(n).select((F.col("id") * 2).alias("auto_id"), F.date_add(F.lit("1883-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"), F.lit("riga").alias("port"), F.lit("deals").alias("commodity"))
        pairs, members = R.record_classes(own, own.select((F.col("auto_id") + 1).alias("human_id"), "date", "port", F.lit("deal").alias("commodity")))
        made.append(pairs.count())
        assert members.count() == 2 * n
    assert made[0] == made[1] == sum(abs(i - j) <= 14 for i in range(40) for j in range(40))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_query_has_every_pair_and_every_record(spark):
    from tidewater.plans import records

    autos, humans = records.sources(spark, SF)
    want = {tuple(r) for r in R.record_pairs(autos, humans).select("auto_id", "human_id", F.round("total_score", 6), F.coalesce("date_diff", F.lit(-1))).collect()}
    got = catalog.queries()["j7_record_pairs"](spark, SF).collect()
    of = {s: collections.defaultdict(list) for s in ("auto", "human")}
    for r in got:
        if r["kind"] != "pair":
            of[r["kind"]][r["class_id"]].append(r[f"{r['kind']}_id"])
    assert sum(map(len, of["auto"].values())) == autos.count() and sum(map(len, of["human"].values())) == humans.count()
    assert {(i, j, r["total_score"], r["date_diff"]) for r in got if r["kind"] == "pair" for i in of["auto"][r["auto_id"]] for j in of["human"][r["human_id"]]} == want and want
