"""Queries of record linkage and of name decisions."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import linkage as L
from tidewater.operators import records as R
from tidewater.sources.tables import ships, table

from .star import STAR

AUTO_SQL = """autos as (select event_id auto_id, cast(ts as date) auto_date, event_type auto_name, "value" auto_quantity, user_id from events where event_id % 2 = 0),
humans as (select event_id human_id, cast(ts as date) human_date, case when event_id % 3 = 0 then event_type || 's' else event_type end human_name, "value" human_quantity, user_id human_user from events where event_id % 2 = 1)"""
SAME_USER_SQL = "a.user_id = b.human_user and "
LIKE = """case when a.auto_name = b.human_name then 1.0 else 1 - levenshtein(lower(a.auto_name), lower(b.human_name)) / greatest(length(a.auto_name), length(b.human_name)) end"""
PAIRS_SQL = f"""{AUTO_SQL}, pairs as (select *, {LIKE} total_score from autos a join humans b on {SAME_USER_SQL}abs(date_diff('day', auto_date, human_date)) <= 14), good as (select * from pairs where total_score >= 0.8)"""


#: The queries link events of one user; those named ``_all`` link events of all users, so their pairs grow with the square.
USER = ("user_id",)


def sides(spark, d):
    """All events as two sources: those with even ids, and those with odd ids, a third of whose names differ."""
    e = table(spark, d, "events").withColumn("date", F.to_date("ts"))
    autos = e.filter("event_id % 2 = 0").select("user_id", F.col("event_id").alias("auto_id"), F.col("date").alias("auto_date"), F.col("event_type").alias("auto_name"), F.col("value").alias("auto_quantity"))
    name = F.when(F.col("event_id") % 3 == 0, F.concat("event_type", F.lit("s"))).otherwise(F.col("event_type"))
    humans = e.filter("event_id % 2 = 1").select("user_id", F.col("event_id").alias("human_id"), F.col("date").alias("human_date"), name.alias("human_name"), F.col("value").alias("human_quantity"))
    return autos, humans


def candidates(spark, d, on=USER):
    autos, humans = sides(spark, d)
    pairs = L.band_join(autos, humans if on else humans.drop("user_id"), "auto_date", "human_date", 14, on)
    return pairs.withColumn("total_score", L.similarity(F.col("auto_name"), F.col("human_name"))).filter("total_score >= 0.8")


def j7_band_join(spark, d, on=USER):
    """All pairs of similar names within 14 days; of all users they are listed from counted cells, with the scores of names rounded beforehand."""
    if not on:
        autos, humans, keys = keyed(spark, d)
        return L.cell_pairs(autos, humans, keys.withColumn("total_score", F.round("total_score", 6)))
    return candidates(spark, d, on).select("auto_id", "human_id", F.round("total_score", 6).alias("total_score"))


def keyed(spark, d):
    """The two sides with their names as keys, and which keys are similar enough."""
    autos, humans = (x.withColumnsRenamed({f"{s}_date": "date", f"{s}_name": "key"}) for s, x in zip(("auto", "human"), sides(spark, d)))
    keys = L.close_pairs(autos.select(F.col("key").alias("a_key")), humans.select(F.col("key").alias("b_key")), "a_key", "b_key")
    return autos, humans, keys.withColumnRenamed("score", "total_score")


def labels(spark, d, on=USER):
    """Labels of one user's events from their pairs, of all users' events from counted cells."""
    if not on:
        autos, humans, keys = keyed(spark, d)
        return R.labels_by_cells(autos.select("auto_id", "date", "key"), humans.select("human_id", "date", "key"), keys)
    autos, humans = sides(spark, d)
    return L.label_matches(candidates(spark, d, on), autos.select("auto_id"), humans.select("human_id"))


def j12_labels(spark, d, on=USER):
    x = labels(spark, d, on)
    return x.select("match_type", F.coalesce("auto_id", F.lit(-1)).alias("auto_id"), F.coalesce("human_id", F.lit(-1)).alias("human_id"), F.round("total_score", 6).alias("total_score"))


def a15_scores(spark, d, on=USER):
    x = labels(spark, d, on).agg(F.count_if(F.col("match_type").startswith("1:")).alias("tp"), F.count("auto_id").alias("found"), F.countDistinct("human_id").alias("wanted"))
    return x.select("tp", "found", "wanted", *L.scores(F.col("tp"), F.col("found"), F.col("wanted")))


def a15_label_scores(spark, d):
    """Precision, recall and F1 of a plain predicate against the labels."""
    docs, marks = table(spark, d, "documents"), table(spark, d, "labels")
    x = docs.join(marks, "doc_id").select((F.contains("text", F.lit("!!")) | F.contains("text", F.lit(" | "))).alias("found"), (F.col("quality") == 0).alias("wanted"))
    x = x.agg(F.count_if(F.expr("found and wanted")).alias("tp"), F.count_if("found").alias("found"), F.count_if("wanted").alias("wanted"))
    return x.select("tp", "found", "wanted", *L.scores(F.col("tp"), F.col("found"), F.col("wanted")))


def a16_distribution(spark, d, on=USER):
    kind = F.regexp_replace("match_type", r" \(best of \d+\)", "")
    x = labels(spark, d, on).groupBy(kind.alias("match_type")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # four rows
    return x.withColumn("percent", F.round(100 * F.col("n") / total, 4))


def a17_accuracy(spark, d, on=USER):
    if not on:
        autos, humans, keys = keyed(spark, d)
        x = R.near_quantities(autos.withColumnRenamed("auto_quantity", "quantity"), humans.withColumnRenamed("human_quantity", "quantity"), keys)
        return x.select(F.col("key").alias("auto_name"), "n", F.col("within_0").alias("within_5"), F.col("within_1").alias("within_10"))
    c = candidates(spark, d, on).withColumn("apart", F.try_divide(F.abs(F.col("auto_quantity") - F.col("human_quantity")), F.greatest("auto_quantity", "human_quantity")))
    return c.groupBy("auto_name").agg(F.count("*").alias("n"), F.count_if(F.col("apart") <= 0.05).alias("within_5"), F.count_if(F.col("apart") <= 0.10).alias("within_10"))


def a18_examples(spark, d, on=USER):
    if not on:
        autos, humans, keys = keyed(spark, d)
        return R.examples_by_cells(autos.select("auto_id", "date", "key"), humans.select("human_id", "date", "key"), keys)
    c = candidates(spark, d, on).withColumn("k", F.when(F.col("total_score") == 1, "same").otherwise("near"))
    r = F.row_number().over(Window.partitionBy("k").orderBy("auto_id", "human_id"))
    return c.withColumn("r", r).filter("r <= 3").select("k", "r", "auto_id", "human_id")


def j8_nearest(spark, d):
    """Each event with the week of events or orders that begins nearest to it."""
    own = table(spark, d, "events").select(F.col("event_id").alias("auto_id"), F.to_date("ts").alias("auto_date"))
    issues = table(spark, d, "orders").select(F.date_trunc("week", "o_orderdate").cast("date").alias("w")).distinct()
    issues = table(spark, d, "events").select(F.date_trunc("week", "ts").cast("date").alias("issue")).distinct().unionByName(issues.withColumnRenamed("w", "issue")).distinct()
    return L.nearest(own, issues, "auto_id", "auto_date", "issue", 14).select("auto_id", "issue", "days_apart")


def misspelled():
    """A quarter of the names with an E more, a quarter with other vowels."""
    return F.when(F.col("record_id") % 4 == 0, F.concat("origin_port", F.lit("E"))).when(F.col("record_id") % 4 == 1, F.translate("origin_port", "AI", "EY")).otherwise(F.col("origin_port"))

MISSPELLED_SQL = "case record_id % 4 when 0 then origin_port || 'E' when 1 then translate(origin_port, 'AI', 'EY') else origin_port end"



def raw_ports(spark, d):
    return ships(spark, d).select("record_id", misspelled().alias("raw"))


def j9_best_match(spark, d):
    found = L.best_match(raw_ports(spark, d), table(spark, d, "nation"), "raw", "n_name")
    return found.select("raw", "n_name", F.round("score", 6).alias("score"))


def tiers(spark, d):
    raw = raw_ports(spark, d)
    counts = raw.groupBy("raw").agg(F.count("*").alias("ship_count"))
    exact = table(spark, d, "nation").select(F.lower("n_name").alias("low"), F.lit(True).alias("exact"))
    x = counts.join(exact, F.lower("raw") == F.col("low"), "left").join(L.best_match(raw, table(spark, d, "nation"), "raw", "n_name"), "raw", "left")
    tier = L.tier(T.is_port_error(F.col("raw"), "origin"), F.coalesce("exact", F.lit(False)), F.lit(False), F.coalesce("score", F.lit(0.0)))
    return x.withColumn("tier", tier)


def p16_a14_triage(spark, d):
    x = tiers(spark, d)
    return x.select("raw", "ship_count", F.coalesce("n_name", F.lit("")).alias("match"), "tier", L.triage(F.col("tier"), F.col("ship_count")).alias("outcome"))


def j13_decisions(spark, d):
    n = table(spark, d, "nation")
    decisions = n.select(F.concat("n_name", F.lit("E")).alias("original_port"), F.when(F.col("n_nationkey") % 3 == 0, "ERROR").when(F.col("n_nationkey") % 3 == 1, "MAP").otherwise("ACCEPT").alias("action"), F.col("n_name").alias("map_to_port"))
    x = L.decide(raw_ports(spark, d), decisions, "raw", F.lower("raw"))
    return x.groupBy("raw", "decided").agg(F.count("*").alias("n"))


def j11_greedy(spark, d):
    """One-to-one among the events of a user in a week, which are an issue's records."""
    autos, humans = sides(spark, d)
    week = lambda c: F.date_trunc("week", c).cast("date")
    pairs = autos.withColumn("week", week("auto_date")).join(humans.withColumn("week", week("human_date")), ["user_id", "week"])
    pairs = pairs.withColumn("block", F.concat_ws("/", "user_id", "week")).withColumn("total_score", L.similarity(F.col("auto_name"), F.col("human_name"))).filter("total_score >= 0.8")
    return L.greedy(pairs).select("block", "auto_id", "human_id", F.round("total_score", 6).alias("total_score"))


QUERIES = {f.__name__: f for f in (j7_band_join, j8_nearest, j9_best_match, j11_greedy, j12_labels, j13_decisions, p16_a14_triage, a15_scores, a15_label_scores, a16_distribution, a17_accuracy, a18_examples)}
LINKED = (j7_band_join, j12_labels, a15_scores, a16_distribution, a17_accuracy, a18_examples)
QUERIES |= {f"{f.__name__}_all": partial(f, on=()) for f in LINKED}
LABELS_SQL = f"""{PAIRS_SQL}, ranked as (select *, count(*) over (partition by auto_id) n, row_number() over (partition by auto_id order by total_score desc, human_id) r from good),
matched as (select case when n = 1 then '1:1' else '1:many (best of ' || n || ')' end match_type, auto_id, human_id, total_score from ranked where r = 1),
labels_ as (select * from matched union all select 'unmatched_auto', auto_id, null, 0.0 from autos where auto_id not in (select auto_id from matched)
  union all select 'unmatched_human', null, human_id, 0.0 from humans where human_id not in (select human_id from matched))"""
SCORE_SQL = "round(coalesce(tp / nullif(found, 0), 0), 6) as \"precision\", round(coalesce(tp / nullif(wanted, 0), 0), 6) recall, round(coalesce(2 * (tp / found) * (tp / wanted) / nullif(tp / found + tp / wanted, 0), 0), 6) f1"
BEST_SQL = f"""raws as (select record_id, {MISSPELLED_SQL} raw from ships), best as (select * from (select raw, n_name, 1 - levenshtein(lower(raw), lower(n_name)) / greatest(length(raw), length(n_name)) score,
  row_number() over (partition by raw order by levenshtein(lower(raw), lower(n_name)) / greatest(length(raw), length(n_name)), n_name) r from (select distinct raw from raws), nation) where r = 1 and score > 0.70)"""
SQL = {
    "j7_band_join": f"with {PAIRS_SQL} select auto_id, human_id, round(total_score, 6) total_score from good",
    "j8_nearest": """with autos as (select event_id auto_id, cast(ts as date) auto_date from events), issues as (select distinct cast(date_trunc('week', ts) as date) issue from events union select distinct cast(date_trunc('week', o_orderdate) as date) from orders)
select auto_id, issue, days_apart from (select auto_id, issue, cast(abs(date_diff('day', auto_date, issue)) as int) days_apart, row_number() over (partition by auto_id order by abs(date_diff('day', auto_date, issue)), issue) r
  from autos, issues) where r = 1 and days_apart <= 14""",
    "j9_best_match": f"{STAR}, {BEST_SQL} select raw, n_name, round(score, 6) score from best",
    "j12_labels": f"with {LABELS_SQL} select match_type, coalesce(auto_id, -1) auto_id, coalesce(human_id, -1) human_id, round(total_score, 6) total_score from labels_",
    "j13_decisions": f"""{STAR}, {BEST_SQL}, dec as (select n_name || 'E' o, n_nationkey % 3 a, n_name m from nation)
select raw, case a when 0 then '' when 1 then m when 2 then raw else lower(raw) end decided, count(*) n from raws left join dec on o = raw group by 1, 2""",
    "p16_a14_triage": f"""{STAR}, {BEST_SQL}, t as (select c.raw, ship_count, coalesce(n_name, '') as "match",
  case when length(c.raw) <= 2 then 'error' when lower(c.raw) in (select lower(n_name) from nation) then 'exact' when score > 0.92 then 'fuzzy_high' when score > 0.85 then 'fuzzy_medium' when score > 0.70 then 'fuzzy_low' else 'unmapped' end tier
  from (select raw, count(*) ship_count from raws group by 1) c left join best b on b.raw = c.raw)
select *, case when tier in ('exact', 'variant', 'fuzzy_high') then 'auto' when tier = 'error' then 'error' when ship_count >= 20 or tier = 'fuzzy_medium' then 'review' when ship_count < 10 then 'error' else 'review' end outcome from t""",
    "a15_scores": f"""with {LABELS_SQL}, c as (select count(*) filter (match_type like '1:%') tp, count(auto_id) found, count(distinct human_id) wanted from labels_) select tp, found, wanted, {SCORE_SQL} from c""",
    "a15_label_scores": f"""with x as (select contains(text, '!!') or contains(text, ' | ') f, quality = 0 w from documents join labels using (doc_id)),
c as (select count(*) filter (f and w) tp, count(*) filter (f) found, count(*) filter (w) wanted from x) select tp, found, wanted, {SCORE_SQL} from c""",
    "a16_distribution": f"""with {LABELS_SQL} select regexp_replace(match_type, ' \\(best of \\d+\\)', '') match_type, count(*) n, round(100 * count(*) / sum(count(*)) over (), 4) percent from labels_ group by 1""",
    "a17_accuracy": f"""with {PAIRS_SQL} select auto_name, count(*) n, count(*) filter (abs(auto_quantity - human_quantity) / greatest(auto_quantity, human_quantity) <= 0.05) within_5,
  count(*) filter (abs(auto_quantity - human_quantity) / greatest(auto_quantity, human_quantity) <= 0.10) within_10 from good group by 1""",
    "a18_examples": f"""with {PAIRS_SQL}, k as (select case when total_score = 1 then 'same' else 'near' end k, auto_id, human_id from good)
select k, r, auto_id, human_id from (select *, cast(row_number() over (partition by k order by auto_id, human_id) as int) r from k) where r <= 3""",
}
SQL |= {f"{f.__name__}_all": SQL[f.__name__].replace(SAME_USER_SQL, "") for f in LINKED}
