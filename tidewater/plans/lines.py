"""Queries of the order-dependent operators, over lines of documents, turns of conversations and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import blocks as B
from tidewater.operators import cargo as G
from tidewater.operators import context as C
from tidewater.operators import datasets as D
from tidewater.operators import linkage as L
from tidewater.sources.files import lines
from tidewater.streaming import events
from tidewater.sources.tables import table

from .texts import quoted

LINE_SQL = "lines as (select doc_id, cast(generate_subscripts(a, 1) as int) line_number, unnest(a) line from (select doc_id, string_split(text, chr(10)) a from documents where text is not null))"
JOURNAL = ["LONDON.", "MILLWALL DOCKS.", "April 16.", "Sept. 11 Essex (s)-Konigsberg-sleepers-Order", "Fatfield (s)-Memel-deals-Order", "ALLOA.", "May 3.", "April 27. Andreas @ Fredrikstad,—54,266 boards, Nil.", "SURREY DOCKS.", "plain prose", "HULL."]
JOURNAL_SQL = f"journal as (select o_custkey doc_key, o_orderkey n, (list_value({', '.join(map(quoted, JOURNAL))}))[cast((o_orderkey * 7 + o_custkey) % {len(JOURNAL)} + 1 as int)] line from orders)"


def journal(spark, d):
    """Customers as journals: each order a line."""
    o = table(spark, d, "orders")
    pick = F.get(F.array(*map(F.lit, JOURNAL)), ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % len(JOURNAL)).cast("int"))
    return o.select(F.col("o_custkey").alias("doc_key"), F.col("o_orderkey").alias("n"), pick.alias("line"))


def doc_lines(spark, d):
    return lines(table(spark, d, "documents"), "text", ("doc_id",))


def t1_lines(spark, d):
    return doc_lines(spark, d).select("doc_id", "line_number", F.length("line").alias("n_chars"), F.md5("line").alias("line_md5"))


def w1_look_back(spark, d):
    x = doc_lines(spark, d).withColumn("h", F.when(F.length("line") <= 40, F.col("line_number")))
    return x.select("doc_id", "line_number", F.coalesce(C.look_back(F.col("h"), ["doc_id"], ["line_number"]), F.lit(0)).alias("header_line"))


def w2_forward_fill(spark, d):
    t = table(spark, d, "conversations").withColumn("h", F.when(F.col("role") == "user", F.col("turn")))
    return t.select("conv_id", "turn", F.coalesce(C.forward_fill(F.col("h"), ["conv_id"], ["turn"]), F.lit(-1)).alias("last_user_turn"))


def m1_carried_context(spark, d):
    x = C.carry_context(journal(spark, d), ["doc_key"], ["n"])
    return x.select("doc_key", "n", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("port", "month", "day")))


def w4_neighbour_mode(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return C.neighbour_mode(e, ["user_id"], ["event_id"], "event_type").select("event_id", "near")


def w5_runs(spark, d):
    return C.runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type").groupBy("event_type", "n").agg(F.count("*").alias("runs"))


def w6_first_of_signature(spark, d):
    return C.first_of_signature(table(spark, d, "documents").select("doc_id", "text"), ["text"], "doc_id").select("doc_id", F.length("text").alias("n_chars"))


def w8_sections(spark, d):
    x = C.sections(journal(spark, d), ["doc_key"], ["n"], T.is_port_header(F.col("line")))
    return x.groupBy("doc_key", "section").agg(F.count("*").alias("n_lines"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), "|").alias("body"))


def a10_duplicates(spark, d):
    x = doc_lines(spark, d).filter(F.length("line") > 20).withColumn("sig", F.md5("line"))
    return C.duplicate_report(x, ["sig"], "doc_id").select("sig", "n", "is_major", "members")


def a11_frequent_share(spark, d):
    per = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    totals = per.groupBy(F.col("event_type").alias("kind")).agg(F.sum("n").alias("total"))
    return per.filter("n >= 10").join(totals, F.col("event_type").eqNullSafe(F.col("kind"))).select("event_type", "user_id", "n", F.round(100 * F.col("n") / F.col("total"), 4).alias("percent"))


def a12_coverage(spark, d):
    j = C.carry_context(journal(spark, d), ["doc_key"], ["n"])
    p = T.parse_record(F.col("line"))
    return j.select(p.alias("p"), "port", "month").filter("p.format_type is not null").agg(
        F.count("*").alias("records"), F.count_if(F.col("port").isNotNull()).alias("with_port"), F.round(100 * F.count_if(F.col("month").isNotNull()) / F.greatest(F.count("*"), F.lit(1)), 2).alias("date_percent"),
        F.count_if("p.is_steamship").alias("steamships"),
    )


def a21_stratified(spark, d):
    return C.stratified(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "lang")


def a27_block_confidence(spark, d):
    x = journal(spark, d).filter(F.trim("line") != "")
    return x.groupBy("doc_key").agg(F.round(F.avg(B.is_import_record(F.col("line")).cast("double")), 6).alias("confidence"))


def p37_format_signals(spark, d):
    j = journal(spark, d).groupBy("doc_key").agg(
        F.count_if(T.is_port_header(F.col("line"))).alias("headers"), F.count_if(F.contains("line", F.lit("@"))).alias("at_lines"), F.count_if(F.col("line").rlike(r"-.*-.*-")).alias("dash_lines")
    )
    kind = T.first_case([(F.col("at_lines") > F.col("dash_lines"), "early_at"), (F.col("dash_lines") > 0, "dash"), (F.col("headers") > 0, "headers")], "unknown")
    return j.select("doc_key", "headers", "at_lines", "dash_lines", kind.alias("format"))


def a25_steam_and_sail(spark, d):
    """Records of steamships and of others by the month they stand under."""
    x = C.carry_context(journal(spark, d), ["doc_key"], ["n"]).select(T.parse_record(F.col("line")).alias("p"), "month").filter("p.format_type is not null")
    return x.groupBy(F.coalesce("month", F.lit("")).alias("month")).agg(F.count_if("p.is_steamship").alias("steam"), F.count_if(~F.col("p.is_steamship")).alias("sail"))


CARGO = ["102 bgs. wood pulp", "1,300 staves, Nickols & Co.", "115 pcs. timber, Order.", "deals and battens", "46,012 boards; 570 logs; 3 lds. oak, J. Smith", "570 logs mahogany and cedar", "ab", "—2,000 sleepers, Nil", None]


def t2_cargo_items(spark, d):
    o = table(spark, d, "orders")
    pick = F.get(F.array(*(F.lit(v).cast("string") for v in CARGO)), (F.col("o_orderkey") % len(CARGO)).cast("int"))
    items = o.select(F.col("o_orderkey").alias("id"), F.posexplode(G.parse_cargo(pick)).alias("pos", "item"))
    return items.select("id", "pos", *(F.coalesce(F.col(f"item.{c}"), F.lit("")).alias(c) for c in ("quantity", "unit", "commodity", "merchant")))


def m6_event_windows(spark, d):
    e = table(spark, d, "events")
    return events.windowed(e).select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("v", 4).alias("v"))


def m6_sessions(spark, d):
    return events.sessions(table(spark, d, "events")).groupBy("n").agg(F.count("*").alias("sessions"))


def a23_vocabulary(spark, d):
    v = table(spark, d, "part").select("p_type").distinct().filter("p_type < 'N'")
    p = table(spark, d, "part").join(v.withColumn("known", F.lit(1)), "p_type", "left")
    return p.groupBy("p_brand").agg(F.round(100 * F.sum(F.coalesce("known", F.lit(0))) / F.count("*"), 4).alias("covered_percent"))


def u1_ratio(spark, d):
    n = table(spark, d, "nation").select(F.col("n_name").alias("a"))
    pairs = n.join(n.select(F.col("a").alias("b")), F.substring("a", 1, 1) == F.substring("b", 1, 1))
    return pairs.select("a", "b", F.round(L.matching_ratio("a", "b"), 6).alias("ratio"))


QUERIES = {f.__name__: f for f in (t1_lines, w1_look_back, w2_forward_fill, m1_carried_context, w4_neighbour_mode, w5_runs, w6_first_of_signature, w8_sections, a10_duplicates, a11_frequent_share, a12_coverage, a25_steam_and_sail, a21_stratified, a27_block_confidence, p37_format_signals, t2_cargo_items, m6_event_windows, m6_sessions, a23_vocabulary, u1_ratio)}
HEADER = r"regexp_matches(line, '^[A-Z\s&.''()]+\.\s*$')"
CONTEXT_SQL = rf"""{JOURNAL_SQL},
named as (select *, case when {HEADER} then array_to_string(list_transform(string_split(regexp_replace(line, '\.\s*$', ''), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') end name from journal),
kinds as (select *, upper(name) in ('LONDON','LIVERPOOL','GLASGOW','HULL','BRISTOL','CARDIFF','LEITH','GRANGEMOUTH') is_city, regexp_matches(upper(name), 'DOCK|WHARF') is_dock,
  nullif(coalesce(nullif(regexp_extract(line, '^(\w{{3,9}})\.?\s+\d{{1,2}}\.?\s*$', 1), ''), regexp_extract(line, '^(\w{{3,9}})\.?\s+\d{{1,2}}\.?\s+.*(?:@|-.*-.*-)', 1)), '') m,
  nullif(coalesce(nullif(regexp_extract(line, '^\w{{3,9}}\.?\s+(\d{{1,2}})\.?\s*$', 1), ''), regexp_extract(line, '^\w{{3,9}}\.?\s+(\d{{1,2}})\.?\s+.*(?:@|-.*-.*-)', 1)), '') dd from named),
cities as (select *, last_value(case when is_city then name when name is not null and not is_dock then '' end ignore nulls) over (partition by doc_key order by n) city from kinds),
ports as (select *, case when is_dock and coalesce(city, '') <> '' then city || ' (' || name || ')' else name end p from cities),
context as (select doc_key, n, line, last_value(p ignore nulls) over w port, last_value(m ignore nulls) over w "month", last_value(dd ignore nulls) over w "day" from ports window w as (partition by doc_key order by n))"""
SQL = {
    "t1_lines": f"with {LINE_SQL} select doc_id, line_number, cast(length(line) as int) n_chars, md5(line) line_md5 from lines",
    "w1_look_back": f"""with {LINE_SQL} select doc_id, line_number, coalesce(last_value(case when length(line) <= 40 then line_number end ignore nulls)
  over (partition by doc_id order by line_number rows between 4 preceding and 1 preceding), 0) header_line from lines""",
    "w2_forward_fill": """select conv_id, turn, coalesce(last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn), -1) last_user_turn from conversations""",
    "m1_carried_context": f"""with {CONTEXT_SQL} select doc_key, n, coalesce(port, '') port, coalesce("month", '') "month", coalesce("day", '') "day" from context""",
    "w4_neighbour_mode": """with e as (select user_id, event_id, event_type, row_number() over (partition by user_id order by event_id) r from events),
c as (select a.event_id, b.event_type t, count(*) n from e a join e b on a.user_id = b.user_id and b.r between a.r - 10 and a.r + 9 and a.r <> b.r group by all),
m as (select event_id, t from (select *, row_number() over (partition by event_id order by n desc, t) k from c) where k = 1)
select e.event_id, coalesce(t, '') near from e left join m on m.event_id = e.event_id""",
    "w5_runs": """with c as (select *, case when event_type is distinct from lag(event_type) over (partition by user_id order by ts, event_id) then 1 else 0 end g from events),
r as (select *, sum(g) over (partition by user_id order by ts, event_id) run from c)
select event_type, n, count(*) runs from (select user_id, run, event_type, count(*) n from r group by all having count(*) >= 3) group by all""",
    "w6_first_of_signature": "select min(doc_id) doc_id, cast(length(text) as int) n_chars from documents group by text",
    "w8_sections": f"""with {JOURNAL_SQL}, s as (select *, sum(case when {HEADER} then 1 else 0 end) over (partition by doc_key order by n) sec from journal)
select doc_key, cast(sec as bigint) section, count(*) n_lines, string_agg(line, '|' order by n) body from s group by 1, 2""",
    "a10_duplicates": f"""with {LINE_SQL} select md5(line) sig, count(*) n, count(*) >= 50 is_major, array_to_string(list_sort(list(doc_id))[1:10], ',') members from lines where length(line) > 20 group by 1 having count(*) > 1""",
    "a11_frequent_share": """select * from (select event_type, user_id, count(*) n, round(100 * count(*) / sum(count(*)) over (partition by event_type), 4) percent from events group by 1, 2) where n >= 10""",
    "a12_coverage": rf"""with {CONTEXT_SQL} select count(*) records, count(port) with_port, round(100 * count("month") / greatest(count(*), 1), 2) date_percent, count(*) filter (contains(line, '(s)')) steamships
from context where line like '%@%' or regexp_matches(line, '-.*-.*-')""",
    "a25_steam_and_sail": rf"""with {CONTEXT_SQL} select coalesce("month", '') "month", count(*) filter (contains(line, '(s)')) steam, count(*) filter (not contains(line, '(s)')) sail
from context where line like '%@%' or regexp_matches(line, '-.*-.*-') group by 1""",
    "a21_stratified": """with n as (select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 i, count(*) over (partition by lang) n from documents)
select doc_id, lang from n where i % greatest(1, n // 5) = 0 and i // greatest(1, n // 5) < 5""",
    "a27_block_confidence": rf"""with {JOURNAL_SQL} select doc_key, round(avg(case when length(trim(line)) >= 10 and (contains(line, '@') or regexp_matches(trim(line), '^(\w+\.\s+)?\d{{1,2}}\s+\w+.*-.*-|^\w+[\s(].*-.*-.*-|^\d{{1,5}}\s+(pcs\.|lds\.|deals|timber|boards)')) then 1.0 else 0.0 end), 6) confidence from journal where trim(line) <> '' group by 1""",
    "p37_format_signals": rf"""with {JOURNAL_SQL}, c as (select doc_key, count(*) filter ({HEADER}) headers, count(*) filter (line like '%@%') at_lines, count(*) filter (regexp_matches(line, '-.*-.*-')) dash_lines from journal group by 1)
select *, case when at_lines > dash_lines then 'early_at' when dash_lines > 0 then 'dash' when headers > 0 then 'headers' else 'unknown' end format from c""",
    "t2_cargo_items": """with x(k, pos, quantity, unit, commodity, merchant) as (values (0, 0, '102', 'bgs', 'wood pulp', ''), (1, 0, '1300', '', 'staves', 'Nickols & Co'), (2, 0, '115', 'pcs', 'timber', ''),
  (3, 0, '', '', 'deals', ''), (4, 0, '46012', '', 'boards', ''), (4, 1, '570', '', 'logs', ''), (4, 2, '3', 'lds', 'oak', 'J. Smith'), (5, 0, '570', '', 'logs mahogany and cedar', ''), (7, 0, '2000', '', 'sleepers', ''))
select o_orderkey id, pos, quantity, unit, commodity, merchant from orders join x on o_orderkey % 9 = k""",
    "m6_event_windows": """select strftime(time_bucket(interval '6 hours', ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as "start", event_type, count(*) n, round(sum("value"), 4) v from events group by 1, 2""",
    "m6_sessions": """with c as (select *, case when ts - lag(ts) over w >= interval '2 hours' or lag(ts) over w is null then 1 else 0 end g from events window w as (partition by user_id order by ts, event_id)),
s as (select user_id, sum(g) over (partition by user_id order by ts, event_id) k from c)
select n, count(*) sessions from (select user_id, k, count(*) n from s group by 1, 2) group by 1""",
    "a23_vocabulary": """select p_brand, round(100 * count(*) filter (p_type < 'N') / count(*), 4) covered_percent from part group by 1""",
}
