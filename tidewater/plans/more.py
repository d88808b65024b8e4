"""Queries of the remaining operators: headings, fix tables, batches, ranks, ids, orders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions import dates as N
from tidewater.functions import text as T
from tidewater.operators import blocks as B
from tidewater.operators import context as C
from tidewater.operators import linkage as L
from tidewater.sources.tables import cargo, ships, table

from .lines import journal
from .links import MISSPELLED_SQL, misspelled
from .star import SHIPS, STAR
from .texts import LINES, quoted, sample, sample_sql

HEADINGS = ["LONDON.", "H.", "A.", "HULL.", "TIMBER TRADES JOURNAL.", "PITCH PINE.", "FREIGHTS.", "ALLOA.", "imports of timber into", "In all 12", "May 3 lines", "",
            "The Gandy Belt.", "OAK.", "OAKHAM.", "R & CO.", "BRANCH YARD AT NEWBURGH.", "MILWALL.", "B. & F. WHARF.", "SILVER MEDAL.", "LEITH."]
#: Which of them are skipped, and which head a list.
SKIPPED = [False, True, True, False, True, True, True, False, True, False, False, False, True, True, False, True, True, True, True, True, False]
HEADS = [False, False, False, False, False, False, False, False, True, True, True, True] + [False] * 9


def f5_skip_headers(spark, d):
    return sample(spark, d, HEADINGS).select("id", B.skipped(F.col("s")).alias("skipped"), B.heads_lines(F.col("s")).alias("heads"))


PLACES, GOODS = ["Riga", "Memel"], ["deals", "timber", "oak"]
DASHED = ["1889-03-27 — Surrey Commercial Docks — Riga — 14,559 n.s. deals; for Smith & Co.", "Hull — Danzig — 30 loads oak", "Hull (late) — memel — staves", "LONDON.", "no dashes here", ""]


def t5_parsed_lines(spark, d):
    x = B.parse_lines(sample(spark, d, DASHED), "s", PLACES, GOODS)
    arrays = {"goods": "product_type_list", "warned": "warnings"}
    texts = ("date_iso", "arrival_place_raw", "departure_port_raw", "departure_port_std", "product_list_raw", "merchants_raw", "notes")
    return x.select("id", *(F.coalesce(f"parsed.{c}", F.lit("")).alias(c) for c in texts), *(F.array_join(f"parsed.{c}", ",").alias(n) for n, c in arrays.items()))


def f4_triage(spark, d):
    x = B.triage(B.parse_lines(sample(spark, d, DASHED), "s", PLACES, GOODS))
    return x.groupBy(F.array_join("parsed.warnings", ",").alias("warned")).agg(F.count("*").alias("lines"))


def p14_fuzzy_commodities(spark, d):
    """Names of which some are misspelled, by the frequent ones."""
    x = cargo(spark, d).select(F.when(F.col("record_id") % 5000 == 7, F.concat("commodity", F.lit("X"))).otherwise(F.col("commodity")).alias("raw"))
    return L.normalize_commodities(x, "raw").groupBy("commodity_name").agg(F.count("*").alias("n"))


def p15_fuzzy_ports(spark, d):
    x = ships(spark, d).select(misspelled().alias("raw"))
    return L.normalize_ports(x, "raw", table(spark, d, "nation"), "n_name").groupBy("raw", "port").agg(F.count("*").alias("n"))


def n14_word_errors(spark, d):
    x = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_type", "p_brand").alias("truth"))
    read = F.regexp_replace(F.regexp_replace("truth", "E", "F"), "STANDARD ", "")
    return x.select("p_partkey", F.round(N.word_error_rate(read, F.col("truth")), 6).alias("wer"))


def f9_import_records(spark, d):
    return sample(spark, d, [x for x in LINES if x is not None]).select("id", B.is_import_record(F.col("s")).alias("is_record"))


def p21_fix_table(spark, d):
    """Commodities through a table of fixes: ERROR empties, NORMALIZE replaces."""
    fixes = table(spark, d, "part").select("p_type").distinct()
    fixes = fixes.select(F.col("p_type").alias("commodity"), F.when(F.col("p_type") < "F", "ERROR").when(F.col("p_type") < "P", "NORMALIZE").alias("action"), F.lower("p_type").alias("recommendation")).filter("action is not null")
    x = cargo(spark, d).join(fixes, "commodity", "left")
    fixed = F.when(F.col("action") == "ERROR", "").when(F.col("action") == "NORMALIZE", F.col("recommendation")).otherwise(F.col("commodity"))
    return x.groupBy(fixed.alias("fixed")).agg(F.count("*").alias("n"))


def p21_recommended(spark, d):
    """The last words of commodities as single forms, fragments and units."""
    words = [*T.NO_COMMODITIES, *T.MERGED_COMMODITIES, "Deal ", "oak"]
    pick = F.get(F.array(*map(F.lit, words)), (F.col("o_orderkey") % len(words)).cast("int"))
    return table(spark, d, "orders").groupBy(T.recommended_commodity(pick).alias("fixed")).agg(F.count("*").alias("n"))


def p29_aliases(spark, d):
    low = F.lower("text")
    for old, new in (("the", "le"), ("and", "et")):
        low = F.regexp_replace(low, rf"\b{old}\b", new)
    return table(spark, d, "documents").select("doc_id", F.md5(low).alias("aliased_md5"))


def p35_recompose(spark, d):
    """Turns of a conversation as numbered lines of one text."""
    t = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("a"))
    return t.select("conv_id", F.md5(F.array_join(F.transform("a", lambda x: F.concat_ws(": ", x["turn"].cast("string"), x["role"], x["text"])), "\n")).alias("text_md5"))


def t8_blocks(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\n\n")).alias("pos", "block"))
    return t.select("conv_id", "turn", "pos", F.length("block").alias("n_chars"))


def t4_entries(spark, d):
    texts = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("Ann (s) @ Riga. — deals, "), F.col("o_orderpriority"), F.lit(". Sophie @ Hull. — oak")).alias("s"))
    return B.entries(texts, "id", "s").groupBy("ship_name", "is_steamship", "origin_port").agg(F.count("*").alias("n"))


def w7_running_ids(spark, d):
    """Ids from 1 in the order of the date: counts of days before, and a number within the day."""
    s = ships(spark, d).select("record_id", "ship_date")
    days = s.groupBy("ship_date").agg(F.count("*").alias("n"))
    before = days.select("ship_date", (F.sum("n").over(Window.orderBy("ship_date")) - F.col("n")).alias("before"))  # a row for each day
    within = F.row_number().over(Window.partitionBy("ship_date").orderBy("record_id"))
    return s.withColumn("r", within).join(before, "ship_date").select("record_id", (F.col("before") + F.col("r")).alias("running_id"))


IMPORT_LINES = ["Imports of Timber", "LONDON.", "Fatfield (s)-Memel-deals-Order", "April 27. Andreas @ Fredrikstad,—54,266 boards", "some prose", "more prose, and so on", "", "HULL.", "the ship of last week", "115 pcs. timber, Order",
                "IMPORTS.", "THE WOOD TRADE in spring", "SURREY COMMERCIAL DOCKS.", "11 Essex (s)-Konigsberg-sleepers-Order", "ALL.", "Essex (s)-Riga-deals-Smith", "3 lds. oak", "12 Sophie-Danzig-oak-Order"]
#: What each of them is to a list of imports.
IMPORT_KINDS = ["header", "record", "record", "record", "other", "other", "blank", "record", "other", "record", "header", "end", "end", "record", "other", "record", "other", "record"]


def w9_import_blocks(spark, d):
    k = (F.col("o_orderkey") * 13 + F.floor(F.col("o_orderkey") / 7) * 5) % len(IMPORT_LINES)
    x = table(spark, d, "orders").select((F.col("o_orderkey") % 97).alias("doc_key"), F.col("o_orderkey").alias("n"), F.get(F.array(*map(F.lit, IMPORT_LINES)), k.cast("int")).alias("line"))
    return B.import_blocks(x, "doc_key", "n")


def w3_date_labels(spark, d):
    """Customers' orders as running text, every third with a date; each entry with the date it stands under."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    dated = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.date_format("o_orderdate", "MMMM"), F.lit(" 3rd. "))).otherwise(F.lit(""))
    piece = F.concat(dated, F.lit("Ship"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " (s)").otherwise(""), F.lit(" @ "), F.col("n_name"), F.lit(". — 12 "), F.lower("o_orderpriority"))
    texts = o.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", piece.alias("piece")))), lambda x: x["piece"]), ". ").alias("text"))
    return B.entries(texts, "o_custkey", "text").select("o_custkey", "ship_name", "is_steamship", "origin_port", "body", F.coalesce("date_label", F.lit("")).alias("date_label"))


def w11_ranks(spark, d):
    per = ships(spark, d).groupBy("destination_port", "origin_port").agg(F.count("*").alias("ship_count"))
    return per.withColumn("place", F.rank().over(Window.partitionBy("destination_port").orderBy(F.desc("ship_count"))))


def text_order(s):
    """Places in the order of year, month name and day as texts, missing ones last: what stands in days before, and a number within the day."""
    s = s.select("record_id", F.year("ship_date").cast("string").alias("y"), N.month_name(F.month("ship_date")).alias("m"), F.when(F.col("record_id") % 3 != 0, F.day("ship_date").cast("string")).alias("dd"))
    s = s.withColumns({"m": F.coalesce("m", F.lit("ZZZ")), "dd": F.coalesce("dd", F.lit("99"))})
    days = s.groupBy("y", "m", "dd").agg(F.count("*").alias("size"))  # some 400 rows a year
    before = days.select(F.col("y").alias("by"), F.col("m").alias("bm"), F.col("dd").alias("bd"), (F.sum("size").over(Window.partitionBy("y").orderBy("m", "dd")) - F.col("size")).alias("before"))
    placed = C.place_within(s, ["y", "m", "dd"], "record_id", "within")
    met = placed.join(before, F.col("y").eqNullSafe(F.col("by")) & (F.col("m") == F.col("bm")) & (F.col("dd") == F.col("bd")))
    return met.select("record_id", (F.col("before") + F.col("within") + 1).cast("int").alias("place"))


def o2_text_order(spark, d):
    """Places among all shipments of a year."""
    return text_order(ships(spark, d))


def o5_natural_order(spark, d):
    """Names by their text and then their number."""
    p = table(spark, d, "part").select("p_brand").distinct()
    key = [F.regexp_extract("p_brand", r"^(\D*)", 1), F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")]
    return p.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*key)))  # a few brands


def k9_batches(spark, d):
    numbered = C.place_within(table(spark, d, "documents").select("lang", "doc_id"), ["lang"], "doc_id", "n")
    return numbered.groupBy("lang", F.floor(F.col("n") / 50).alias("batch")).agg(F.count("*").alias("lines"))


def n5_arrival_dates(spark, d):
    s = ships(spark, d).select("record_id", F.concat_ws("-", F.year("ship_date"), N.month_name(F.month("ship_date")), F.day("ship_date")).alias("raw"))
    got = F.date_format(F.try_to_timestamp("raw", F.lit("yyyy-MMMM-d")), "yyyy-MM-dd")
    return s.select("record_id", F.coalesce(got, "raw").alias("arrival"))


def n13_grades(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg((100 * F.count_if(F.col("value") > 50) / F.count("*")).alias("p"))
    return e.groupBy(N.grade(F.col("p")).alias("grade")).agg(F.count("*").alias("users"))


QUERIES = {f.__name__: f for f in (f4_triage, n14_word_errors, p14_fuzzy_commodities, p15_fuzzy_ports, t5_parsed_lines, f5_skip_headers, f9_import_records, p21_fix_table, p21_recommended, p29_aliases, p35_recompose, t4_entries, t8_blocks, w3_date_labels, w7_running_ids, w9_import_blocks, w11_ranks, o2_text_order, o5_natural_order, k9_batches, n5_arrival_dates, n13_grades)}
SQL = {
    "f5_skip_headers": f"""with x(k, skipped, heads) as (values {", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(SKIPPED, HEADS)))})
select o_orderkey id, skipped, heads from orders join x on o_orderkey % {len(HEADINGS)} = k""",
    "t5_parsed_lines": f"""with x(k, date_iso, arrival_place_raw, departure_port_raw, departure_port_std, product_list_raw, merchants_raw, notes, goods, warned) as (values
  (0, '1889-03-27', 'Surrey Commercial Docks', 'Riga', 'Riga', '. deals', 'for Smith & Co.', '', 'deals', ''), (1, '', 'Hull', 'Danzig', '', 'oak', '', '', 'oak', 'unknown_port'),
  (2, '', 'Hull', 'memel', 'Memel', 'staves', '', 'late', '', 'ambiguous_products')) select o_orderkey id, x.* exclude (k) from orders join x on o_orderkey % 6 = k""",
    "f4_triage": "select case o_orderkey % 6 when 1 then 'unknown_port' else 'ambiguous_products' end warned, count(*) lines from orders where o_orderkey % 6 in (1, 2) group by 1",
    "p14_fuzzy_commodities": f"{STAR} select lower(commodity) commodity_name, count(*) n from cargo group by 1",
    "p15_fuzzy_ports": f"with {SHIPS} select {MISSPELLED_SQL} raw, case record_id % 4 when 1 then translate(origin_port, 'AI', 'EY') else origin_port end port, count(*) n from ships group by 1, 2",
    "f9_import_records": f"""with {sample_sql([x for x in LINES if x is not None])} select id, length(s) >= 10 and (s like '%@%' or regexp_matches(s, '^(\\w+\\.\\s+)?\\d{{1,2}}\\s+\\w+.*-.*-|^\\w+[\\s(].*-.*-.*-')) is_record from sample""",
    "p21_fix_table": f"""{STAR} select case when commodity < 'F' then '' when commodity < 'P' then lower(commodity) else commodity end fixed, count(*) n from cargo group by 1""",
    "p21_recommended": """with fixes(k, fixed) as (values (22, 'squares'), (29, ''), (30, 'deals'), (31, 'staves'), (32, 'props'), (33, 'battens'), (34, 'boards'), (35, 'sleepers'), (36, 'logs'), (37, 'hoops'),
  (38, 'ends'), (39, 'laths'), (40, 'scantlings'), (41, 'spars'), (42, 'planks'), (43, 'floorings'), (44, 'squares'), (45, 'deals'), (46, 'oak'))
select coalesce(fixed, '') fixed, count(*) n from orders left join fixes on o_orderkey % 47 = k group by 1""",
    "p29_aliases": r"""select doc_id, md5(regexp_replace(regexp_replace(lower(text), '\bthe\b', 'le', 'g'), '\band\b', 'et', 'g')) aliased_md5 from documents""",
    "p35_recompose": """select conv_id, md5(string_agg(turn || ': ' || role || ': ' || text, chr(10) order by turn, role, text)) text_md5 from conversations group by 1""",
    "t4_entries": """select 'Ann' ship_name, true is_steamship, 'Riga' origin_port, count(*) n from orders union all select 'Sophie', false, 'Hull', count(*) from orders""",
    "t8_blocks": """select conv_id, turn, cast(generate_subscripts(a, 1) - 1 as int) pos, cast(length(unnest(a)) as int) n_chars from (select conv_id, turn, string_split(text, chr(10) || chr(10)) a from conversations)""",
    "w7_running_ids": f"with {SHIPS} select record_id, row_number() over (order by ship_date, record_id) running_id from ships",
    "w3_date_labels": """with x as (select *, 'Ship' || o_orderkey ship, case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%B') || ' 3rd' end d from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
select o_custkey, ship ship_name, o_orderkey % 2 = 0 is_steamship, n_name origin_port, '12 ' || lower(o_orderpriority) body, coalesce(last_value(d ignore nulls) over (partition by o_custkey order by o_orderkey), '') date_label from x""",
    "w9_import_blocks": f"""with recursive kinds(k, kind) as (values {", ".join(f"({i}, '{k}')" for i, k in enumerate(IMPORT_KINDS))}),
l as (select o_orderkey % 97 doc, o_orderkey n, kind, row_number() over (partition by o_orderkey % 97 order by o_orderkey) i from orders join kinds on k = (o_orderkey * 13 + (o_orderkey // 7) * 5) % {len(IMPORT_LINES)}),
walk as (
  select distinct doc, cast(0 as bigint) i, false inside, 0 others, cast(0 as bigint) begun, false closed, cast(0 as bigint) c_begun, cast(0 as bigint) c_last, cast(0 as bigint) c_n from l
  union all
  select l.doc, l.i, x.inside, x.others, case when kind = 'header' then l.i else begun end, w.inside and (kind = 'header' or (not x.inside and l.i - begun >= 6)),
    begun, case when kind = 'other' then l.i - 3 else l.i - 1 end, l.i - begun
  from walk w join l on l.doc = w.doc and l.i = w.i + 1,
    lateral (select kind = 'header' or (w.inside and kind <> 'end' and not (kind = 'other' and w.others = 3)) inside, case when kind = 'other' then w.others + 1 else 0 end others) x),
ends as (select doc, max(i) m from l group by 1),
blocks as (
  select doc, c_begun a, c_last b, c_n n from walk where closed
  union all select doc, begun, m, m - begun + 1 from walk join ends using (doc) where i = m and inside and m - begun >= 5)
select blocks.doc, f.n as "first", t.n as "last", blocks.n from blocks join l f on f.doc = blocks.doc and f.i = a join l t on t.doc = blocks.doc and t.i = b""",
    "w11_ranks": f"""with {SHIPS} select destination_port, origin_port, count(*) ship_count, cast(rank() over (partition by destination_port order by count(*) desc) as int) place from ships group by 1, 2""",
    "o2_text_order": f"""with {SHIPS}, t as (select record_id, cast("year" as varchar) y, strftime(ship_date, '%B') m, case when record_id % 3 <> 0 then cast(day(ship_date) as varchar) end dd from ships)
select record_id, cast(row_number() over (partition by y order by y, m, coalesce(dd, '99'), record_id) as int) place from t""",
    "o5_natural_order": r"""select p_brand, cast(row_number() over (order by regexp_extract(p_brand, '^(\D*)', 1), cast(regexp_extract(p_brand, '(\d+)$', 1) as int)) as int) place from (select distinct p_brand from part)""",
    "k9_batches": """select lang, n // 50 batch, count(*) lines from (select lang, row_number() over (partition by lang order by doc_id) - 1 n from documents) group by 1, 2""",
    "n5_arrival_dates": f"with {SHIPS} select record_id, strftime(ship_date, '%Y-%m-%d') arrival from ships",
    "n13_grades": """select case when p >= 35 then 'GOOD' when p >= 25 then 'MODERATE' else 'POOR' end grade, count(*) users from (select user_id, 100 * count(*) filter ("value" > 50) / count(*) p from events group by 1) group by 1""",
}
