"""Queries of formats and tags over generated texts: journals of a page a customer, and lists of goods of an order each."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import cargo_grammar as G
from tidewater.operators import context as C
from tidewater.operators import formats as P
from tidewater.operators import linkage as L
from tidewater.sources.files import lines
from tidewater.sources.tables import cargo, table

from .lines import JOURNAL_SQL, LINE_SQL, journal
from .star import STAR


def pages(spark, d):
    """A customer's journal as one text, of the year 1870 and its key by 25; every fifth has no year."""
    x = journal(spark, d).groupBy("doc_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), "\n").alias("text"))
    return x.withColumn("year", F.when(F.col("doc_key") % 5 != 0, (1870 + F.col("doc_key") % 25).cast("int")))


def p37_signals(spark, d):
    found = P.signals(F.col("text"))
    arrays = ("port_headers", "sample_records")
    return pages(spark, d).select("doc_key", *((F.array_join(v, "|") if k in arrays else v).alias(k) for k, v in found.items()))


def p38_formats(spark, d):
    return pages(spark, d).select("doc_key", P.format_of(F.col("text"), F.col("year")).alias("format"))


def a22_formats_by_year(spark, d):
    return P.formats_by_year(pages(spark, d), "year", "text").withColumn("year", F.coalesce("year", F.lit(0)))


GOODS = ["redwood", "deals", "ends", "deal ends", "deaks", "oak logs", "deal", "pine", "boards", "and", "legends", "Teak"]
KINDS = ["oak logs", "deal ends", "redwood", "boards", "deals", "logs", "pine", "teak", "oak"]


def p28_tagged(spark, d):
    """Lists of three to six words, as many as there are orders."""
    k = F.col("o_orderkey")
    pick = lambda i: F.get(F.array(*map(F.lit, GOODS)), ((k * 31 + i * i * 7 + F.floor(k / (i + 2))) % len(GOODS)).cast("int"))
    words = F.transform(F.sequence(F.lit(1), (3 + k % 4).cast("int")), pick)
    return table(spark, d, "orders").select("o_orderkey", F.array_join(T.tagged_products(F.array_join(words, " "), KINDS), "|").alias("types"))


def a10_sources(spark, d):
    """Lines that several places have, with the sources of their documents."""
    docs = table(spark, d, "documents")
    x = lines(docs, "text", ("doc_id", "source")).filter(F.length("line") > 20).withColumn("sig", F.md5("line"))
    return C.duplicate_report(x, ["sig"], "doc_id", source="source").select("sig", "n", "is_major", "members", "n_sources", "sources")


def p14_listed_commodities(spark, d):
    """Names that are listed stay, though the rules would change some of them."""
    goods = F.when(F.col("record_id") % 4 == 0, "Oak Planks").when(F.col("record_id") % 4 == 1, " bright red deals").when(F.col("record_id") % 4 == 2, "white deal").otherwise(F.col("commodity"))
    x = cargo(spark, d).select(goods.alias("raw"))
    listed = spark.range(1).select(F.explode(F.array(F.lit("Bright red deals"), F.lit("oak planks"))).alias("commodity"))
    return L.normalize_commodities(x, "raw", canonical=listed).groupBy("commodity_name").agg(F.count("*").alias("n"))


UNITS = [("pcs. ", "pieces"), ("loads ", "loads"), ("", ""), ("Bdls ", "bundles"), ("ton ", "tons"), ("doz. ", "dozens"), ("cords ", "cords")]
ITEMS = [("deals", "deals"), ("Oak", "oak"), ("pitch pine timber", "pitch pine timber"), ("split-staves", "split-staves"), ("loads", "")]
MERCHANTS = [("", ""), (", SMITH & CO.", "Smith"), (", Order", ""), (", H. & R. Fowler", "H. and R. Fowler"), (", Messrs. J. BROWN & Sons", "J. Brown"), (", Bank Of The North Ltd", "Bank of the North"), (", nil", "")]


def t2_cargo_grammar(spark, d):
    """One to three items an order, of every quantity, unit, commodity and merchant; a unit in a commodity's place is none."""
    k = F.col("o_orderkey")
    of = lambda pairs, at: F.get(F.array(*(F.lit(a) for a, _ in pairs)), (at % len(pairs)).cast("int"))
    item = lambda i: F.concat(F.format_number((k * 37 + i * 11) % 99991 + 1, 0), F.lit(" "), of(UNITS, k + i), of(ITEMS, F.floor(k / 3) + i * 2), of(MERCHANTS, F.floor(k / 5) + i * 3))
    items = F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), item)
    cargo_ = F.concat(F.when(k % 2 == 0, "—").otherwise(""), F.when(k % 4 == 0, F.array_join(items, " — ")).otherwise(F.array_join(items, "; ")))
    x = table(spark, d, "orders").select("o_orderkey", F.posexplode(G.parse_items(cargo_)).alias("pos", "item"))
    return x.select("o_orderkey", "pos", *(F.coalesce(f"item.{c}", F.lit("")).alias(c) for c in ("quantity", "unit", "commodity", "merchant")))


QUERIES = {f.__name__: f for f in (p37_signals, p38_formats, a22_formats_by_year, p28_tagged, a10_sources, p14_listed_commodities, t2_cargo_grammar)}
PAGES_SQL = f"""{JOURNAL_SQL}, pages as (select doc_key, string_agg(line, chr(10) order by n) "text", case when doc_key % 5 <> 0 then cast(1870 + doc_key % 25 as int) end "year" from journal group by 1)"""
_sql_list = lambda pairs: "[" + ", ".join("'" + b + "'" for _, b in pairs) + "]"
SQL = {
    "t2_cargo_grammar": f"""with x as (select o_orderkey, o_orderkey k, unnest(range(0, o_orderkey % 3 + 1)) i from orders),
y as (select o_orderkey, i, cast((k * 37 + i * 11) % 99991 + 1 as varchar) quantity, ({_sql_list(UNITS)})[(k + i) % {len(UNITS)} + 1] unit, ({_sql_list(ITEMS)})[(k // 3 + i * 2) % {len(ITEMS)} + 1] commodity, ({_sql_list(MERCHANTS)})[(k // 5 + i * 3) % {len(MERCHANTS)} + 1] merchant from x)
select o_orderkey, cast(row_number() over (partition by o_orderkey order by i) - 1 as int) pos, quantity, unit, commodity, merchant from y where commodity <> ''""",
    "p37_signals": rf"""with {PAGES_SQL}, l as (select doc_key, n, line, row_number() over (partition by doc_key order by n) r from journal),
samples as (select doc_key, string_agg(line, '|' order by n) s from (select *, row_number() over (partition by doc_key order by n) k from l where r <= 200 and regexp_matches(line, '^(\w+\.\s+)?\d{{1,2}}\s+\w+.*[@—]')) where k <= 5 group by 1),
h as (select *, regexp_extract_all("text", '(?m)^([A-Z\s&.''()]+)\.\s*$', 1) hs from pages)
select doc_key, "text" ilike '%import of timber%' or "text" ilike '%imports of timber%' has_import_header, regexp_matches("text", '(?m)^IMPORTS\.?\s*$') has_imports_caps, contains("text", '@') uses_at_delimiter,
  regexp_matches("text", '\s+-\s+') uses_dash_delimiter, cast(length("text") - length(replace("text", '@', '')) as int) at_count, array_to_string(hs[1:10], '|') port_headers, cast(len(hs) as int) port_header_count,
  regexp_matches("text", '(?m)^\w{{3,4}}\.\s+\d{{1,2}}\s+') has_date_prefix, regexp_matches("text", '(?m)^\d{{1,2}}\s+[A-Z]') has_numeric_date, contains("text", '(s)') has_steamship_marker,
  regexp_matches("text", 'SURREY COMMERCIAL DOCKS|MILLWALL DOCKS|TILBURY') has_dock_subdivisions, regexp_matches("text", '—\w+[-,]\w+') has_compressed_format, coalesce(s, '') sample_records
from h left join samples using (doc_key)""",
    "p38_formats": rf"""with {PAGES_SQL}, c as (select *, length("text") - length(replace("text", '@', '')) a, len(regexp_extract_all("text", '\s+-\s+')) s from pages)
select doc_key, case when "year" <= 1878 then 'early_at' when "year" <= 1880 then 'transition' when "year" <= 1884 then 'standard_dash' when "year" is not null then 'late_dock' when a > s then 'early_at'
  when contains("text", 'MILLWALL DOCKS') then 'late_dock' when regexp_matches("text", '-[A-Z]') then 'standard_dash' when a > 0 and s > 0 then 'transition' else 'unknown' end format from c""",
    "a22_formats_by_year": rf"""with {PAGES_SQL}, c as (select coalesce("year", 0) "year", count(*) pages, count(*) filter (contains("text", '@')) at_pages, count(*) filter (regexp_matches("text", '\s+-\s+')) dash_pages, count(*) filter (contains("text", 'MILLWALL DOCKS')) dock_pages from pages group by 1)
select *, case when at_pages > dash_pages then 'AT-DELIMITER' when dash_pages > 0 then 'DASH-DELIMITER' else 'MIXED' end || case when dock_pages > 0 then ' + DOCK-SUBS' else '' end format from c""",
    "p28_tagged": rf"""with x as (select o_orderkey, replace(lower(array_to_string([(['redwood', 'deals', 'ends', 'deal ends', 'deaks', 'oak logs', 'deal', 'pine', 'boards', 'and', 'legends', 'Teak'])[cast((o_orderkey * 31 + i * i * 7 + o_orderkey // (i + 2)) % 12 + 1 as int)] for i in range(1, 4 + o_orderkey % 4)], ' ')), 'deaks', 'deals') s from orders),
v as (select *, [k for k in ['deal ends', 'oak logs', 'redwood', 'boards', 'deals', 'logs', 'pine', 'teak', 'oak'] if regexp_matches(s, '(^|[^a-z])' || k || '($|[^a-z])')] plain, regexp_matches(s, '\bends\b') e from x),
f as (select *, case when e and contains(s, 'redwood') and contains(s, 'deal') then ['deals', 'deal ends', 'redwood'] else [] end a, case when e and regexp_matches(s, '\bdeals?\b') then ['deal ends'] else [] end z from v),
g as (select o_orderkey, list_concat(a, [k for k in plain if not list_contains(a, k)]) y, z from f)
select o_orderkey, array_to_string(list_concat(y, [k for k in z if not list_contains(y, k)]), '|') types from g""",
    "a10_sources": f"""with {LINE_SQL}, x as (select md5(line) sig, doc_id, source from lines join documents using (doc_id) where length(line) > 20)
select sig, count(*) n, count(*) >= 50 is_major, array_to_string(list_sort(list(doc_id))[1:10], ',') members, count(distinct source) n_sources, coalesce(array_to_string(list_sort(list(distinct source) filter (source is not null))[1:10], ','), '') sources from x group by 1 having count(*) > 1""",
    "p14_listed_commodities": f"""{STAR} select case record_id % 4 when 0 then 'oak planks' when 1 then 'bright red deals' when 2 then 'deals' else lower(commodity) end commodity_name, count(*) n from cargo group by 1""",
}
