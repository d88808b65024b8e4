"""Queries of the text and date functions, over texts that orders stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import dates as N
from tidewater.functions import text as T
from tidewater.sources.files import page_keys, text_or_json
from tidewater.sources.tables import table


def sample(spark, d, values: list[str | None]):
    """(id, s): every order stands for one of the texts."""
    orders = table(spark, d, "orders")
    return orders.select(F.col("o_orderkey").alias("id"), F.get(F.array(*(F.lit(v).cast("string") for v in values)), (F.col("o_orderkey") % len(values)).cast("int")).alias("s"))


def quoted(v: str | None) -> str:
    return "null" if v is None else "'" + v.replace("'", "''") + "'"


def sample_sql(values: list[str | None]) -> str:
    return f"sample as (select o_orderkey id, (list_value({', '.join(map(quoted, values))}))[cast(o_orderkey % {len(values)} + 1 as int)] s from orders)"


QUERIES, SQL = {}, {}


def known(c, name: str):
    """Numbers with 0 for null, as clients show null numbers in different ways."""
    return F.coalesce(c, F.lit(0)) if name in ("year", "day") else c


def case(name: str, values: list[str | None], columns, sql: str) -> None:
    """A query of ``columns(s)`` by name, and the select list that must agree."""

    def run(spark, d):
        return sample(spark, d, values).select("id", *(c.alias(n) for n, c in columns(F.col("s")).items()))

    QUERIES[name] = run
    SQL[name] = f"with {sample_sql(values)} select id, {sql} from sample"
    zero = [n for n in ("year", "day") if f'"{n}"' in sql]
    if zero:
        SQL[name] = f"select * replace ({', '.join(f'coalesce({chr(34)}{n}{chr(34)}, 0) as {chr(34)}{n}{chr(34)}' for n in zero)}) from ({SQL[name]})"


def cases_sql(value: str, tests: list[tuple[str, str]], rest: str) -> str:
    return "case " + " ".join(f"when {t.format(v=value)} then {r}" for t, r in tests) + f" else {rest} end"


def nested(value: str, pairs: dict[str, str]) -> str:
    for k, v in pairs.items():
        value = f"replace({value}, {quoted(k)}, {quoted(v)})"
    return value


PORTS = ["Gävle", "GÃ¤vle", "Timrå", "TimrÃ¥", "MÃ¶nsterÃ¥s harbour", "F'stad", "Fredrikshald", "Fredrickhamn", "Frederiksvoern", "Christiansand S.", "Christianstad", "Christiania", "St. John, N.B.",
         "Dantzic", "London (Surrey Docks)", "Tyne buoys", "Hull", "", "  ", None, "Mo", "ab", "deals", "THE JOURNAL", "---", "Halifax, N.S.", "Riga Wharf no 4", "oslo"]
case("p1_fix_encoding", PORTS, lambda s: {"fixed": T.fix_encoding(s)},
     "case s " + " ".join(f"when {quoted(k)} then {quoted(v)}" for k, v in T.MOJIBAKE_NAMES.items()) + f" else {nested('s', T.MOJIBAKE_LETTERS)} end fixed")
FILES = ["18891019p.3_p001.txt", "18790426p.11_p012.txt", "The Journal Aug 10 1875 - p2.txt", "July 3 1880_p002.txt", "1891 supplement.txt", "18991399_p001.txt", "nothing.txt", "Sept 08 1885.txt", "augus 1 1890.txt", None]
case("p2_publication_date", FILES, lambda s: {k: known(N.publication_date(s)[k], k) for k in ("year", "month", "day")},
     """case when try_cast(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])(\\d{2})(\\d{2})', 2) as int) between 1 and 12 then try_cast(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])(\\d{2})(\\d{2})', 1) as int)
  when regexp_matches(s, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\w*\\s+\\d{1,2}\\s+(187[4-9]|188[0-9]|189[0-9])') then try_cast(regexp_extract(s, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\w*\\s+(\\d{1,2})\\s+(187[4-9]|188[0-9]|189[0-9])', 3) as int)
  else try_cast(nullif(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])', 1), '') as int) end "year",
case when try_cast(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])(\\d{2})(\\d{2})', 2) as int) between 1 and 12 then
    (['January','February','March','April','May','June','July','August','September','October','November','December'])[try_cast(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])(\\d{2})(\\d{2})', 2) as int)]
  when regexp_matches(s, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\w*\\s+\\d{1,2}\\s+(187[4-9]|188[0-9]|189[0-9])') then
    case lower(regexp_extract(s, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\w*\\s+\\d{1,2}\\s+1', 1)) when 'jan' then 'January' when 'feb' then 'February' when 'mar' then 'March' when 'apr' then 'April' when 'may' then 'May'
      when 'jun' then 'June' when 'jul' then 'July' when 'aug' then 'August' when 'sep' then 'September' when 'oct' then 'October' when 'nov' then 'November' else 'December' end end "month",
case when try_cast(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])(\\d{2})(\\d{2})', 2) as int) between 1 and 12 then try_cast(regexp_extract(s, '(187[4-9]|188[0-9]|189[0-9])(\\d{2})(\\d{2})', 3) as int)
  when regexp_matches(s, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\w*\\s+\\d{1,2}\\s+(187[4-9]|188[0-9]|189[0-9])') then try_cast(regexp_extract(s, '(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\\w*\\s+(\\d{1,2})\\s+1', 2) as int) end "day\"""")  # fmt: skip
case("s2_page_keys", FILES, lambda s: {"doc_key": page_keys(s)[0], "page_no": page_keys(s)[1]},
     """case when s is null then null when regexp_matches(s, '^.+_p\\d{3}\\.txt$') then regexp_extract(s, '^(.+?)_p\\d{3}\\.txt$', 1) else regexp_replace(s, '\\.txt$', '') end doc_key,
case when regexp_matches(s, '^.+_p\\d{3}\\.txt$') then cast(regexp_extract(s, '_p(\\d{3})\\.txt$', 1) as int) else 0 end page_no""")  # fmt: skip
case("s10_text_or_json", ['{"text": "inner", "n": 1}', "plain line", '{"n": 2}', None], lambda s: {"body": text_or_json(s)},
     "coalesce(case when json_valid(s) then json_extract_string(s, '$.text') end, s) body")
LINES = ["ALLOA.", "LONDON DOCKS & CO.", "April 16.", "Sept. 11", "April 27. Andreas @ Fredrikstad,—54,266 boards, Nil.", "Sept. 11 Essex (s)-Konigsberg-sleepers-Order", "23 Sophie-Halmstad-14,500 pit props-Love & Co.",
         "Fatfield (s)-Memel-sleepers, deals-Order", "Dec. 3 Mary Ann-St. John-deals-J. Smith & Sons", "some prose without marks", "", None]
case("p4_parse_record", LINES, lambda s: {k: known(T.parse_record(s)[k], k) for k in ("format_type", "month", "day", "ship_name", "origin_port", "cargo", "merchant")},
     """case when s like '%@%' then 'early_at' when regexp_matches(s, '^(\\w+\\.\\s+)?\\d{1,2}\\s+[^-]+-[^-]+-[^-]+-.+$') then 'standard_dash' when regexp_matches(s, '^[A-Za-z][^-]+-[^-]+-[^-]+-.+$') then 'condensed' end format_type,
case when s like '%@%' or regexp_matches(s, '^(\\w+\\.\\s+)?\\d{1,2}\\s+[^-]+-[^-]+-[^-]+-.+$') then nullif(regexp_extract(s, '^(\\w{3,9})\\.?\\s+\\d', 1), '') end "month",
case when s like '%@%' or regexp_matches(s, '^(\\w+\\.\\s+)?\\d{1,2}\\s+[^-]+-[^-]+-[^-]+-.+$') then try_cast(regexp_extract(s, '^(?:\\w+\\.?\\s+)?(\\d{1,2})', 1) as int) end "day",
case when s like '%@%' then trim(regexp_extract(s, '^\\w+\\.? \\d+\\.? ([^@]+)@', 1)) when regexp_matches(s, '^[^-]+-[^-]+-[^-]+-.+$') then trim(replace(regexp_extract(s, '^(?:(?:\\w+\\.\\s+)?\\d+ )?([^-]+)-', 1), '(s)', '')) end ship_name,
case when s like '%@%' then regexp_extract(s, '@ ([^,]+),', 1) when regexp_matches(s, '^[^-]+-[^-]+-[^-]+-.+$') then trim(split_part(s, '-', 2)) end origin_port,
case when s like '%@%' then regexp_extract(s, '(—.*)$', 1) when regexp_matches(s, '^[^-]+-[^-]+-[^-]+-.+$') then trim(split_part(s, '-', 3)) end cargo,
case when s not like '%@%' and regexp_matches(s, '^[^-]+-[^-]+-[^-]+-.+$') then trim(split_part(s, '-', 4)) end merchant""")  # fmt: skip
case("p5_headers", LINES, lambda s: {"is_header": F.coalesce(T.is_port_header(s), F.lit(False)), "month": T.part(s, T.DATE_HEADER, 1), "day": known(T.part(s, T.DATE_HEADER, 2).cast("int"), "day"), "is_steamship": F.coalesce(F.contains(s, F.lit("(s)")), F.lit(False)), "confidence": T.confidence(T.is_port_header(s), s.rlike(T.DATE_HEADER))},
     """coalesce(regexp_matches(s, '^[A-Z\\s&.''()]+\\.\\s*$'), false) is_header, nullif(regexp_extract(s, '^(\\w{3,9})\\.?\\s+\\d{1,2}\\.?\\s*$', 1), '') "month", try_cast(regexp_extract(s, '^\\w{3,9}\\.?\\s+(\\d{1,2})\\.?\\s*$', 1) as int) "day",
coalesce(contains(s, '(s)'), false) is_steamship, case when regexp_matches(s, '^[A-Z\\s&.''()]+\\.\\s*$') then 1.0 when regexp_matches(s, '^\\w{3,9}\\.?\\s+\\d{1,2}\\.?\\s*$') then 0.9 else 0.7 end::double confidence""")  # fmt: skip
case("p13_merchant", ["Order", "nil", " Nickols & Co. ltd", "Love & Co.", "Churchill Bros. & Sim.", "  ", None, "---", "A. Co. B"], lambda s: {"merchant": T.normalize_merchant(s)},
     "case when s is null or lower(trim(s)) in ('order', 'nil', 'ditto', '---') then '' else replace(replace(replace(rtrim(trim(s), '.'), '&', 'and'), ' Co.', ' Company'), ' Bros.', ' Brothers') end merchant")
COMMODITIES = ["Deal", "sawn fir deal", "bright yellow deals", "white pine timber", "oak staves", "boars", "mahogany logs", "teak planks", "firewood", "  Battens ", "", None, "lath", "flooring", "deals &c", "deals &", "smith & co", "& ends", "&", "slating battens"]
case("p14_commodity", COMMODITIES, lambda s: {"commodity": T.normalize_commodity(s)},
     cases_sql("s", [("{v} is null", "''"), *((f"regexp_matches(lower(trim({{v}})), {quoted(p)})".replace("{v}", "{v}"), quoted(v)) for p, v in T.COMMODITY_RULES)], "lower(trim(s))") + " commodity")
case("p15_port", PORTS, lambda s: {"port": T.normalize_port(s, F.when(F.lower(F.trim(s)) == "hull", F.lit("Hull")))},
     cases_sql("lower(trim(s))", [("{v} is null", "''"), ("{v} = 'hull'", "'Hull'"), *((f"{{v}} = {quoted(k.lower())}", quoted(v)) for k, v in T.PORT_ABBREVIATIONS.items()),
               *((f"regexp_matches({{v}}, '{'|'.join(stems)}') and regexp_matches({{v}}, '{'|'.join(parts)}')", quoted(name)) for stems, members, rest in T.PORT_FAMILIES for parts, name in [*members, (stems, rest)])], "trim(s)") + " port")
ERROR_SQL = """coalesce(trim(s) = '' or (length(trim(s)) <= 2 and trim(s) not in ('Mo', 'Mo.')) or trim(s) in ('---', '--', '-', '.', '&', 'and', 'or') or length(trim(s)) > 150
  or regexp_matches(upper(s), 'JOURNAL|IMPORTS|EXPORTS|FREIGHTS|FAILURES|LIQUIDATIONS|DIVIDENDS'){more}, true)"""
case("p17_port_errors", PORTS, lambda s: {"origin_error": T.is_port_error(s, "origin"), "destination_error": T.is_port_error(s, "destination")},
     ERROR_SQL.format(more=" or lower(trim(s)) in ('deals','timber','staves','lathwood','pitwood','props','battens','boards')") + " origin_error, " + ERROR_SQL.format(more="") + " destination_error")
case("p18_docks", PORTS, lambda s: {"port": T.consolidate_dock(s)},
     "case when s like 'London (%)' then 'London' when regexp_matches(lower(s), 'buoy|wharf|stairs') and contains(trim(s), ' ') then split_part(trim(s), ' ', 1) else s end port")
case("p19_p20_artifacts", COMMODITIES, lambda s: {"number": T.number_forms(s), "clean": T.fix_artifacts(s)},
     """case lower(trim(s)) when 'lath' then 'laths' when 'flooring' then 'floorings' else s end number,
case when s is null then null when regexp_matches(trim(regexp_replace(trim(rtrim(s, '&')), '&c$', '')), '^&|& (co|son|sons|atkinson|sim|wood)$') then '' else trim(regexp_replace(trim(rtrim(s, '&')), '&c$', '')) end clean""")  # fmt: skip
NOTED = ["Surrey Docks — Aalesund (via Hull) — 14,559 n.s. deals, battens, and boards", "1889-03-27 — London – Riga--5,000 pcs. redwood deals and ends; for Love & Co.", "Ship (s)  with space (note one) (x) (two)", "oak logs, 3 loads teak / pine & ash et cedar, Order", "deals, Smith & Co.", "", None]
case("p22_p26_shape", NOTED, lambda s: {"squeezed": T.squeeze(s), "dashed": T.dashes(s), "notes": T.notes(s), "bare": T.without_notes(s), "parts": F.array_join(T.dash_parts(s), "|"), "iso": N.iso_prefix(s)},
     """trim(regexp_replace(s, '[\\s ]+', ' ', 'g')) squeezed, regexp_replace(replace(replace(s, '–', '—'), '--', '—'), '\\s*—\\s*', ' — ', 'g') dashed,
nullif(array_to_string(list_filter(list_transform(regexp_extract_all(s, '\\(([^)]*)\\)', 1), lambda x: trim(x)), lambda x: length(x) > 1), '; '), '') "notes",
trim(regexp_replace(regexp_replace(s, '\\([^)]*\\)', '', 'g'), '[\\s ]+', ' ', 'g')) bare,
array_to_string(list_filter(list_transform(string_split_regex(s, '\\s*(—|–|\\s-\\s|-{2,})\\s*'), lambda x: trim(regexp_replace(x, '[\\s ]+', ' ', 'g'))), lambda x: x <> ''), '|') parts,
nullif(regexp_extract(s, '^(\\d{4}-\\d{2}-\\d{2})\\b', 1), '') iso""")  # fmt: skip
VOCABULARY = ["deals", "deal ends", "battens", "boards", "redwood", "oak logs", "oak", "pine", "logs", "teak"]
case("p28_product_types", NOTED, lambda s: {"types": F.array_join(T.product_types(s, VOCABULARY), "|")},
     "array_to_string(list_filter([" + ", ".join(f"case when regexp_matches(lower(s), '(^|[^a-z]){v}($|[^a-z])') then '{v}' end" for v in sorted(VOCABULARY, key=lambda v: (-len(v), v))) + "], lambda x: x is not null), '|') types")
case("p30_p33_merchants", NOTED, lambda s: {"products": T.split_merchant(s)["products"], "merchant": T.split_merchant(s)["merchant"], "buyer": T.split_for(s)["merchant"], "tokens": F.array_join(T.product_tokens(s), "|")},
     """case when s is null then null when p[-1] = 'Order' or regexp_matches(coalesce(p[-1], ''), '\\b(Co|Sons?)\\b') then array_to_string(p[:-2], ', ') else trim(regexp_replace(s, '[\\s ]+', ' ', 'g')) end products,
case when p[-1] = 'Order' or regexp_matches(p[-1], '\\b(Co|Sons?)\\b') then p[-1] end merchant,
case when regexp_matches(s, ';.*\\b(for|to)\\b') then trim(split_part(s, ';', 2)) end buyer,
array_to_string(list_filter(list_transform(string_split_regex(replace(regexp_replace(s, '[/;]', ',', 'g'), '&', ' and '), '(?i)\\b(et|and)\\b|,'), lambda x: trim(regexp_replace(x, '[\\s ]+', ' ', 'g'))), lambda x: x <> ''), '|') tokens""")  # fmt: skip
SQL["p30_p33_merchants"] = SQL["p30_p33_merchants"].replace("from sample", "from (select *, list_filter(list_transform(string_split(trim(regexp_replace(s, '[\\s ]+', ' ', 'g')), ','), lambda x: trim(x)), lambda x: x <> '') p from sample)").replace(
    "from orders)", "from orders)", 1)
case("p27_quantities", ["14,559 n.s. deals, battens", "3 loads teak , 2 pcs oak", "deals", "", None, "100 cases 20 bales"], lambda s: {"bare": T.strip_quantities(s)},
     """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '(?i)\\b(?:\\d+[\\d,.]*|n\\.?s\\.?|pcs?\\.?|loads?\\.?|bdft|ft\\.?|in\\.?|cwt\\.?|tons?\\.?|bales?\\.?|pkgs?\\.?|cases?\\.?|boxes?\\.?)\\b', ' ', 'g'), '\\s+,', ',', 'g'), ',\\s*,', ', ', 'g'), '\\s+', ' ', 'g'), '^[ ;,:]+|[ ;,:]+$', '', 'g')) bare""")  # fmt: skip
case("p40_province", ["Halifax, N.S.", "St. John, N. B.", "Hull", "Souris, P.E.I.", None], lambda s: {"port": T.without_province(s)}, r"regexp_replace(s, ', (N[.]\s?B|N[.]\s?S|P[.]\s?E[.]\s?I|P[.]\s?Q)[.]$', '') port")
PARTS = ["1885|August|8|1885|September|12", "|||1885|Sept|3", "1889|Mar|01|1889|March|2", "x|June|9|1890|Feb|4", "1880|||1881|Dec|25", "|||||", None]


def date_parts(s):
    return [F.get(F.split(s, r"\|"), i) for i in range(6)]


case("n1_n3_dates", PARTS, lambda s: (lambda p: {"year": known(N.year_of(p[3], p[0]), "year"), "label": N.date_text(p[0], p[1], p[2]), "hybrid": N.hybrid_date((p[0], p[1], p[2]), (p[3], p[4], p[5]))})(date_parts(s)),
     """try_cast(coalesce(nullif(split_part(s, '|', 4), ''), split_part(s, '|', 1)) as int) "year",
concat_ws('-', nullif(split_part(s, '|', 1), ''), nullif(split_part(s, '|', 2), ''), nullif(split_part(s, '|', 3), '')) "label",
coalesce(nullif(split_part(s, '|', 1), '') || '-' || lpad(cast({m2} as varchar), 2, '0') || '-' || lpad(cast(try_cast(split_part(s, '|', 3) as int) as varchar), 2, '0'),
  nullif(split_part(s, '|', 4), '') || '-' || lpad(cast({m5} as varchar), 2, '0') || '-' || lpad(cast(try_cast(split_part(s, '|', 6) as int) as varchar), 2, '0'), '') hybrid"""
     .replace("{m2}", "case split_part(s, '|', 2) " + " ".join(f"when '{a}' then {i} when '{b}' then {i}" for i, (a, b) in enumerate(T.MONTHS.items(), 1) if a != b) + " when 'May' then 5 end")
     .replace("{m5}", "case split_part(s, '|', 5) " + " ".join(f"when '{a}' then {i} when '{b}' then {i}" for i, (a, b) in enumerate(T.MONTHS.items(), 1) if a != b) + " when 'May' then 5 end"))
case("n9_quantity", ["54,266 boards", "abt 12.5 loads", "nil", "", None, "1,0,0"], lambda s: {"quantity": N.quantity(s)}, r"try_cast(nullif(regexp_extract(replace(s, ',', ''), '(\d+(\.\d+)?)', 1), '') as double) quantity")
case("n14_cer", ["Fredrikstad", "Fredrikshald", "Hull", "", None], lambda s: {"cer": F.round(N.character_error_rate(s, F.lit("Fredrikstad")), 6)}, "round(levenshtein(s, 'Fredrikstad') / 11, 6) cer")


def n10_error_classes(spark, d):
    line = table(spark, d, "lineitem")
    human = F.when(F.col("l_partkey") % 5 == 0, F.col("l_quantity") * 10).when(F.col("l_partkey") % 5 == 1, F.col("l_quantity")).when(F.col("l_partkey") % 5 == 2, F.col("l_quantity") / 10).otherwise(F.col("l_quantity") + F.col("l_partkey") % 7)
    counted = line.groupBy(N.error_class(F.col("l_quantity"), human).alias("error")).agg(F.count("*").alias("n"))
    return counted


QUERIES["n10_error_classes"] = n10_error_classes
SQL["n10_error_classes"] = """with q as (select l_quantity a, case l_partkey % 5 when 0 then l_quantity * 10 when 1 then l_quantity when 2 then l_quantity / 10 else l_quantity + l_partkey % 7 end h from lineitem)
select case when a = h then 'exact' when abs(a - h * 10) < 5 then 'missing_digit_human' when abs(a * 10 - h) < 5 then 'missing_digit_auto' when h > 0 and a / h between 9.5 and 10.5 then '10x_auto_high'
  when h > 0 and a / h between 0.095 and 0.105 then '10x_auto_low' when abs(a - h) / greatest(a, h) * 100 <= 5 then 'close_5pct' when abs(a - h) / greatest(a, h) * 100 <= 10 then 'close_10pct'
  when abs(a - h) / greatest(a, h) * 100 <= 25 then 'moderate_diff' else 'large_diff' end error, count(*) n from q group by 1"""
