"""Queries of the earlier readings of record lines: a customer's orders are the lines of a journal, made of parts that the SQL knows without reading them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import older_forms as O
from tidewater.sources.tables import table

from .texts import quoted

PORTS = ["HULL", "SURREY DOCKS", "ST. IVES", "BO'NESS (NEW)"]
SHIPS = ["Anna", "Jane & Mary", "St. Olaf", "Lady O'Neil", "Essex"]
ORIGINS = ["Riga", "New York", "St. John, N.B", "Pitea"]
MERCHANTS = ["Order", "Churchill & Sim", "W. Mallinson", "Robbins & Co."]
UNITS = ["pcs.", "bdls", "lds.", "logs"]
TYPES = ["deals", "white wood", "staves"]
MONTHS = ["Aug", "Sept", "Mar"]
FULL = ["August", "february", "Mar"]


def parts(spark, d):
    """doc_key, n and the parts of a line; kind 0 is a header, 1 and 2 are dated records, 3 early, 4 condensed and 5 dated with a month, 6 and 7 none."""
    k, c = F.col("n"), F.col("doc_key")
    of = lambda values, at: F.get(F.array(*map(F.lit, values)), (at % len(values)).cast("int"))
    item = lambda q, i: F.concat_ws(" ", F.format_number(q, 0), of(UNITS, k + i), of(TYPES, F.floor(k / 4) + i))
    x = table(spark, d, "orders").select(F.col("o_custkey").alias("doc_key"), F.col("o_orderkey").alias("n"))
    named = {"kind": (k * 7 + c) % 8, "header": of(PORTS, F.floor((k * 7 + c) / 8)), "day": (k % 31 + 1).cast("int"), "mon": of(MONTHS, k), "ship": of(SHIPS, k)}
    named |= {"steam": F.when(k % 3 == 0, " (s)").otherwise(""), "origin": of(ORIGINS, F.floor(k / 2)), "merchant": of(MERCHANTS, F.floor(k / 3))}
    return x.withColumns(named | {"cargo": F.concat_ws(", ", item(k * 37 % 99991 + 1, 0), item(k % 900 + 1, 1))})


def journal(spark, d):
    ship, rest = F.concat("ship", "steam"), [F.col(c) for c in ("origin", "cargo", "merchant")]
    forms = [
        F.concat("header", F.lit(".")),
        F.concat("day", F.lit(" "), F.concat_ws("-", ship, *rest)),
        F.concat(F.lit("  "), "day", F.lit(" "), F.concat_ws(" - ", ship, *rest), F.lit("\r")),
        F.concat("mon", F.lit(". "), "day", F.lit(" "), ship, F.lit(" @ "), "origin", F.lit(",—"), "cargo"),
        F.concat_ws("-", ship, *rest),
        F.concat("mon", F.lit(". "), "day", F.lit(" "), F.concat_ws("-", ship, *rest)),
        F.concat(F.lit("April 27. "), "ship", F.lit(" @ Riga,—54 boards")),
        F.concat(F.lit("of the "), "ship"),
    ]
    return parts(spark, d).select("doc_key", "n", F.get(F.array(*forms), F.col("kind").cast("int")).alias("line"))


def shown(items):
    return F.array_join(F.transform(items, lambda i: F.concat_ws(" ", i["quantity"].cast("string"), i["unit"], i["type"])), "|")


def p39_dated_records(spark, d):
    c = F.col("doc_key")
    month = F.get(F.array(*map(F.lit, FULL)), (c % 3).cast("int"))
    x = O.dated_records(journal(spark, d), ["doc_key"], ["n"], 1880 + c % 10, month)
    return x.drop("raw_line").withColumn("cargo_items", shown(F.col("cargo_items")))


def p39_line_records(spark, d):
    x = O.line_records(journal(spark, d), ["doc_key"], ["n"])
    return x.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("destination_port", "month", "merchant")} | {"day": F.coalesce("day", F.lit(0))})


def t6_goods(spark, d):
    return parts(spark, d).select("n", F.posexplode(O.goods(F.col("cargo"))).alias("pos", "i")).select("n", "pos", "i.*")


QUERIES = {f.__name__: f for f in (p39_dated_records, p39_line_records, t6_goods)}


def _of(values: list[str], at: str) -> str:
    return f"([{', '.join(map(quoted, values))}])[cast(({at}) % {len(values)} + 1 as int)]"


PARTS_SQL = f"""numbered as (select o_custkey doc_key, o_orderkey n from orders),
goods as (select n, i pos, case i when 0 then n * 37 % 99991 + 1 else n % 900 + 1 end quantity, {_of(UNITS, "n + i")} u, {_of(TYPES, "n // 4 + i")} "type" from numbered, (select unnest([0, 1]) i)),
cargoes as (select n, string_agg(format('{{:,}}', quantity) || ' ' || u || ' ' || "type", ', ' order by pos) cargo, string_agg(quantity || ' ' || rtrim(u, '.') || ' ' || "type", '|' order by pos) cargo_items from goods group by 1),
parts as (select *, (n * 7 + doc_key) % 8 kind, {_of(PORTS, "(n * 7 + doc_key) // 8")} header, cast(n % 31 + 1 as int) d, {_of(MONTHS, "n")} mon, {_of(SHIPS, "n")} ship_name, n % 3 = 0 is_steamship, {_of(ORIGINS, "n // 2")} origin_port, {_of(MERCHANTS, "n // 3")} m
  from numbered join cargoes using (n))"""
_SO_FAR = "over (partition by doc_key order by n rows between unbounded preceding and current row)"
SQL = {
    "p39_dated_records": f"""with {PARTS_SQL}, x as (select *, last_value(case when kind = 0 and header not like '%(%' then header end ignore nulls) {_SO_FAR} port, 1880 + doc_key % 10 y, {_of(FULL, "doc_key")} mm from parts)
select doc_key, n, port, case when mm = 'August' then y || '-08-' || lpad(cast(d as varchar), 2, '0') when mm = 'february' and (d <= 28 or d = 29 and y % 4 = 0) then y || '-02-' || lpad(cast(d as varchar), 2, '0') else y || '-' || mm || '-' || d end arrival_date,
  d "day", ship_name, is_steamship, origin_port, cargo, m merchant, cargo_items from x where kind in (1, 2) and port is not null""",
    "p39_line_records": f"""with {PARTS_SQL}, x as (select *, last_value(case when kind = 0 then header end ignore nulls) {_SO_FAR} p, last_value(case when kind in (3, 5) then mon end ignore nulls) {_SO_FAR} mm from parts)
select doc_key, n, coalesce(p, '') destination_port, case kind when 3 then 'early_at' when 4 then 'condensed' else 'standard_dash' end format_type, coalesce(mm, '') "month", case when kind = 4 then 0 else d end "day", ship_name, is_steamship, case when kind = 3 then split_part(origin_port, '.', 1) else origin_port end origin_port,
  case when kind <> 3 then cargo when contains(origin_port, '.') then 'John, N.B,—' || cargo else '—' || cargo end cargo, case when kind = 3 then '' else m end merchant from x where kind between 1 and 5""",
    "t6_goods": f"""with {PARTS_SQL} select n, pos, quantity, rtrim(u, '.') unit, "type" from goods""",
}
