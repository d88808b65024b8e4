"""Queries over lists of names and parts of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import cargo as G
from tidewater.operators import names as S
from tidewater.sources.tables import ships, table

from .lines import CARGO
from .star import SHIPS


def f7_clean_names(spark, d):
    """Names of nations beside numbers, placeholders and short cells."""
    c = table(spark, d, "customer")
    raw = F.when(F.col("c_custkey") % 5 == 0, F.col("c_nationkey").cast("string")).when(F.col("c_custkey") % 5 == 1, F.lit("(vide)")).when(F.col("c_custkey") % 5 == 2, F.lit(" x ")).otherwise(F.concat(F.lit(" "), "c_mktsegment"))
    return S.clean_names(c.select(raw.alias("name")), "name")


def x6_extended_names(spark, d):
    names = table(spark, d, "nation").select(F.col("n_name").alias("name"))
    return S.extended(names, table(spark, d, "customer").select(F.col("c_mktsegment").alias("name")), "name")


def x2_part_without_repeats(spark, d):
    """All events but clicks, and one click of each user and day."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return S.without_repeats_where(e, F.col("event_type") == "click", ["user_id", "day"], "event_id").select("event_id", "event_type")


def j14_normalized_beside(spark, d):
    """Shipments beside their normalized names, by record_id."""
    s = ships(spark, d)
    done = s.select("record_id", F.lower("origin_port").alias("normalized"))
    return s.select("record_id", "origin_port").join(done, "record_id").groupBy("origin_port", "normalized").agg(F.count("*").alias("n"))


def t3_commodity_names(spark, d):
    pick = F.get(F.array(*(F.lit(v).cast("string") for v in CARGO)), (F.col("o_orderkey") % len(CARGO)).cast("int"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(S.commodity_names(G.parse_cargo(pick)), "|").alias("names"))


QUERIES = {f.__name__: f for f in (f7_clean_names, x6_extended_names, x2_part_without_repeats, j14_normalized_beside, t3_commodity_names)}
SQL = {
    "f7_clean_names": "select distinct c_mktsegment \"name\" from customer where c_custkey % 5 in (3, 4)",
    "x6_extended_names": "select n_name \"name\" from nation union select c_mktsegment from customer",
    "x2_part_without_repeats": """select event_id, event_type from events where event_type <> 'click' union all
select min(event_id), 'click' from events where event_type = 'click' group by user_id, cast(ts as date)""",
    "j14_normalized_beside": f"with {SHIPS} select origin_port, lower(origin_port) normalized, count(*) n from ships group by 1, 2",
    "t3_commodity_names": """select o_orderkey id, coalesce(names, '') "names" from orders left join (values (0, 'wood pulp'), (1, 'staves'), (2, 'timber'), (3, 'deals'),
  (4, 'boards|logs|oak'), (5, 'logs mahogany and cedar'), (7, 'sleepers')) x(k, names) on o_orderkey % 9 = k""",
}
