"""Queries over shipments and cargo: the published views, counts, sets and sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import datasets as D
from tidewater.sources.tables import cargo, ships, table

SHIPS = """ships as (select o_orderkey record_id, n_name origin_port, c_mktsegment destination_port, cast(year(o_orderdate) as int) "year",
  c_name merchant, cast(o_orderdate as date) ship_date
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""
CARGO = """cargo as (select l_orderkey record_id, p_type commodity, l_quantity quantity, p_brand unit from lineitem join part on l_partkey = p_partkey)"""
STAR = f"with {SHIPS}, {CARGO}"


def both(f):
    return lambda spark, d: f(ships(spark, d), cargo(spark, d))


def a3_route_commodity_matrix(spark, d):
    """In parts of a million items or less."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), table(spark, d, "lineitem").count() // 1_000_000 + 1)
    return D.route_commodity_matrix(ships(spark, d), cargo(spark, d), parts)


def a7_commodity_counts(spark, d):
    return cargo(spark, d).groupBy("commodity").agg(F.count("*").alias("n"), F.countDistinct("record_id").alias("ships"))


def a8_frequency_buckets(spark, d):
    per = ships(spark, d).groupBy("merchant").agg(F.count("*").alias("n"))
    return per.groupBy(D.buckets(F.col("n"), [(3, "1-3"), (10, "4-10")], ">10").alias("bucket")).agg(F.count("*").alias("merchants"))


def a13_years_of_ports(spark, d):
    years = ships(spark, d).groupBy("origin_port").agg(F.array_sort(F.collect_set("year")).alias("y"), F.min("year").alias("lo"), F.max("year").alias("hi"), F.count("*").alias("ship_count"))
    label = F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", "lo", "hi"))
    return years.select("origin_port", "ship_count", F.array_join(F.transform("y", lambda v: v.cast("string")), ",").alias("years"), label.alias("year_range"))


def a19_ports_origin_first(spark, d):
    s = ships(spark, d)
    origins = s.select(F.col("origin_port").alias("port")).distinct()
    others = s.select(F.col("destination_port").alias("port")).distinct().join(origins, "port", "left_anti")
    return origins.withColumn("port_type", F.lit("origin")).unionByName(others.withColumn("port_type", F.lit("destination")))


def a20_commonest_spelling(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("word")).filter("word <> ''")
    counted = words.groupBy("word").agg(F.count("*").alias("n")).withColumn("k", F.lower("word"))
    best = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("n"), "word"))
    return counted.withColumn("r", best).filter("r = 1").select("word", "n")


def a25_monthly(spark, d):
    return ships(spark, d).groupBy(F.date_format("ship_date", "yyyy-MM").alias("month"), "destination_port").agg(F.count("*").alias("num_ships"), F.countDistinct("merchant").alias("merchants"))


def a25_year_origin(spark, d):
    return ships(spark, d).groupBy("year", "origin_port").agg(F.count("*").alias("num_ships"), F.countDistinct("destination_port").alias("destinations"))


def a25_specialization(spark, d):
    """Each merchant's commonest commodity, the first in order of equals, and its share of the merchant's items."""
    per = cargo(spark, d).join(ships(spark, d).select("record_id", "merchant"), "record_id").groupBy("merchant", "commodity").agg(F.count("*").alias("n"))
    best = F.min_by("commodity", F.struct(-F.col("n"), "commodity"))
    out = per.groupBy("merchant").agg(F.sum("n").alias("items"), F.max("n").alias("most"), best.alias("commodity"))
    return out.select("merchant", "items", "commodity", F.round(100 * F.col("most") / F.col("items"), 4).alias("percent"))


def a26_quality(spark, d):
    s, c = ships(spark, d), cargo(spark, d)
    orphans = c.join(s, "record_id", "left_anti").agg(F.count("*").alias("orphan_items"))
    empty = s.join(c, "record_id", "left_anti").agg(F.count("*").alias("ships_without_cargo"))
    total = s.agg(F.count("*").alias("num_ships"), F.count_if(F.col("origin_port").isNull()).alias("null_origins"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.countDistinct("origin_port").alias("origins"))
    return total.crossJoin(orphans).crossJoin(empty)  # three rows of one


def n7_decades(spark, d):
    return ships(spark, d).groupBy((F.floor(F.col("year") / 10) * 10).cast("int").alias("decade")).agg(F.count("*").alias("num_ships"))


def ext_rollup(spark, d):
    return ships(spark, d).rollup("origin_port", "destination_port").agg(F.count("*").alias("num_ships"), F.grouping_id().cast("int").alias("level"))


def ext_cube(spark, d):
    joined = cargo(spark, d).join(ships(spark, d), "record_id")
    return joined.cube("destination_port", "commodity").agg(F.count("*").alias("items"), F.round(F.sum("quantity"), 2).alias("quantity"))


def j4_cargo_of_kept(spark, d):
    kept = ships(spark, d).filter("destination_port = 'BUILDING'").select("record_id")
    return cargo(spark, d).join(kept, "record_id", "left_semi").groupBy("commodity").agg(F.count("*").alias("n"))


def j5_cargo_of_removed(spark, d):
    removed = ships(spark, d).filter("destination_port = 'BUILDING'").select("record_id")
    return cargo(spark, d).join(removed, "record_id", "left_anti").groupBy("commodity").agg(F.count("*").alias("n"))


def j3_last_wins(spark, d):
    """Items joined to one row of a repeated key, the last."""
    line = table(spark, d, "lineitem")
    last = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_extendedprice")))
    right = line.withColumn("r", last).filter("r = 1").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("last_part"))
    return line.join(right, ["l_orderkey", "l_linenumber"]).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum((F.col("l_partkey") == F.col("last_part")).cast("long")).alias("own"))


def o3_top_merchants(spark, d):
    return ships(spark, d).groupBy("merchant").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "merchant").limit(20)


def o4_by_type_then_count(spark, d):
    counted = D.port_roles(ships(spark, d)).groupBy("port_type", "port_name").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("port_type").orderBy(F.desc("n"), "port_name"))
    return counted.select("port_type", "port_name", "n", rank.alias("place"))


def x_sets(spark, d):
    """Sizes of union, intersection and difference of the nations with customers and with suppliers."""
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    parts = [("union", a.union(b).distinct()), ("intersect", a.intersect(b)), ("except", a.exceptAll(b))]
    out = None
    for name, part in parts:
        row = part.agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def f1_given(spark, d):
    e = table(spark, d, "events").withColumn("port", F.when(F.col("user_id") % 7 == 0, "").when(F.col("user_id") % 11 == 0, F.lit(None)).otherwise(F.col("event_type")))
    return e.filter(D.given("port", "value")).groupBy("port").agg(F.count("*").alias("n"))


def f2_year_and_place(spark, d):
    return ships(spark, d).filter((F.col("year") == 1996) & F.upper("destination_port").contains("BUILD")).groupBy("origin_port").agg(F.count("*").alias("n"))


QUERIES = {
    "a1_trade_routes_by_year": both(D.trade_routes_by_year),
    "a2_commodity_flows_by_year": both(D.commodity_flows_by_year),
    "a3_route_commodity_matrix": a3_route_commodity_matrix,
    "a4_port_activity_summary": both(D.port_activity_summary),
    "a5_detailed_long": both(lambda s, c: D.detailed_long(c, s)),
    "a6_top3_commodities": both(lambda s, c: D.top_k(c.join(s, "record_id"), ["origin_port"], "commodity", 3)),
    "a7_commodity_counts": a7_commodity_counts,
    "a8_frequency_buckets": a8_frequency_buckets,
    "a13_years_of_ports": a13_years_of_ports,
    "a19_ports_origin_first": a19_ports_origin_first,
    "a20_commonest_spelling": a20_commonest_spelling,
    "a24_ship_items": both(D.ship_items),
    "a25_monthly": a25_monthly,
    "a25_year_origin": a25_year_origin,
    "a25_specialization": a25_specialization,
    "a26_quality": a26_quality,
    "n7_decades": n7_decades,
    "ext_rollup": ext_rollup,
    "ext_cube": ext_cube,
    "j3_last_wins": j3_last_wins,
    "j4_cargo_of_kept": j4_cargo_of_kept,
    "j5_cargo_of_removed": j5_cargo_of_removed,
    "o3_top_merchants": o3_top_merchants,
    "o4_by_type_then_count": o4_by_type_then_count,
    "t7_port_roles": lambda spark, d: D.port_roles(ships(spark, d)).groupBy("port_type", "port_name").agg(F.count("*").alias("n")),
    "x_sets": x_sets,
    "f1_given": f1_given,
    "f2_year_and_place": f2_year_and_place,
}


def top_sql(keys: str, item: str, source: str, k: int = 1) -> str:
    return f"""(select * from (select *, row_number() over (partition by {keys} order by n desc, {item}) place
      from (select {keys}, {item}, count(*) n from {source} group by {keys}, {item})) where place <= {k})"""


JOINED = "joined as (select * from ships join cargo using (record_id))"
ROLES = """roles as (select record_id, "year", origin_port port_name, 'origin' port_type from ships
  union all select record_id, "year", destination_port, 'destination' from ships)"""
SQL = {
    "a1_trade_routes_by_year": f"""{STAR}, {JOINED}, per as (select record_id, count(*) items from cargo group by 1),
base as (select origin_port, destination_port, "year", count(*) num_ships, cast(coalesce(sum(items), 0) as bigint) num_cargo_items
  from ships left join per using (record_id) group by all)
select b.*, coalesce(t.commodity, '') top_commodity, coalesce(t.n, 0) top_commodity_count
from base b left join {top_sql('origin_port, destination_port, "year"', "commodity", "joined")} t using (origin_port, destination_port, "year")""",
    "a2_commodity_flows_by_year": f"""{STAR}, {JOINED}
select b.*, coalesce(o.origin_port, '') top_origin, coalesce(p.destination_port, '') top_destination
from (select commodity, "year", count(distinct record_id) num_ships, count(*) num_cargo_items from joined group by all) b
left join {top_sql('commodity, "year"', "origin_port", "joined")} o using (commodity, "year")
left join {top_sql('commodity, "year"', "destination_port", "joined")} p using (commodity, "year")""",
    "a3_route_commodity_matrix": f"""{STAR}, {JOINED}
select origin_port, destination_port, commodity, "year", count(distinct record_id) num_ships, count(*) num_cargo_items from joined group by all""",
    "a4_port_activity_summary": f"""{STAR}, {ROLES}, per as (select record_id, count(*) items from cargo group by 1),
rc as (select * from roles join cargo using (record_id)), t as {top_sql('port_name, port_type, "year"', "commodity", "rc", 3)}
select b.*, coalesce(max(case when place = 1 then commodity end), '') top_commodity_1, coalesce(max(case when place = 2 then commodity end), '') top_commodity_2,
  coalesce(max(case when place = 3 then commodity end), '') top_commodity_3
from (select port_name, port_type, "year", count(distinct record_id) num_ships, cast(coalesce(sum(items), 0) as bigint) num_cargo_items
  from roles left join per using (record_id) group by all) b left join t using (port_name, port_type, "year") group by all""",
    "a5_detailed_long": f"""{STAR} select c.record_id, ship_date, "year", origin_port, destination_port, commodity, quantity, unit, merchant
from cargo c left join ships s on s.record_id = c.record_id""",
    "a6_top3_commodities": f"{STAR}, {JOINED} select * from {top_sql('origin_port', 'commodity', 'joined', 3)}",
    "a7_commodity_counts": f"{STAR} select commodity, count(*) n, count(distinct record_id) ships from cargo group by 1",
    "a8_frequency_buckets": f"""{STAR} select case when n <= 3 then '1-3' when n <= 10 then '4-10' else '>10' end bucket, count(*) merchants
from (select merchant, count(*) n from ships group by 1) group by 1""",
    "a13_years_of_ports": f"""{STAR} select origin_port, count(*) ship_count, string_agg(distinct cast("year" as varchar), ',' order by cast("year" as varchar)) "years",
  case when min("year") = max("year") then cast(min("year") as varchar) else min("year") || '-' || max("year") end year_range from ships group by 1""",
    "a19_ports_origin_first": f"""{STAR} select distinct origin_port port, 'origin' port_type from ships
union all select distinct destination_port, 'destination' from ships where destination_port not in (select origin_port from ships)""",
    "a20_commonest_spelling": """select word, n from (select *, row_number() over (partition by lower(word) order by n desc, word) r
from (select word, count(*) n from (select unnest(string_split(text, ' ')) word from documents) where word <> '' group by 1)) where r = 1""",
    "a24_ship_items": f"""{STAR} select s.record_id, coalesce(string_agg(commodity, '; ' order by commodity), '') commodities, coalesce(sum(quantity), 0) total_quantity
from ships s left join cargo c on c.record_id = s.record_id group by 1""",
    "a25_year_origin": f"""{STAR} select "year", origin_port, count(*) num_ships, count(distinct destination_port) destinations from ships group by all""",
    "a25_specialization": f"""{STAR}, per as (select merchant, commodity, count(*) n from cargo join ships using (record_id) group by all)
select merchant, cast(sum(n) as bigint) items, first(commodity order by n desc, commodity) commodity, round(100 * max(n) / sum(n), 4) percent from per group by 1""",
    "a25_monthly": f"""{STAR} select strftime(ship_date, '%Y-%m') as "month", destination_port, count(*) num_ships, count(distinct merchant) merchants from ships group by all""",
    "a26_quality": f"""{STAR} select count(*) num_ships, count(*) filter (origin_port is null) null_origins, min("year") first_year, max("year") last_year,
  count(distinct origin_port) origins, (select count(*) from cargo where record_id not in (select record_id from ships)) orphan_items,
  (select count(*) from ships where record_id not in (select record_id from cargo)) ships_without_cargo from ships""",
    "n7_decades": f"""{STAR} select cast(floor("year" / 10) * 10 as int) "decade", count(*) num_ships from ships group by 1""",
    "ext_rollup": f"""{STAR} select origin_port, destination_port, count(*) num_ships, cast(grouping_id(origin_port, destination_port) as int) "level"
from ships group by rollup (origin_port, destination_port)""",
    "ext_cube": f"""{STAR}, {JOINED} select destination_port, commodity, count(*) items, round(sum(quantity), 2) quantity from joined group by cube (destination_port, commodity)""",
    "j3_last_wins": """with r as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_extendedprice desc) n from lineitem)
select a.l_returnflag, count(*) n, cast(sum(case when a.l_partkey = r.l_partkey then 1 else 0 end) as bigint) own
from lineitem a join r on r.n = 1 and r.l_orderkey = a.l_orderkey and r.l_linenumber = a.l_linenumber group by 1""",
    "j4_cargo_of_kept": f"""{STAR} select commodity, count(*) n from cargo where record_id in (select record_id from ships where destination_port = 'BUILDING') group by 1""",
    "j5_cargo_of_removed": f"""{STAR} select commodity, count(*) n from cargo where record_id not in (select record_id from ships where destination_port = 'BUILDING') group by 1""",
    "o3_top_merchants": f"{STAR} select merchant, count(*) n from ships group by 1 order by n desc, merchant limit 20",
    "o4_by_type_then_count": f"""{STAR}, {ROLES} select port_type, port_name, n, cast(row_number() over (partition by port_type order by n desc, port_name) as int) place
from (select port_type, port_name, count(*) n from roles group by all)""",
    "t7_port_roles": f"{STAR}, {ROLES} select port_type, port_name, count(*) n from roles group by all",
    "x_sets": """with a as (select distinct c_nationkey k from customer), b as (select distinct s_nationkey k from supplier)
select 'union' kind, count(*) n from (select k from a union select k from b)
union all select 'intersect', count(*) from (select k from a intersect select k from b)
union all select 'except', count(*) from (select k from a except select k from b)""",
    "f1_given": """select port, count(*) n from (select value, case when user_id % 7 = 0 then '' when user_id % 11 = 0 then null else event_type end port from events)
where port is not null and port <> '' and value is not null group by 1""",
    "f2_year_and_place": f"""{STAR} select origin_port, count(*) n from ships where "year" = 1996 and upper(destination_port) like '%BUILD%' group by 1""",
}
