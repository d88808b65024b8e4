"""The published aggregate views over shipments and cargo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def given(*columns: str) -> Column:
    """All of ``columns`` are neither null nor empty."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return out


def top_k(df: DataFrame, keys: list[str], item: str, k: int = 1) -> DataFrame:
    """(keys, item, n, place): the ``k`` most frequent items of each key, ties in the order of the item.

    Rows are counted before they are ranked, so a window sees one row for each item of a key.
    """
    counted = df.groupBy(*keys, item).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), item))
    return counted.withColumn("place", place).filter(F.col("place") <= k)


def detailed_long(cargo: DataFrame, ships: DataFrame) -> DataFrame:
    """Every cargo item with its shipment; items without one keep nulls."""
    return cargo.join(ships, "record_id", "left").select("record_id", "ship_date", "year", "origin_port", "destination_port", "commodity", "quantity", "unit", "merchant")


def trade_routes_by_year(ships: DataFrame, cargo: DataFrame) -> DataFrame:
    """Shipments, cargo items and the commonest commodity of each origin, destination and year."""
    keys = ["origin_port", "destination_port", "year"]
    ships = ships.filter(given(*keys))
    items = cargo.groupBy("record_id").agg(F.count("*").alias("items"))
    base = ships.join(items, "record_id", "left").groupBy(*keys).agg(F.count("*").alias("num_ships"), F.coalesce(F.sum("items"), F.lit(0)).alias("num_cargo_items"))
    top = top_k(ships.join(cargo, "record_id"), keys, "commodity").select(*keys, F.col("commodity").alias("top_commodity"), F.col("n").alias("top_commodity_count"))
    return base.join(top, keys, "left").fillna({"top_commodity": "", "top_commodity_count": 0})


def commodity_flows_by_year(ships: DataFrame, cargo: DataFrame) -> DataFrame:
    """Shipments, items, commonest origin and destination of each commodity and year."""
    keys = ["commodity", "year"]
    joined = cargo.join(ships, "record_id").filter(given(*keys))
    base = joined.groupBy(*keys).agg(F.countDistinct("record_id").alias("num_ships"), F.count("*").alias("num_cargo_items"))
    for side in ("origin", "destination"):
        top = top_k(joined.filter(given(f"{side}_port")), keys, f"{side}_port").select(*keys, F.col(f"{side}_port").alias(f"top_{side}"))
        base = base.join(top, keys, "left")
    return base.fillna({"top_origin": "", "top_destination": ""})


def route_commodity_matrix(ships: DataFrame, cargo: DataFrame, parts: int | None = None) -> DataFrame:
    """Shipments and items of each route, commodity and year.

    Items are dealt to ``parts`` by their shipment (by default as many as shuffles have); the items of a shipment, which are counted
    first, lie in one part, so that a task's memory is that of a part.
    """
    keys = ["origin_port", "destination_port", "commodity", "year"]
    dealt = cargo.select("record_id", "commodity")
    dealt = dealt.repartition(parts, "record_id") if parts else dealt.repartition("record_id")
    joined = dealt.join(ships.select("record_id", "origin_port", "destination_port", "year"), "record_id").filter(given(*keys))
    items = joined.groupBy(*keys, "record_id").agg(F.count("*").alias("items"))
    return items.groupBy(*keys).agg(F.count("record_id").alias("num_ships"), F.sum("items").alias("num_cargo_items"))


def port_roles(ships: DataFrame) -> DataFrame:
    """Each shipment once for its origin and once for its destination: port_name, port_type."""
    roles = F.explode(F.array(*(F.struct(F.col(f"{r}_port").alias("port_name"), F.lit(r).alias("port_type")) for r in ("origin", "destination"))))
    return ships.withColumn("role", roles).select("record_id", "year", "role.port_name", "role.port_type")


def port_activity_summary(ships: DataFrame, cargo: DataFrame) -> DataFrame:
    """Shipments, items and the three commonest commodities of each port, role and year."""
    keys = ["port_name", "port_type", "year"]
    roles = port_roles(ships).filter(given("port_name", "year"))
    items = cargo.groupBy("record_id").agg(F.count("*").alias("items"))
    base = roles.join(items, "record_id", "left").groupBy(*keys).agg(F.countDistinct("record_id").alias("num_ships"), F.coalesce(F.sum("items"), F.lit(0)).alias("num_cargo_items"))
    top = top_k(roles.join(cargo, "record_id"), keys, "commodity", 3)
    best = top.groupBy(*keys).agg(*(F.max(F.when(F.col("place") == i, F.col("commodity"))).alias(f"top_commodity_{i}") for i in (1, 2, 3)))
    return base.join(best, keys, "left").fillna("", [f"top_commodity_{i}" for i in (1, 2, 3)])


def ship_items(ships: DataFrame, cargo: DataFrame) -> DataFrame:
    """Commodities of each shipment in one string, and the sum of its quantities."""
    items = cargo.groupBy("record_id").agg(F.array_join(F.array_sort(F.collect_list("commodity")), "; ").alias("commodities"), F.sum("quantity").alias("total_quantity"))
    return ships.join(items, "record_id", "left").select("record_id", F.coalesce("commodities", F.lit("")).alias("commodities"), F.coalesce("total_quantity", F.lit(0.0)).alias("total_quantity"))


def buckets(value: Column, bounds: list[tuple[int, str]], rest: str) -> Column:
    """The name of the first bound that ``value`` doesn't exceed, else ``rest``."""
    out = None
    for most, name in bounds:
        out = F.when(value <= most, name) if out is None else out.when(value <= most, name)
    return out.otherwise(rest)
