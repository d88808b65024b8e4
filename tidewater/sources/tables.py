"""Tables of a directory, and their roles: shipments with their cargo, documents with their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as shipments: record_id, origin_port, destination_port, year, merchant, ship_date."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .select(
            F.col("o_orderkey").alias("record_id"),
            F.col("n_name").alias("origin_port"),
            F.col("c_mktsegment").alias("destination_port"),
            F.year("o_orderdate").alias("year"),
            F.col("c_name").alias("merchant"),
            F.to_date("o_orderdate").alias("ship_date"),
        )
    )


def cargo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as cargo: record_id, commodity, quantity, unit."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).select(
        F.col("l_orderkey").alias("record_id"), F.col("p_type").alias("commodity"), F.col("l_quantity").alias("quantity"), F.col("p_brand").alias("unit")
    )
