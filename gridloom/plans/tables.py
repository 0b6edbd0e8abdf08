"""Reading the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their customer's nation and region; the small tables are joined first."""
    nation, region, customer, orders, lineitem = (table(spark, sf_dir, n) for n in ("nation", "region", "customer", "orders", "lineitem"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customers = customer.join(places, customer.c_nationkey == places.n_nationkey)
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return lineitem.join(placed, lineitem.l_orderkey == placed.o_orderkey)


SALES_SQL = """(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
