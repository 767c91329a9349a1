"""The driver's tables in the roles that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_YEAR, YEARS = 2008, 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """documents as articles: source is the company, lang the sector.

    An article counts as fetched when its text holds a full stop.
    """
    return table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("company_name"), F.col("lang").alias("sector_name"),
        (F.lit(FIRST_YEAR) + F.pmod("doc_id", F.lit(YEARS))).cast("bigint").alias("year"),
        F.when(F.contains("text", F.lit(".")), 1).otherwise(0).cast("bigint").alias("success"),
        F.col("text").alias("content"))


def statistics(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem by supplier's nation as monthly statistics, with row key ``seq``."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("ref_date"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("label"), "l_returnflag",
        F.when(F.col("l_linestatus") == "F", "Cubic metres").otherwise("Barrels").alias("uom"),
        F.col("l_quantity").alias("value"))
    suppliers = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("geo"))
    # Spark broadcasts the suppliers while their files are small; beyond, it splits hot ones.
    return items.join(suppliers, "l_suppkey").select(
        F.col("l_orderkey").alias("seq"), "ref_date", "geo", "label", "l_returnflag", "uom", "value")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """nation as the table of coordinates."""
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("geo"),
        (F.col("n_nationkey") * 2.0 - 20).alias("latitude"),
        (F.col("n_nationkey") * 5.0 - 100).alias("longitude"))


# The first nations of the test data stand in for the places merged to regions.
REGIONS = {
    "NATION_0": "North", "NATION_5": "North", "NATION_10": "North",
    "NATION_1": "East", "NATION_6": "East", "NATION_11": "East",
}


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """orders as facts of monthly series."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.to_date("o_orderdate").alias("ref_date"),
        F.col("o_orderpriority").alias("geo"), F.col("o_orderstatus").alias("label"),
        F.col("o_totalprice").alias("value"))
