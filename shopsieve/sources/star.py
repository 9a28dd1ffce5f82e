"""The raw sales table as a view over an order-line star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsieve.schema import PRICE, SALES_RAW, UNREADABLE_DATE, assert_schema

# Every so many orders carry an unreadable date, so that the format rule has something to find.
UNREADABLE_EVERY = 400


# The columns used of each table. Stating them saves a look into the files' footers per query.
LAYOUTS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(LAYOUTS[name]).parquet(f"{sf_dir}/{name}.parquet")


def sales_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per order line. Line numbers repeat within an order, so some ids do too.

    The region is joined to the orders first, so that the lines, by far the largest table, are
    shuffled for it by order alone (and by product, where prices are too many to broadcast);
    prices are cast per product, not per line. The join
    by order comes last: after one by product, an aggregation per product would need no
    shuffle of its own, and a hot product would stay whole in one task. Join strategies are
    left to the planner.
    """
    line, order, customer, nation, region, part = (table(spark, sf_dir, name) for name in LAYOUTS)
    bought = (
        order.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "o_custkey", "r_name")
    )
    priced = part.select("p_partkey", F.col("p_retailprice").cast(PRICE).alias("price"))
    ship_day = F.col("l_shipdate").cast("date").cast("string")
    sales = (
        line.join(priced, F.col("l_partkey") == F.col("p_partkey"))
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            "price",
            F.col("r_name").alias("region"),
            F.when(F.col("l_orderkey") % UNREADABLE_EVERY == 0, F.lit(UNREADABLE_DATE))
            .otherwise(ship_day)
            .alias("sale_date"),
        )
    )
    return assert_schema(sales, SALES_RAW)
