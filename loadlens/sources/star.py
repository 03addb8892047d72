"""Loads as a view over the given star schema, with surrogate predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions import constants as K


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loads_from(spark: SparkSession, sf_dir: str, lineitem: DataFrame) -> DataFrame:
    """The loads view on a given lineitem frame (batch or stream).

    Orders get the customer's place first. The fact rows meet them while they are narrow, then part, supplier and nation. No
    side is hinted; Catalyst and AQE broadcast those that are small by their own statistics and shuffle the others. Catalyst
    takes the size of a join for the product of its sides, so suppliers joined with nations beforehand would never count as
    small, and all fact rows would be shuffled by supplier.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    place = lambda key, side: [
        F.col("n_name").alias(side),
        (25 + (F.col(key) * 7) % 24).cast("double").alias(f"{side}_lat"),
        (-120 + (F.col(key) * 11) % 45).cast("double").alias(f"{side}_lon"),
    ]
    customer = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", *place("c_nationkey", "delivery"))
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "delivery", "delivery_lat", "delivery_lon")
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    miles = F.col("l_quantity") * 62.5
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(
                F.lit("TR-"),
                F.format_string("%07d", F.col("l_orderkey").cast("long")),
                F.lit("-"),
                F.col("l_linenumber").cast("string"),
            ).alias("load_id"),
            *place("s_nationkey", "pickup")[:1],
            "delivery",
            *place("s_nationkey", "pickup")[1:],
            "delivery_lat",
            "delivery_lon",
            miles.alias("distance"),
            F.when(F.col("l_returnflag") == "A", "Dry Van")
            .when(F.col("l_returnflag") == "N", "Reefer")
            .otherwise("Flatbed")
            .alias("equipment"),
            F.when(F.col("l_partkey") % 97 == 0, None)
            .otherwise((20000 + 500 * F.col("p_size")).cast("double"))
            .alias("weight"),
            F.to_date("l_shipdate").alias("date"),
            F.when(F.col("l_orderkey") % 101 == 0, None)
            .otherwise(F.lit(0.7) + F.col("l_tax") * 9)
            .alias("market_index"),
            (F.lit(0.7) + (F.col("l_partkey") % 290).cast("double") / 100).alias("quote_signal"),
            (
                (F.lit(300) + miles * (F.lit(1.4) + F.col("l_discount") * 8))
                * F.when(F.col("l_partkey") % 311 == 7, 4).otherwise(1)
            ).alias("posted_rate"),
        )
    )


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads_from(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def with_surrogate(df: DataFrame) -> DataFrame:
    """Deterministic stand-ins for model output, so the analytics on predictions can be checked in SQL."""
    return df.withColumns(
        {
            K.PREDICTION: F.lit(300.0) + F.lit(1.8) * F.col("distance"),
            "high_probability": F.when(F.col(K.TARGET) >= K.HIGH_RATE, F.lit(0.55)).otherwise(F.lit(0.1))
            + F.lit(5.0) * F.coalesce(F.col("market_index") - F.lit(0.7), F.lit(0.0)) / 9,
        }
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_surrogate(loads(spark, sf_dir))


def submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction file over the orders: unique keys, positive values."""
    key = F.format_string("%06d", (F.col("o_orderkey") + 1).cast("long"))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("TE-"), key).alias("load_id"),
        (F.col("o_totalprice") / 50).alias("predicted_rate"),
    )
