"""Sales panels derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.normalize import dense_panel


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the region of the supplier (store) and the type of the part (item).

    No broadcast hints: Catalyst broadcasts a dimension only while it is under the session's
    size limit and otherwise shuffles, with skewed keys split at run time.
    """
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("date", F.col("l_shipdate").cast("date"))
    )


def sales_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily units per region and part type; days without a shipment are absent."""
    return (
        shipped_lines(spark, sf_dir)
        .groupBy(F.col("date"), F.col("r_name").alias("store"), F.col("p_type").alias("item"))
        .agg(F.sum("l_quantity").alias("sales"))
    )


def sales_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse panel with unit price and promotion flag."""
    return (
        shipped_lines(spark, sf_dir)
        .groupBy(F.col("date"), F.col("r_name").alias("store"), F.col("p_type").alias("item"))
        .agg(
            F.sum("l_quantity").alias("sales"),
            (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"),
            F.max((F.col("l_discount") >= 0.05).cast("double")).alias("promotion_flag"),
        )
    )


def sales_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse panel with every missing day of a series as 0."""
    return dense_panel(sales_sparse(spark, sf_dir))


def sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series: 50 supplier groups by part brand."""
    return (
        shipped_lines(spark, sf_dir)
        .groupBy(
            F.col("date"),
            (F.col("l_suppkey") % 50).cast("string").alias("store"),
            F.col("p_brand").alias("item"),
        )
        .agg(F.sum("l_quantity").alias("sales"))
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an untyped sales export: text columns, foreign names, unreadable quantities."""
    units = (
        F.when(F.col("l_linenumber") == 7, "n/a")
        .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"), None)
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    return shipped_lines(spark, sf_dir).select(
        F.col("date").cast("string").alias("Date"),
        F.col("r_name").alias("Store"),
        F.col("p_type").alias("Product"),
        units.alias("Quantity"),
        F.when(F.col("l_linenumber") != 2, F.col("l_tax").cast("string")).alias("Price"),
    )


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines under canonical names with faults: unreadable dates, missing and negative sales."""
    day = F.when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "N"), "unknown").otherwise(
        F.col("date").cast("string")
    )
    units = F.when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "A"), None).otherwise(
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), -F.col("l_quantity")).otherwise(
            F.col("l_quantity")
        )
    )
    return shipped_lines(spark, sf_dir).select(
        day.alias("date"), F.col("r_name").alias("store"), F.col("p_type").alias("item"), units.alias("sales")
    )
