"""File sources and sinks: CSV in and out, Parquet tables, portfolio export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.schemas import NEW_PRODUCTS, RAW_SALES


def read_raw_sales(spark: SparkSession, path: str) -> DataFrame:
    """Raw daily sales from CSV with a header and ISO dates."""
    return spark.read.schema(RAW_SALES).csv(path, header=True, escape='"')


def read_new_products(spark: SparkSession, path: str) -> DataFrame:
    """New-product feed: same fields in another column order."""
    feed = spark.read.schema(NEW_PRODUCTS).csv(path, header=True, escape='"')
    return feed.select(RAW_SALES.fieldNames())


def read_table_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_sales(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Raw or engineered sales, one folder per category."""
    if file_format == "csv":
        df.write.option("header", True).option("escape", '"').csv(path)
    else:
        df.repartition("category", "product_id").write.partitionBy("category").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)
