"""Row-window operators over each product's daily history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.operators.features import by_product, spread


def last_rows(sales: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each product."""
    back = Window.partitionBy("product_id").orderBy(F.desc("date"))
    return sales.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= n).drop("_back")


def _recent_stats(units: Column) -> list[Column]:
    return [F.count(units).cast("double").alias("n"), F.sum(units).alias("total"),
            F.sum(units * units).alias("squares")]


def _with_recent(grouped: DataFrame) -> DataFrame:
    sigma = spread(F.col("n"), F.col("total"), F.col("squares"), sample=False)
    return (grouped.withColumn("avg_daily", F.col("total") / F.col("n"))
            .withColumn("sigma", F.when(sigma > 0, sigma).otherwise(2.0))
            .drop("n", "total", "squares"))


def recent_demand(sales: DataFrame, n: int) -> DataFrame:
    """Mean and population standard deviation of the last ``n`` rows; no spread counts as 2."""
    units = F.col("units_sold").cast("double")
    return _with_recent(last_rows(sales, n).groupBy("product_id").agg(*_recent_stats(units)))


def _attributes() -> list[Column]:
    first = ["brand", "product_name", "category", "lead_time_days"]
    return [*[F.min_by(c, "date").alias(c) for c in first],
            F.min_by("unit_price", "date").alias("first_price"),
            F.max_by("unit_price", "date").alias("last_price")]


def product_attributes(sales: DataFrame) -> DataFrame:
    """First and last attributes of each product by date."""
    return sales.groupBy("product_id").agg(*_attributes())


def product_profile(sales: DataFrame, n: int) -> DataFrame:
    """Attributes and recent demand of each product from one pass over its rows."""
    back = Window.partitionBy("product_id").orderBy(F.desc("date"))
    units = F.when(F.col("_back") <= n, F.col("units_sold").cast("double"))
    numbered = sales.withColumn("_back", F.row_number().over(back))
    return _with_recent(numbered.groupBy("product_id").agg(*_attributes(), *_recent_stats(units)))


def mean_demand(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        (F.sum(F.col("units_sold").cast("double")) / F.count("units_sold")).alias("avg_daily"))


def sequences(sales: DataFrame, width: int = 30) -> DataFrame:
    """The ``width`` values before each row, with the row as target; full windows only."""
    before = by_product().rowsBetween(-width, -1)
    return (sales.select("product_id", "date", F.col("units_sold").alias("target"),
                         F.collect_list("units_sold").over(before).alias("window"))
            .where(F.size("window") == width))


def scaler(train: DataFrame) -> DataFrame:
    """Per-product mean and population standard deviation; a constant series scales by 1."""
    units = F.col("units_sold").cast("double")
    stats = train.groupBy("product_id").agg(
        F.count("units_sold").cast("double").alias("n"),
        F.sum(units).alias("total"), F.sum(units * units).alias("squares"))
    sigma = spread(F.col("n"), F.col("total"), F.col("squares"), sample=False)
    return stats.select("product_id", (F.col("total") / F.col("n")).alias("center"),
                        F.when(sigma > 0, sigma).otherwise(1.0).alias("scale"))


def scale(sales: DataFrame, fitted: DataFrame) -> DataFrame:
    return sales.join(fitted, "product_id").withColumn(
        "scaled", (F.col("units_sold") - F.col("center")) / F.col("scale"))


def unscale(values: DataFrame, column: str = "scaled") -> DataFrame:
    return values.withColumn("restored", F.col(column) * F.col("scale") + F.col("center"))
