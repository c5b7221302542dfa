"""Stored result tables as append-only Parquet folders with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.schemas import STORED_TABLES, TABLE_KEYS


class Store:
    """The four tables under one shared folder. Nothing is ever overwritten."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str) -> str:
        if table not in STORED_TABLES:
            raise ValueError(f"unknown table {table!r}; choose one of {sorted(STORED_TABLES)}")
        return f"{self.folder}/{table}"

    def create(self) -> None:
        """Create the tables that do not exist yet."""
        for table, schema in STORED_TABLES.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        path = self.path(table)
        return self.spark.read.schema(STORED_TABLES[table]).parquet(path)

    def append(self, table: str, rows: DataFrame) -> None:
        schema = STORED_TABLES[table]
        rows.select([F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").parquet(self.path(table))

    def insert_new(self, table: str, rows: DataFrame, first_by: list[str | Column]) -> None:
        """Append the rows whose key is not stored yet."""
        self.append(table, new_rows(rows, self.read(table), table, first_by))

    def seed_products(self, sales: DataFrame) -> None:
        self.insert_new("products", sales, ["date"])

    def seed_sales(self, sales: DataFrame) -> None:
        rows = sales.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        self.insert_new("sales", rows, ["unit_price", "units_sold"])

    def save_forecasts(self, forecasts: DataFrame, model: str) -> None:
        """One row per product and day from (product_id, forecast_dates, forecast) arrays."""
        self.append("forecasts", forecast_rows(forecasts, model))

    def save_optimization(self, rows: DataFrame, model: str) -> None:
        self.append("stock_policy", optimization_rows(rows, model))


def new_rows(rows: DataFrame, stored: DataFrame, table: str, first_by: list[str | Column]) -> DataFrame:
    """Insert-or-ignore: null fields are refused, the first row of a key wins, stored keys stay.

    The first row per key is an aggregate, which combines on the map side, so
    a key repeated in a third of the rows costs one row per task.
    """
    columns, keys = STORED_TABLES[table].fieldNames(), TABLE_KEYS[table]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in first_by])
    whole = rows.dropna("any", subset=columns)
    rest = [c for c in columns if c not in keys]
    first = whole.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("row")).select(*keys, "row.*")
    return first.join(stored.select(*keys), keys, "left_anti").select(columns)


def forecast_rows(forecasts: DataFrame, model: str) -> DataFrame:
    pairs = F.explode(F.arrays_zip("forecast_dates", "forecast")).alias("p")
    return forecasts.select("product_id", pairs).select(
        "product_id", F.lit(model).alias("model_name"),
        F.col("p.forecast_dates").alias("forecast_date"), F.col("p.forecast").alias("predicted_units"),
        F.current_timestamp().alias("created_at"))


def optimization_rows(rows: DataFrame, model: str) -> DataFrame:
    return rows.select(
        "product_id", F.lit(model).alias("model_name"), "avg_daily_demand", "safety_stock", "reorder_point",
        "eoq", "days_of_supply", F.col("needs_restock").cast("int").alias("needs_restock"),
        "recommended_order_qty", F.current_timestamp().alias("created_at"))
