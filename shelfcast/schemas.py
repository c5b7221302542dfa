"""Declared schemas; nothing is inferred from the data."""

from pyspark.sql import types as T

RAW_SALES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("lead_time_days", T.IntegerType()),
    T.StructField("on_promo", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("units_sold", T.LongType()),
])

# The new-product feed holds the same columns in another order.
NEW_PRODUCTS = T.StructType([RAW_SALES[c] for c in (
    "date", "product_id", "brand", "product_name", "category",
    "unit_price", "lead_time_days", "on_promo", "units_sold")])

STORED_TABLES = {
    "products": T.StructType([
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("lead_time_days", T.IntegerType()),
    ]),
    "sales": T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("on_promo", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("units_sold", T.LongType()),
    ]),
    "forecasts": T.StructType([
        T.StructField("product_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("forecast_date", T.StringType()),
        T.StructField("predicted_units", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
    ]),
    "stock_policy": T.StructType([
        T.StructField("product_id", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("avg_daily_demand", T.DoubleType()),
        T.StructField("safety_stock", T.DoubleType()),
        T.StructField("reorder_point", T.DoubleType()),
        T.StructField("eoq", T.DoubleType()),
        T.StructField("days_of_supply", T.DoubleType()),
        T.StructField("needs_restock", T.IntegerType()),
        T.StructField("recommended_order_qty", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]),
}

TABLE_KEYS = {"products": ["product_id"], "sales": ["date", "product_id"]}
