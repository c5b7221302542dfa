"""Inventory KPIs, risk and orders for the whole portfolio from one forecast table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions import policy
from shelfcast.operators.forecast import append_to_history, as_arrays, demand_summary
from shelfcast.operators.history import last_rows, product_attributes

# Filter entries that mean no filter, and the column names of the exported analysis.
ALL_BRANDS = "All Brands"
ALL_CATEGORIES = "All Categories"
DISPLAY = {
    "product_name": "Product",
    "brand": "Brand",
    "category": "Category",
    "current_stock": "Current Stock",
    "avg_daily_demand": "Avg Forecast/Day",
    "forecast_total": "Forecast Total",
    "safety_stock": "Safety Stock",
    "reorder_point": "Reorder Point",
    "days_of_supply": "Days of Supply",
    "risk_badge": "Stock Risk",
    "recommended_order_qty": "Recommended Order",
    "action": "Action",
}
# The restock message of a product below and above its reorder point.
RESTOCK_MESSAGE = "RESTOCK REQUIRED: Stock (%d) is below ROP (%d). Order %d units."
SAFE_MESSAGE = "OPTIMAL INVENTORY: Stock (%d) is safe above ROP (%d)."
ATTENTION = ["product_name", "brand", "current_stock", "avg_daily_demand", "reorder_point",
             "days_of_supply", "recommended_order_qty", "action"]


def matching_products(sales: DataFrame, brand: str | None = None, category: str | None = None) -> DataFrame:
    """Sales of the asked brand and category; empty or "All ..." keeps everything."""
    if brand and brand != ALL_BRANDS:
        sales = sales.where(F.col("brand") == brand)
    if category and category != ALL_CATEGORIES:
        sales = sales.where(F.col("category") == category)
    return sales


def _kpis(demand: DataFrame, stock: Column, service_level, ordering_cost: float, holding_share: float) -> DataFrame:
    """Policy columns from avg_daily, forecast_std, lead_time_days, unit_price."""
    avg, sigma, lead = F.col("avg_daily"), F.col("forecast_std"), F.col("lead_time_days")
    return (
        demand
        .withColumn("safety", policy.safety_stock(sigma, lead, service_level))
        .withColumn("rop", policy.lead_time_demand(avg, lead) + F.col("safety"))
        .withColumn("current_stock", stock)
        .withColumn("annual", avg * policy.DAYS_PER_YEAR)
        .withColumn("order_size", policy.economic_order_quantity(
            F.col("annual"), ordering_cost, F.col("unit_price") * holding_share))
        .withColumn("dos", policy.days_of_supply(F.col("current_stock"), avg))
        .withColumn("needs_restock", policy.needs_restock(F.col("current_stock"), F.col("rop")))
        .withColumn("recommended_order_qty", policy.restock_quantity(F.col("current_stock"), F.col("rop"), avg))
    )


def optimize_fixed_stock(sales: DataFrame, forecast: DataFrame, horizon: int, current_stock: int = 60,
                         service_level=95, ordering_cost: float = policy.ORDERING_COST,
                         holding_share: float = policy.HOLDING_SHARE, with_series: bool = True) -> DataFrame:
    """KPIs of all products at one stock level; filter by product for a single summary."""
    base = (product_attributes(sales).withColumnRenamed("last_price", "unit_price")
            .join(demand_summary(forecast), "product_id"))
    rows = _kpis(base, F.lit(current_stock).cast("bigint"), service_level, ordering_cost, holding_share)
    summary = rows.select(
        "product_id", "product_name", "category", "lead_time_days", "unit_price",
        F.lit(horizon).alias("horizon_days"),
        F.round("avg_daily", 2).alias("avg_daily_demand"),
        F.round("forecast_std", 2).alias("forecast_std"),
        F.round("safety", 2).alias("safety_stock"),
        F.round("rop", 2).alias("reorder_point"),
        F.round("order_size", 2).alias("eoq"),
        F.round("annual", 2).alias("annual_demand"),
        F.round("dos", 2).alias("days_of_supply"),
        "needs_restock", "recommended_order_qty")
    return summary.join(as_arrays(forecast), "product_id") if with_series else summary


def summarize_product(sales: DataFrame, forecast: DataFrame, product_id: str, horizon: int, **options) -> DataFrame:
    """The one-product summary; the filter reaches the scans of both inputs."""
    only = F.col("product_id") == product_id
    return optimize_fixed_stock(sales.where(only), forecast.where(only), horizon, **options)


def optimize_portfolio(sales: DataFrame, forecast: DataFrame, horizon: int, brand: str | None = None,
                       category: str | None = None, service_level=95,
                       ordering_cost: float = policy.ORDERING_COST,
                       holding_share: float = policy.HOLDING_SHARE,
                       stock_overrides: DataFrame | None = None) -> DataFrame:
    """One row per matching product. A product without a usable forecast gives an ERROR row of zeros.

    ``stock_overrides`` holds (product_id, stock) rows and wins over the computed stock.
    """
    products = product_attributes(matching_products(sales, brand, category))
    demand = demand_summary(forecast).withColumn("forecast_std", policy.safe_sigma(F.col("forecast_std")))
    base = products.withColumn("unit_price", policy.normalize_price(F.col("last_price"))).join(
        demand, "product_id", "left")
    if stock_overrides is None:
        base = base.withColumn("given_stock", F.lit(None).cast("bigint"))
    else:
        given = stock_overrides.select("product_id", F.col("stock").cast("bigint").alias("given_stock"))
        base = base.join(given, "product_id", "left")
    stock = F.coalesce("given_stock", policy.opening_stock(F.col("product_id"), F.col("rop")))
    rows = _kpis(base, stock, service_level, ordering_cost, holding_share)

    ok = F.col("avg_daily").isNotNull()
    level = F.when(ok, policy.risk_level(F.col("current_stock"), F.col("rop"), F.col("dos"),
                                         F.col("lead_time_days"))).otherwise("ERROR")

    def value(column, empty=0.0):
        return F.when(ok, column).otherwise(F.lit(empty))

    return rows.withColumn("risk_level", level).select(
        "product_id", "product_name", "brand", "category",
        value(F.col("current_stock"), 0).cast("bigint").alias("current_stock"),
        value(F.round("avg_daily", 2)).alias("avg_daily_demand"),
        value(F.round("forecast_std", 2)).alias("forecast_std"),
        value(F.rint("forecast_total"), 0).cast("bigint").alias("forecast_total"),
        value(F.round("safety", 2)).alias("safety_stock"),
        value(F.round("rop", 2)).alias("reorder_point"),
        value(F.round("dos", 2)).alias("days_of_supply"),
        policy.risk_badge(F.col("risk_level")).alias("risk_badge"),
        value(F.col("recommended_order_qty"), 0).cast("bigint").alias("recommended_order_qty"),
        policy.risk_action(F.col("risk_level")).alias("action"),
        "risk_level",
        value(F.round("order_size", 2)).alias("eoq"),
        value(F.round("annual", 2)).alias("annual_demand"),
        value(F.col("lead_time_days"), 0).cast("int").alias("lead_time_days"),
        value(F.round("unit_price", 2)).alias("unit_price"),
        value(F.col("needs_restock"), False).alias("needs_restock"),
        F.when(ok, "SUCCESS").otherwise("FAILED: no forecast").alias("status"))


def portfolio_summary(portfolio: DataFrame) -> DataFrame:
    """Product counts per risk and totals; an empty portfolio gives zeros."""
    def count_of(level):
        return F.count_if(F.col("risk_level") == level)

    return portfolio.agg(
        F.count("*").alias("total_products"),
        count_of("HIGH").alias("high_risk_count"),
        count_of("MEDIUM").alias("medium_risk_count"),
        count_of("LOW").alias("healthy_count"),
        F.coalesce(F.sum("recommended_order_qty"), F.lit(0)).alias("total_recommended_order"),
        F.coalesce(F.sum("forecast_total"), F.lit(0)).alias("total_forecasted_demand"))


def needing_attention(portfolio: DataFrame) -> DataFrame:
    """HIGH and MEDIUM products, shortest supply first."""
    return (portfolio.where(F.col("risk_level").isin("HIGH", "MEDIUM"))
            .orderBy("days_of_supply", "product_id").select("product_id", *ATTENTION))


def export_view(portfolio: DataFrame) -> DataFrame:
    """The 12 columns of the exported analysis under their display names."""
    return portfolio.select([F.col(name).alias(label) for name, label in DISPLAY.items()])


def portfolio_map(portfolio: DataFrame) -> DataFrame:
    """Points of the portfolio map per risk level, with a marker size of 12 to 35."""
    size = F.least(F.greatest(F.col("current_stock") / 8.0 + 12, F.lit(12.0)), F.lit(35.0))
    return portfolio.where(F.col("risk_level").isin("HIGH", "MEDIUM", "LOW")).select(
        "risk_level", "product_id", F.col("days_of_supply").alias("x"),
        F.col("avg_daily_demand").alias("y"), size.alias("marker_size"))


def drill_down(sales: DataFrame, forecast: DataFrame, portfolio: DataFrame, days: int = 60) -> DataFrame:
    """Last ``days`` of history, the forecast, the reorder line and the restock message."""
    series = append_to_history(last_rows(sales, days), forecast)
    message = F.when(
        F.col("needs_restock"),
        F.format_string(RESTOCK_MESSAGE, "current_stock", F.ceil("reorder_point"), "recommended_order_qty")).otherwise(
        F.format_string(SAFE_MESSAGE, "current_stock", F.ceil("reorder_point")))
    line = portfolio.select("product_id", "reorder_point", message.alias("message"))
    return series.join(line, "product_id")
