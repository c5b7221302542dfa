"""Synthetic daily sales of a catalog over a calendar, reproducible by hash."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the demand model.
FIRST_DAY, LAST_DAY = "2024-01-01", "2025-12-31"
WEEKEND_FACTOR = 1.35
HOLIDAY_MONTHS, HOLIDAY_FACTOR = (11, 12), 1.4
PROMO_RATE, PROMO_FACTOR = 0.10, 1.5
NOISE_SHARE = 0.05
USD_RATE, PROMO_PRICE = Decimal("83"), Decimal("0.85")


def uniform(part: int) -> Column:
    """A number in (0, 1) from eight hex digits of the md5 of product and day."""
    digest = F.md5(F.concat_ws("|", "product_id", F.date_format("date", "yyyy-MM-dd")).cast("binary"))
    return (F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def normal() -> Column:
    """Standard normal noise from two uniforms."""
    return F.sqrt(-2.0 * F.log(uniform(0))) * F.cos(2 * math.pi * uniform(1))


def synthetic_sales(catalog: DataFrame, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    """Daily sales of (product_id, brand, product_name, category, base_demand,
    lead_time_days, price, seasonal_months, seasonal_factor) rows.

    Every catalog row expands over the calendar in place.
    """
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    cells = catalog.withColumn("date", F.explode(days)).withColumn(
        "on_promo", (uniform(2) < PROMO_RATE).cast("int"))
    month = F.month("date")
    in_season = F.coalesce(F.array_contains("seasonal_months", month), F.lit(False))
    demand = (F.col("base_demand")
              * F.when(F.weekday("date") >= 5, WEEKEND_FACTOR).otherwise(1.0)
              * F.when(in_season, F.col("seasonal_factor")).otherwise(1.0)
              * F.when(month.isin(*HOLIDAY_MONTHS), HOLIDAY_FACTOR).otherwise(1.0)
              * F.when(F.col("on_promo") == 1, PROMO_FACTOR).otherwise(1.0))
    price = F.col("price").cast("decimal(12,2)") * F.lit(USD_RATE)
    sold = F.when(F.col("on_promo") == 1, price * F.lit(PROMO_PRICE)).otherwise(price)
    return cells.select(
        "date", "product_id", "brand", "product_name", "category", "lead_time_days", "on_promo",
        F.round(sold, 2).cast("double").alias("unit_price"),
        F.greatest(F.lit(0), F.floor(demand * (1 + NOISE_SHARE * normal()))).cast("bigint").alias("units_sold"))
