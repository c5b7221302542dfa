"""Daily sales per product, built from order lines and parts.

``lineitem`` is the large side. It is joined to ``part`` without a hint, so
Catalyst broadcasts ``part`` only below ``autoBroadcastJoinThreshold`` and
otherwise sort-merges, where adaptive execution splits a hot part key. The
aggregation to (product, day) combines on the map side, so a product holding a
third of all lines reaches the shuffle as at most one row per day and task.

After that step a product has at most one row per calendar day, which bounds
every later per-product window or array by the length of the calendar.
"""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

PROMO_DISCOUNT = 0.09
PROMO_PRICE_FACTOR = Decimal("0.85")


def product_id() -> Column:
    return F.concat_ws("-", "p_brand", "p_type")


def catalog(part: DataFrame) -> DataFrame:
    """One row per product: attributes, lead time of 3..8 days and list price."""
    return (
        part.groupBy("p_brand", "p_type")
        .agg(F.min("p_partkey").alias("first_part"),
             F.min(F.col("p_retailprice").cast("decimal(12,2)")).alias("list_price"))
        .select(
            product_id().alias("product_id"),
            F.col("p_brand").alias("brand"),
            F.concat_ws(" ", "p_brand", "p_type").alias("product_name"),
            F.col("p_type").alias("category"),
            (3 + F.col("first_part") % 6).cast("int").alias("lead_time_days"),
            "list_price",
        )
    )


def sold_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    lines = lineitem.select(
        "l_partkey",
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
    )
    keys = part.select("p_partkey", product_id().alias("product_id"))
    return (lines.join(keys, lines.l_partkey == keys.p_partkey)
            .select("product_id", "date", "quantity", "discount"))


def _per_day(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id", "date").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        (F.max("discount") >= PROMO_DISCOUNT).cast("int").alias("on_promo"),
    )


def _with_attributes(cells: DataFrame, products: DataFrame) -> DataFrame:
    price = F.when(F.col("on_promo") == 1, F.round(F.col("list_price") * F.lit(PROMO_PRICE_FACTOR), 2))
    return cells.join(products, "product_id").select(
        "date", "product_id", "brand", "product_name", "category", "lead_time_days", "on_promo",
        F.coalesce(price, F.col("list_price")).cast("double").alias("unit_price"),
        "units_sold",
    )


def daily_sales(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Sparse form: only (product, day) cells with a sale."""
    return _with_attributes(_per_day(sold_lines(lineitem, part)), catalog(part))


def calendar_days(lineitem: DataFrame) -> DataFrame:
    """One row holding every day from the first to the last sale."""
    day = F.to_date("l_shipdate")
    return lineitem.agg(F.sequence(F.min(day), F.max(day)).alias("days"))


def spine(products: DataFrame, days: DataFrame) -> DataFrame:
    """Every (product, day) cell. The days arrive as one scalar array, bounded by
    the calendar, so each product row expands in place and nothing is shuffled."""
    return products.select("product_id", F.explode(days.scalar()).alias("date"))


def daily_panel(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Dense form: all products on all days, zero units on days without a sale.

    The empty cells are unioned in ahead of the daily aggregation, so filling
    the gaps costs no join of its own.
    """
    products = catalog(part)
    empty = spine(products, calendar_days(lineitem)).select(
        "product_id", "date", F.lit(0.0).alias("quantity"), F.lit(0.0).alias("discount"))
    return _with_attributes(_per_day(sold_lines(lineitem, part).unionByName(empty)), products)


def last_day(lineitem: DataFrame) -> date:
    """The day of the last sale, from one column."""
    return lineitem.agg(F.to_date(F.max("l_shipdate"))).first()[0]


def panel_between(lineitem: DataFrame, part: DataFrame, first: date, last: date) -> DataFrame:
    """The dense panel from ``first`` to ``last``, both included.

    As literals compared with the bare ``l_shipdate`` the days reach the Parquet scan,
    where dates and zoned timestamps skip other row groups; a subquery would not get there.
    """
    products = catalog(part)
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    empty = products.select("product_id", F.explode(days).alias("date"),
                            F.lit(0.0).alias("quantity"), F.lit(0.0).alias("discount"))
    kind = lineitem.schema["l_shipdate"].dataType
    after = F.lit(last + timedelta(days=1)).cast("date").cast(kind)
    lines = lineitem.where((F.col("l_shipdate") >= F.lit(first).cast("date").cast(kind)) & (F.col("l_shipdate") < after))
    return _with_attributes(_per_day(sold_lines(lines, part).unionByName(empty)), products)


def recent_panel(lineitem: DataFrame, part: DataFrame, days: int, last: date | None = None) -> DataFrame:
    """The last ``days`` days of the dense panel, equal to its last rows per product."""
    last = last or last_day(lineitem)
    return panel_between(lineitem, part, last - timedelta(days=days - 1), last)


def panel_mean(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Mean units per cell of the dense panel, without building it: all units over products times days."""
    cells = catalog(part).agg(F.count("*").alias("n")).scalar() * calendar_days(lineitem).select(F.size("days")).scalar()
    return sold_lines(lineitem, part).agg((F.sum("quantity") / cells).alias("mean_units"))


def event_counts(events: DataFrame) -> DataFrame:
    """Daily event counts per type as a positive demand series."""
    return events.groupBy(F.col("event_type").alias("product_id"), F.to_date("ts").alias("date")).agg(
        F.count("*").alias("units_sold"))
