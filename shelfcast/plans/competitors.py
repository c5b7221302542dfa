"""Competitor benchmark of the whole catalog in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.functions import policy, pricing


def elasticity_table(spark: SparkSession, values: dict[str, float] | None = None) -> DataFrame:
    """The literal elasticity per category as a table of a few rows."""
    rows = list((values or pricing.CATEGORY_ELASTICITY).items())
    return spark.createDataFrame(rows, "category string, elasticity double")


def with_elasticity(products: DataFrame, elasticities: DataFrame) -> DataFrame:
    """Elasticity by category, -1.5 where the category has none."""
    found = products.join(elasticities, "category", "left")
    return found.withColumn("ped", F.coalesce("elasticity", F.lit(pricing.DEFAULT_ELASTICITY))).drop("elasticity")


def our_prices(products: DataFrame) -> DataFrame:
    """Last price per product as an exact amount, dollars converted."""
    price = policy.normalize_price(F.col("last_price").cast("decimal(12,2)")).cast("decimal(14,2)")
    return products.select("product_id", "category", price.alias("our_price"))


def competitor_prices(prices: DataFrame, offers: DataFrame | None = None) -> DataFrame:
    """Price of each shop, their average and our index.

    ``offers`` holds (product_id, <shop>_price) rows; a missing or
    non-positive offer is replaced by a price drawn from the product's hash.
    """
    shops = list(pricing.SHOP_NOISE)
    if offers is None:
        for shop in shops:
            prices = prices.withColumn(f"{shop}_offer", F.lit(None).cast("double"))
    else:
        given = offers.select("product_id", *[F.col(f"{s}_price").alias(f"{s}_offer") for s in shops])
        prices = prices.join(given, "product_id", "left")
    for shop in shops:
        simulated = pricing.simulated_price(shop, F.col("product_id"), F.col("our_price"))
        prices = prices.withColumn(f"{shop}_price", pricing.shop_price(F.col(f"{shop}_offer"), simulated))
    average = pricing.average_price([F.col(f"{s}_price") for s in shops])
    return (prices.withColumn("competitor_avg_price", average)
            .withColumn("relative_price_index",
                        pricing.price_index(F.col("our_price"), F.col("competitor_avg_price")))
            .drop(*[f"{s}_offer" for s in shops]))


def market_threat(prices: DataFrame, elasticities: DataFrame) -> DataFrame:
    """Price gap, demand impact, threat level and text for each product."""
    gap = pricing.price_gap(F.col("our_price"), F.col("competitor_avg_price"))
    rows = (with_elasticity(prices, elasticities)
            .withColumn("price_diff_pct", gap)
            .withColumn("demand_impact_pct", pricing.demand_impact(F.col("price_diff_pct"), F.col("ped")))
            .withColumn("threat_level", pricing.threat_level(F.col("price_diff_pct"))))
    return (rows.withColumn("threat_badge", pricing.threat_badge(F.col("threat_level")))
            .withColumn("recommendation", pricing.recommendation(
                F.col("threat_level"), F.col("price_diff_pct"),
                F.col("competitor_avg_price"), F.col("demand_impact_pct"))))


def competitor_summary(products: DataFrame, elasticities: DataFrame, offers: DataFrame | None = None) -> DataFrame:
    return market_threat(competitor_prices(our_prices(products), offers), elasticities)


