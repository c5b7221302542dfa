"""Bundle suggestions from sales similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.history import mean_demand
from shelfcast.operators.similarity import product_pairs

SIMILARITY_DIGITS = 3


def with_names(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Name and category of both sides of a pair."""
    for side in ("a", "b"):
        names = products.select(
            F.col("product_id").alias(f"product_{side}"),
            F.col("product_name").alias(f"name_{side}"),
            F.col("category").alias(f"category_{side}"))
        pairs = pairs.join(names, f"product_{side}")
    return pairs


def by_similarity(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy(F.desc("similarity"), "product_a", "product_b")


def best_pairs(pairs: DataFrame, top_n: int) -> DataFrame:
    return by_similarity(pairs).limit(top_n)


def at_least_similar(pairs: DataFrame, min_similarity: float) -> DataFrame:
    return pairs.where(F.col("similarity") >= min_similarity)


def recommend(sales: DataFrame, products: DataFrame, product_count: int, top_n: int = 5,
              min_similarity: float = 0.0) -> DataFrame:
    """The ``top_n`` pairs by similarity rounded to 3 digits; ties in id order."""
    pairs = product_pairs(sales, product_count, best=top_n, min_similarity=min_similarity,
                          digits=SIMILARITY_DIGITS)
    # The joins lose the order of the few best rows.
    named = by_similarity(with_names(best_pairs(pairs, top_n), products))
    return named.select("product_a", "product_b", "name_a", "name_b", "category_a", "category_b", "similarity")


def with_sales_impact(pairs: DataFrame, sales: DataFrame) -> DataFrame:
    """Rounded mean daily sales of both sides, 0 when unknown, and their sum."""
    demand = mean_demand(sales).select("product_id", F.round("avg_daily", 2).alias("avg_daily"))
    for side in ("a", "b"):
        one = demand.withColumnsRenamed({"product_id": f"product_{side}", "avg_daily": f"avg_daily_sales_{side}"})
        pairs = pairs.join(one, f"product_{side}", "left").fillna(0.0, [f"avg_daily_sales_{side}"])
    return pairs.withColumn("bundle_avg_daily_sales",
                            F.round(F.col("avg_daily_sales_a") + F.col("avg_daily_sales_b"), 2))
