"""Similarity of products by their daily sales pattern.

Every product becomes one row with its sold days and values relative to its
filled cells, so that a missing cell is zero and needs no storage. Products are
hashed into blocks; a task multiplies the vectors of one pair of blocks. The
shuffle carries each vector once per block (P * blocks rows), never one row per
pair and day, and a task holds two blocks of vectors.
"""

from __future__ import annotations

import math
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# Products per block: enough to pay for a task, few enough for its memory.
SMALLEST_BLOCK, LARGEST_BLOCK = 32, 1024
PAIR_SCHEMA = "product_a string, product_b string, similarity double"


def sold_days(sales: DataFrame) -> DataFrame:
    """One row holding every day with any sale, in order; bounded by the calendar."""
    return sales.agg(F.sort_array(F.collect_set("date")).alias("days"))


def cell_means(sales: DataFrame) -> DataFrame:
    """Mean units per (date, product) cell."""
    return sales.groupBy("product_id", "date").agg(
        (F.sum(F.col("units_sold").cast("double")) / F.count("units_sold")).alias("units"))


def filled_cells(sales: DataFrame) -> DataFrame:
    """Every (date, product) cell, a missing one filled with the product's mean.

    Empty cells join the real ones ahead of the cell aggregation, so the gaps
    cost no join.
    """
    units = sales.select("product_id", "date", F.col("units_sold").cast("double").alias("units"))
    gaps = sales.select("product_id").distinct().select(
        "product_id", F.explode(sold_days(sales).scalar()).alias("date"), F.lit(None).cast("double").alias("units"))
    cells = units.unionByName(gaps).groupBy("product_id", "date").agg(
        F.try_divide(F.sum("units"), F.count("units")).alias("units"))
    known = Window.partitionBy("product_id")
    mean = F.sum("units").over(known) / F.count("units").over(known)
    return cells.select("product_id", "date", F.coalesce("units", mean).alias("units"))


def sales_pivot(sales: DataFrame, product_ids: list[str]) -> DataFrame:
    """Wide form: one row per date, one column per named product."""
    return (filled_cells(sales).where(F.col("product_id").isin(product_ids))
            .groupBy("date").pivot("product_id", product_ids).agg(F.first("units")))


def centred(cells: DataFrame) -> DataFrame:
    """Cells relative to the product's mean: a cell filled with the mean is zero."""
    known = Window.partitionBy("product_id")
    mean = F.sum("units").over(known) / F.count("units").over(known)
    return cells.select("product_id", "date", (F.col("units") - mean).alias("value"))


def centred_ranks(cells: DataFrame, days: Column) -> DataFrame:
    """Average ranks over all ``days`` relative to the rank of the filled cells.

    The missing cells of a product all tie at its mean; their ranks follow from
    counts, so they are never built.
    """
    product = Window.partitionBy("product_id")
    n, mean = F.count("units").over(product), F.sum("units").over(product) / F.count("units").over(product)
    counted = cells.select(
        "product_id", "date", "units", mean.alias("mean"), (days - n).alias("missing"),
        F.rank().over(product.orderBy("units")).alias("position"),
        F.count("*").over(Window.partitionBy("product_id", "units")).alias("tied"))
    below = F.sum((F.col("units") < F.col("mean")).cast("int")).over(product)
    same = F.sum((F.col("units") == F.col("mean")).cast("int")).over(product)
    rank = F.col("position") + (F.col("tied") - 1) / 2 + (
        F.when(F.col("units") > F.col("mean"), F.col("missing"))
        .when(F.col("units") == F.col("mean"), F.col("missing") / 2).otherwise(0))
    filled = below + (same + F.col("missing") + 1) / 2
    return counted.select("product_id", "date", (rank - filled).alias("value"))


def _vectors(values: DataFrame) -> DataFrame:
    """One row per product: day numbers and values, at most a calendar long."""
    day = F.unix_date("date")
    return values.groupBy("product_id").agg(
        F.collect_list(F.struct(day.alias("day"), "value")).alias("rows")).select(
        "product_id", F.col("rows.day").alias("day"), F.col("rows.value").alias("value"))


def _block_pairs(vectors: DataFrame, blocks: int) -> DataFrame:
    block = F.pmod(F.xxhash64("product_id"), F.lit(blocks)).cast("int")
    with_block = vectors.withColumn("block", block)
    partner = with_block.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return partner.select(
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "product_id", "day", "value", "days")


def block_count(products: int, parallelism: int) -> int:
    """Blocks whose pairs keep all cores busy, within the bounds of a block's size.

    Fewer blocks mean fewer copies of each vector in the shuffle.
    """
    wanted = math.ceil(math.sqrt(2 * parallelism))
    return max(1, math.ceil(products / LARGEST_BLOCK), min(wanted, math.ceil(products / SMALLEST_BLOCK)))


def _dense(rows: pd.DataFrame, axis: np.ndarray) -> np.ndarray:
    matrix = np.zeros((len(rows), len(axis)))
    for i, (day, value) in enumerate(zip(rows["day"], rows["value"])):
        matrix[i, np.searchsorted(axis, day)] = value
    return matrix


def _correlation(left: pd.DataFrame, right: pd.DataFrame, days: int) -> np.ndarray:
    """Correlation over ``days`` days where a day without a value counts as zero."""
    axis = np.unique(np.concatenate([*left["day"], *right["day"]]))
    x, y = _dense(left, axis), _dense(right, axis)
    sx, sy = x.sum(axis=1), y.sum(axis=1)
    vx, vy = (x * x).sum(axis=1) - sx * sx / days, (y * y).sum(axis=1) - sy * sy / days
    # A product without variance has no correlation; rounding noise does not count as variance.
    vx[vx <= 1e-9], vy[vy <= 1e-9] = np.nan, np.nan
    return (x @ y.T - np.outer(sx, sy) / days) / np.sqrt(np.outer(vx, vy))


def _correlate(best: int | None, min_similarity: float | None, digits: int | None):
    def block_pair(key: tuple[Any, ...], group: pd.DataFrame) -> pd.DataFrame:
        low, high = key
        group = group.sort_values("product_id")
        left, right = group[group["block"] == low], group[group["block"] == high]
        empty = pd.DataFrame({"product_a": [], "product_b": [], "similarity": []}).astype(
            {"product_a": object, "product_b": object, "similarity": float})
        if left.empty or right.empty:
            return empty
        score = _correlation(left, right, int(group["days"].iloc[0]))
        a, b = left["product_id"].to_numpy(), right["product_id"].to_numpy()
        chosen = ~np.isnan(score)
        if low == high:
            chosen &= a[:, None] < b[None, :]
        i, j = np.nonzero(chosen)
        first, second = a[i], b[j]
        swap = first > second
        pairs = pd.DataFrame({"product_a": np.where(swap, second, first),
                              "product_b": np.where(swap, first, second),
                              "similarity": np.clip(score[i, j], -1.0, 1.0)})
        if digits is not None:
            pairs["similarity"] = pairs["similarity"].round(digits)
        if min_similarity is not None:
            pairs = pairs[pairs["similarity"] >= min_similarity]
        if best is not None:
            pairs = pairs.sort_values(["similarity", "product_a", "product_b"],
                                      ascending=[False, True, True]).head(best)
        return pairs
    return block_pair


def product_pairs(sales: DataFrame, products: int, method: str = "pearson", best: int | None = None,
                  min_similarity: float | None = None, digits: int | None = None) -> DataFrame:
    """Correlation of every unordered product pair, each pair once with a < b.

    ``products`` is the expected product count and sets the number of blocks.
    With ``best`` each block pair keeps its own best rows, which contain the
    overall best, so a top-N never materialises all pairs.
    """
    days = sold_days(sales).select(F.size("days")).scalar()
    cells = cell_means(sales)
    values = centred_ranks(cells, days) if method == "spearman" else centred(cells)
    blocks = block_count(products, sales.sparkSession.sparkContext.defaultParallelism)
    grouped = _block_pairs(_vectors(values).withColumn("days", days), blocks).groupBy("low", "high")
    return grouped.applyInPandas(_correlate(best, min_similarity, digits), PAIR_SCHEMA)


def varying_pairs(sales: DataFrame, products: int) -> DataFrame:
    """Every unordered pair of products that have a correlation, without computing any.

    A product has one if its cells differ from its mean. Ids are paired block by block,
    so no row of the result passes through one task or the driver.
    """
    known = cell_means(sales).groupBy("product_id").agg(F.min("units").alias("low"), F.max("units").alias("high"))
    ids = known.where("high > low").select("product_id")
    blocks = block_count(products, sales.sparkSession.sparkContext.defaultParallelism)
    block = F.pmod(F.xxhash64("product_id"), F.lit(blocks)).cast("int")
    left = ids.select(F.col("product_id").alias("product_a"), block.alias("block_a"),
                      F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block_b"))
    right = ids.select(F.col("product_id").alias("product_b"), block.alias("block_b"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block_a"))
    return left.join(right, ["block_a", "block_b"]).where("product_a < product_b").select("product_a", "product_b")


def similarity_matrix(pairs: DataFrame, product_ids: DataFrame) -> DataFrame:
    """Full symmetric matrix in long form: the pairs, their mirror and a diagonal of 1."""
    mirror = pairs.select(F.col("product_b").alias("product_a"), F.col("product_a").alias("product_b"), "similarity")
    diagonal = product_ids.select(
        F.col("product_id").alias("product_a"), F.col("product_id").alias("product_b"),
        F.lit(1.0).alias("similarity"))
    return pairs.unionByName(mirror).unionByName(diagonal)
