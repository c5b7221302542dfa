"""Per-product sequence forecaster: the next value from the last 30, in scaled units."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.operators.features import by_product, recent_history
from shelfcast.operators.forecast import _steps, at_least_zero
from shelfcast.operators.models import fit_per_product

WINDOW = 30
RIDGE = 1e-3
SCHEMA = "product_id string, center double, scale double, weights array<double>, bias double"


def _fit_one(rows: pd.DataFrame) -> pd.DataFrame:
    units = rows["units_sold"].to_numpy(float)
    center, scale = units.mean(), units.std() or 1.0
    scaled = (units - center) / scale
    weights, bias = np.zeros(WINDOW), 0.0
    if len(scaled) > WINDOW:
        lags = np.lib.stride_tricks.sliding_window_view(scaled, WINDOW)[:-1]
        inputs = np.column_stack([lags, np.ones(len(lags))])
        gram = inputs.T @ inputs + RIDGE * np.eye(WINDOW + 1)
        solved = np.linalg.solve(gram, inputs.T @ scaled[WINDOW:])
        weights, bias = solved[:-1], solved[-1]
    return pd.DataFrame({"product_id": [rows["product_id"].iloc[0]], "center": [center], "scale": [scale],
                         "weights": [weights.tolist()], "bias": [float(bias)]})


def fit(train: DataFrame) -> DataFrame:
    """Autoregressive weights over the last 30 scaled values of each product."""
    return fit_per_product(train.select("product_id", "date", "units_sold"), _fit_one, SCHEMA)


def next_scaled(window: Column, weights: Column, bias: Column) -> Column:
    products = F.zip_with(window, weights, lambda v, w: v * w)
    return F.aggregate(products, bias, lambda total, v: total + v)


def one_step(sales: DataFrame, fitted: DataFrame, from_date: str) -> DataFrame:
    """One-step predictions from ``from_date`` on, true history fed back."""
    before = by_product().rowsBetween(-WINDOW, -1)
    windows = (sales.select("product_id", "date", F.col("units_sold").cast("double").alias("actual"),
                            F.collect_list(F.col("units_sold").cast("double")).over(before).alias("window"))
               .where((F.col("date") >= F.lit(from_date).cast("date")) & (F.size("window") == WINDOW)))
    scaled = F.transform("window", lambda v: (v - F.col("center")) / F.col("scale"))
    value = next_scaled(scaled, F.col("weights"), F.col("bias")) * F.col("scale") + F.col("center")
    return windows.join(fitted, "product_id").select(
        "product_id", F.col("date").alias("forecast_date"), "actual",
        at_least_zero(value).alias("predicted_units"))


def forecast(sales: DataFrame, fitted: DataFrame, horizon: int) -> DataFrame:
    """Recursive forecast; own predictions are fed back unclipped in scaled units."""
    state = recent_history(sales, WINDOW).join(fitted, "product_id").where(F.size("units") == WINDOW)
    start = F.transform("units", lambda v: (v - F.col("center")) / F.col("scale"))

    def advance(values: Column, step: Column) -> Column:
        last = F.slice(values, F.size(values) - WINDOW + 1, F.lit(WINDOW))
        return F.concat(values, F.array(next_scaled(last, F.col("weights"), F.col("bias"))))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance)
    state = state.withColumn("made", F.slice(grown, WINDOW + 1, horizon))
    return _steps(state, horizon, lambda step: F.element_at("made", step) * F.col("scale") + F.col("center"))
