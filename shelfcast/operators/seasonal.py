"""Holt-Winters smoothing per product: additive trend, multiplicative weekly season.

Each product's series is one array, at most a calendar long. The parameter grid
is tried for all its members at once with numpy inside the task that holds the
product; Spark only partitions the products.
"""

from __future__ import annotations

from itertools import product as combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.forecast import _steps, seasonal_naive

SEASON = 7
MIN_LENGTH = 2 * SEASON
GRID = [i / 10 for i in range(1, 10)]
STATE = "alpha double, beta double, gamma double, level double, trend double, season array<double>, sse double"


def series(sales: DataFrame) -> DataFrame:
    """One row per product: last date and units in date order."""
    rows = F.array_sort(F.collect_list(F.struct("date", F.col("units_sold").cast("double").alias("units"))))
    return sales.groupBy("product_id").agg(F.max("date").alias("last_date"), rows.alias("rows")).select(
        "product_id", "last_date", F.transform("rows", lambda r: r["units"]).alias("units"))


def is_smoothable(units="units"):
    """A multiplicative season needs two full seasons of positive values."""
    return (F.size(units) >= MIN_LENGTH) & F.forall(units, lambda v: v > 0)


def smooth(units: np.ndarray, alpha: np.ndarray, beta: np.ndarray, gamma: np.ndarray):
    """Final level, trend, season and squared error of one series for many parameter sets."""
    first, second = units[:SEASON].sum() / SEASON, units[SEASON:MIN_LENGTH].sum() / SEASON
    level = np.full(alpha.shape, first)
    trend = np.full(alpha.shape, (second - first) / SEASON)
    season = np.repeat((units[:SEASON] / first)[:, None], alpha.size, axis=1)
    sse = np.zeros(alpha.shape)
    for t in range(SEASON, len(units)):
        i, y = t % SEASON, units[t]
        base = level + trend
        miss = y - base * season[i]
        sse = sse + miss * miss
        moved = alpha * (y / season[i]) + (1 - alpha) * base
        trend = beta * (moved - level) + (1 - beta) * trend
        season[i] = gamma * (y / base) + (1 - gamma) * season[i]
        level = moved
    return level, trend, season, sse


def fit(sales: DataFrame, grid: list[tuple[float, float, float]] | None = None) -> DataFrame:
    """Best parameters and final state per product over the grid; ties take the first set.

    Products whose series cannot carry the model, or for which no set of parameters
    gives a finite error, are left out.
    """
    sets = np.array(grid or list(combinations(GRID, GRID, GRID)))

    @F.pandas_udf(STATE)
    def best_state(column: pd.Series) -> pd.DataFrame:
        rows = []
        for units in column:
            with np.errstate(all="ignore"):
                level, trend, season, sse = smooth(np.asarray(units), *sets.T)
            k = int(np.argmin(np.where(np.isfinite(sse), sse, np.inf)))
            error = sse[k] if np.isfinite(sse[k]) else None
            rows.append((*sets[k], level[k], trend[k], season[:, k].tolist(), error))
        return pd.DataFrame(rows, columns=["alpha", "beta", "gamma", "level", "trend", "season", "sse"])

    ready = series(sales).where(is_smoothable())
    return ready.select("product_id", "last_date", F.size("units").alias("n"),
                        best_state("units").alias("s")).select("product_id", "last_date", "n", "s.*").where(
        F.col("sse").isNotNull() & ~F.isnan("sse"))


def forecast(states: DataFrame, horizon: int) -> DataFrame:
    """Closed form (level + step * trend) * season, clipped at zero."""
    def value(step):
        position = F.pmod(F.col("n") + step - 1, F.lit(SEASON)) + 1
        return (F.col("level") + step * F.col("trend")) * F.element_at("season", position)
    return _steps(states, horizon, value)


def forecast_or_naive(sales: DataFrame, horizon: int, grid=None) -> DataFrame:
    """Smoothed forecast where the series allows it, else the last season repeated."""
    states = fit(sales, grid)
    rest = sales.join(states.select("product_id"), "product_id", "left_anti")
    return forecast(states, horizon).unionByName(seasonal_naive(rest, horizon, SEASON))
