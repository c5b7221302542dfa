"""Lag and rolling features over daily sales.

All features share one window: partition by product, order by date. That is one
shuffle and one sort for the whole feature table. A product has one row per day,
so a partition is never longer than the calendar.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions import calendar

LAGS = (1, 7, 14, 30)
WINDOWS = (3, 7, 14, 30)

# The model input columns, in order.
FEATURES = [
    "day_of_week", "month", "quarter", "is_weekend",
    "dow_sin", "dow_cos", "month_sin", "month_cos",
    "on_promo", "on_promo_lag7", "unit_price",
    "sales_lag_1", "sales_lag_7", "sales_lag_14", "sales_lag_30",
    "rolling_mean_3", "rolling_std_3",
    "rolling_mean_7", "rolling_std_7",
    "rolling_mean_14", "rolling_std_14",
    "rolling_mean_30", "rolling_std_30",
    "rolling_min_7", "rolling_max_7",
]


def by_product():
    return Window.partitionBy("product_id").orderBy("date")


def calendar_features(sales: DataFrame) -> DataFrame:
    return sales.withColumns(calendar.calendar_parts(F.col("date")))


def cyclic_features(sales: DataFrame) -> DataFrame:
    return sales.withColumns(calendar.cyclic_parts(F.col("date")))


def sales_lags(lags=LAGS) -> dict[str, Column]:
    return {f"sales_lag_{n}": F.lag("units_sold", n).over(by_product()).cast("double") for n in lags}


def promo_lag(n: int = 7) -> Column:
    return F.coalesce(F.lag("on_promo", n).over(by_product()), F.lit(0)).cast("double")


def spread(n: Column, total: Column, squares: Column, sample: bool) -> Column:
    """Standard deviation from count, sum and sum of squares; whole units stay exact."""
    gap = F.greatest(n * squares - total * total, F.lit(0.0))
    return F.sqrt(F.try_divide(gap, n * (n - 1) if sample else n * n))


def rolling(width: int, stat: str) -> Column:
    """Statistic of the ``width`` rows before this one; null until the window is full."""
    frame = by_product().rowsBetween(-width, -1)
    units = F.col("units_sold").cast("double")
    total, squares = F.sum(units).over(frame), F.sum(units * units).over(frame)
    value = {
        "mean": lambda: total / width,
        "std": lambda: spread(F.lit(float(width)), total, squares, sample=True),
        "min": lambda: F.min(units).over(frame),
        "max": lambda: F.max(units).over(frame),
    }[stat]()
    return F.when(F.count("units_sold").over(frame) == width, value)


def rolling_stats(stats=("mean", "std", "min", "max"), widths=WINDOWS) -> dict[str, Column]:
    return {f"rolling_{s}_{w}": rolling(w, s) for w in widths for s in stats}


def transform_groups(sales: DataFrame, name: str, fn: Callable[[Column], Column], frame: tuple[int, int] | None = None,
                     units: str = "units_sold") -> DataFrame:
    """Give every row the aggregate ``fn`` of its product's rows, or of a frame of them around it in date order.

    ``frame`` counts rows from the current one, as in ``(-6, 0)``.
    """
    group = by_product().rowsBetween(*frame) if frame else Window.partitionBy("product_id")
    return sales.withColumn(name, fn(F.col(units)).over(group))


def feature_table(sales: DataFrame) -> DataFrame:
    """All 29 derived columns; rows with any null are dropped (the first 30 of each product)."""
    derived = {
        **calendar.calendar_parts(F.col("date")),
        **calendar.cyclic_parts(F.col("date")),
        "on_promo_lag7": promo_lag(),
        **sales_lags(),
        **rolling_stats(),
    }
    return sales.withColumns(derived).dropna("any")


def split_at(df: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the date and rows from it on."""
    cut = F.lit(date).cast("date")
    return df.where(F.col("date") < cut), df.where(F.col("date") >= cut)


def recent_history(sales: DataFrame, n: int = 30) -> DataFrame:
    """One row per product with its last ``n`` units and 7 promo flags as arrays, oldest first."""
    back = Window.partitionBy("product_id").orderBy(F.desc("date"))
    last = sales.select("product_id", "date", "units_sold", "on_promo", "unit_price",
                        F.row_number().over(back).alias("back")).where(F.col("back") <= n)
    rows = F.array_sort(F.collect_list(F.struct("date", "units_sold", "on_promo")))
    return (
        last.groupBy("product_id")
        .agg(rows.alias("rows"), F.max_by("unit_price", "date").alias("unit_price"))
        .select(
            "product_id",
            F.element_at("rows", -1)["date"].alias("last_date"),
            "unit_price",
            F.transform("rows", lambda r: r["units_sold"].cast("double")).alias("units"),
            F.transform("rows", lambda r: r["on_promo"].cast("double")).alias("promos"),
        )
    )


def _tail(units: Column, width: int) -> Column:
    size = F.size(units)
    return F.slice(units, F.greatest(size - width + 1, F.lit(1)), F.lit(width))


def _add(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _deviation(values: Column, mean: Column) -> Column:
    """Population standard deviation around a known mean, safe for any real values."""
    n = F.size(values).cast("double")
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / n)


def state_features(units: Column, promos: Column, date: Column, price: Column) -> dict[str, Column]:
    """The 25 model inputs for the day after the end of ``units``.

    Unlike the training table these use whatever rows exist, and the population
    standard deviation; the two definitions differ on purpose.
    """
    def lagged(n):
        return F.when(F.size(units) >= n, F.try_element_at(units, F.lit(-n))).otherwise(F.element_at(units, -1))

    values = {
        **calendar.calendar_parts(date),
        **calendar.cyclic_parts(date),
        "on_promo": F.lit(0.0),
        "on_promo_lag7": F.when(F.size(promos) >= 7, F.try_element_at(promos, F.lit(-7))).otherwise(0.0),
        "unit_price": price,
        **{f"sales_lag_{n}": lagged(n) for n in LAGS},
        "rolling_min_7": F.array_min(_tail(units, 7)),
        "rolling_max_7": F.array_max(_tail(units, 7)),
    }
    for width in WINDOWS:
        tail = _tail(units, width)
        mean = _add(tail) / F.size(tail).cast("double")
        values[f"rolling_mean_{width}"] = mean
        values[f"rolling_std_{width}"] = _deviation(tail, mean)
    return {name: values[name].cast("double") for name in FEATURES}


class HistoryMatrix:
    """The state of many products as arrays, for forecasts that carry on inside a task.

    ``features`` gives the same inputs as ``state_features``, added up in the same order;
    units stand at the right end of a row, so the last ones of all products share columns.
    """

    def __init__(self, units: list, promos: list, prices: np.ndarray, horizon: int):
        self.prices, self.end = prices, max([*map(len, units), *map(len, promos), 1])
        self.start, self.sizes = self.end, np.array([len(u) for u in units])
        self.promo_sizes = np.array([len(p) for p in promos])
        self.units, self.promos = (np.zeros((len(units), self.end + horizon)) for _ in range(2))
        for table, rows in ((self.units, units), (self.promos, promos)):
            for row, values in zip(table, rows):
                row[self.end - len(values):self.end] = values

    def append(self, values: np.ndarray) -> None:
        """The next day's units, without a promotion."""
        self.units[:, self.end] = values
        self.end += 1
        self.sizes, self.promo_sizes = self.sizes + 1, self.promo_sizes + 1

    def made(self) -> np.ndarray:
        return self.units[:, self.start:self.end]

    def _lag(self, n: int) -> np.ndarray:
        last = self.units[:, self.end - 1]
        return np.where(self.sizes >= n, self.units[:, self.end - n], last) if n <= self.end else last

    def _tail(self, width: int):
        """(values, whether they exist) of the last days, oldest first."""
        for k in range(min(width, self.end), 0, -1):
            yield self.units[:, self.end - k], self.sizes >= k

    def features(self, days: np.ndarray) -> np.ndarray:
        """The model inputs of each product for its day, given as days since 1970-01-01."""
        weekday = (days + 3) % 7
        month = days.astype("datetime64[D]").astype("datetime64[M]").astype(int) % 12 + 1
        values = {
            "day_of_week": weekday, "month": month, "quarter": (month + 2) // 3, "is_weekend": weekday >= 5,
            "on_promo": np.zeros(len(days)), "unit_price": self.prices,
            "on_promo_lag7": np.where(self.promo_sizes >= 7, self.promos[:, max(self.end - 7, 0)], 0.0),
            **{f"sales_lag_{n}": self._lag(n) for n in LAGS},
            "rolling_min_7": np.min([np.where(there, v, np.inf) for v, there in self._tail(7)], axis=0),
            "rolling_max_7": np.max([np.where(there, v, -np.inf) for v, there in self._tail(7)], axis=0),
        }
        for name, value, period in (("dow", weekday, 7), ("month", month, 12)):
            angle = value * (2 * math.pi) / period
            values[f"{name}_sin"], values[f"{name}_cos"] = np.sin(angle), np.cos(angle)
        for width in WINDOWS:
            n = np.minimum(self.sizes, width).astype(float)
            mean = sum(np.where(there, v, 0.0) for v, there in self._tail(width)) / n
            squares = sum(np.where(there, (v - mean) * (v - mean), 0.0) for v, there in self._tail(width))
            values[f"rolling_mean_{width}"], values[f"rolling_std_{width}"] = mean, np.sqrt(squares / n)
        return np.column_stack([np.asarray(values[name], float) for name in FEATURES])


def hold_last_features(sales: DataFrame, horizon: int) -> DataFrame:
    """Features of the next ``horizon`` days with the last sale repeated and no promotion."""
    state = recent_history(sales).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    ahead = state.select(
        "product_id", "step", "unit_price",
        F.date_add("last_date", F.col("step")).alias("date"),
        F.concat("units", F.array_repeat(F.element_at("units", -1), F.col("step") - 1)).alias("units"),
        F.concat("promos", F.array_repeat(F.lit(0.0), F.col("step") - 1)).alias("promos"),
    )
    features = state_features(F.col("units"), F.col("promos"), F.col("date"), F.col("unit_price"))
    return ahead.select("product_id", "step", "date", *[c.alias(n) for n, c in features.items()])
