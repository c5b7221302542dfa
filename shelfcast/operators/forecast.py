"""Forecasts of every product at once.

A forecast is a long table (product_id, step, forecast_date, predicted_units).
State is one row per product holding at most its last 30 units.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.operators import features as feat
from shelfcast.operators.history import last_rows
from shelfcast.session import cut_lineage

ROUNDS_PER_CHECKPOINT = 5


def at_least_zero(value) -> Column:
    return F.greatest(F.col(value) if isinstance(value, str) else value, F.lit(0.0))


def _steps(state: DataFrame, horizon: int, value: Callable[[Column], Column]) -> DataFrame:
    ahead = state.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return ahead.select(
        "product_id", "step",
        F.date_add("last_date", F.col("step")).alias("forecast_date"),
        at_least_zero(value(F.col("step")).cast("double")).alias("predicted_units"))


def naive(sales: DataFrame, horizon: int) -> DataFrame:
    """Repeat the last value."""
    state = sales.groupBy("product_id").agg(
        F.max("date").alias("last_date"), F.max_by("units_sold", "date").alias("last_units"))
    return _steps(state, horizon, lambda step: F.col("last_units"))


def seasonal_naive(sales: DataFrame, horizon: int, season: int = 7) -> DataFrame:
    """Repeat the last ``season`` values in order."""
    state = (last_rows(sales.select("product_id", "date", "units_sold"), season).groupBy("product_id")
             .agg(F.max("date").alias("last_date"),
                  F.array_sort(F.collect_list(F.struct("date", "units_sold"))).alias("rows")))
    return _steps(state, horizon, lambda step: F.element_at(
        "rows", ((step - 1) % F.size("rows") + 1).cast("int"))["units_sold"])


def with_model(sales: DataFrame, model: PipelineModel, horizon: int) -> DataFrame:
    """Recursive forecast with any fitted model: features, predict, clip, append, repeat.

    All products advance one day per round. The state is cut from its lineage
    every few rounds by a reliable checkpoint, so the plan stays small.
    """
    state = feat.recent_history(sales).withColumn("made", F.array().cast("array<double>"))
    for done in range(horizon):
        day = F.date_add("last_date", done + 1)
        columns = feat.state_features(F.col("units"), F.col("promos"), day, F.col("unit_price"))
        scored = model.transform(state.withColumns(columns))
        value = at_least_zero("prediction")
        state = scored.select(
            "product_id", "last_date", F.col("unit_price"),
            feat._tail(F.concat("units", F.array(value)), 30).alias("units"),
            feat._tail(F.concat("promos", F.array(F.lit(0.0))), 30).alias("promos"),
            F.concat("made", F.array(value)).alias("made"))
        if (done + 1) % ROUNDS_PER_CHECKPOINT == 0 and done + 1 < horizon:
            state = cut_lineage(state)
    return _steps(state, horizon, lambda step: F.element_at("made", step))


def with_predictor(sales: DataFrame, predictor, horizon: int) -> DataFrame:
    """Recursive forecast with any object that has ``predict(matrix)``, all steps of a product in one pass.

    The state is one row per product. A batch of products is carried forward day by day
    inside one Arrow function, so a step costs neither a job nor a checkpoint.
    """
    state = feat.recent_history(sales).select("product_id", "last_date", "unit_price", "units", "promos")
    schema = T.StructType([*state.schema.fields[:2], T.StructField("made", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            days = np.asarray(batch.column(1).cast(pa.int32()), np.int64)
            state = feat.HistoryMatrix(batch.column(3).to_pylist(), batch.column(4).to_pylist(),
                                       np.asarray(batch.column(2), float), horizon)
            for step in range(horizon):
                state.append(np.maximum(predictor.predict(state.features(days + step + 1)), 0.0))
            made = pa.array(state.made().tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["product_id", "last_date", "made"])

    return _steps(state.mapInArrow(run, schema), horizon, lambda step: F.element_at("made", step))


def linear_score(inputs: dict[str, Column], coefficients: dict[str, float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for name, weight in coefficients.items():
        total = total + inputs[name] * F.lit(float(weight))
    return total


def with_linear(sales: DataFrame, coefficients: dict[str, float], intercept: float, horizon: int) -> DataFrame:
    """Recursive forecast of a linear model, folded inside one expression per product."""
    def advance(state: Column, step: Column) -> Column:
        inputs = feat.state_features(state["units"], state["promos"],
                                     F.date_add("last_date", step), F.col("unit_price"))
        used = {name: inputs[name] for name in coefficients}
        value = at_least_zero(linear_score(used, coefficients, intercept))
        return F.struct(F.concat(state["units"], F.array(value)).alias("units"),
                        F.concat(state["promos"], F.array(F.lit(0.0))).alias("promos"))

    start = F.struct(F.col("units").alias("units"), F.col("promos").alias("promos"))
    folded = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, advance)["units"]
    state = feat.recent_history(sales).withColumn("made", F.slice(folded, F.size("units") + 1, horizon))
    return _steps(state, horizon, lambda step: F.element_at("made", step))


def append_to_history(sales: DataFrame, forecast: DataFrame) -> DataFrame:
    """History rows followed by forecast rows, told apart by ``kind``."""
    past = sales.select("product_id", "date", F.col("units_sold").cast("double").alias("units"),
                        F.lit("history").alias("kind"))
    ahead = forecast.select("product_id", F.col("forecast_date").alias("date"),
                            F.col("predicted_units").alias("units"), F.lit("forecast").alias("kind"))
    return past.unionByName(ahead)


def as_arrays(forecast: DataFrame) -> DataFrame:
    """One row per product with dates and rounded units as arrays in step order."""
    rows = F.array_sort(F.collect_list(F.struct("step", "forecast_date", "predicted_units")))
    return forecast.groupBy("product_id").agg(rows.alias("rows")).select(
        "product_id",
        F.transform("rows", lambda r: F.round(r["predicted_units"], 2)).alias("forecast"),
        F.transform("rows", lambda r: F.date_format(r["forecast_date"], "yyyy-MM-dd")).alias("forecast_dates"))


def demand_summary(forecast: DataFrame) -> DataFrame:
    """Mean, population deviation and total per product, also over the first 30 days.

    Mean and deviation are rounded to 10 digits, which hides the order in which
    partial sums were added.
    """
    units, first = F.col("predicted_units"), F.when(F.col("step") <= 30, F.col("predicted_units"))
    return forecast.groupBy("product_id").agg(
        F.round(F.avg(units), 10).alias("avg_daily"),
        F.round(F.stddev_pop(units), 10).alias("forecast_std"),
        F.sum(units).alias("forecast_total"),
        F.sum(first).cast("bigint").alias("month_total"),
        F.avg(first).alias("month_avg"))


def peak(forecast: DataFrame) -> DataFrame:
    """Largest forecast value per product and its earliest date."""
    best = F.max_by(F.col("forecast_date"), F.struct("predicted_units", -F.col("step")))
    return forecast.groupBy("product_id").agg(
        F.max("predicted_units").alias("peak_units"), best.alias("peak_date"))


def for_requests(requests: DataFrame, products: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Answer (request_id, product_id, model, horizon) rows from a forecast table with a ``model`` column.

    Steps beyond the asked horizon are left out. A request that cannot be answered
    keeps one row without a forecast, and its status says why.
    """
    known = products.select(F.col("product_id").alias("known_id")).distinct()
    ahead = forecasts.select(F.col("product_id").alias("at"), F.col("model").alias("by"), "step", "forecast_date", "predicted_units")
    found = (requests.join(known, requests["product_id"] == F.col("known_id"), "left")
             .join(ahead, (requests["product_id"] == F.col("at")) & (F.col("model") == F.col("by"))
                   & (F.col("step") <= F.col("horizon")), "left"))
    status = (F.when(F.col("model").isNull(), "UNKNOWN MODEL").when(F.col("known_id").isNull(), "UNKNOWN PRODUCT")
              .when(F.col("step").isNull(), "NO FORECAST").otherwise("SUCCESS"))
    return found.select("request_id", "product_id", "model", "step", "forecast_date",
                        F.round("predicted_units", 2).alias("forecast_units"), status.alias("status"))
