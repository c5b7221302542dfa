"""Forecast accuracy: errors, ranking, precision, leaderboard, error per boosting round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from shelfcast.operators.features import FEATURES
from shelfcast.operators.forests import FlatForest, staged_errors
from shelfcast.session import materialize

TOLERANCE = 0.20
# Leaderboard status for a model that is best and active, only active, only best, neither.
STATUS = ["👑 BEST OPTIMAL & ACTIVE", "⚡ ACTIVE FORECASTER", "👑 BEST OPTIMAL", "BENCHMARK"]
METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
])


def hold_out(forecast: DataFrame, test: DataFrame) -> DataFrame:
    """Forecast rows next to the actual units of the same product and day."""
    actual = test.select("product_id", F.col("date").alias("forecast_date"),
                         F.col("units_sold").cast("double").alias("actual"))
    return forecast.join(actual, ["product_id", "forecast_date"])


def errors(scored: DataFrame, *by: str, digits: int = 3) -> DataFrame:
    """MAE and RMSE over (actual, predicted_units), pooled or per group."""
    gap = F.col("actual") - F.col("predicted_units")
    return scored.groupBy(*by).agg(
        F.round(F.sum(F.abs(gap)) / F.count("*"), digits).alias("mae"),
        F.round(F.sqrt(F.sum(gap * gap) / F.count("*")), digits).alias("rmse"))


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models by ascending MAE; the table holds one row per model."""
    order = Window.orderBy("mae", "model")
    return metrics.select("model", "mae", "rmse", F.row_number().over(order).alias("rank"))


def merge_metrics(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The stored report with every model of ``fresh`` replaced by its new entry."""
    return stored.join(fresh.select("model").distinct(), "model", "left_anti").unionByName(fresh, allowMissingColumns=True)


def metrics_entries(scored: DataFrame, split: str, train_rows: Column) -> DataFrame:
    """A report entry per model: pooled errors, errors per product, split date and sample counts."""
    per_product = errors(scored, "model", "product_id").groupBy("model").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("product_id", F.struct("mae", "rmse"))))).alias("per_product"))
    counts = scored.groupBy("model").agg(F.count("*").alias("test_rows"))
    return (errors(scored, "model").join(per_product, "model").join(counts, "model")
            .withColumn("split_date", F.lit(split)).withColumn("train_rows", train_rows))


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.min_by("model", F.struct("mae", "model")).alias("best_model"))


def within_tolerance(scored: DataFrame, *by: str) -> DataFrame:
    """Share of predictions within 20 percent of the actual value, in percent."""
    gap = F.abs(F.col("predicted_units") - F.col("actual"))
    hit = gap <= TOLERANCE * F.abs("actual") + 1e-9
    return scored.groupBy(*by).agg((F.count_if(hit) * 100.0 / F.count("*")).alias("precision_pct"))


def accuracy(mae: Column, mean_demand: Column) -> Column:
    share = 1 - F.try_divide(mae, mean_demand)
    return F.round(F.greatest(F.lit(0.0), share) * 100, 2)


def mean_units(sales: DataFrame) -> DataFrame:
    return sales.agg((F.sum(F.col("units_sold").cast("double")) / F.count("units_sold")).alias("mean_units"))


def leaderboard(validation: DataFrame, test: DataFrame, val_demand: DataFrame, test_demand: DataFrame,
                active: str) -> DataFrame:
    """Validation and test accuracy of each model, lowest test MAE first."""
    both = validation.select("model", F.col("mae").alias("val_mae")).join(
        test.select("model", F.col("mae").alias("test_mae")), "model")
    best = best_model(test).scalar()
    is_best, is_active = F.col("model") == best, F.col("model") == active
    status = (F.when(is_best & is_active, STATUS[0]).when(is_active, STATUS[1])
              .when(is_best, STATUS[2]).otherwise(STATUS[3]))
    return both.select(
        "model", "val_mae", accuracy(F.col("val_mae"), val_demand.scalar()).alias("val_accuracy"),
        "test_mae", accuracy(F.col("test_mae"), test_demand.scalar()).alias("test_accuracy"),
        status.alias("status")).orderBy("test_mae", "model")


def errors_of_all(predictors: dict[str, object], rows: DataFrame, label: str = "units_sold",
                  predicted: tuple[str, ...] = (), digits: int = 3) -> DataFrame:
    """(model, n, mae, rmse, precision_pct) of many fitted models over the same rows, in one scan.

    ``predictors`` have ``predict(matrix)`` over the features. The columns named in
    ``predicted`` hold predictions made elsewhere, such as per-product models; rows where
    such a column is null do not count for it. Predictions are clipped at zero. A task adds
    up its rows and hands on one row per model.
    """
    names = [*predictors, *predicted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 4))
        for batch in batches:
            actual = np.asarray(batch.column(0), float)
            made = [np.asarray(c.cast(pa.float64()).fill_null(np.nan), float) for c in batch.columns[1:1 + len(predicted)]]
            matrix = np.column_stack([np.asarray(c, float) for c in batch.columns[1 + len(predicted):]])
            for k, guess in enumerate([*(p.predict(matrix) for p in predictors.values()), *made]):
                gap = np.abs(np.maximum(guess, 0.0) - actual)
                hit = gap <= TOLERANCE * np.abs(actual) + 1e-9
                total[k] += [np.isfinite(gap).sum(), np.nansum(gap), np.nansum(gap * gap), hit.sum()]
        yield pa.RecordBatch.from_arrays([pa.array(names), *[pa.array(c) for c in total.T]], names=["model", "n", "gap", "squares", "hits"])

    inputs = rows.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in [*predicted, *FEATURES]])
    sums = inputs.mapInArrow(run, "model string, n double, gap double, squares double, hits double").groupBy("model").agg(
        *[F.sum(c).alias(c) for c in ("n", "gap", "squares", "hits")]).where("n > 0")
    return sums.select("model", F.col("n").cast("long").alias("n"), F.round(F.col("gap") / F.col("n"), digits).alias("mae"),
                       F.round(F.sqrt(F.col("squares") / F.col("n")), digits).alias("rmse"),
                       F.round(F.col("hits") * 100.0 / F.col("n"), digits).alias("precision_pct"))


def round_report(forest: FlatForest, rows: DataFrame, label: str = "units_sold") -> DataFrame:
    """(epoch, val_mae, val_rmse, is_best, test_mae, test_rmse, test_precision) of a boosted ensemble.

    ``rows`` holds the features, the label and a column ``part`` that says ``validation`` or
    ``test``; one pass scores every round of both. The test figures stand at the best round,
    the earliest of those with the lowest validation error, and are null elsewhere.
    """
    # One row per part and round: a size of the model, not of the data.
    staged = materialize(staged_errors(forest, rows, label), "staged-errors")
    validation = staged.where("part = 'validation'").select(
        "epoch", F.col("mae").alias("val_mae"), F.col("rmse").alias("val_rmse"))
    test = staged.where("part = 'test'").select(
        "epoch", F.col("mae").alias("test_mae"), F.col("rmse").alias("test_rmse"), F.col("precision_pct").alias("test_precision"))
    is_best = F.col("epoch") == best_round(validation).scalar()
    both = validation.join(test, "epoch", "left").withColumn("is_best", is_best)
    shown = [F.when(F.col("is_best"), F.col(c)).alias(c) for c in ("test_mae", "test_rmse", "test_precision")]
    return both.select("epoch", "val_mae", "val_rmse", "is_best", *shown)


def best_round(rounds: DataFrame) -> DataFrame:
    return rounds.agg(F.min_by("epoch", F.struct("val_mae", "epoch")).alias("best_epoch"))


def thin_rounds(rounds: DataFrame, lines: int = 15) -> DataFrame:
    """Every k-th round, about ``lines`` of them, and always the last."""
    last = rounds.agg(F.max("epoch").alias("n")).scalar()
    step = F.greatest(F.lit(1), F.floor(last / lines))
    return rounds.where((F.pmod(F.col("epoch") - 1, step) == 0) | (F.col("epoch") == last))


def metrics_json(metrics: DataFrame) -> DataFrame:
    """All metrics as one JSON document, the form the report is stored in."""
    entry = F.struct("model", F.struct(F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE")))
    return metrics.agg(F.to_json(F.struct(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("metrics"),
        F.min_by("model", F.struct("mae", "model")).alias("best_model"))).alias("report"))


def parse_metrics(reports: DataFrame) -> DataFrame:
    """Models with a numeric MAE out of metrics JSON documents; other entries are skipped."""
    schema = "metrics map<string, string>, best_model string"
    entries = reports.select(F.from_json("report", schema).alias("r")).select(
        "r.best_model", F.explode(F.map_entries("r.metrics")).alias("e"))

    def number(name):
        return F.get_json_object("e.value", f"$.{name}").try_cast("double")

    return entries.select(F.col("e.key").alias("model"), number("MAE").alias("mae"),
                          number("RMSE").alias("rmse"), "best_model").where(F.col("mae").isNotNull())
