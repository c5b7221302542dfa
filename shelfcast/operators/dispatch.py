"""A forecast from any kind of model by its name."""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfcast.operators import forecast as fc, models, seasonal, sequence

SEASONAL, SEQUENCE, LINEAR = "Seasonal Baseline (Holt-Winters)", "LSTM (PyTorch)", "Linear Regression"


def forecast(model: str, fitted: Callable[[str], object], sales: DataFrame, panel: DataFrame, horizon: int) -> DataFrame:
    """A forecast of every product from the named kind.

    ``fitted`` gives the model of a name for the kinds on features, ``sales`` the sparse
    sales that smoothing needs, ``panel`` the dense history that is carried on.
    """
    if model == SEASONAL:
        return seasonal.forecast_or_naive(sales, horizon)
    if model == SEQUENCE:
        return sequence.forecast(panel, sequence.fit(panel), horizon)
    if model == LINEAR:
        return fc.with_linear(panel, *models.coefficients(fitted(model)), horizon)
    return fc.with_predictor(panel, models.flat(fitted(model)), horizon)


#: Kinds that are fitted on the feature table; the others are fitted per product.
ON_FEATURES = [LINEAR, "Random Forest", "Gradient Boosting", "LightGBM", "XGBoost", "Support Vector (RBF)"]


def answer(requests: DataFrame, products: DataFrame, fitted: Callable[[str], object], sales: DataFrame,
           panel: DataFrame) -> DataFrame:
    """Answer (request_id, product_id, model, horizon) rows; see ``forecast.for_requests``.

    What is forecast follows the requests: per kind of model only the products asked of
    it, as far as the longest horizon asked of that kind. A kind that nobody asks for is
    neither fitted nor run. Products are carried forward once, however often they are
    asked for.
    """
    known = requests.join(products.select("product_id").distinct(), "product_id", "left_semi")
    wanted = known.where(F.col("model").isNotNull() & (F.col("horizon") > 0)).groupBy("model", "product_id").agg(
        F.max("horizon").alias("days"))
    # One row per kind of model.
    longest = {r["model"]: r["days"] for r in wanted.groupBy("model").agg(F.max("days").alias("days")).collect()}
    made = []
    for kind, days in sorted(longest.items()):
        asked = wanted.where(F.col("model") == kind).select("product_id", "days")
        ahead = forecast(kind, fitted, sales.join(asked, "product_id", "left_semi"),
                         panel.join(asked, "product_id", "left_semi"), days)
        made.append(ahead.join(asked, "product_id").where(F.col("step") <= F.col("days")).drop("days")
                    .withColumn("model", F.lit(kind)))
    nothing = fc.naive(sales.limit(0), 1).withColumn("model", F.lit(""))
    return fc.for_requests(requests, products, reduce(DataFrame.unionByName, made, nothing))
