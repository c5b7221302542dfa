"""Demand models on the 25 features: linear, forests, boosters, a kernel machine."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.operators import tube
from shelfcast.operators.boosting import Settings, fit_boosting
from shelfcast.operators.features import FEATURES
from shelfcast.operators.forecast import at_least_zero
from shelfcast.operators.forests import FlatForest, flatten

LABEL = "units_sold"
SEED = 42
FOURIER_FEATURES = 50


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def regressor(model: str, **overrides):
    """The estimator behind a model name with its standard settings, which ``overrides`` tune.

    Trees are limited in depth, as the driver holds all nodes.
    """
    common = dict(featuresCol="features", labelCol=LABEL)
    settings = {
        "Linear Regression": (LinearRegression, dict(regParam=0.0, solver="normal")),
        "Random Forest": (RandomForestRegressor, dict(numTrees=100, maxDepth=12, seed=SEED)),
    }
    estimator, values = settings[model]
    return estimator(**common, **{**values, **overrides})


#: Plain level-wise growth of depth 5; leaf-wise growth with 31 leaves; level-wise growth of depth 6 with a
#: penalty on leaf weights and 90 % of the rows and of the features per tree. 30 rounds at step size 0.3 have the
#: total shrinkage of 300 at 0.03: each round is a chain of jobs, so rounds cost time whatever the cluster.
BOOSTERS = {
    "Gradient Boosting": Settings(leaves=32, depth=5, min_rows=1),
    "LightGBM": Settings(leaves=31, min_rows=20),
    "XGBoost": Settings(leaves=64, depth=6, penalty=1.0, min_rows=1, rows_share=0.9, columns_share=0.9),
}


def fit(model: str, train: DataFrame, **overrides) -> PipelineModel | FourierRegression | FlatForest:
    """Assemble the features and fit. The training rows are read once per tree level,
    so they are kept while fitting and released after."""
    if model == "Support Vector (RBF)":
        return fit_rbf(train, **overrides)
    if model in BOOSTERS:
        return fit_boosting(train, LABEL, replace(BOOSTERS[model], **overrides))
    # With its name in the plan, a model fitted beside others keeps rows of its own and releases no other's.
    rows = train.select(*FEATURES, LABEL, F.lit(model).alias("fitted_for")).persist()
    try:
        return Pipeline(stages=[assembler(), regressor(model, **overrides)]).fit(rows)
    finally:
        rows.unpersist()


class FourierRegression:
    """A fitted line on random Fourier features; scores like any fitted pipeline."""

    def __init__(self, weights: np.ndarray, offsets: np.ndarray, line: np.ndarray):
        self.weights, self.offsets, self.line = weights, offsets, line

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return fourier(rows, self.weights, self.offsets) @ self.line[:-1] + self.line[-1]

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", score_with(self, rows))


def fourier(rows: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.cos(rows @ weights.T + offsets)


def fit_rbf(train: DataFrame, components: int = FOURIER_FEATURES, **overrides) -> FourierRegression:
    """Support-vector regression on random Fourier features of an RBF kernel: cost 1, tube of 0.1.

    The kernel width is 1 / (inputs * variance over all inputs), as for a kernel
    machine on unscaled inputs.
    """
    means = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in FEATURES],
                      *[F.var_pop(F.col(c).cast("double")).alias(f"var_{c}") for c in FEATURES]).first()
    centres = np.array([means[c] for c in FEATURES])
    variance = float(np.mean([means[f"var_{c}"] for c in FEATURES]) + centres.var())
    rng = np.random.default_rng(SEED)
    weights = rng.normal(0.0, np.sqrt(2.0 / (len(FEATURES) * variance)), (components, len(FEATURES)))
    offsets = rng.uniform(0.0, 2 * np.pi, components)
    blocks = tube.pack(train, FEATURES, LABEL, lambda rows: fourier(rows, weights, offsets)).persist()
    try:
        line, _ = tube.fit_tube(blocks, components, **overrides)
    finally:
        blocks.unpersist()
    return FourierRegression(weights, offsets, line)


def fit_all(names: list[str], train: DataFrame) -> dict[str, PipelineModel | FourierRegression | FlatForest]:
    """The named models, fitted side by side: each is a chain of short jobs, and chains fill the
    gaps that others leave."""
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fit), name, train) for name in names}
        return {name: job.result() for name, job in jobs.items()}


def flat(model: PipelineModel | FourierRegression | FlatForest):
    """The model as an object with ``predict(matrix)``."""
    if not isinstance(model, PipelineModel):
        return model
    last = model.stages[-1]
    return LinearScore(last.coefficients.toArray(), float(last.intercept)) if isinstance(
        last, LinearRegressionModel) else flatten(last)


@dataclass
class LinearScore:
    weights: np.ndarray
    intercept: float

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights + self.intercept


def predict(model: PipelineModel | FourierRegression | FlatForest, features: DataFrame) -> DataFrame:
    """Clipped predictions next to the actual units."""
    return model.transform(features).select(
        "product_id", F.col("date").alias("forecast_date"),
        F.col(LABEL).cast("double").alias("actual"), at_least_zero("prediction").alias("predicted_units"))


def coefficients(model: PipelineModel) -> tuple[dict[str, float], float]:
    line = model.stages[-1]
    return dict(zip(FEATURES, map(float, line.coefficients))), float(line.intercept)


def save(model: PipelineModel | FourierRegression | FlatForest | DataFrame, path: str) -> None:
    """Store a fitted model of any kind in a shared folder.

    Seasonal and sequence models are tables of states, one row per product.
    """
    if isinstance(model, DataFrame):
        model.write.mode("overwrite").parquet(f"{path}/states")
    elif isinstance(model, FlatForest):
        model.save(path)
    elif isinstance(model, FourierRegression):
        # The intercept is the line's last weight and has no feature.
        rows = [(i, weights.tolist(), float(offset), float(line)) for i, (weights, offset, line) in enumerate(
            zip([*model.weights, np.zeros(0)], [*model.offsets, 0.0], model.line))]
        SparkSession.active().createDataFrame(rows, "i int, weights array<double>, offset double, line double").write.mode(
            "overwrite").parquet(f"{path}/fourier")
    else:
        model.write().overwrite().save(path)


def load(path: str, model: str) -> PipelineModel | FourierRegression | FlatForest | DataFrame:
    """The stored model of that name."""
    spark = SparkSession.active()
    if model in ("Seasonal Baseline (Holt-Winters)", "LSTM (PyTorch)"):
        return spark.read.parquet(f"{path}/states")
    if model in BOOSTERS:
        return FlatForest.load(path)
    if model == "Support Vector (RBF)":
        rows = spark.read.parquet(f"{path}/fourier").orderBy("i").collect()
        return FourierRegression(np.array([r["weights"] for r in rows[:-1]]), np.array([r["offset"] for r in rows[:-1]]),
                                 np.array([r["line"] for r in rows]))
    return PipelineModel.load(path)


def score_with(predictor, features: DataFrame, columns: list[str] = FEATURES) -> Column:
    """Predictions of any object with ``predict(matrix)``, in Arrow batches."""
    @F.pandas_udf("double")
    def scored(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(np.asarray(predictor.predict(batch[columns].to_numpy(float)), dtype=float))

    return scored(F.struct(*[F.col(c).cast("double").alias(c) for c in columns]))


def fit_per_product(sales: DataFrame, fit_one, schema: str) -> DataFrame:
    """Fit one model per product; a product's rows are bounded by the calendar.

    ``fit_one`` takes the product's rows in date order and returns one row.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return fit_one(rows.sort_values("date"))

    return sales.groupBy("product_id").applyInPandas(run, schema)
