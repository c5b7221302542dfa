"""Tree ensembles as flat arrays, and what can be scored with them in one pass.

All nodes of all trees stand in a few arrays, so a batch of rows walks every tree at
once. An ensemble is bounded by its trees and their leaves, not by data; Spark sends it
to the tasks once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.operators.features import FEATURES
from shelfcast.session import drop_at_exit, new_folder

LEAF = -1
#: Cells of (row, tree) that are walked together.
CELLS = 1 << 20


@dataclass
class FlatForest:
    """Prediction = base + sum over trees of weight * value of the leaf; a row goes left where x <= threshold."""

    base: float
    weights: np.ndarray
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, as node numbers (rows x trees)."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        row = np.arange(len(rows))[:, None]
        while True:
            feature = self.feature[at]
            inner = feature != LEAF
            if not inner.any():
                return at
            left = rows[row, np.maximum(feature, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)

    def contributions(self, rows: np.ndarray) -> np.ndarray:
        """What each tree adds to the prediction of each row (rows x trees)."""
        return self.value[self.leaves(rows)] * self.weights

    def _parts(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        step = max(1, CELLS // max(1, len(self.roots)))
        for first in range(0, len(rows), step):
            yield rows[first:first + step]

    def predict(self, rows: np.ndarray) -> np.ndarray:
        parts = [self.base + self.contributions(part).sum(axis=1) for part in self._parts(rows)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def staged(self, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, predictions after each tree) of parts of the rows."""
        first = 0
        for part in self._parts(rows):
            yield first, self.base + np.cumsum(self.contributions(part), axis=1)
            first += len(part)

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows with ``prediction``, like a fitted pipeline."""
        @F.pandas_udf("double")
        def scored(batch: pd.DataFrame) -> pd.Series:
            return pd.Series(self.predict(batch.to_numpy(float)))

        return rows.withColumn("prediction", scored(F.struct(*[F.col(c).cast("double").alias(c) for c in FEATURES])))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        nodes = pd.DataFrame({"node": np.arange(len(self.feature)), "feature": self.feature, "threshold": self.threshold,
                              "left": self.left, "right": self.right, "value": self.value})
        spark.createDataFrame(nodes).write.mode("overwrite").parquet(f"{path}/nodes")
        trees = pd.DataFrame({"tree": np.arange(len(self.roots)), "root": self.roots, "weight": self.weights, "base": self.base})
        spark.createDataFrame(trees, "tree int, root int, weight double, base double").write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str) -> FlatForest:
        spark = SparkSession.active()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("node").toPandas()
        trees = spark.read.parquet(f"{path}/trees").orderBy("tree").toPandas()
        return cls(float(trees["base"].iloc[0]), trees["weight"].to_numpy(), trees["root"].to_numpy(),
                   *[nodes[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")])


def flatten(model: RandomForestRegressionModel | GBTRegressionModel) -> FlatForest:
    """The fitted trees of ``pyspark.ml`` as arrays, by way of the table the model is stored as."""
    spark = SparkSession.active()
    path = new_folder(spark, "forest")
    model.write().save(path)
    drop_at_exit(spark, path)
    node = F.col("nodeData")
    table = spark.read.parquet(f"{path}/data").select(
        "treeID", node["id"].alias("id"), node["prediction"].alias("value"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"))
    nodes = table.orderBy("treeID", "id").toPandas()
    tree = nodes["treeID"].to_numpy()
    # Nodes of a tree are numbered from 0 without gaps.
    roots = np.flatnonzero(nodes["id"].to_numpy() == 0)
    start = roots[tree]
    inner = nodes["left"].to_numpy() >= 0
    weights = np.asarray(model.treeWeights, float)
    if isinstance(model, RandomForestRegressionModel):
        weights = weights / weights.sum()
    return FlatForest(0.0, weights, roots, np.where(inner, nodes["feature"].to_numpy(), LEAF),
                      np.where(inner, nodes["threshold"].to_numpy(float), 0.0),
                      np.where(inner, nodes["left"].to_numpy() + start, 0),
                      np.where(inner, nodes["right"].to_numpy() + start, 0), nodes["value"].to_numpy(float))


def staged_errors(forest: FlatForest, rows: DataFrame, label: str, part: str = "part",
                  tolerance: float = 0.2) -> DataFrame:
    """(part, epoch, n, mae, rmse, precision_pct) after each tree, for each value of the column ``part``.

    One pass scores all rounds of all parts: a task adds up what its rows say of each
    round and hands on one row per part and round. Predictions are clipped at zero like
    forecasts; precision is the share of rows within the tolerance, in percent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            parts = batch.column(0).to_pylist()
            actual = np.asarray(batch.column(1), float)
            matrix = np.column_stack([np.asarray(c, float) for c in batch.columns[2:]])
            for name in set(parts):
                mine = np.array([p == name for p in parts])
                total = sums.setdefault(name, np.zeros((4, len(forest.roots))))
                truth = actual[mine]
                for first, staged in forest.staged(matrix[mine]):
                    wanted = truth[first:first + len(staged), None]
                    gap = np.abs(np.maximum(staged, 0.0) - wanted)
                    hit = gap <= tolerance * np.abs(wanted) + 1e-9
                    total += [np.full(gap.shape[1], len(gap)), gap.sum(axis=0), (gap * gap).sum(axis=0), hit.sum(axis=0)]
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * total.shape[1], pa.string()), pa.array(np.arange(1, total.shape[1] + 1), pa.int32()),
                 *[pa.array(row) for row in total]], names=["part", "epoch", "n", "gap", "squares", "hits"])

    inputs = rows.select(F.col(part).cast("string"), F.col(label).cast("double"), *[F.col(c).cast("double") for c in FEATURES])
    sums = inputs.mapInArrow(run, "part string, epoch int, n double, gap double, squares double, hits double")
    return sums.groupBy("part", "epoch").agg(*[F.sum(c).alias(c) for c in ("n", "gap", "squares", "hits")]).select(
        "part", "epoch", F.col("n").cast("long").alias("n"), (F.col("gap") / F.col("n")).alias("mae"),
        F.sqrt(F.col("squares") / F.col("n")).alias("rmse"), (F.col("hits") * 100.0 / F.col("n")).alias("precision_pct"))
