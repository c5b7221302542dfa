"""Epsilon-insensitive regression on given features, by subgradients summed over packed blocks.

Rows inside the tube around the line cost nothing and pull at nothing; rows outside pull
with a constant force, whatever their distance. The line starts at the ridge solution,
whose normal equations take one pass; each round then takes one pass that sums the
subgradient, turned by the inverse of the same normal equations. The best line met is
kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.session import materialize

_BLOCK = "n int, inputs binary, labels binary"


def pack(rows: DataFrame, columns: list[str], label: str, inputs: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Blocks of rows as matrices of ``inputs`` of the columns, with a last input of 1 for the intercept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = inputs(np.column_stack([np.asarray(c, float) for c in batch.columns[1:]]))
            matrix = np.column_stack([matrix, np.ones(batch.num_rows)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int32()), *[pa.array([np.ascontiguousarray(a, float).tobytes()], pa.binary())
                                                           for a in (matrix, np.asarray(batch.column(0), float))]],
                names=["n", "inputs", "labels"])

    source = rows.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in columns])
    return materialize(source.mapInArrow(run, _BLOCK), "tube-blocks")


def block_sums(blocks: DataFrame, size: int, sums: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``size`` numbers that each block gives; tasks add up first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for block in batch.to_pylist():
                total += sums(np.frombuffer(block["inputs"]).reshape(block["n"], -1), np.frombuffer(block["labels"]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["k", "v"])

    rows = blocks.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[np.asarray(rows.column("k"))] = np.asarray(rows.column("v"))
    return out


def tube_sums(weights: np.ndarray, epsilon: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Per block: the loss beyond the tube, the rows outside, and the subgradient of each weight."""
    def sums(inputs: np.ndarray, labels: np.ndarray) -> np.ndarray:
        gap = inputs @ weights - labels
        outside = np.abs(gap) > epsilon
        pull = np.where(outside, np.sign(gap), 0.0)
        return np.concatenate([[(np.abs(gap) - epsilon)[outside].sum(), outside.sum()], pull @ inputs])

    return sums


def fit_tube(blocks: DataFrame, inputs: int, cost: float = 1.0, epsilon: float = 0.1, rounds: int = 30,
             ridge: float = 1e-3, start: np.ndarray | None = None) -> tuple[np.ndarray, list[float]]:
    """(weights with the intercept last, objective after each round).

    The objective is |weights|^2 / 2 + cost * sum of max(0, |miss| - epsilon); the
    intercept is not penalised.
    """
    size = inputs + 1
    normal = block_sums(blocks, 2 + size + size * size, lambda x, y: np.concatenate(
        [[len(y), np.abs(y).sum()], y @ x, (x.T @ x).ravel()]))
    count, right = max(normal[0], 1.0), normal[2:2 + size] / max(normal[0], 1.0)
    free = np.append(np.ones(inputs), 0.0)
    gram = normal[2 + size:].reshape(size, size) / count + np.diag(ridge * free + 1e-12)
    turned = np.linalg.inv(gram)
    weights = turned @ right if start is None else np.asarray(start, float)
    best, history, step = (np.inf, weights), [], None
    for number in range(rounds + 1):
        sums = block_sums(blocks, 2 + size, tube_sums(weights, epsilon))
        objective = 0.5 * float(free @ (weights * weights)) + cost * sums[0]
        history.append(objective)
        if objective < best[0]:
            best = (objective, weights)
        if sums[1] == 0:  # every row is inside the tube
            break
        # A row outside moves the line by about the mean miss at first, by less and less later.
        step = step if step is not None else sums[0] / count
        slope = (free * weights / cost + sums[2:]) / count
        weights = weights - step / np.sqrt(number + 1.0) * (turned @ slope)
    return best[1], history
