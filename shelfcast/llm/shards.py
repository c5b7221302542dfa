"""Sharding by a k-d tree over document metadata, with DataFrame operations only.

Points are groups of equal texts, so copies stay together. A node is split at the
weighted median of its bytes along its widest dimension until the leaves reach
the target. The median is found by narrowing a key range: each pass sums bytes
into at most 2^16 cells per node, with partial sums on the map side, and the
driver sees one cell per node.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.tables import literal_table
from shelfcast.session import materialize

CELL_BITS = 16
KEY_BITS = 62
HALF = 31


def _coordinate(column: Column, kind: str) -> Column:
    """A metadata value as an integer below 2^31: numbers in their order, text by hash, null as 0."""
    if kind in ("bigint", "int", "smallint", "tinyint", "double", "float"):
        scaled = F.log1p(F.greatest(column.cast("double"), F.lit(0.0))) * F.lit(float(1 << 25))
        value = F.least(F.floor(scaled), F.lit((1 << HALF) - 1))
    else:
        value = F.pmod(F.xxhash64(column.cast("string")), F.lit(1 << HALF))
    return F.coalesce(value.cast("long"), F.lit(0).cast("long"))


def text_groups(df: DataFrame, text_col: str, dimensions: list[str]) -> DataFrame:
    """One row per distinct text: 128-bit key, bytes, and the coordinates of its metadata."""
    kinds = dict(df.dtypes)
    coordinates = [F.min(_coordinate(F.col(c), kinds[c])).alias(f"x{i}") for i, c in enumerate(dimensions)]
    return (df.groupBy(*_text_key(F.col(text_col)))
            .agg(F.sum(_size(F.col(text_col))).alias("bytes"), *coordinates, _coordinate(F.max(_size(F.col(text_col))), "int")
                 .alias(f"x{len(dimensions)}"))
            .withColumn("tie", F.pmod(F.col("k1"), F.lit(1 << HALF))))


def _size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("group"), text, text.isNull()).alias("k2")]


def _key(dims: list[str], dim: Column) -> Column:
    """Total order along a dimension: ties go by the hash of the text."""
    return F.get(F.array(*[F.col(d) for d in dims]), dim) * F.lit(1 << HALF) + F.col("tie")


def _node_table(points: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A table of the tree's open nodes; it has at most as many rows as there are shards."""
    return F.broadcast(literal_table(points.sparkSession, rows, schema))


def _split(points: DataFrame, leaves: dict[int, int], dims: list[str], tolerance: float) -> dict[int, tuple[int, int]]:
    """For each open node the number of its dimension and its cut: keys up to the cut go left."""
    extent = points.agg(*[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]).first()
    spans = [max(1, (extent[f"hi_{d}"] or 0) - (extent[f"lo_{d}"] or 0)) for d in dims]
    todo = _node_table(points, [(n,) for n, k in leaves.items() if k > 1], "node long")
    stats = points.join(todo, "node").groupBy("node").agg(
        F.sum("bytes").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in dims]).collect()
    state = {}
    for row in stats:
        widest = max(range(len(dims)), key=lambda i: (row[dims[i]] / spans[i], -i))
        left = leaves[row["node"]] // 2
        state[row["node"]] = {"dim": widest, "low": 0, "bits": KEY_BITS, "before": 0, "cut": None,
                              "want": row["bytes"] * left / leaves[row["node"]], "slack": tolerance * row["bytes"]}
    while todo := {n: s for n, s in state.items() if s["cut"] is None}:
        table = _node_table(points, [
            (n, s["dim"], s["low"], max(s["bits"] - CELL_BITS, 0), 1 << s["bits"], float(s["want"] - s["before"]))
            for n, s in todo.items()], "node long, dim int, low long, shift int, width long, want double")
        cells = (points.join(table, "node").withColumn("at", _key(dims, F.col("dim")) - F.col("low"))
                 .where((F.col("at") >= 0) & (F.col("at") < F.col("width")))
                 .groupBy("node", "want", F.expr("shiftright(at, shift)").alias("cell")).agg(F.sum("bytes").alias("bytes")))
        crossing = (cells.withColumn("upto", F.sum("bytes").over(Window.partitionBy("node").orderBy("cell")))
                    .where(F.col("upto") >= F.col("want"))
                    .groupBy("node").agg(F.min(F.struct("cell", "bytes", "upto")).alias("at")).collect())
        found = {r["node"]: r["at"] for r in crossing}
        for node, s in todo.items():
            at, step = found.get(node), max(s["bits"] - CELL_BITS, 0)
            if at is None:
                s["cut"] = s["low"] + (1 << s["bits"]) - 1
                continue
            edge = s["low"] + (at["cell"] << step)
            over, under = s["before"] + at["upto"] - s["want"], s["want"] - (s["before"] + at["upto"] - at["bytes"])
            if step == 0 or min(over, under) <= s["slack"]:
                s["cut"] = edge + (1 << step) - 1 if over <= under else edge - 1
            else:
                s |= {"low": edge, "bits": step, "before": s["before"] + at["upto"] - at["bytes"]}
    return {n: (s["dim"], s["cut"]) for n, s in state.items()}


def kd_shards(df: DataFrame, text_col: str = "text", dimensions: list[str] | None = None, shards: int | None = None,
              target_bytes: int = 512 << 20, tolerance: float = 2e-4) -> DataFrame:
    """The rows of ``df`` with shard_size and shard.

    ``shards`` leaves, or as many as ``target_bytes`` asks for. The size of a row is
    its UTF-8 bytes (0 for null) plus 1. Shard sizes differ from an equal share by
    the tolerance of each split and by the groups of equal texts on the edges, which
    are never divided. Dimensions may hold nulls, and names missing in ``df`` are left
    out. An empty table gives no rows. Columns named shard_size or shard are replaced.
    """
    base = df.drop("shard_size", "shard")
    dimensions = [c for c in (dimensions or []) if c in base.columns]
    points = materialize(text_groups(base, text_col, dimensions).withColumn("node", F.lit(1).cast("long")), "shard-points")
    dims = [c for c in points.columns if c.startswith("x")]
    if shards is None:
        shards = max(1, math.ceil((points.agg(F.sum("bytes")).first()[0] or 0) / target_bytes))
    leaves = {1: shards}
    while any(k > 1 for k in leaves.values()):
        cuts = _split(points, leaves, dims, tolerance)
        grown = {n: k for n, k in leaves.items() if k == 1}
        for n, k in leaves.items():
            if k > 1:
                grown |= {2 * n: k // 2, 2 * n + 1: k - k // 2}
        table = _node_table(points, [(n, dim, cut) for n, (dim, cut) in cuts.items()], "node long, dim int, cut long")
        right = F.when(_key(dims, F.col("dim")) > F.col("cut"), F.lit(1)).otherwise(F.lit(0))
        child = F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.col("node") * 2 + right)
        points = materialize(points.join(table, "node", "left").withColumn("node", child).drop("dim", "cut"), "shard-points")
        leaves = grown
    order = sorted(leaves, key=lambda n: n / (1 << n.bit_length()))
    numbers = _node_table(points, [(n, i) for i, n in enumerate(order)], "node long, shard int")
    placed = points.join(numbers, "node").select(
        F.col("k1").alias("_group_1"), F.col("k2").alias("_group_2"), "shard")
    first, second = _text_key(F.col(text_col))
    keyed = base.select("*", _size(F.col(text_col)).alias("shard_size"), first.alias("_group_1"), second.alias("_group_2"))
    return keyed.join(placed, ["_group_1", "_group_2"]).drop("_group_1", "_group_2")


def with_slots(df: DataFrame, order: list[str], shard_col: str = "shard", lanes: int = 256) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps, in lanes that are numbered in parallel."""
    lane = F.pmod(F.xxhash64(*order), F.lit(lanes)).cast("int")
    laned = df.drop("slot").withColumn("_lane", lane)
    counts = laned.groupBy(F.col(shard_col).alias("_of_shard"), F.col("_lane").alias("_of_lane")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_of_shard").orderBy("_of_lane").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_of_shard", "_of_lane", before.alias("_before"))
    number = F.row_number().over(Window.partitionBy(shard_col, "_lane").orderBy(*order)) - 1
    return (laned.withColumn("_number", number)
            .join(offsets, (F.col(shard_col) == F.col("_of_shard")) & (F.col("_lane") == F.col("_of_lane")))
            .withColumn("slot", (F.col("_number") + F.col("_before")).cast("long"))
            .drop("_lane", "_number", "_before", "_of_shard", "_of_lane"))
