"""Hard-negative mining by exact window searches in a GNAT-style tree.

For an anchor, the rows of its own label with the largest inner products are its
positives; the hard negatives of a positive are the rows of other labels whose scores
come close to the positive's from below. Both are searches for rows in a ring around
the anchor, which `gnat.Tree` answers: a first pass looks only at the anchor's own leaf
and gives bounds, a second looks at every other leaf that a ring still meets. Leaves are
read whole, scores are exact integers, so nothing is missed.

Rows with equal labels and vectors are folded to the few smallest ids that can ever be
answers, and anchors with equal labels and vectors are searched once, so copies cost
nothing. Leaves are dealt in parts of bounded size, whatever their rows have in common;
each task holds one part and lets the queries that visit it stream past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.gnat import Tree, as_queries, as_rows
from shelfcast.llm.tokens import in_small_batches
from shelfcast.session import materialize

#: The tree is fitted on so many rows and so many bytes of them at most.
SAMPLE_ROWS, SAMPLE_BYTES = 4096, 32 << 20
#: Rows that a leaf should hold, and the rows and bytes of one part of a leaf.
LEAF_ROWS, PART_ROWS, PART_BYTES = 4096, 8192, 32 << 20
#: Queries whose scores are worked out together.
TOGETHER = 256
#: Stands for no bound, and for an id that is null.
FAR = (1 << 63) - 1
#: Integers up to here are exact in floating point.
EXACT = float(1 << 53)


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long integers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column, label: Column) -> Column:
    """True for rows with a label and a vector of finite components only."""
    def finite(x: Column) -> Column:
        value = x.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))

    return label.isNotNull() & vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where all sums are exact there, else in integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < EXACT:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def _least_ids(rows: DataFrame, keep: int) -> DataFrame:
    """Of rows with equal label and vector the ``keep`` smallest ids; others can never be among the first."""
    nth = F.row_number().over(Window.partitionBy("label", "vector").orderBy("id"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= keep).drop("nth")


def _fit(rows: DataFrame, dim: int, largest: int, count: int, leaf_rows: int) -> Tree:
    most = max(2, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, dim))))
    sample = rows.orderBy(F.xxhash64("vector", F.lit(7)), "vector").limit(most).select("vector").toArrow()
    vectors = _matrix(sample.column(0).combine_chunks(), dim)
    return Tree.grow(as_rows(vectors, largest), count / max(1, len(vectors)), leaf_rows)


def _leaves(tree: Tree, dim: int, largest: int, column: str):
    """Adds the leaf of each row's vector, which is the last column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(batch.num_columns - 1), dim)
            leaf = tree.leaf_of(as_rows(vectors, largest))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())],
                                             names=[*batch.schema.names, column])

    return run


def _ranges(tree: Tree, dim: int, largest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple] = {}
        for batch in batches:
            for node, i, j, least, most in tree.ranges(as_rows(_matrix(batch.column(0), dim), largest)):
                low, high = best.get((node, i, j), (np.inf, -np.inf))
                best[node, i, j] = min(low, least), max(high, most)
        if best:
            keys, values = zip(*best.items())
            columns = [*zip(*keys), *zip(*values)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 3 + [pa.float64()] * 2)],
                                             names=["node", "i", "j", "low", "high"])

    return run


class Index:
    """All rows by leaf in the shared folder, the parts of each leaf, and the tree above them."""

    def __init__(self, rows: DataFrame, dim: int, largest: int, count: int, leaf_rows: int, part_rows: int):
        self.dim, self.largest = dim, largest
        self.tree = _fit(rows, dim, largest, count, leaf_rows)
        self.rows = materialize(self.with_leaf(rows.select("id", "label", "vector"), "leaf"), "gnat-rows")
        # One row per pair of split points of a node: bounded by the sample the tree was fitted on.
        ranges = self.rows.select("vector").mapInArrow(
            _ranges(self.tree, dim, largest), "node int, i int, j int, low double, high double")
        self.tree.set_ranges(tuple(r) for r in ranges.groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect())
        parts = F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts")
        self.parts = self.rows.groupBy("leaf").agg(parts)

    def with_leaf(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows, whose last column is the vector, with the number of their leaf."""
        kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
        return rows.mapInArrow(_leaves(self.tree, self.dim, self.largest, column), ", ".join([*kinds, f"{column} int"]))

    def search(self, visits: DataFrame, same_label: bool, keep: int) -> DataFrame:
        """(query, slot, score, id, own): up to ``keep`` rows of each part visited, for each window of a query.

        ``visits`` holds (leaf, query, label, vector, lows, highs). A window takes scores from
        low to high, the largest first, ties by id. ``own`` marks rows with the query's vector.
        """
        # One row per leaf, and leaves are bounded by the sample.
        parts = F.broadcast(self.parts)
        part = F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int")
        none = F.lit(None).cast("array<bigint>")
        held = self.rows.join(parts, "leaf").select("leaf", part.alias("part"), F.lit(0).alias("kind"), "id", "label",
                                                    "vector", none.alias("lows"), none.alias("highs"))
        asked = visits.join(parts, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"),
            F.col("query").alias("id"), "label", "vector", "lows", "highs")
        dealt = held.unionByName(asked).repartition("leaf", "part").sortWithinPartitions("leaf", "part", "kind", "id")
        return dealt.mapInArrow(_scan(self.dim, same_label, keep), "query long, slot int, score long, id long, own boolean")

    def other_leaves(self, queries: DataFrame) -> DataFrame:
        """Visits of the leaves that a window of a query may have rows in, without its home leaf."""
        schema = "leaf int, query long, label long, vector array<bigint>, lows array<bigint>, highs array<bigint>"
        return queries.select("query", "label", "vector", "lows", "highs", "home").mapInArrow(
            _meetings(self.tree, self.dim, self.largest), schema)


def _meetings(tree: Tree, dim: int, largest: int):
    def radius(queries: np.ndarray, bound: np.ndarray) -> np.ndarray:
        squares = (queries * queries).sum(axis=1) + largest - 2.0 * bound
        return np.sqrt(np.maximum(squares, 0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, label, vector, lows, highs, home = batch.columns
            windows = np.diff(np.asarray(lows.offsets))
            row = np.repeat(np.arange(batch.num_rows), windows)
            queries = as_queries(_matrix(vector, dim))[row]
            low, high = np.asarray(lows.flatten(), np.int64), np.asarray(highs.flatten(), np.int64)
            outer = np.where(low <= -FAR, np.inf, radius(queries, low.astype(float)))
            inner = np.where(high >= FAR, 0.0, radius(queries, high.astype(float)))
            window, leaf = tree.meeting(queries, inner, outer)
            pairs = np.unique(np.column_stack([row[window], leaf]).astype(np.int64), axis=0)
            pairs = pairs[pairs[:, 1] != np.asarray(home)[pairs[:, 0]]]
            for first in range(0, len(pairs), 4096):
                at = pa.array(pairs[first:first + 4096, 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[first:first + 4096, 1].astype(np.int32)),
                     *[c.take(at) for c in (query, label, vector, lows, highs)]],
                    names=["leaf", "query", "label", "vector", "lows", "highs"])

    return run


def _scan(dim: int, same_label: bool, keep: int):
    """Rows come sorted: for each part its held rows in order of id, then the queries."""
    names = ["query", "slot", "score", "id", "own"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def answers(block: tuple, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, vectors = block
        queries = _matrix(batch.column(5), dim)
        found = []
        for query, label, vector, value, lows, highs in zip(
                batch.column(3).to_pylist(), batch.column(4).to_pylist(), queries, scores(queries, vectors),
                batch.column(6).to_pylist(), batch.column(7).to_pylist()):
            wanted = np.flatnonzero((labels == label) == same_label)
            near = value[wanted]
            for slot, (low, high) in enumerate(zip(lows, highs)):
                at = wanted[(near >= low) & (near <= high)]
                if len(at) > keep:
                    at = at[value[at] >= np.partition(value[at], len(at) - keep)[len(at) - keep]]
                for k in at[np.argsort(-value[at], kind="stable")][:keep]:
                    own = same_label and bool((vectors[k] == vector).all())
                    found.append((query, slot, int(value[k]), int(ids[k]), own))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 5, kinds)],
                                          names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            marks = np.column_stack([np.asarray(batch.column(k), np.int64) for k in range(3)])
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for first, last in zip(cuts, cuts[1:]):
                if first == last:
                    continue
                if key != tuple(marks[first, :2]):
                    key, held, block = tuple(marks[first, :2]), [], None
                run_of = batch.slice(first, last - first)
                if marks[first, 2] == 0:
                    held.append((np.asarray(run_of.column(3)), np.asarray(run_of.column(4)), _matrix(run_of.column(5), dim)))
                    continue
                if not held:
                    continue
                if block is None:
                    block = tuple(np.concatenate(c) for c in zip(*held))
                for at in range(0, run_of.num_rows, TOGETHER):
                    yield answers(block, run_of.slice(at, TOGETHER))

    return run


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` rows of each window of a query, numbered."""
    order = Window.partitionBy("query", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep)


def _window_search(index: Index, queries: DataFrame, same_label: bool, keep: int, name: str) -> DataFrame:
    """(query, slot, nth, score, id, own): the best rows of each window (lows, highs) of (query, label, vector, home)."""
    queries = materialize(queries, f"{name}-queries")
    home = index.search(queries.withColumnRenamed("home", "leaf"), same_label, keep)
    home = materialize(_first(home, keep), f"{name}-home")
    # A window full at home needs nothing below its last row there.
    full = home.where(F.col("nth") == keep).groupBy("query").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("least"))
    bound = F.transform("lows", lambda low, slot: F.greatest(low, F.coalesce(F.try_element_at("least", slot), low)))
    narrowed = queries.join(full, "query", "left").withColumn("lows", F.when(F.col("least").isNull(), F.col("lows")).otherwise(bound))
    away = index.search(index.other_leaves(narrowed), same_label, keep)
    return _first(home.drop("nth").unionByName(away), keep)


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80,
                        high_percent: int = 100, leaf_rows: int = LEAF_ROWS, part_rows: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over (id, label, vector).

    ``id`` and ``label`` are integers, ``vector`` an array of long whose inner products fit a
    long; other columns are not read. A shorter vector counts as followed by zeros. Rows with
    a null label, a null vector or a null component take no part. An anchor's positives are
    the first ``positives`` other rows of its label by score, ties by smaller id; for each,
    the first ``negatives`` rows of other labels with low_percent * positive score <=
    100 * score <= high_percent * positive score are returned, numbered from 1. Where there
    are fewer, all are returned, and a pair without any gives no row. Rows with a repeated id
    are rows of their own; a null id comes last among ties. An empty table gives no rows.
    """
    spark, keep = rows.sparkSession, max(positives + 1, negatives)
    known = in_small_batches(rows).select(
        F.coalesce(F.col("id").cast("long"), F.lit(FAR)).alias("id"), F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<bigint>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    known = materialize(known.where(usable(F.col("vector"), F.col("label"))), "negatives-rows")
    dim = known.agg(F.max(F.size("vector"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], _RESULT)
    padded = known.withColumn("vector", F.when(F.size("vector") == dim, F.col("vector")).otherwise(
        F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("vector")))))
    folded = materialize(_least_ids(padded.drop("anchor"), keep), "negatives-folded")
    square = F.aggregate("vector", F.lit(0).cast("long"), lambda total, x: total + x * x)
    count, largest = folded.agg(F.count("*"), F.max(square)).first()
    part_rows = part_rows or max(256, min(PART_ROWS, PART_BYTES // (8 * max(1, dim))))
    index = Index(folded, dim, largest, count, leaf_rows, part_rows)

    anchors = padded.where("anchor").drop("anchor")
    distinct = anchors.select("label", "vector").distinct().select(F.monotonically_increasing_id().alias("query"), "label", "vector")
    queries = materialize(index.with_leaf(distinct, "home"), "negatives-anchors")
    window = queries.select("*", F.array(F.lit(-FAR)).alias("lows"), F.array(F.lit(FAR)).alias("highs"))
    near = _window_search(index, window, True, positives + 1, "positives")
    nearest = materialize(near.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("nth", "score", "id", "own"))).alias("near")), "negatives-positives")

    def percent(share: int, whole) -> Column:
        return whole(F.col("p").cast("decimal(20,0)") * F.lit(share) / F.lit(100).cast("decimal(3,0)")).cast("long")

    tops = nearest.select("query", F.explode(F.array_distinct(F.transform("near", lambda r: r["score"]))).alias("p"))
    bounds = tops.select("query", "p", percent(low_percent, F.ceil).alias("low"), percent(high_percent, F.floor).alias("high"))
    windows = bounds.where("low <= high").groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("p", "low", "high"))).alias("w"))
    windowed = queries.join(windows, "query").select(
        *queries.columns, F.col("w")["p"].alias("tops"), F.col("w")["low"].alias("lows"), F.col("w")["high"].alias("highs"))
    windowed = materialize(windowed, "negatives-windows")
    hard = _window_search(index, windowed.drop("tops"), False, negatives, "negatives")
    listed = hard.groupBy("query", "slot").agg(F.sort_array(F.collect_list(F.struct("nth", "score", "id"))).alias("hard"))
    by_query = listed.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("slot", "hard"))).alias("hard"))
    tables = (nearest.join(windowed.select("query", "label", "vector", "tops"), "query").join(by_query, "query"))

    # The anchor itself is left out of its positives, one row with its id and vector at most.
    near = F.col("near")
    itself = F.array_position(F.transform(near, lambda r: r["own"] & (r["id"] == F.col("id"))), True).cast("int")
    others = F.slice(F.filter(near, lambda r, i: i + 1 != itself), 1, positives)
    pairs = anchors.join(tables, ["label", "vector"]).select("id", F.explode(others).alias("positive"), "tops", "hard")
    slot = F.array_position("tops", F.col("positive")["score"]).cast("int") - 1
    result = pairs.select("id", "positive", F.explode(F.try_element_at("hard", slot)).alias("n"))

    def outward(column: Column) -> Column:
        return F.when(column != FAR, column)

    return result.select(
        outward(F.col("id")).alias("anchor_id"), outward(F.col("positive")["id"]).alias("positive_id"),
        F.col("n")["nth"].cast("int").alias("rank"), outward(F.col("n")["id"]).alias("negative_id"),
        F.col("positive")["score"].alias("positive_score"), F.col("n")["score"].alias("negative_score"))


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
