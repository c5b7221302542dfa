"""Second-order gradient boosting on binned features, grown leaf by leaf or level by level.

The rows are binned once and kept as packed blocks; a tree keeps the gradients of the
rows that it sees, so trees before it are walked once and not in each of its jobs. A job adds up gradients and
Hessians per (leaf, feature, bin) of all leaves that may be split next: tasks sum their
own blocks, a shuffle brings the sums of a leaf and feature together, and there the best
cut is found. The driver sees one row per leaf and feature, whatever the bins, the tasks
or the data, and chooses the splits.

Best-first growth splits the leaf of largest gain until the leaves are used up. To know
the gains below a split its children must have been summed, so each job sums the
children of every leaf that best-first choice would take if the unknown ones were worth
nothing; what is summed in vain is not split. A tree takes about as many jobs as levels.

Gradients are summed as scaled integers, so the trees do not depend on the order of
partial sums.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.features import FEATURES
from shelfcast.operators.forests import LEAF, FlatForest
from shelfcast.session import materialize

#: Trees that blocks are behind before their predictions are written anew.
BEHIND = 8
#: Rows that a task should hold, in blocks of an Arrow batch.
TASK_ROWS = 65_536
#: Sums of a leaf and feature by one task (512 numbers) that a task adds up when they meet.
FEW_PARTS = 1024
#: Rows that are summed at once, and the bit from which their count stands above the sum of 20 bits each.
COUNTED, COUNT_BIT = 1 << 16, 36
_BLOCK = "n int, bins binary, labels binary, keys binary, scores binary"
_SPLIT = "slot int, feature int, gain double, cut int, left_g long, left_n long, all_g long, all_n long"
_SPLIT_NAMES = [column.split()[0] for column in _SPLIT.split(", ")]
_STEP, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(11)


@dataclass
class Settings:
    """How trees grow. ``leaves`` or ``depth`` limits them, ``penalty`` is added to each Hessian sum."""

    rounds: int = 30
    step: float = 0.3
    leaves: int = 31
    depth: int | None = None
    penalty: float = 0.0
    min_rows: int = 20
    rows_share: float = 1.0
    columns_share: float = 1.0
    bins: int = 255
    seed: int = 42


@dataclass
class Tree:
    """A tree on bins under construction: inner nodes split at bin <= cut."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        first = len(self.feature)
        for _ in range(2):
            for column, empty in ((self.feature, LEAF), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                column.append(empty)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, first, first + 1
        return first, first + 1


@dataclass
class Split:
    """The best split of a node, and [gradients, rows] left of it and in the whole node."""

    gain: float
    feature: int
    cut: int
    left: np.ndarray
    total: np.ndarray


def forest_of(trees: list[Tree], base: float, step: float, cuts: list[np.ndarray] | None = None) -> FlatForest:
    """The trees as arrays, on bins or, with ``cuts``, on the values of the features."""
    sizes = [len(t.feature) for t in trees]
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int) if trees else np.zeros(0, int)
    join = lambda name: np.array([v for t in trees for v in getattr(t, name)])
    offset = np.repeat(roots, sizes) if trees else 0
    feature, cut = join("feature").astype(int), join("cut").astype(int)
    threshold = cut.astype(float)
    if cuts is not None:
        threshold = np.array([cuts[f][c] if f != LEAF else 0.0 for f, c in zip(feature, cut)])
    return FlatForest(base, np.full(len(trees), step), roots, feature, threshold, join("left").astype(int) + offset,
                      join("right").astype(int) + offset, join("value").astype(float))


def quantile_cuts(rows: DataFrame, bins: int, columns: list[str]) -> list[np.ndarray]:
    """Upper ends of at most ``bins`` bins per feature, at even shares of the rows. Every row has the
    Hessian 1 under squared loss, so these are the weighted quantiles too."""
    shares = ", ".join(repr((k + 1) / bins) for k in range(bins - 1))
    found = rows.agg(*[F.expr(f"percentile_approx(cast(`{c}` as double), array({shares}), {20 * bins})").alias(c)
                       for c in columns]).first()
    return [np.unique(np.array(found[c], float)) for c in columns]


def _pack(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = [np.searchsorted(c, np.asarray(x, float)).astype(np.uint8) for c, x in zip(cuts, batch.columns[2:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int32()),
                 *[pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (
                     np.array(bins), np.asarray(batch.column(1), float), np.asarray(batch.column(0)),
                     np.zeros(batch.num_rows))]], names=["n", "bins", "labels", "keys", "scores"])

    return run


class Blocks:
    """The training rows as packed blocks, with the predictions of all but the last few trees."""

    def __init__(self, train: DataFrame, label: str, key: list[str], settings: Settings, columns: list[str]):
        self.columns = len(columns)
        count, low, high, mean = train.agg(F.count("*"), F.min(label), F.max(label), F.avg(label)).first()
        if not count:
            raise ValueError("there are no rows to fit")
        self.base = float(mean)
        self.cuts = quantile_cuts(train, settings.bins, columns)
        # Every sum of gradients fits 62 bits.
        widest = max(float(high) - float(low), 1e-9) * 4.0 * count
        self.scale = 2.0 ** min(40, int(np.floor(62 - np.log2(widest))))
        self.parts = max(1, -(-count // TASK_ROWS), min(train.sparkSession.sparkContext.defaultParallelism, count // 16_384))
        rows = train.select(F.xxhash64(*key).alias("row_key"), F.col(label).cast("double").alias("label"),
                            *[F.col(c).cast("double").alias(c) for c in columns]).repartition(self.parts, "row_key")
        self.table = self._keep(rows.mapInArrow(_pack(self.cuts), _BLOCK))

    def _keep(self, table: DataFrame) -> DataFrame:
        return materialize(table, "boosting-blocks").persist()

    def catch_up(self, trees: list[Tree], step: float) -> None:
        """Adds the trees to the stored predictions."""
        behind, columns, before = forest_of(trees, 0.0, step), self.columns, self.table

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.to_pylist():
                    bins = np.frombuffer(block["bins"], np.uint8).reshape(columns, block["n"])
                    block["scores"] = (np.frombuffer(block["scores"]) + behind.predict(bins.T)).tobytes()
                    yield pa.RecordBatch.from_pylist([block], batch.schema)

        self.table = self._keep(before.mapInArrow(run, _BLOCK))
        self.table.count()
        before.unpersist()

    def seen_by(self, behind: list[Tree], number: int, settings: Settings) -> DataFrame:
        """The bins of the rows that a tree may see and their scaled gradients, for all jobs of that tree.

        Filled by the first of them; the caller unpersists it.
        """
        recent = forest_of(behind, self.base, settings.step)
        columns, scale, share = self.columns, self.scale, settings.rows_share
        salt = np.uint64((settings.seed * 1_000_003 + number) & 0xFFFFFFFF)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in batch.to_pylist():
                    bins = np.frombuffer(block["bins"], np.uint8).reshape(columns, block["n"])
                    scores, labels = np.frombuffer(block["scores"]), np.frombuffer(block["labels"])
                    if share < 1:
                        seen = drawn(np.frombuffer(block["keys"], np.int64), salt, share)
                        bins, scores, labels = bins[:, seen], scores[seen], labels[seen]
                    # Squared loss: the gradient is prediction minus label, the Hessian is 1.
                    gradients = np.rint((scores + recent.predict(bins.T) - labels) * scale)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(labels)], pa.int32()), pa.array([np.ascontiguousarray(bins).tobytes()], pa.binary()),
                         pa.array([gradients.tobytes()], pa.binary())], names=["n", "bins", "gradients"])

        return self.table.mapInArrow(run, "n int, bins binary, gradients binary").persist()

    def splits(self, seen: DataFrame, tree: Tree, nodes: list[int], settings: Settings, features: np.ndarray) -> dict[int, Split]:
        """The best split of each node over the rows of ``seen_by``."""
        current = forest_of([tree], 0.0, 1.0)
        slot = np.full(len(tree.feature), -1)
        slot[nodes] = np.arange(len(nodes))
        columns, scale = self.columns, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(nodes), columns, 2, 256), np.int64)
            size = len(nodes) * 256
            for batch in batches:
                for block in batch.to_pylist():
                    every = np.frombuffer(block["bins"], np.uint8).reshape(columns, block["n"])
                    for first in range(0, block["n"], COUNTED):
                        bins = every[:, first:first + COUNTED]
                        at = slot[current.leaves(bins.T)[:, 0]]
                        mine = at >= 0
                        at, part = at[mine] * 256, bins[:, mine]
                        gradients = np.frombuffer(block["gradients"])[first:first + COUNTED][mine]
                        # Two halves, so that sums in floating point are exact; the lower one counts the rows above its bits.
                        high, low = np.divmod(gradients, float(1 << 20))
                        low += float(1 << COUNT_BIT)
                        for f in features:
                            cell = at + part[f]
                            lower = np.bincount(cell, low, size).astype(np.int64).reshape(-1, 256)
                            total[:, f, 0] += np.bincount(cell, high, size).astype(np.int64).reshape(-1, 256) << 20
                            total[:, f, 0] += lower & ((1 << COUNT_BIT) - 1)
                            total[:, f, 1] += lower >> COUNT_BIT
            used = np.argwhere(total[:, :, 1].any(axis=-1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used[:, 0].astype(np.int32)), pa.array(used[:, 1].astype(np.int32)),
                 pa.array([total[node, f].tobytes() for node, f in used], pa.binary())], names=["slot", "feature", "sums"])

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            met: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for k, f, sums in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    part = np.frombuffer(sums, np.int64).reshape(2, 256)
                    met[k, f] = met[k, f] + part if (k, f) in met else part
            keys, sums = np.array(list(met), np.int32).reshape(-1, 2), np.array(list(met.values()), np.int64).reshape(-1, 2, 256)
            gain = gains(sums[:, 0] / scale, sums[:, 1].astype(float), settings.penalty, settings.min_rows)
            most = gain.max(axis=1, initial=0.0)
            cut = np.argmax(gain > most[:, None] * (1 - 1e-12), axis=1)
            upto, whole = np.cumsum(sums, axis=2)[np.arange(len(cut)), :, cut], sums.sum(axis=2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.where(most > 1e-9, most, 0.0)), pa.array(cut.astype(np.int32)),
                 *[pa.array(side[:, i]) for side in (upto, whole) for i in (0, 1)]], names=_SPLIT_NAMES)

        sums = seen.mapInArrow(run, "slot int, feature int, sums binary")
        if self.parts > 1:
            most = self.parts * len(nodes) * len(features)
            sums = sums.repartition(max(1, min(self.parts, most // max(1, FEW_PARTS))), "slot", "feature")
        rows = sums.mapInArrow(choose, _SPLIT).toArrow().to_pylist()
        found: dict[int, list[dict]] = {}
        for row in sorted(rows, key=lambda r: r["feature"]):
            found.setdefault(row["slot"], []).append(row)
        return {node: self._first_best(found.get(k, [])) for k, node in enumerate(nodes)}

    def _first_best(self, rows: list[dict]) -> Split:
        """The largest gain of a node's features; ties take the smallest feature."""
        most = max((r["gain"] for r in rows), default=0.0)
        row = next((r for r in rows if r["gain"] > most * (1 - 1e-12)), None)
        total = lambda r, side: np.array([r[f"{side}_g"] / self.scale, float(r[f"{side}_n"])])
        if row is None:
            return Split(0.0, -1, -1, np.zeros(2), total(rows[0], "all") if rows else np.zeros(2))
        return Split(row["gain"], row["feature"], row["cut"], total(row, "left"), total(row, "all"))

    def close(self) -> None:
        self.table.unpersist()


def drawn(keys: np.ndarray, salt: np.uint64, share: float) -> np.ndarray:
    """The rows whose hash with the salt falls under the share; the same rows whenever asked."""
    with np.errstate(over="ignore"):
        mixed = (keys.view(np.uint64) ^ salt) * _STEP
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return (mixed >> _SHIFT).astype(float) / float(1 << 53) < share


def gains(gradients: np.ndarray, rows: np.ndarray, penalty: float, min_rows: int) -> np.ndarray:
    """The gain of a cut after each bin, 0 where a side has too few rows; both arrays are (features, bins)."""
    g, h = np.cumsum(gradients, axis=1), np.cumsum(rows, axis=1)
    all_g, all_h = g[:, -1:], h[:, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (h + penalty) + (all_g - g) ** 2 / (all_h - h + penalty) - all_g * all_g / (all_h + penalty)
    return np.where((h >= min_rows) & (all_h - h >= min_rows), gain, 0.0)


def best_split(sums: np.ndarray, features: np.ndarray, penalty: float, min_rows: int) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split of a node; (0, -1, -1) if none gains.

    The gain is G_l^2 / (H_l + penalty) + G_r^2 / (H_r + penalty) - G^2 / (H + penalty); ties take the
    smallest feature and bin.
    """
    gain = gains(sums[features, :, 0], sums[features, :, 1], penalty, min_rows)
    at = int(np.argmax(gain > gain.max() * (1 - 1e-12)))
    if not gain.max() > 1e-9:
        return 0.0, -1, -1
    row, cut = divmod(at, gain.shape[1])
    return float(gain[row, cut]), int(features[row]), int(cut)


class _Growth:
    """One tree: the nodes whose best splits are known, and the best-first choice among them."""

    def __init__(self, blocks: Blocks, behind: list[Tree], number: int, settings: Settings):
        self.blocks, self.settings = blocks, settings
        self.seen = blocks.seen_by(behind, number, settings)
        rng = np.random.default_rng([settings.seed, number])
        take = max(1, int(round(settings.columns_share * blocks.columns)))
        self.features = np.sort(rng.permutation(blocks.columns)[:take])
        self.tree = Tree()
        self.depth = {0: 0}
        self.total: dict[int, np.ndarray] = {}
        self.best: dict[int, Split] = {}

    def _learn(self, nodes: list[int]) -> None:
        """Finds the best splits of the given nodes by one job."""
        self.best.update(self.blocks.splits(self.seen, self.tree, nodes, self.settings, self.features))
        if 0 in nodes:
            self.total[0] = self.best[0].total

    def _children(self, node: int) -> None:
        best = self.best[node]
        left, right = self.tree.split(node, best.feature, best.cut)
        for child, total in ((left, best.left), (right, best.total - best.left)):
            self.depth[child], self.total[child] = self.depth[node] + 1, total

    def _choose(self) -> tuple[list[int], list[int]]:
        """The nodes that best-first choice splits, and the children it would have to know next."""
        limit = self.settings
        open_nodes, split, unknown = [(-self.best[0].gain, 0)], [], []
        while open_nodes and len(split) + 1 < limit.leaves:
            gain, node = heapq.heappop(open_nodes)
            if gain == 0:
                break
            split.append(node)
            if self.tree.feature[node] == LEAF:
                self._children(node)
            if limit.depth is not None and self.depth[node] + 1 >= limit.depth:
                continue
            for child in (self.tree.left[node], self.tree.right[node]):
                if child in self.best:
                    heapq.heappush(open_nodes, (-self.best[child].gain, child))
                elif self.total[child][1] >= 2 * limit.min_rows:
                    unknown.append(child)
        return split, unknown if len(split) + 1 < limit.leaves or unknown else []

    def run(self) -> Tree:
        try:
            self._learn([0])
            while True:
                split, unknown = self._choose()
                if not unknown:
                    return self._pruned(set(split))
                self._learn(sorted(unknown))
        finally:
            self.seen.unpersist()

    def _pruned(self, split: set[int]) -> Tree:
        """The tree with the chosen splits only, and the values of its leaves."""
        out, todo = Tree(), [(0, 0)]
        while todo:
            node, place = todo.pop()
            if node in split:
                children = out.split(place, self.tree.feature[node], self.tree.cut[node])
                todo += zip((self.tree.left[node], self.tree.right[node]), children)
            else:
                g, h = self.total[node]
                out.value[place] = float(-g / (h + self.settings.penalty)) if h + self.settings.penalty else 0.0
        return out


def fit_boosting(train: DataFrame, label: str, settings: Settings, key: tuple[str, ...] = ("product_id", "date"),
                 columns: list[str] = FEATURES) -> FlatForest:
    """A boosted ensemble for the squared loss of ``label``, starting from its mean.

    ``key`` names the columns whose hash decides which trees see a row. Rows must have no
    null features.
    """
    blocks, trees, done = Blocks(train, label, list(key), settings, columns), [], 0
    try:
        for number in range(settings.rounds):
            trees.append(_Growth(blocks, trees[done:], number, settings).run())
            if len(trees) - done >= BEHIND and number + 1 < settings.rounds:
                blocks.catch_up(trees[done:], settings.step)
                done = len(trees)
    finally:
        blocks.close()
    return forest_of(trees, blocks.base, settings.step, blocks.cuts)
