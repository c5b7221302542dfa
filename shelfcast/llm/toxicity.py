"""Toxicity by weak supervision.

Voters are words (lexicon), word beginnings or endings and, in scripts without spaces,
short runs of characters (patterns) that labelled training texts single out; the given
label is one more, fallible voter. A generative model with a hidden class estimates how
often each voter fires in either class, how voters repeat each other and how far the
labels can be trusted. A linear classifier learns the posterior labels and scores all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.tokens import in_small_batches
from shelfcast.session import materialize

WORDS = re.compile(r"[^\W\d_]+")
#: Runs of scripts without spaces: Thai and Lao, Burmese, Khmer, Japanese, Chinese.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff]+")
#: Lengths of word beginnings and endings that may become voters.
BEGINNINGS, ENDINGS = (3, 4, 5, 6), (4, 5)
#: Labelled rows that the fit reads; toxic texts, log odds and divergence from the base rate that a voter needs.
SAMPLE_ROWS, LEAST_TEXTS, LEAST_ODDS, LEAST_DIVERGENCE = 20_000, 4, 3.0, 6.0
#: Words without a vote that a task keeps in mind.
REMEMBERED = 1 << 19


def character_runs(text: str) -> set[str]:
    """The runs of two and three characters of the parts in scripts without spaces."""
    if text.isascii():
        return set()
    found = set()
    for part in set(UNSPACED.findall(text)):
        pairs = list(map(add, part, part[1:]))
        found.update(pairs, map(add, pairs, part[2:]))
    return found


def marks_of(word: str) -> tuple[str, ...]:
    """A word, its beginnings and its endings."""
    return ("=" + word, *("<" + word[:n] for n in BEGINNINGS if len(word) > n), *(">" + word[-n:] for n in ENDINGS if len(word) > n))


def evidence(text: str | None) -> set[str]:
    """What can vote on a text: its words, their beginnings and endings, and its character runs."""
    if not text:
        return set()
    found = set(chain.from_iterable(map(marks_of, set(WORDS.findall(text.lower())))))
    found.update("~" + run for run in character_runs(text))
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold each piece of evidence, combined per batch; the empty mark counts all."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[int(toxic)].update(evidence(text) | {""})
        # Evidence of no toxic text of the batch still counts against a voter.
        keys = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), *[pa.array([counts[i][k] for k in part], type=pa.int64()) for i in (1, 0)]],
                names=["mark", "toxic", "clean"])


class Votes:
    """Finds the voters that fire on a text."""

    def __init__(self, voters: list[str]):
        self.number = {v: i for i, v in enumerate(voters)}
        self.runs = {v[1:]: i for i, v in enumerate(voters) if v[0] == "~"}
        self.silent: set[str] = set()

    def of(self, text: str | None) -> tuple[list[int], int, int]:
        """Voters that fire, the number of words or runs with a vote, and the number of distinct words.

        Words without a vote are remembered, up to a number, so most words cost one look into a set.
        """
        words = set(WORDS.findall(text.lower())) if text else set()
        fired = {self.runs[run] for run in self.runs.keys() & character_runs(text)} if text and self.runs else set()
        marked = len(fired)
        number = self.number
        for word in words - self.silent:
            if hits := [number[mark] for mark in marks_of(word) if mark in number]:
                marked += 1
                fired.update(hits)
            else:
                self.silent.add(word)
        if len(self.silent) > REMEMBERED:
            self.silent.clear()
        return sorted(fired), marked, len(words)


@dataclass
class Fired:
    """Which voters fire on which rows, as pairs; all products with it take time in proportion to the pairs."""

    row: np.ndarray
    voter: np.ndarray
    rows: int
    voters: int

    @classmethod
    def of(cls, lists: list[list[int]], voters: int) -> "Fired":
        sizes = [len(x) for x in lists]
        flat = np.array([v for x in lists for v in x], dtype=np.int64)
        return cls(np.repeat(np.arange(len(lists)), sizes), flat, len(lists), voters)

    def by_row(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of the voters that fire on each row."""
        return np.bincount(self.row, weights=weights[self.voter], minlength=self.rows)

    def by_voter(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of the rows on which each voter fires."""
        return np.bincount(self.voter, weights=weights[self.row], minlength=self.voters)

    def together(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows on which each voter fires together with each of the voters from ``first`` to ``end``: cells and counts."""
        mine = (self.voter >= first) & (self.voter < end)
        strip = np.zeros((self.rows, end - first), dtype=np.float32)
        strip[self.row[mine], self.voter[mine] - first] = 1
        order = np.argsort(self.voter, kind="stable")
        out = np.zeros((self.voters, end - first))
        present, starts = np.unique(self.voter[order], return_index=True)
        bounds = [*starts.tolist(), len(order)]
        for v, low, high in zip(present.tolist(), bounds, bounds[1:]):
            out[v] = strip[self.row[order[low:high]]].sum(axis=0)
        at = np.flatnonzero(out)
        return at, out.flat[at]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class LabelModel:
    """Class balance, firing rates of each voter in either class, weights after correlations, trust in the annotator.

    A voter that does not fire abstains, which says nothing: voters of one language are
    silent on texts of another. The annotator votes on every row and may be wrong.
    """

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    weight: np.ndarray
    trust: float

    def posterior(self, votes: Fired, annotator: np.ndarray) -> np.ndarray:
        said = np.where(annotator == 1, 1.0, -1.0) * np.log(self.trust / (1 - self.trust))
        gain = np.log(self.toxic / self.clean) * self.weight
        return _sigmoid(np.log(self.prior / (1 - self.prior)) + votes.by_row(gain) + said)


def fit_label_model(votes: Fired, annotator: np.ndarray, rounds: int = 25, strip: int = 256) -> LabelModel:
    """Expectation maximisation over the hidden class, from the votes and the annotator's labels.

    After each step the correlation of any two voters within a class is estimated from
    the posterior; a voter that repeats others shares its weight with them. Correlations
    are built for ``strip`` voters at a time: the sum over rows of the product of two
    centred votes is the number of rows they share, less terms of their means.
    """
    likely = np.where(annotator == 1, 0.9, 0.05)
    shared = [(at, min(at + strip, votes.voters)) for at in range(0, votes.voters, strip)]
    together = [votes.together(*part) for part in shared]
    fires = votes.by_voter(np.ones(votes.rows))
    model = None
    for _ in range(rounds):
        mass = likely.sum(), (1 - likely).sum()
        in_toxic, in_clean = votes.by_voter(likely), votes.by_voter(1 - likely)
        toxic, clean = (in_toxic + 0.5) / (mass[0] + 1), (in_clean + 0.5) / (mass[1] + 1)
        squares = (likely ** 2).sum(), (likely * (1 - likely)).sum(), ((1 - likely) ** 2).sum()

        def product(a, b, both):
            return (both - in_toxic[a] * toxic[b] - in_clean[a] * clean[b] - in_toxic[b] * toxic[a] - in_clean[b] * clean[a]
                    + squares[0] * toxic[a] * toxic[b] + squares[2] * clean[a] * clean[b]
                    + squares[1] * (toxic[a] * clean[b] + clean[a] * toxic[b]))

        def shared_by(low, high, cells):
            both = np.zeros((votes.voters, high - low))
            both.flat[cells[0]] = cells[1]
            return product(every[:, None], every[None, low:high], both)

        every = np.arange(votes.voters)
        spread = np.sqrt(np.maximum(product(every, every, fires), 0) + 1e-9)
        weight = np.concatenate([
            1 / np.maximum((np.clip(shared_by(low, high, cells) / np.outer(spread, spread[low:high]), 0, 1) ** 2).sum(axis=0), 1)
            for (low, high), cells in zip(shared, together)])
        trust = float(np.clip(np.where(annotator == 1, likely, 1 - likely).mean(), 0.7, 0.95))
        model = LabelModel(float(np.clip(mass[0] / votes.rows, 1e-3, 1 - 1e-3)), toxic, clean, weight, trust)
        likely = model.posterior(votes, annotator)
    return model


def _summary(fired: int, marked: int, words: int) -> tuple[float, float, float, float]:
    """The inputs beside the voters; the last one is the constant."""
    return np.log1p(fired), np.log1p(marked), 10 * marked / (words + 10), 1.0


def fit_classifier(votes: Fired, summary: np.ndarray, likely: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on posterior labels by Newton steps; the last weight is the constant.

    Each step is solved by conjugate gradients, so no matrix of voters by voters is built.
    """
    def margin(w: np.ndarray) -> np.ndarray:
        return votes.by_row(w[:votes.voters]) + summary @ w[votes.voters:]

    def gather(r: np.ndarray) -> np.ndarray:
        return np.concatenate([votes.by_voter(r), summary.T @ r])

    penalty = np.full(votes.voters + summary.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(len(penalty))
    for _ in range(rounds):
        p = _sigmoid(margin(weights))
        curve = p * (1 - p) + 1e-6
        # The diagonal scales the problem, so voters of few and of many rows take alike few iterations.
        scale = np.concatenate([votes.by_voter(curve), (summary ** 2).T @ curve]) + penalty
        residual = gather(likely - p) - penalty * weights
        step, small = np.zeros_like(weights), 1e-10 * max(1e-12, float(residual @ (residual / scale)))
        toward = residual / scale
        energy = float(residual @ toward)
        for _ in range(200):
            if energy <= small:
                break
            bent = gather(curve * margin(toward)) + penalty * toward
            length = energy / float(toward @ bent)
            step += length * toward
            residual = residual - length * bent
            scaled = residual / scale
            before, energy = energy, float(residual @ scaled)
            toward = scaled + energy / before * toward
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class Model:
    """Broadcast as its fields: workers need no copy of this package."""

    voters: list[str]
    labels: LabelModel | None
    weights: np.ndarray


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits the model on a bounded sample, the ``sample_rows`` labelled ids with the smallest hashes.

    The sample's labels may so be sent to every executor and its votes, one row an id,
    to the driver. A mark becomes a voter when at least four toxic texts of the sample
    hold it, its odds are e^3 or more, and chance would make one mark in 400 so uneven
    at most (e^-6); these bars are the same at every size and the number of voters has no limit. Of marks of a kind (word, beginning, ending, run) that fire on the
    same rows of the sample the longest votes for all. Rows without a label are left out; an id
    labelled twice counts as toxic if either label says so, and of rows with one id the
    text that sorts last counts, once. Without any toxic row there are no voters.
    """
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic")).where(
        "label_id is not null and toxic in (0, 1)").groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("place", F.xxhash64("label_id"))
    edge = known.orderBy("place").limit(sample_rows).agg(F.max("place")).first()[0]
    if edge is None:
        return Model([], None, np.zeros(0))
    rows = materialize(
        in_small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(known.where(F.col("place") <= edge)), F.col("id") == F.col("label_id"))
        .groupBy("id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"), "labelled")
    counted = materialize(rows.mapInArrow(_count, "mark string, toxic long, clean long").groupBy("mark").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= LEAST_TEXTS), "marks")
    whole = counted.where("mark = ''").first()
    if whole is None or not whole["clean"]:
        return Model([], None, np.zeros(0))
    base = whole["toxic"] / (whole["toxic"] + whole["clean"])
    odds = F.log((F.col("toxic") + 0.5) / F.lit(whole["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(whole["clean"] + 1.0))
    # The chance that so many of its texts are toxic is at most exp(-divergence).
    held = (F.col("toxic") + F.col("clean")).cast("double")
    divergence = (F.col("toxic") * F.log(F.col("toxic") / held / F.lit(base))
                  + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / held / F.lit(1 - base))).otherwise(0.0))
    voters = [r["mark"] for r in counted.where("mark <> ''").where(
        (odds >= LEAST_ODDS) & (divergence >= LEAST_DIVERGENCE)).select("mark").orderBy("mark").collect()]
    if not voters:
        return Model([], None, np.zeros(0))
    shared = df.sparkSession.sparkContext.broadcast(voters)

    def fire(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = Votes(shared.value)
        for batch in batches:
            found = [votes.of(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([f[0] for f in found], type=pa.list_(pa.int32())),
                                              pa.array([f[1] for f in found], type=pa.int32()),
                                              pa.array([f[2] for f in found], type=pa.int32())],
                                             names=["toxic", "fired", "marked", "words"])

    # In one order, so that sums do not depend on the partitions.
    seen = sorted(rows.mapInArrow(fire, "toxic int, fired array<int>, marked int, words int").collect())
    annotator = np.array([r["toxic"] for r in seen])
    voters, lists = one_voter_per_set(voters, [r["fired"] for r in seen])
    votes = Fired.of(lists, len(voters))
    summary = np.array([_summary(len(x), r["marked"], r["words"]) for x, r in zip(lists, seen)])
    model = fit_label_model(votes, annotator)
    return Model(voters, model, fit_classifier(votes, summary, model.posterior(votes, annotator)))


def one_voter_per_set(voters: list[str], fired: list[list[int]]) -> tuple[list[str], list[list[int]]]:
    """Of voters of a kind that fire on the same rows only the longest stays (ties: the first); the rows with new numbers."""
    signs = np.random.default_rng(1).integers(0, 1 << 62, len(fired), dtype=np.uint64)
    sums = np.zeros(len(voters), dtype=np.uint64)
    for sign, row in zip(signs, fired):
        sums[row] += sign  # a row holds a voter once
    best: dict[tuple[str, int], int] = {}
    for i, voter in enumerate(voters):
        key = voter[0], int(sums[i])
        if key not in best or len(voters[best[key]]) < len(voter):
            best[key] = i
    kept = sorted(i for i in best.values() if sums[i])
    number = {old: new for new, old in enumerate(kept)}
    return [voters[i] for i in kept], [[number[v] for v in row if v in number] for row in fired]


def score_one(weights: np.ndarray, votes: Votes, text: str | None) -> float:
    if not len(weights):
        return 0.0
    fired, marked, words = votes.of(text)
    return float(_sigmoid(weights[fired].sum() + weights[-4:] @ np.array(_summary(len(fired), marked, words))))


def _apply(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, weights = shared.value
        votes = Votes(voters)
        for batch in batches:
            scores = [score_one(weights, votes, text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, type=pa.float64())], names=["doc_id", "score"])

    return run


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and a score from 0 to 1.

    Only the text is read. Null and empty texts have no votes and get the score of a
    text without evidence. Repeated rows are scored alike, other columns are not read,
    an empty table gives no rows. A model without voters scores 0.
    """
    rows = in_small_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast((model.voters, model.weights))
    return rows.mapInArrow(_apply(shared), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def keep_clean(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose text scores below the threshold, with all columns, in place."""
    at = in_small_batches(df).columns.index(text_col)
    shared = df.sparkSession.sparkContext.broadcast((model.voters, model.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, weights = shared.value
        votes = Votes(voters)
        for batch in batches:
            scores = [score_one(weights, votes, text) for text in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([s < threshold for s in scores], type=pa.bool_()))

    return df.mapInArrow(run, df.schema)
