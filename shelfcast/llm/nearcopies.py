"""Near duplicates by SuperMinHash signatures, banding, verification and union of links.

Documents with equal shingle sets are one class. Classes that share a band meet
at the smallest class of that band first, so a band with k classes gives k - 1
pairs. Only classes that this leaves in another component than their band's
smallest one, the strays, are compared with the other members as well: as blocks
of queries that all members stream past, never as rows of pairs. Every link is
confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.graph import components
from shelfcast.llm.tokens import in_small_batches, mix, row_slices, word_hashes
from shelfcast.session import materialize

BANDS, ROWS = 24, 4
_A, _B = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and the offsets of the rows."""
    hashes, offsets = word_hashes(column)
    counts = np.diff(offsets)
    size = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(ends[-1]) - ends[row] + offsets[row]
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for step in range(words):
            inside = at + step < offsets[row + 1]
            word = hashes[np.minimum(at + step, max(len(hashes) - 1, 0))] if len(at) else out
            out = np.where(inside, mix(out + word * _A + _B), out)
    for first, last in zip(ends[:-1].tolist(), ends[1:].tolist()):
        out[first:last].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    distinct = np.bincount(row[fresh], minlength=len(size)) if len(out) else np.zeros(len(size), np.int64)
    return out[fresh], np.concatenate([[0], np.cumsum(distinct)])


def super_minhash(sets: np.ndarray, offsets: np.ndarray, registers: int) -> np.ndarray:
    """Signatures of all rows at once; rows without shingles keep the largest value.

    Each element walks a permutation of the registers and offers its j-th register the
    value j + r_j. A row stops when no register can still fall, which for long rows is
    after a few steps.
    """
    rows = len(offsets) - 1
    signature = np.full(rows * registers, np.uint64(0xFFFFFFFFFFFFFFFF))
    row = np.repeat(np.arange(rows), np.diff(offsets))
    elements, order = sets, None
    step = 0
    while len(elements) and step < registers:
        with np.errstate(over="ignore"):
            draw = mix(elements + np.uint64(2 * step + 1) * _A)
            pick = step + (mix(draw ^ _B) % np.uint64(registers - step)).astype(np.int64)
        every = np.arange(len(elements))
        if order is None:
            register = pick
        else:
            register = order[every, pick].astype(np.int64)
            order[every, pick] = order[:, step]
        value = (np.uint64(step) << np.uint64(56)) | (draw >> np.uint64(8))
        np.minimum.at(signature, row * registers + register, value)
        step += 1
        highest = signature.reshape(rows, registers).max(axis=1)
        running = (highest >> np.uint64(56)) >= np.uint64(step)
        keep = running[row]
        if order is None:
            elements, row = elements[keep], row[keep]
            order = np.tile(np.arange(registers, dtype=np.uint8), (len(elements), 1))
            order[np.arange(len(elements)), pick[keep]] = 0
        elif keep.sum() < 0.8 * len(keep) or not keep.any():
            elements, row, order = elements[keep], row[keep], order[keep]
    return signature.reshape(rows, registers)


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, 1, 2 << 20):
                sets, offsets = shingle_sets(batch.column(1), words)
                signature = super_minhash(sets, offsets, BANDS * ROWS)
                with np.errstate(over="ignore"):
                    band = np.zeros((batch.num_rows, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _A
                    for r in range(ROWS):
                        band = mix(band + signature[:, r::ROWS][:, :BANDS] * _B)
                    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ c), dtype=np.uint64)]) for c in (_A, _B)]
                    prints = [s[offsets[1:]] - s[offsets[:-1]] for s in sums]
                at = pa.array(np.arange(0, band.size + 1, BANDS), type=pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(offsets), type=pa.int64()),
                     *[pa.array(p.view(np.int64)) for p in prints],
                     pa.ListArray.from_arrays(at, pa.array(band.reshape(-1).view(np.int64)))],
                    names=["doc_id", "n", "f1", "f2", "bands"])

    return run


def _compare(words: int):
    """Rows sorted by pivot, salt and role: a pivot's set is held while its partners stream past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: list[np.ndarray] = []
        current = None
        for whole in batches:
            for batch in row_slices(whole, 3, 2 << 20):
                sets, offsets = shingle_sets(batch.column("text"), words)
                out = []
                for i, (pivot, other) in enumerate(zip(batch.column("pivot").to_pylist(), batch.column("other").to_pylist())):
                    own = sets[offsets[i]:offsets[i + 1]]
                    if pivot != current:
                        current, pivots = pivot, []
                    if other is None:
                        pivots.append(own)
                        continue
                    best = (0, 1)
                    for held in pivots:
                        small, large = (own, held) if len(own) <= len(held) else (held, own)
                        at = np.minimum(np.searchsorted(large, small), max(len(large) - 1, 0))
                        both = int((large[at] == small).sum()) if len(large) else 0
                        either = len(own) + len(held) - both
                        if both * best[1] > best[0] * either:
                            best = (both, either)
                    out.append((other, pivot, *best))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in zip(*out)],
                                                     names=["a", "b", "both", "either"])

    return run


def verify(pairs: DataFrame, texts: DataFrame, words: int, per_task: int = 64) -> DataFrame:
    """The sizes of intersection and union of the full sets of each pair (a, b).

    Partners of one b are dealt out in salted parts of about ``per_task`` rows, so a
    text that many others are compared with is read by many tasks.
    """
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / per_task).cast("int").alias("salts"))
    salted = pairs.join(counts, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    others = salted.join(texts, salted["a"] == texts["node"]).select(
        F.col("b").alias("pivot"), "salt", F.col("a").alias("other"), "text")
    pivots = counts.join(texts, counts["b"] == texts["node"]).select(
        F.col("b").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(None).cast("long").alias("other"), "text")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (pivots.unionByName(others).repartition(parts, "pivot", "salt")
             .sortWithinPartitions("pivot", "salt", F.col("other").asc_nulls_first()))
    return dealt.mapInArrow(_compare(words), "a long, b long, both long, either long")


def _fits(n1: Column, n2: Column, percent: int) -> Column:
    """Sets whose sizes differ too much cannot reach the similarity."""
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept.

    Documents are linked when 100 * intersection >= percent * union of their sets of
    ``words``-word shingles; a text with fewer words is one shingle, one without words
    has none and is linked with nothing. The component is the smallest id reachable.
    Ids are integers; rows with the same id are one document and stay or go together;
    rows with a null id are linked with nothing, have a null component and are kept.
    A null text is empty. Other columns are not read. An empty table gives no rows.
    Bands of 4 of 96 registers find a pair at similarity 0.8 with 1 - 3e-6; every pair
    that shares a band and is not joined otherwise is decided on full sets.
    """
    texts = in_small_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = materialize(texts.mapInArrow(_sketch(words), "doc_id long, n long, f1 long, f2 long, bands array<long>"),
                           "sketches")
    able = sketches.where("doc_id is not null and n > 0")
    classes = able.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("node"), F.min("bands").alias("bands"))
    classes = materialize(classes, "classes")
    pairs, members = _candidates(classes, percent)
    involved = members.select("node").distinct()
    bodies = materialize(texts.join(involved, texts["doc_id"] == involved["node"]).select("node", "text"), "texts")
    tested = materialize(verify(pairs, bodies, words), "tested")
    link = 100 * F.col("both") >= percent * F.col("either")
    links = tested.where(link).select("a", "b")
    found = materialize(components(links), "components")
    more_links = materialize(rest_links(_strays(members, found), bodies, words, percent), "links")
    if not more_links.isEmpty():
        found = materialize(components(links.unionByName(more_links)), "components")
    named = (classes.join(found, "node", "left")
             .select("f1", "f2", F.col("n").alias("size"), F.coalesce("component", "node").alias("component")))
    named = named.select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "size", "component")
    ids = sketches.select("doc_id", "n", "f1", "f2")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    linked = (ids.where(~alone)
              .join(named, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & (F.col("n") == F.col("size")))
              .select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")))
    single = ids.where(alone).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(single).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _candidates(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of each class with the smallest class of its bands; and the members of shared bands."""
    banded = classes.select("node", "n", F.explode("bands").alias("band"))
    shared = (banded.groupBy("band").agg(F.min(F.struct("node", "n")).alias("pivot"), F.count("*").alias("size"))
              .where("size > 1").select("band", F.col("pivot")["node"].alias("pivot"), F.col("pivot")["n"].alias("pivot_n")))
    members = materialize(banded.join(shared, "band"), "band-members")
    pairs = (members.where((F.col("node") != F.col("pivot")) & _fits(F.col("n"), F.col("pivot_n"), percent))
             .select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct())
    return pairs, members


def _strays(members: DataFrame, found: DataFrame) -> DataFrame:
    """Every class with the smallest class of its bands, and whether that one is still in another component."""
    at = found.select(F.col("node").alias("x"), F.col("component").alias("c"))
    met = members.select("pivot", "node").distinct()
    named = (met.join(at, F.col("node") == F.col("x"), "left").withColumn("own", F.coalesce("c", "node")).drop("x", "c")
             .join(at, F.col("pivot") == F.col("x"), "left").withColumn("theirs", F.coalesce("c", "pivot")).drop("x", "c"))
    return named.select("pivot", "node", "own", (F.col("own") != F.col("theirs")).alias("stray"))


def _compare_blocks(words: int, percent: int):
    """Rows sorted by group and role: the sets of a block of strays are held while a part of the members streams past."""

    def index(held: list[tuple]) -> dict:
        sizes = np.array([len(h[2]) for h in held])
        keys = np.concatenate([h[2] for h in held])
        order = np.argsort(keys, kind="stable")
        return {"keys": keys[order], "owner": np.repeat(np.arange(len(held)), sizes)[order], "sizes": sizes,
                "nodes": np.array([h[0] for h in held]), "own": np.array([h[1] for h in held])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block = None, [], None
        for whole in batches:
            for batch in row_slices(whole, 6, 2 << 20):
                sets, offsets = shingle_sets(batch.column("text"), words)
                columns = [batch.column(c).to_pylist() for c in ("pivot", "block", "part", "role", "node", "own")]
                links: list[np.ndarray] = []
                for i, (pivot, number, part, role, node, own) in enumerate(zip(*columns)):
                    shingles = sets[offsets[i]:offsets[i + 1]]
                    if (pivot, number, part) != current:
                        current, held, block = (pivot, number, part), [], None
                    if role == 0:
                        held.append((node, own, shingles))
                        continue
                    if not held:
                        continue
                    block = block or index(held)
                    first = np.searchsorted(block["keys"], shingles, "left")
                    count = np.searchsorted(block["keys"], shingles, "right") - first
                    at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                    both = np.bincount(block["owner"][at], minlength=len(held))
                    linked = 100 * both >= percent * (len(shingles) + block["sizes"] - both)
                    for other in block["nodes"][linked & (block["own"] != own)].tolist():
                        links.append((other, node))
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in zip(*links)], names=["a", "b"])

    return run


def rest_links(strays: DataFrame, texts: DataFrame, words: int, percent: int, block: int = 256, part: int = 2048) -> DataFrame:
    """The links between strays and all other classes that share a band with them.

    Strays of one pivot are held in blocks, its members stream past in parts; no row per
    pair exists, and a pivot with a third of all classes is dealt to many tasks.
    """
    counts = strays.groupBy("pivot").agg(
        F.ceil(F.count_if("stray") / block).cast("int").alias("blocks"), F.ceil(F.count("*") / part).cast("int").alias("parts"))
    known = strays.join(counts.where("blocks > 0"), "pivot")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(n)).cast("int")
    held = known.where("stray").select("pivot", dealt("blocks", 1).alias("block"), every("parts").alias("part"),
                                       F.lit(0).alias("role"), "node", "own")
    streamed = known.where("node <> pivot").select("pivot", every("blocks").alias("block"), dealt("parts", 2).alias("part"),
                                                   F.lit(1).alias("role"), "node", "own")
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = held.unionByName(streamed).join(texts, "node").select("pivot", "block", "part", "role", "node", "own", "text")
    return (rows.repartition(tasks, "pivot", "block", "part").sortWithinPartitions("pivot", "block", "part", "role")
            .mapInArrow(_compare_blocks(words, percent), "a long, b long"))
