"""Exact duplicates by Grace hash partitioning of complete contents.

Every scan task first folds equal texts of its own into one head row with the
list of their ids, so a text that a third of the table repeats reaches the
shuffle once per task. Heads are partitioned by the hash of the content; each
bucket fills an open-addressing table that compares complete contents. A bucket
that outgrows its table writes the texts that found no place to spill files in
the shared folder, and these are partitioned anew by other bits of the hash
until nothing spills.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.tokens import SPACE, in_small_batches
from shelfcast.session import materialize


class ContentTable:
    """Open addressing with linear probing; a slot holds a content, equality means equal bytes."""

    def __init__(self, budget: int):
        self.budget = budget
        self.bytes = 0
        self.full = False
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self.slots = np.full(1024, -1, dtype=np.int64)

    def find(self, hashed: int, content: bytes, insert: bool = True) -> int:
        """The number of the content, or -1 if it is new and has no place."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (number := int(self.slots[at])) >= 0:
            if self.hashes[number] == hashed and self.contents[number] == content:
                return number
            at = (at + 1) & mask
        if self.full or not insert:
            return -1
        number = len(self.contents)
        self.contents.append(content)
        self.hashes.append(hashed)
        self.slots[at] = number
        self.bytes += len(content) + 64
        self.full = self.bytes >= self.budget
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return number

    def _grow(self) -> None:
        slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(slots) - 1
        for number, hashed in enumerate(self.hashes):
            at = hashed & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = number
        self.slots = slots


def _signed(hashed: int) -> int:
    return hashed - (1 << 64) if hashed >> 63 else hashed


def _combine(id_type: pa.DataType, budget: int):
    """Folds equal contents of one task: a head row per content and table."""
    member = pa.struct([("id", id_type), ("points", pa.int32())])
    schema = pa.schema([("hash", pa.int64()), ("head", pa.int64()), ("content", pa.binary()),
                        ("sha", pa.string()), ("members", pa.list_(member))])

    def flush(table: ContentTable, rows: list[list], first: int) -> Iterator[pa.RecordBatch]:
        step = max(1, int(len(rows) * (4 << 20) / max(table.bytes, 1)))
        for at in range(0, len(rows), step):
            part = range(at, min(at + step, len(rows)))
            members = pa.array([m for i in part for m in rows[i]], type=member)
            offsets = np.cumsum([0, *(len(rows[i]) for i in part)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([_signed(table.hashes[i]) for i in part], type=pa.int64()),
                pa.array([first + i for i in part], type=pa.int64()),
                pa.array([table.contents[i] for i in part], type=pa.binary()),
                pa.array([hashlib.sha256(table.contents[i]).hexdigest() for i in part], type=pa.string()),
                pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), members)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        table, rows, held = ContentTable(1 << 62), [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            points = batch.column(2).to_pylist()
            for key, text, n in zip(ids, batch.column(1), points):
                content = text.as_buffer().to_pybytes().translate(None, SPACE) if text.is_valid else b""
                number = table.find(xxhash.xxh3_64_intdigest(content), content)
                if number == len(rows):
                    rows.append([])
                rows[number].append({"id": key, "points": n})
                held += 1
                if table.bytes >= budget or held >= 50_000:
                    yield from flush(table, rows, first)
                    first += len(rows)
                    table, rows, held = ContentTable(1 << 62), [], 0
        if rows:
            yield from flush(table, rows, first)

    return run


def _resolve(budget: int):
    """Gives every head the number of its content in the bucket; what finds no place is spilled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, ContentTable] = {}
        shared = 0
        for batch in batches:
            numbers, keep = [], []
            for bucket, hashed, content in zip(batch.column("bucket").to_pylist(), batch.column("hash").to_pylist(),
                                               batch.column("content").to_pylist()):
                table = tables.get(bucket)
                if table is None:
                    table = tables[bucket] = ContentTable(1 << 62)
                    table.full = shared >= budget
                before = table.bytes
                number = table.find(hashed & 0xFFFFFFFFFFFFFFFF, content)
                shared += table.bytes - before
                if shared >= budget:
                    for other in tables.values():
                        other.full = True
                numbers.append(None if number < 0 else number)
                keep.append(content if number < 0 else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("hash"), batch.column("head"), pa.array(keep, type=pa.binary()), batch.column("sha"),
                batch.column("members"), pa.array(numbers, type=pa.int64()), batch.column("bucket")],
                names=["hash", "head", "content", "sha", "members", "number", "bucket"])

    return run


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bucket_bytes: int = 32 << 20, combine_bytes: int = 16 << 20) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and the SHA-256 of the normalised text.

    Texts are equal when they are identical without white space; a null text is
    empty. Of equal texts the one with the most code points stays, then the
    smallest id (a null id comes last). Of rows that agree in all of this exactly
    one stays. Other columns are not read; an empty table gives no rows.
    ``bucket_bytes`` bounds the contents that one task keeps in memory.
    """
    spark = df.sparkSession
    rows = in_small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("content"),
                     F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).alias("points"))
    id_type = rows.schema["id"].dataType
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type.simpleString()]
    volume = rows.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    member = f"array<struct<id:{id_type.simpleString()},points:int>>"
    heads = rows.mapInArrow(_combine(arrow_id, combine_bytes),
                            f"hash long, head long, content binary, sha string, members {member}")
    levels: list[DataFrame] = []
    while True:
        level = len(levels)
        buckets = max(1, math.ceil(volume * 2 / bucket_bytes))
        dealt = heads.withColumn("bucket", F.pmod(F.xxhash64("hash", F.lit(level)), F.lit(buckets)).cast("int"))
        done = materialize(
            dealt.repartition(buckets, "bucket").mapInArrow(
                _resolve(bucket_bytes),
                f"hash long, head long, content binary, sha string, members {member}, number long, bucket int"),
            f"exact-level-{level}")
        levels.append(done.where("number is not null").select(
            F.lit(level).alias("level"), "hash", "number", "head", "sha", "members"))
        spilled = done.where("number is null").drop("number", "bucket")
        left = spilled.agg(F.sum(F.octet_length("content")), F.count("*")).first()
        if not left[1]:
            break
        heads, volume = spilled, left[0]
    resolved = levels[0]
    for more in levels[1:]:
        resolved = resolved.unionByName(more)
    return _answer(resolved)


def _order(member: F.Column, position: F.Column) -> F.Column:
    return F.struct((-member["points"]).alias("points"), member["id"].isNull().alias("missing"),
                    member["id"].alias("id"), F.col("head").alias("head"), position.alias("position"))


def _answer(resolved: DataFrame) -> DataFrame:
    """Joins the best member of each content to all members."""
    key = ["level", "hash", "number"]
    best = F.array_min(F.transform("members", lambda m, i: _order(m, i)))
    groups = resolved.groupBy(*key).agg(F.min(best).alias("best"), F.sum(F.size("members")).alias("group_size"))
    member = F.col("m")
    return (resolved.join(groups, key)
            .select("*", F.posexplode("members").alias("position", "m"))
            .select(member["id"].alias("doc_id"), F.col("best")["id"].alias("keep_id"),
                    F.col("group_size").cast("long").alias("group_size"),
                    ((F.col("head") == F.col("best")["head"])
                     & (F.col("position") == F.col("best")["position"])).alias("kept"),
                    F.col("sha").alias("text_sha256")))
