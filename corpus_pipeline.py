"""The corpus pipeline: toxic texts go, near duplicates go, leaks go, sources are mixed, the rest is sharded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import decontaminate, mixing, nearcopies, shards, toxicity
from shelfcast.llm.queries import SHARD_DIMENSIONS
from shelfcast.session import materialize

#: SQL cannot express the trained and hashed stages; the tests hold them against brute force.
ORACLE_SQL = None


def _columns(spark: SparkSession, sf_dir: str) -> list[str]:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").columns


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model rejects go. The scores are joined by the id and the text stays in its row."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.learn(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"))
    return toxicity.keep_clean(docs, model).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays; rows with a null id are linked with nothing and stay."""
    gone = nearcopies.near_duplicates(docs, words=5, percent=80).where("not kept").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == F.col("gone_id"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_leaking(docs, benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's repetition rate says."""
    return mixing.emit_copies(mixing.mix_sources(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard_size, shard and slot."""
    return shards.with_slots(shards.kd_shards(docs, dimensions=SHARD_DIMENSIONS, shards=8), ["doc_id", "shard_size"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
