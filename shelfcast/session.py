"""Session settings and the shared folder used to cut lineage and keep tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master, where the driver and
    the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfcast-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared = shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For a result that several branches of a plan use: the input is scanned once,
    each branch prunes its own columns, and lost executors cost no recomputation. The
    folder goes when the application ends.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a folder of this application when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table or model of this run."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
