"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "riskweave", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of its own only in local mode, where all tasks share the machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="riskweave-")
        spark.sparkContext.setCheckpointDir(current)
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh location inside the shared folder."""
    return f"{shared_dir(spark)}/riskweave/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder.

    A written table survives the loss of executors like a checkpoint does, and its size is known
    to the planner; a checkpoint would carry the estimates of its plan on, and those multiply with
    every round of an iterative job.
    """
    path = new_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_by(df: DataFrame, key: str, rows: int = 20_000) -> DataFrame:
    """The rows by hash of a key, some `rows` to a task, for steps that make many rows of one."""
    return df.repartition(max(1, -(-df.count() // rows)), key)
