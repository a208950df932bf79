"""Shared helpers: staged tables, table access, remote files, runs of sorted rows, components of links."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave import session
from riskweave.session import new_path

__all__ = ["components", "crc_mod_4", "cut_lineage", "filesystem", "free_names", "give_back", "held_out", "in_runs", "int64s", "new_path", "settings", "table", "task_batches", "thinned", "thinning", "uint64s"]

#: rows and bytes of an Arrow batch handed to Python, which JVM and worker both hold; a single longer text is a batch of its own
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
SPREAD = 16  # tasks among which the rows of a group are thinned out


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the length of a block (underscores stand for dots)."""
    old = {}
    for key, value in values.items():
        key = key.replace("__", ".")
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, worked out with small Arrow batches."""
    with settings(df.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS), spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        return session.cut_lineage(df)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder in the shared location, for tasks that write or range-read files."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names as given, with lines before them as far as `df` has such columns (Spark does not tell upper from lower case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def crc_mod_4(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4


def held_out(key: Column) -> Column:
    """Rows that no model may learn from; a null key counts as training."""
    return F.coalesce(crc_mod_4(key) == 2, F.lit(False))


def thinned(rows: DataFrame, k: int, order: list[Column | str], *groups: str) -> DataFrame:
    """Rows among which the first k of each group are, at most SPREAD * k of a group.

    Each task passes on its first k of a group, and SPREAD tasks a group thin them out again, so that the one that picks
    the k sees a bounded number of rows however many tasks there were. Run it inside `thinning`: beyond a limit of Spark's own
    each task would pass on all its rows.
    """
    some = Window.partitionBy(*groups, "_part").orderBy(*order)
    rows = rows.withColumn("_part", F.spark_partition_id() % SPREAD).withColumn("_at", F.row_number().over(some))
    return rows.filter(F.col("_at") <= k).drop("_part", "_at")


def thinning(spark: SparkSession, k: int):
    """Inside, tasks thin rows out before they are shuffled for any number of rows up to k."""
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    return settings(spark, **{name.replace(".", "__"): str(max(k, int(spark.conf.get(name))))})


def uint64s(column: pa.Array) -> np.ndarray:
    return int64s(column).view(np.uint64)


def int64s(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False))


def in_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of all rows of one key, from batches sorted by the key; one key is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            v = c.to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
        bounds = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(c[lo].as_py() for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return memory that the allocators of a Python worker hold to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def task_batches(rows: Iterator[dict], schema: pa.Schema, size: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches of dictionaries."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def components(links: DataFrame, stage: Callable[[DataFrame], DataFrame] = cut_lineage, limit: int = 60) -> DataFrame:
    """(node, label): the smallest node that links (a, b) reach from each linked node.

    Each round takes the smallest label among the neighbours, then the label of that label; both are joins and
    minima that Spark combines before the shuffle. Ends when no label changes, fails if that takes over `limit` rounds.
    """
    ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ways = stage(ways.union(links.select("a", F.col("a").alias("b"))).union(links.select(F.col("b").alias("a"), "b")).distinct())
    labels = stage(ways.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")))
    for _ in range(limit):
        near = (
            ways.join(labels, ways.b == labels.node)
            .groupBy("a")
            .agg(F.min("label").alias("label"), F.min(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old"))
        )
        far = labels.select(F.col("node").alias("target"), F.col("label").alias("next"))
        step = near.join(far, F.col("label") == F.col("target"))
        step = stage(step.select(F.col("a").alias("node"), F.least("label", "next").alias("label"), "old"))
        moved = step.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = step.select("node", "label")
        if not moved:
            return labels
    raise RuntimeError(f"links did not settle in {limit} rounds")
