"""Upserts, appends, replacement and ledgers over Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S

BATCH = "batch_id"  # partition column of tables that grow by batches


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), update: Sequence[str] | None = None) -> DataFrame:
    """Existing rows overwritten by new rows of the same key.

    `keep` columns stay as first stored; with `update`, only the named columns change.
    The new rows must hold one row per key; see `upsert_changes` for a log of changes.
    """
    stacked = existing.withColumn("_at", F.lit(0)).unionByName(new.withColumn("_at", F.lit(1)))
    return _merge(stacked, keys, F.col("_at"), keep, update, [c for c in existing.columns])


def upsert_changes(changes: DataFrame, keys: Sequence[str], order: Column, keep: Sequence[str] = (), update: Sequence[str] | None = None) -> DataFrame:
    """State after applying a log of changes in the given order."""
    return _merge(changes.withColumn("_at", order), keys, F.col("_at"), keep, update, changes.columns)


def _merge(stacked: DataFrame, keys, order: Column, keep, update, columns) -> DataFrame:
    rest = [c for c in columns if c not in keys]
    changing = [c for c in rest if c not in keep and (update is None or c in update)]
    fixed = [c for c in rest if c not in changing]
    # combining aggregation: a key with very many changes still leaves each task as one row
    aggs = []
    if changing:
        aggs.append(F.max_by(F.struct(*changing), order).alias("_new"))
    if fixed:
        aggs.append(F.min_by(F.struct(*fixed), order).alias("_old"))
    merged = stacked.groupBy(*keys).agg(*aggs)
    where = {**{c: f"_new.{c}" for c in changing}, **{c: f"_old.{c}" for c in fixed}}
    return merged.select(*[F.col(where.get(c, c)).alias(c) for c in columns])


# Key, columns kept as first stored, and columns that alone may change, per table.
UPSERT_RULES: dict[str, tuple[list[str], list[str], list[str] | None]] = {
    "companies": (["cik"], ["created_at"], None),
    "filings": (["accession_number"], ["ingested_at"], None),
    "financial_facts": (["id"], [], ["value", "filed"]),
    "financial_metrics": (["id"], ["cik", "period_end", "form"], None),
    "ingestion_runs": (["id"], ["started_at"], None),
}


def upsert_table(name: str, existing: DataFrame, new: DataFrame) -> DataFrame:
    keys, keep, update = UPSERT_RULES[name]
    return upsert(existing, new, keys, keep, update)


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows plus the new rows whose key is not there yet."""
    fresh = new.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh)


def stack(frames: dict[str, DataFrame]) -> DataFrame:
    """Frames of unequal shape under each other, missing columns as null."""
    out: DataFrame | None = None
    for name, df in frames.items():
        named = df.select(F.lit(name).alias("table_name"), "*")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def export_report(frames: dict[str, tuple[DataFrame, str]], path: str) -> dict[str, str]:
    """One CSV folder per table, sorted by its score (a range-partitioned sort, not one task)."""
    written = {}
    for name, (df, by) in frames.items():
        written[name] = f"{path}/{name}"
        df.orderBy(F.desc(by)).write.mode("overwrite").csv(written[name], header=True)
    return written


def cap(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows by key; 0 takes all."""
    return df.orderBy(key).limit(n) if n else df


def first_table(spark: SparkSession, names: Sequence[str], schema: str) -> DataFrame:
    """The first of the named tables that exists, else an empty one."""
    for name in names:
        try:
            if spark.catalog.tableExists(name):
                return spark.table(name)
        except AnalysisException:
            continue
    return spark.createDataFrame([], schema)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """All rows of a stored table anew; `df` must not read from it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """One partition of changes per batch; a replayed batch overwrites its own partition and nothing else."""
    rows = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


BASES = "upto long, folder string"


def _newest_base(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Last batch folded into a base table, and the folder of that table."""
    try:
        row = spark.read.schema(BASES).parquet(f"{path}-bases").agg(F.max(F.struct("upto", "folder")).alias("last")).first()
    except AnalysisException:
        return None
    return tuple(row["last"]) if row["last"] else None


def current_rows(spark: SparkSession, path: str, schema: str, keys: Sequence[str], keep: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """State of a table of batches: per key the row of the last batch (within it, the highest `order`), `keep` as first stored.

    A table without any batch has no rows. Changes are combined per task before the shuffle. After `compact` only its base
    and the batches behind it are read.
    """
    columns = f"{schema}, {BATCH} long"
    try:
        changes = spark.read.schema(columns).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    if base := _newest_base(spark, path):
        folded = spark.read.schema(schema).parquet(base[1]).withColumn(BATCH, F.lit(base[0]))
        changes = folded.unionByName(changes.where(F.col(BATCH) > base[0]))
    by = [BATCH, *order]
    rest = [c for c in changes.columns if c not in keys]
    if any(kind in f.dataType.simpleString() for f in changes.select(*rest).schema for kind in ("map<", "variant")):  # without an order
        return upsert_changes(changes, keys, F.struct(*by), keep).drop(BATCH)
    # columns of the order lead each struct, so that they are moved once with the columns they choose
    chosen = [c for c in rest if c not in keep and c not in by]
    fixed = [c for c in keep if c in rest]
    aggs = [F.max(F.struct(*by, *chosen)).alias("_new")]
    if fixed:
        aggs.append(F.min(F.struct(*by, *[c for c in fixed if c not in by])).alias("_old"))
    merged = changes.groupBy(*keys).agg(*aggs)
    return merged.select(*[F.col(c if c in keys else f"_old.{c}" if c in fixed else f"_new.{c}").alias(c) for c in changes.columns if c != BATCH])


def compact(spark: SparkSession, path: str, schema: str, keys: Sequence[str], keep: Sequence[str] = (), order: Sequence[str] = ()) -> int | None:
    """Fold all batches that are there into a base table, so that reading the state costs its size and not its history.

    Call it between batches, whose numbers must rise. The base becomes valid by one row written after it: a run that breaks
    off leaves the state as it was. Folded batches stay on disk and are no longer read; a replay of one changes nothing.
    Returns the number of the last batch folded, None where there is nothing new to fold.
    """
    try:
        last = spark.read.schema(f"{schema}, {BATCH} long").parquet(path).agg(F.max(BATCH)).first()[0]
    except AnalysisException:
        return None
    known = _newest_base(spark, path)
    if last is None or known and known[0] >= last:
        return None
    folder = f"{path}-base-{uuid.uuid4().hex}"
    current_rows(spark, path, schema, keys, keep, order).write.parquet(folder)
    spark.createDataFrame([(last, folder)], BASES).coalesce(1).write.mode("append").parquet(f"{path}-bases")
    return last


def run_row(spark: SparkSession, run_id: str, at: datetime, status: str = "running", companies: int = 0, filings: int = 0, facts: int = 0, error: str | None = None) -> DataFrame:
    """Ledger row of a run; merged by id under the rules of `ingestion_runs`, the start stays and the rest follows."""
    ended = at if status in ("completed", "failed") else None
    return spark.createDataFrame([(run_id, at, ended, status, companies, filings, facts, error)], S.RUNS)


def run_states(events: DataFrame) -> DataFrame:
    """Latest state per run from its status events (id, at, status, seq); the start stays."""
    return events.groupBy("id").agg(
        F.min("at").alias("started_at"),
        F.max(F.when(F.col("status").isin("completed", "failed"), F.col("at"))).alias("ended_at"),
        F.max_by("status", F.struct("at", "seq")).alias("status"),
        F.count(F.lit(1)).alias("n_events"),
    )


def last_runs(states: DataFrame, n: int = 10) -> DataFrame:
    return states.orderBy(F.desc("started_at"), "id").limit(n)
