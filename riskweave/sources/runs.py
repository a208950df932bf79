"""Ledger of runs: counts are taken while a job writes, and a failed run leaves its error."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.sources import sinks


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


class Ledger:
    """A table of run rows in a folder. Rows are only added; of a run the row written last counts, its first start stays."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, run_id: str, at: datetime, **values) -> None:
        row = sinks.run_row(self.spark, run_id, at, **values).withColumn("step", F.lit(time.time_ns()))
        row.coalesce(1).write.mode("append").parquet(self.path)

    def states(self) -> DataFrame:
        """One row per run; none where no run has started."""
        try:
            rows = self.spark.read.schema(f"{S.RUNS}, step long").parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], S.RUNS)
        return sinks.upsert_changes(rows, ["id"], F.col("step"), ["started_at"]).drop("step")


def tracked(ledger: Ledger, work: Callable[[], dict], run_id: str | None = None, clock: Callable[[], datetime] = utc_now) -> str:
    """Runs `work` under a run row and returns the run's id.

    `work` gives the counts `companies`, `filings` and `facts`, and may give `status` and `error` itself. An exception
    is written into the row and raised again.
    """
    run_id = run_id or uuid.uuid4().hex
    ledger.add(run_id, clock())
    try:
        done = work()
    except Exception as e:
        ledger.add(run_id, clock(), status="failed", error=f"{type(e).__name__}: {e}"[:2000])
        raise
    ledger.add(run_id, clock(), **{"status": "completed", **done})
    return run_id


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", **measures) -> dict:
    """Writes the rows and returns how many there were, with further aggregates, from the pass that wrote them."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()]).write.mode(mode).parquet(path)
    return seen.get


def load_tables(ledger: Ledger, folder: str, companies: DataFrame, filings: DataFrame, facts: DataFrame, run_id: str | None = None, clock: Callable[[], datetime] = utc_now) -> str:
    """Companies, filings and facts written anew under one run row with the counts of all three."""

    def work() -> dict:
        frames = {"companies": companies, "filings": filings, "facts": facts}
        return {name: write_counted(df, f"{folder}/{name}")["rows"] for name, df in frames.items()}

    return tracked(ledger, work, run_id, clock)
