"""Incremental versions of the audit, monitoring and ingest jobs."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskweave.functions import constants as K
from riskweave.functions.exprs import count_if, rate
from riskweave.session import new_path
from riskweave.sources import sinks


def file_stream(spark: SparkSession, folder: str, table: str, per_trigger: int | None = None) -> DataFrame:
    """A table, one file or a folder of files, as a stream; the schema is that of the files already there."""
    path = f"{folder.rstrip('/')}/{table}"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern it may name a file or a folder alike


def run_available(stream: DataFrame, mode: str, checkpoint: str, *, path: str | None = None, each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Work off what is there, to Parquet files or batch by batch."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(each) if each else writer.format("parquet").option("path", path)
    query = writer.start()
    query.awaitTermination()


def deduplicated(stream: DataFrame, key: str, stamp: str, delay: str = "1 day") -> DataFrame:
    """First record of each id; state is dropped once the watermark has passed it."""
    return stream.withWatermark(stamp, delay).dropDuplicatesWithinWatermark([key])


def windowed_monitor(stream: DataFrame, length: str, offset: str | None = None, delay: str = "2 days") -> DataFrame:
    """Scoring events per tumbling window. Weeks that start on Monday need an offset of 4 days."""
    stamp = F.col("generated_at")
    span = F.window(stamp, length, length, offset) if offset else F.window(stamp, length)
    used = stream.where("event_type = 'risk_score_generated'").withWatermark("generated_at", delay)
    return used.groupBy(span.alias("w")).agg(
        F.count(F.lit(1)).alias("total_scored"),
        count_if(F.col("is_anomaly")).alias("anomalies_flagged"),
        F.avg("final_risk_score").alias("avg_score"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
    ).select(F.col("w.start").alias("window_start"), "total_scored", "anomalies_flagged", "avg_score", "anomaly_rate")


def batches_into(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps each batch as a partition; a replayed batch id changes nothing."""
    return lambda batch, batch_id: sinks.write_batch(batch, path, batch_id)


MONITOR = "window_start timestamp, total_scored bigint, anomalies_flagged bigint, avg_score double, anomaly_rate double"


def monitor_table(stream: DataFrame, length: str, offset: str | None = None) -> DataFrame:
    """Runs the windowed monitor into a table of batches and returns its state, one row per window."""
    spark = stream.sparkSession
    path = new_path(spark, "monitor")
    run_available(windowed_monitor(stream, length, offset), "update", new_path(spark, "monitor-state"), each=batches_into(path))
    return sinks.current_rows(spark, path, MONITOR, ["window_start"])


class ClosedMonitor:
    """Windows of scoring events that are given out once, when the watermark passes their end, beside a table of late rows.

    Spark's own watermark drops late rows without giving them out. Here each batch is held against the newest event of the
    batches before it: rows of a window that has been closed by then, and rows without a time, go to the late table, all
    others are added up by window and kept as one row per batch and window. So every landed row is in exactly one of the two.
    All tables are kept by batch, and a batch looks only at batches before its own: a replay changes nothing. `clock` holds
    one row a batch, `parts` one row per batch and window it touches.
    """

    PARTS = "window_start timestamp, window_end timestamp, total_scored bigint, anomalies_flagged bigint, judged bigint, score_sum double, scores bigint"

    def __init__(self, spark: SparkSession, folder: str, length: str, offset: str | None = None, delay: str = "2 days"):
        self.spark, self.folder, self.length, self.offset, self.delay = spark, folder, length, offset, delay
        for name in ("clock", "parts", "closed", "late"):
            spark.createDataFrame([], f"{sinks.BATCH} long, empty int").write.mode("ignore").partitionBy(sinks.BATCH).parquet(f"{folder}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, {sinks.BATCH} long").parquet(f"{self.folder}/{name}")

    def _limit(self, newest: int | None):
        """End of the last closed window at the most; null before any event."""
        return F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {self.delay}")

    def newest(self, before: int) -> int | None:
        """Newest event time in microseconds of the batches before this one."""
        return self._read("clock", "newest long").where(F.col(sinks.BATCH) < before).agg(F.max("newest")).first()[0]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        used = batch.where("event_type = 'risk_score_generated'").persist()
        try:
            self._take(used, batch_id)
        finally:
            used.unpersist()

    def _take(self, used: DataFrame, batch_id: int) -> None:
        stamp = F.col("generated_at")
        before = self.newest(batch_id)
        span = F.window(stamp, self.length, self.length, self.offset) if self.offset else F.window(stamp, self.length)
        timed = used.withColumn("w", span)
        is_late = F.coalesce(F.col("w.end") <= self._limit(before), F.lit(False))
        late = timed.where(is_late).drop("w").unionByName(used.where(stamp.isNull()))
        sinks.write_batch(late, f"{self.folder}/late", batch_id)
        parts = timed.where(~is_late).groupBy("w").agg(
            F.count(F.lit(1)).alias("total_scored"), count_if(F.col("is_anomaly")).alias("anomalies_flagged"),
            F.count(F.lit(1)).alias("judged"), F.sum("final_risk_score").alias("score_sum"), F.count("final_risk_score").alias("scores"),
        ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_scored", "anomalies_flagged", "judged", "score_sum", "scores")
        sinks.write_batch(parts, f"{self.folder}/parts", batch_id)
        own = used.agg(F.max(F.unix_micros(stamp))).first()[0]
        after = max((n for n in (before, own) if n is not None), default=None)
        sinks.write_batch(self.spark.createDataFrame([(after,)], "newest long").coalesce(1), f"{self.folder}/clock", batch_id)
        fresh = F.col("window_end") <= self._limit(after)
        if before is not None:
            fresh = fresh & (F.col("window_end") > self._limit(before))
        closed = self._read("parts", self.PARTS).where((F.col(sinks.BATCH) <= batch_id) & fresh).groupBy("window_start").agg(
            F.sum("total_scored").alias("total_scored"), F.sum("anomalies_flagged").alias("anomalies_flagged"),
            (F.sum("score_sum") / F.nullif(F.sum("scores"), F.lit(0))).alias("avg_score"),
            (F.sum("anomalies_flagged") / F.sum("judged")).alias("anomaly_rate"),
        )
        sinks.write_batch(closed, f"{self.folder}/closed", batch_id)

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        """Works off what is there; a restart with the same checkpoint goes on behind the last batch."""
        run_available(stream, "append", checkpoint, each=self.take)

    def closed(self) -> DataFrame:
        """One row per closed window; a row once here never changes."""
        return self._read("closed", MONITOR).drop(sinks.BATCH)

    def late(self, schema: str) -> DataFrame:
        """The late rows themselves, with the batch they came in."""
        return self._read("late", schema)


def drift_rows(hours: DataFrame) -> DataFrame:
    """Each run hour against the hour before it, kept where the drift passes a limit.

    The input has one row per hour, so its size is bound by the calendar.
    """
    order = Window.orderBy("window_start")
    moved = F.col("avg_score") - F.lag("avg_score").over(order)
    shifted = F.col("anomaly_rate") - F.lag("anomaly_rate").over(order)
    rows = hours.select("window_start", moved.alias("score_drift"), shifted.alias("rate_drift"))
    return with_severity(rows.where((F.abs("score_drift") > K.SCORE_DRIFT) | (F.abs("rate_drift") > K.RATE_DRIFT)))


def with_severity(rows: DataFrame) -> DataFrame:
    return rows.withColumn("severity", F.when(F.abs("score_drift") > 2 * K.SCORE_DRIFT, "HIGH").otherwise("MEDIUM"))


class HourlyDrift(StatefulProcessor):
    """Keeps the last closed hour of each series and gives out the change to the next one.

    Hours come closed and, batch by batch, in order: the watermark passes an earlier one no later than a later one. So the
    state is one row a series, and what leaves the stream is never taken back.
    """

    HOUR = "window_start timestamp, avg_score double, anomaly_rate double"
    CHANGE = "series string, window_start timestamp, score_drift double, rate_drift double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.HOUR)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("window_start", kind="stable")
        starts, scores, rates = (hours[c].tolist() for c in ("window_start", "avg_score", "anomaly_rate"))
        held = self.last.get() if self.last.exists() else None
        if held is not None:
            scores, rates = [held[1], *scores], [held[2], *rates]
            moved = starts
        else:
            moved = starts[1:]
        self.last.update((starts[-1].to_pydatetime(), float(scores[-1]), float(rates[-1])))
        if moved:
            yield pd.DataFrame({"series": key[0], "window_start": moved, "score_drift": np.diff(scores), "rate_drift": np.diff(rates)})

    def close(self) -> None:
        pass


def drift_stream(stream: DataFrame, delay: str = "2 days", series: str = "all") -> DataFrame:
    """Hours whose score or anomaly rate moved past a limit against the hour before, as they are closed by the watermark."""
    hours = windowed_monitor(stream, "1 hour", delay=delay).select(F.lit(series).alias("series"), "window_start", "avg_score", "anomaly_rate")
    moved = hours.groupBy("series").transformWithStateInPandas(HourlyDrift(), HourlyDrift.CHANGE, "Append", "None")
    return with_severity(moved.where((F.abs("score_drift") > K.SCORE_DRIFT) | (F.abs("rate_drift") > K.RATE_DRIFT)))


def streamed_drift(stream: DataFrame, path: str, checkpoint: str, delay: str = "2 days") -> DataFrame:
    """Works off what is there into a table of drift rows and returns it; a restart goes on behind the last closed hour."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        run_available(drift_stream(stream, delay), "append", checkpoint, path=path)
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)
    return spark.read.schema(f"{HourlyDrift.CHANGE}, severity string").parquet(path)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
