"""Daily sketches of audit events: reports over many days read a row per day and event type, not the events."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.exprs import count_if
from riskweave.operators.monitoring import UPPER

COMPANY_BITS = 14  # 2^14 registers: the standard error of a distinct count is below 1 %
SCORE_K = 400  # a quantile lies within 1 % of its rank, by the bound of the sketch
RANK_ERROR = 0.02
COUNT_ERROR = 0.04


def daily(audit: DataFrame) -> DataFrame:
    """One row per day and event type: counts, sums, companies seen and the distribution of final scores.

    Sketches are combined per task before the shuffle, so a day or type with most of the events leaves each task as one row.
    Events without a time belong to no day and are left out.
    """
    kept = audit.where("generated_at IS NOT NULL").withColumn("day", F.col("generated_at").cast("date"))
    return kept.groupBy("day", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        count_if(F.col("human_reviewed")).alias("human_reviews"),
        count_if(F.col("review_action") == "escalated").alias("escalations"),
        count_if(F.col("final_risk_tier").isin(*UPPER)).alias("high_risk_flags"),
        count_if(F.col("is_anomaly")).alias("anomalies"),
        F.sum("ml_risk_score").alias("ml_sum"), F.count("ml_risk_score").alias("ml_rows"),
        F.sum("final_risk_score").alias("final_sum"), F.count("final_risk_score").alias("final_rows"),
        F.hll_sketch_agg("cik", F.lit(COMPANY_BITS)).alias("companies"),
        F.kll_sketch_agg_double(F.col("final_risk_score").cast("double"), F.lit(SCORE_K)).alias("scores"),
    )


def write_days(audit: DataFrame, path: str) -> None:
    """The days of these events anew; other days of the table stay. The input must hold all events of its days."""
    rows = daily(audit).repartition("day")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))


def _since(days: DataFrame, as_of: date, length: int) -> DataFrame:
    return days.where(F.col("day") >= F.lit(as_of - timedelta(days=length)))


def events_by_type(days: DataFrame, as_of: date, length: int = 30) -> DataFrame:
    """Events of the last whole days by type; companies are counted by merged sketches."""
    total = {c: F.sum(c).alias(c) for c in ("human_reviews", "escalations", "high_risk_flags")}
    return _since(days, as_of, length).groupBy("event_type").agg(
        F.sum("events").alias("total_events"),
        F.hll_sketch_estimate(F.hll_union_agg("companies")).alias("unique_companies"),
        *total.values(),
    )


def _mean(total: str, rows: str) -> Column:
    return F.sum(total) / F.nullif(F.sum(rows), F.lit(0))


def weekly_performance(days: DataFrame, as_of: date, length: int = 180, share: float = 0.9) -> DataFrame:
    """Scoring events by week from Monday on, with a quantile of the merged score sketches; null where a week has no score."""
    used = _since(days, as_of, length).where("event_type = 'risk_score_generated'")
    weeks = used.groupBy(F.date_trunc("week", "day").cast("date").alias("week")).agg(
        _mean("ml_sum", "ml_rows").alias("avg_ml_score"),
        _mean("final_sum", "final_rows").alias("avg_final_score"),
        _mean("anomalies", "events").alias("anomaly_rate"),
        F.sum("final_rows").alias("_n"),
        F.kll_merge_agg_double("scores").alias("_scores"),
    )
    quantile = F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_scores", F.lit(share)))
    return weeks.withColumn(f"p{round(share * 100)}_score", quantile).drop("_n", "_scores")
