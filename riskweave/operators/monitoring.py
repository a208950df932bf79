"""Audit statistics, run history, drift and bias."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import count_if, rate
from riskweave.functions.order_stats import percentiles

UPPER = ("HIGH", "CRITICAL")


def audit_log(audit: DataFrame, as_of: datetime, days: int = 30, cik: str | None = None, event_type: str | None = None) -> DataFrame:
    """Events of the last days before `as_of`, newest first."""
    out = audit.where(F.col("generated_at") >= F.lit(as_of) - F.make_dt_interval(F.lit(days)))
    if cik is not None:
        out = out.where(F.col("cik") == cik)
    if event_type is not None:
        out = out.where(F.col("event_type") == event_type)
    return out.orderBy(F.desc("generated_at"), "audit_id")


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("cik").alias("companies"),
        count_if(F.col("event_type") == "risk_score_generated").alias("scoring_events"),
        count_if(F.col("human_reviewed")).alias("human_reviews"),
        count_if(F.col("final_risk_tier").isin(*UPPER)).alias("high_risk_events"),
        F.min("generated_at").alias("first_event"),
        F.max("generated_at").alias("last_event"),
    )


def card_statistics(audit: DataFrame) -> DataFrame:
    """Live figures of the model card."""
    scoring = F.col("event_type") == "risk_score_generated"
    return audit.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("cik").alias("companies"),
        count_if(scoring).alias("scored"),
        F.avg(F.when(scoring, F.col("is_anomaly").cast("int"))).alias("anomaly_rate"),
        F.avg(F.when(scoring, F.col("final_risk_score"))).alias("avg_score"),
    )


def events_by_type(audit: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    used = audit.where(F.col("generated_at") > F.lit(as_of) - F.make_dt_interval(F.lit(days)))
    return used.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("cik").alias("unique_companies"),
        count_if(F.col("human_reviewed")).alias("human_reviews"),
        count_if(F.col("review_action") == "escalated").alias("escalations"),
        count_if(F.col("final_risk_tier").isin(*UPPER)).alias("high_risk_flags"),
    )


def daily_trend(audit: DataFrame, as_of: datetime, days: int = 90) -> DataFrame:
    used = audit.where(
        (F.col("event_type") == "risk_score_generated") & (F.col("generated_at") > F.lit(as_of) - F.make_dt_interval(F.lit(days)))
    )
    return used.groupBy(F.col("generated_at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("total_scored"),
        count_if(F.col("is_anomaly")).alias("anomalies_flagged"),
        F.avg("final_risk_score").alias("avg_risk_score"),
        count_if(F.col("final_risk_tier").isin(*UPPER)).alias("high_risk_count"),
    )


def weekly_performance(audit: DataFrame, as_of: datetime, days: int = 180) -> DataFrame:
    """Weeks start on Monday."""
    used = audit.where(
        (F.col("event_type") == "risk_score_generated") & (F.col("generated_at") > F.lit(as_of) - F.make_dt_interval(F.lit(days)))
    ).withColumn("week", F.date_trunc("week", "generated_at").cast("date"))
    p90 = percentiles(used, ["final_risk_score"], [0.9], ["week"]).select("week", F.col("p0").alias("p90_score"))
    out = used.groupBy("week").agg(
        F.avg("ml_risk_score").alias("avg_ml_score"),
        F.avg("final_risk_score").alias("avg_final_score"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
    )
    return out.join(p90, "week", "left")


def non_conforming(conformity: DataFrame) -> DataFrame:
    return (
        conformity.where("conformity_rating = 'Non-conforming'")
        .select("ticker", "company_name", "mad_score", "benford_risk_score", "chi_square_p_value", "interpretation")
        .orderBy(F.desc("benford_risk_score"), "ticker")
    )


def run_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count(F.lit(1)).alias("n_companies"),
        F.avg("final_risk_score").alias("avg_score"),
        F.stddev_samp("final_risk_score").alias("std_score"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
        count_if(F.col("final_risk_tier") == "CRITICAL").alias("critical_count"),
    )


def hourly_runs(audit: DataFrame, last: int | None = 5) -> DataFrame:
    """Scores per run hour, newest first."""
    out = audit.where("event_type = 'risk_score_generated'").groupBy(F.date_trunc("hour", "generated_at").alias("run_hour")).agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.avg("final_risk_score").alias("avg_score"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
    )
    out = out.orderBy(F.desc("run_hour"))
    return out.limit(last) if last else out


def drift_alerts(runs: DataFrame) -> DataFrame:
    """Alerts of the newest run against the run before it; `runs` is the short run list.

    No row comes out when there are fewer than two runs or nothing moved enough.
    """
    newest = Window.orderBy(F.desc("run_hour"))
    # the run list is cut to a handful of rows before this window
    pair = runs.select(
        "run_hour", "avg_score", "anomaly_rate",
        F.lead("avg_score").over(newest).alias("prev_score"),
        F.lead("anomaly_rate").over(newest).alias("prev_rate"),
        F.row_number().over(newest).alias("_n"),
    ).where("_n = 1 and prev_score is not null")
    moved = F.col("avg_score") - F.col("prev_score")
    shifted = F.col("anomaly_rate") - F.col("prev_rate")
    score = F.when(F.abs(moved) > K.SCORE_DRIFT, F.struct(
        F.lit("SCORE_DRIFT").alias("type"),
        F.when(F.abs(moved) > 2 * K.SCORE_DRIFT, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.format_string("Average risk score shifted %+.1f points (%.1f → %.1f)", moved, F.col("prev_score"), F.col("avg_score")).alias("message"),
    ))
    share = F.when(F.abs(shifted) > K.RATE_DRIFT, F.struct(
        F.lit("ANOMALY_RATE_DRIFT").alias("type"),
        F.lit("MEDIUM").alias("severity"),
        F.format_string("Anomaly rate changed %+.1f%% (%.1f%% → %.1f%%)", shifted * 100, F.col("prev_rate") * 100, F.col("anomaly_rate") * 100).alias("message"),
    ))
    return pair.select(
        "run_hour", F.round(moved, 2).alias("score_drift"), F.round(shifted, 4).alias("anomaly_rate_drift"),
        F.inline(F.array_compact(F.array(score, share))),
    )


def drift_report(runs: DataFrame) -> DataFrame:
    """One row: status and drift of the newest run, or a note that history is too short."""
    newest = Window.orderBy(F.desc("run_hour"))
    pair = runs.select(
        F.lead("avg_score").over(newest).alias("prev_score"), F.lead("anomaly_rate").over(newest).alias("prev_rate"),
        "avg_score", "anomaly_rate", F.row_number().over(newest).alias("_n"), F.count(F.lit(1)).over(Window.partitionBy()).alias("history_runs"),
    ).where("_n = 1")
    moved, shifted = F.col("avg_score") - F.col("prev_score"), F.col("anomaly_rate") - F.col("prev_rate")
    alerting = (F.abs(moved) > K.SCORE_DRIFT) | (F.abs(shifted) > K.RATE_DRIFT)
    return pair.select(
        F.when(alerting, "alerts").otherwise("ok").alias("status"),
        F.when(F.col("history_runs") < 2, "Insufficient history for comparison").alias("message"),
        F.round(moved, 2).alias("score_drift"), F.round(shifted, 4).alias("anomaly_rate_drift"), "history_runs",
        F.round("avg_score", 1).alias("current_avg_score"), F.round("prev_score", 1).alias("previous_avg_score"),
    )


# --- bias -------------------------------------------------------------------------------------------


def bias_by_dimension(scores: DataFrame, dimensions: Sequence[str], score: str = "final_risk_score") -> DataFrame:
    """Group statistics for every dimension in one pass over the scores."""
    whole = scores.agg(F.avg(score).alias("m"), F.stddev_samp(score).alias("s")).select(F.struct("m", "s")).scalar()
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("group")) for d in dimensions])
    long = scores.select(F.inline(cells), F.col(score).alias("score")).where(F.col("group").isNotNull())
    med = percentiles(long, ["score"], [0.5], ["dimension", "group"]).select("dimension", "group", F.col("p0").alias("median_score"))
    out = long.groupBy("dimension", "group").agg(
        F.avg("score").alias("mean_score"),
        F.stddev_samp("score").alias("std_score"),
        F.count("score").alias("company_count"),
        count_if(F.col("score") > 70).alias("high_risk_count"),
    )
    z = (F.col("mean_score") - F.col("_w.m")) / F.greatest(F.coalesce("_w.s", F.lit(0.0)), F.lit(0.001))
    return (
        out.join(med, ["dimension", "group"], "left")
        .withColumn("_w", whole)
        .withColumns({"high_risk_rate": F.col("high_risk_count") / F.col("company_count"), "z_score": z,
                      "deviation_from_mean": F.round(F.col("mean_score") - F.col("_w.m"), 1)})
        .withColumns({
            "bias_flag": F.abs("z_score") > K.BIAS_CUT,
            "bias_direction": F.when(F.col("z_score") > K.BIAS_CUT, "Over-scored")
            .when(F.col("z_score") < -K.BIAS_CUT, "Under-scored").otherwise("Normal"),
        })
        .drop("_w")
    )


def bias_summary(groups: DataFrame, scores: DataFrame, score: str = "final_risk_score") -> DataFrame:
    """Severity, counts and wording per dimension; at most three names per direction are gathered."""
    mean = scores.agg(F.avg(score)).scalar()
    stats = groups.groupBy("dimension").agg(
        F.max(F.abs("z_score")).alias("max_z"), count_if(F.col("bias_flag")).alias("flagged_groups"), F.count(F.lit(1)).alias("groups")
    )
    ranked = groups.where("bias_flag").withColumn(
        "_n", F.row_number().over(Window.partitionBy("dimension", "bias_direction").orderBy("group"))
    ).where("_n <= 3")
    names = ranked.groupBy("dimension").agg(*[
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("bias_direction") == d, F.col("group")))), ", ").alias(c)
        for d, c in (("Over-scored", "over"), ("Under-scored", "under"))
    ])
    severity = (
        F.when(F.col("max_z") > 3.0, "HIGH").when(F.col("max_z") > 2.0, "MEDIUM").when(F.col("max_z") > K.BIAS_CUT, "LOW").otherwise("NONE")
    )
    # Wording of the findings.
    none = F.format_string(
        "No systematic bias detected across %s groups. Risk scores are distributed consistently (mean=%.1f).", F.col("dimension"), F.col("overall_mean")
    )
    found = F.concat_ws(
        " ",
        F.format_string("Bias severity: %s.", F.col("bias_severity")),
        F.when(F.col("over") != "", F.format_string("Over-scored groups: %s.", F.col("over"))),
        F.when(F.col("under") != "", F.format_string("Under-scored groups: %s.", F.col("under"))),
        F.lit("Recommend: review feature engineering for these groups and validate with domain expert before production deployment."),
    )
    return (
        stats.join(names, "dimension", "left")
        .withColumns({"bias_severity": severity, "bias_detected": F.col("flagged_groups") > 0, "overall_mean": mean})
        .withColumn("interpretation", F.when(F.col("bias_detected"), found).otherwise(none))
        .drop("over", "under")
    )
