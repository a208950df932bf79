"""Scores of the three signals fused into one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import at_most, clamp, tier
from riskweave.functions.order_stats import mean_rank

WIDE_FLAGS = K.FLAGS
WIDE_RATIOS = ["revenue_yoy_growth", "gross_margin", "operating_margin", "current_ratio", "debt_to_equity", "ar_to_revenue"]


def model_scores(decisions: DataFrame, companies: DataFrame) -> DataFrame:
    """Decision values to percentile, anomaly mark and model score.

    The lowest decision is the most unusual; ties share their mean rank.
    """
    ranked = mean_rank(decisions, "decision")
    pct = (1 - F.col("mean_rank") / F.col("n_rows")) * 100
    who = companies.select("cik", "ticker", "company_name", "industry_group")
    return ranked.join(who, "cik").select(
        "cik", "ticker", "company_name", "industry_group",
        F.round("decision", 4).alias("isolation_forest_score"),
        F.round(pct, 1).alias("anomaly_percentile"),
        F.round(at_most(pct * 0.6 + F.coalesce("pre_ml_risk_score", F.lit(0.0)) * 0.4, 100), 1).alias("ml_risk_score"),
        (F.col("decision") < 0).alias("is_anomaly"),
        F.coalesce("pre_ml_risk_score", F.lit(0.0)).alias("pre_ml_risk_score"),
        tier(F.coalesce("pre_ml_risk_score", F.lit(0.0))).alias("risk_tier"),
    )


def fused(ml: Column, benford: Column, network: Column) -> Column:
    w = K.FUSION_WEIGHTS
    return F.round(clamp(ml * w["ml"] + benford * w["benford"] + network * w["network"], 0, 100), 2)


def final_scores(ml: DataFrame, conformity: DataFrame, network: DataFrame) -> DataFrame:
    """One row per scored company; a missing signal counts 0. All three inputs hold one row per company."""
    b = conformity.select("cik", "benford_risk_score")
    n = network.select("cik", "network_risk_score")
    out = ml.select("cik", "ticker", "company_name", "industry_group", "ml_risk_score", "is_anomaly").join(b, "cik", "left").join(n, "cik", "left")
    out = out.na.fill(0.0, ["ml_risk_score", "benford_risk_score", "network_risk_score"])
    score = fused(F.col("ml_risk_score"), F.col("benford_risk_score"), F.col("network_risk_score"))
    out = out.withColumn("final_risk_score", score).withColumn("final_risk_tier", tier("final_risk_score"))
    return out.withColumn("network_risk_score", F.round("network_risk_score", 4))


def wide_scores(final: DataFrame, ml: DataFrame, conformity: DataFrame, candidates: DataFrame) -> DataFrame:
    """All signals of a company side by side."""
    f = final.select("cik", "ticker", "company_name", "ml_risk_score", "benford_risk_score",
                     F.col("network_risk_score").alias("network_risk"), "final_risk_score", "final_risk_tier")
    m = ml.select("cik", "is_anomaly", "anomaly_percentile", "isolation_forest_score")
    b = conformity.select("cik", "conformity_rating", "mad_score")
    r = candidates.select("cik", "dominant_signal", "total_signal_count", *WIDE_FLAGS, "latest_period", *WIDE_RATIOS,
                          "late_filings_count", "has_late_filings", "industry_group")
    return f.join(m, "cik", "left").join(b, "cik", "left").join(r, "cik", "left")


def signal_summary() -> Column:
    """Raised signals as text lines."""
    # Wording of the lines.
    lines = [F.when(F.col("dominant_signal") != "None", F.concat(F.lit("  • Dominant: "), "dominant_signal", F.lit(" (+0.28)")))]
    lines += [F.when(F.col(f) == 1, F.lit(f"  • {text}")) for f, text in K.SIGNAL_TEXT.items()]
    told = F.array_compact(F.array(*lines))
    return F.when(F.size(told) > 0, F.array_join(told, "\n")).otherwise("  • No individual signals triggered")


def tone_line() -> Column:
    """The tone of a company's filings as a text line; a company without filing texts has none of the marks."""
    mark = lambda c: F.when(F.col(c), "True").otherwise("False")
    return F.format_string(
        "Language risk %.1f, going concern %s, restatement %s, legal risk %s", F.coalesce("language_risk_score", F.lit(0.0)),
        mark("going_concern_detected"), mark("restatement_risk"), mark("legal_risk_detected"))


def evidence_sheets(wide: DataFrame, tone: DataFrame | None = None) -> DataFrame:
    """The numbers behind a company's brief as text; with `tone`, one row per company, its filing tone at the end."""
    lines = [
        F.format_string("%s (%s)", "company_name", "ticker"),
        F.format_string("Final score %.1f/100, tier %s", "final_risk_score", "final_risk_tier"),
        F.format_string("ML score %.1f, percentile %.0f", "ml_risk_score", "anomaly_percentile"),
        F.format_string("First-digit MAD %.5f, %s", "mad_score", "conformity_rating"),
        F.format_string("Network risk %.1f", "network_risk"),
        signal_summary(),
    ]
    if tone is not None:
        wide = wide.join(tone.select("cik", "language_risk_score", "going_concern_detected", "restatement_risk", "legal_risk_detected"), "cik", "left")
        lines.append(tone_line())
    return wide.select("cik", "company_name", F.col("final_risk_score").alias("risk_score"), F.concat_ws("\n", *lines).alias("evidence"))
