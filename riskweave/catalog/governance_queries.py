"""Reports, monitoring, bias, audit and explanation queries."""

from datetime import datetime

from pyspark.sql import functions as F

from riskweave.catalog.base import CTES, query, rnd, rounded, sql_list
from riskweave.functions import constants as K
from riskweave.functions.order_stats import percentiles
from riskweave.operators import explain, governance, sketches
from riskweave.operators import monitoring as M
from riskweave.plans import reports as R
from riskweave.session import new_path, spread_by

AS_OF = datetime(2024, 1, 31)
_AS_OF = "TIMESTAMP '2024-01-31'"


# --- short lists ----------------------------------------------------------------------------------------


@query("tk01_top_model_scores", "SELECT cik, ticker, ml_risk_score FROM t_scored ORDER BY ml_risk_score DESC, cik LIMIT 10")
def _(t):
    return R.top(t.scored, "ml_risk_score", 10).select("cik", "ticker", "ml_risk_score")


@query("tk02_top_final_scores", "SELECT cik, ticker, final_risk_score, final_risk_tier FROM t_scored ORDER BY final_risk_score DESC, cik LIMIT 5")
def _(t):
    return R.top(t.scored, "final_risk_score", 5).select("cik", "ticker", "final_risk_score", "final_risk_tier")


@query("tk08_saved_high_risk", "SELECT ticker, company_name, industry_group, final_risk_score, final_risk_tier, ml_risk_score, benford_risk_score, network_risk_score, is_anomaly FROM t_scored WHERE final_risk_score > 70 ORDER BY final_risk_score DESC, cik LIMIT 50")
def _(t):
    return R.top(t.scored.where("final_risk_score > 70"), "final_risk_score", 50).select(
        "ticker", "company_name", "industry_group", "final_risk_score", "final_risk_tier", "ml_risk_score", "benford_risk_score", "network_risk_score", "is_anomaly")


@query("tk09_display_rows", f"SELECT cik, ticker, final_risk_tier, {rnd('final_risk_score', 1)} AS final_risk_score FROM t_scored ORDER BY t_scored.final_risk_score DESC, cik LIMIT 20")
def _(t):
    return R.display_rows(t.scored, 20).select("cik", "ticker", "final_risk_tier", "final_risk_score")


@query("tk10_sorted_scores", "SELECT cik, final_risk_score FROM t_scored ORDER BY final_risk_score DESC, cik")
def _(t):
    return t.scored.select("cik", "final_risk_score").orderBy(F.desc("final_risk_score"), "cik")


@query("prj26_filtered_scores", "SELECT cik, final_risk_score FROM t_scored WHERE industry_group = 'BUILDING' AND final_risk_tier = 'HIGH' AND final_risk_score >= 72")
def _(t):
    return R.filtered(t.scored, "BUILDING", "HIGH", 72).select("cik", "final_risk_score")


@query("prj13_conformity_labels", "SELECT CASE WHEN n < 50 THEN 'Insufficient Data' WHEN m < 0.006 THEN 'Acceptable' WHEN m < 0.012 THEN 'Marginal' ELSE 'Non-conforming' END AS rating, count(*) AS companies FROM (SELECT abs(c_acctbal) / 500000 AS m, c_custkey % 400 AS n FROM customer) GROUP BY 1")
def _(t):
    from riskweave.operators.first_digit import rating

    c = t.raw("customer").select((F.abs("c_acctbal") / 500000).alias("m"), (F.col("c_custkey") % 400).alias("n"))
    return c.groupBy(rating(F.col("m"), F.col("n")).alias("rating")).agg(F.count("*").alias("companies"))


@query("prj17_fused_scores", f"SELECT cik, {rnd('greatest(least(ml_risk_score * 0.5::DOUBLE + benford_risk_score * 0.3::DOUBLE + network_risk_score * 0.2::DOUBLE, 100), 0)', 2)} AS final_score FROM t_scored")
def _(t):
    from riskweave.plans.fusion import fused

    return t.scored.select("cik", fused(F.col("ml_risk_score"), F.col("benford_risk_score"), F.col("network_risk_score")).alias("final_score"))


def _case(scale):
    cuts, rest = K.TIERS[scale]
    return "CASE " + " ".join(f"WHEN final_risk_score >= {c} THEN '{n}'" for c, n in cuts) + f" ELSE '{rest}' END"


@query("prj18_tier_scales", f"SELECT {_case('scorer')} AS scorer_tier, {_case('card')} AS card_tier, count(*) AS companies, count(*) FILTER (final_risk_score >= 65) AS anomalies FROM t_scored GROUP BY 1, 2")
def _(t):
    from riskweave.functions.exprs import count_if, tier

    return t.scored.groupBy(tier("final_risk_score").alias("scorer_tier"), tier("final_risk_score", "card").alias("card_tier")).agg(
        F.count("*").alias("companies"), count_if(F.col("final_risk_score") >= 65).alias("anomalies"))


@query("prj20_signal_contributions", f"SELECT cik, 'ML Anomaly' AS signal, {rnd('ml_risk_score * 0.5::DOUBLE', 4)} AS contribution FROM t_scored UNION ALL SELECT cik, 'Benford', {rnd('benford_risk_score * 0.3::DOUBLE', 4)} FROM t_scored UNION ALL SELECT cik, 'Network', {rnd('network_risk_score * 0.2::DOUBLE', 4)} FROM t_scored")
def _(t):
    return rounded(R.signal_contributions(t.scored, "cik"), 4)


@query("prj30_late_filer_labels", "SELECT cik, CASE WHEN late_filings_count > 0 THEN 'Late Filer' ELSE 'On-Time Filer' END AS filing_behavior FROM t_scored")
def _(t):
    return t.scored.select("cik", F.when(F.col("late_filings_count") > 0, "Late Filer").otherwise("On-Time Filer").alias("filing_behavior"))


@query("prj32_brief_previews", "SELECT doc_id AS cik, n_chars::DOUBLE AS risk_score, left(text, 200) AS preview FROM documents")
def _(t):
    briefs = t.raw("documents").select(F.col("doc_id").alias("cik"), F.col("n_chars").cast("double").alias("risk_score"), F.col("text").alias("brief"))
    return R.brief_previews(briefs)


@query("jn05_fused_with_missing", f"""SELECT m.cik, m.ml_risk_score, coalesce(b.v, 0) AS benford_risk_score, coalesce(n.v, 0) AS network_risk_score,
 {rnd('greatest(least(m.ml_risk_score * 0.5::DOUBLE + coalesce(b.v, 0) * 0.3::DOUBLE + coalesce(n.v, 0) * 0.2::DOUBLE, 100), 0)', 2)} AS final_risk_score FROM t_scored m
 LEFT JOIN (SELECT cik, benford_risk_score AS v FROM t_scored WHERE late_filings_count > 0) b ON m.cik = b.cik LEFT JOIN (SELECT cik, network_risk_score AS v FROM t_scored WHERE is_anomaly) n ON m.cik = n.cik""")
def _(t):
    from riskweave.plans.fusion import final_scores

    s = t.scored
    out = final_scores(s, s.where("late_filings_count > 0"), s.where("is_anomaly"))
    return out.select("cik", "ml_risk_score", "benford_risk_score", "network_risk_score", "final_risk_score")


# --- report aggregates --------------------------------------------------------------------------------------


@query("ag22_executive_kpis", f"""SELECT count(*) AS total, count(*) FILTER (final_risk_tier = 'CRITICAL') AS critical, count(*) FILTER (final_risk_tier = 'HIGH') AS high, count(*) FILTER (is_anomaly) AS anomalies,
 {rnd('avg(final_risk_score)', 1)} AS avg_score, {rnd("count(*) FILTER (final_risk_tier = 'CRITICAL') * 100.0::DOUBLE / count(*)", 1)} AS critical_pct, {rnd("count(*) FILTER (final_risk_tier = 'HIGH') * 100.0::DOUBLE / count(*)", 1)} AS high_pct,
 {rnd('count(*) FILTER (is_anomaly) * 100.0::DOUBLE / count(*)', 1)} AS anomalies_pct FROM t_scored""")
def _(t):
    return R.executive_kpis(t.scored)


@query("ag23_tier_counts", "SELECT final_risk_tier AS tier, count(*) AS companies FROM t_scored GROUP BY 1")
def _(t):
    return R.tier_counts(t.scored)


@query("ag24_industry_by_tier", "SELECT industry_group, " + ", ".join(f"count(*) FILTER (final_risk_tier = '{x}') AS {x}" for x in K.TIER_ORDER) + " FROM t_scored GROUP BY 1")
def _(t):
    return R.industry_by_tier(t.scored)


_HIST = f"SELECT bin, {rnd('lo + bin * w', 6)} AS bin_start, count(*) AS n FROM (SELECT lo, (hi - lo) / 20 AS w, CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin FROM (SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM (SELECT {{v}} AS v FROM {{src}}))) GROUP BY bin, lo, w"


@query("ag25_price_histogram", _HIST.format(v="l_extendedprice", src="lineitem"))
def _(t):
    return rounded(R.histogram(t.raw("lineitem"), "l_extendedprice"))


@query("ag26_score_histogram", _HIST.format(v="final_risk_score", src="t_scored"))
def _(t):
    return rounded(R.histogram(t.scored, "final_risk_score"))


@query("ag29_training_metrics", f"SELECT count(*) AS n_companies, count(*) FILTER (is_anomaly) AS n_anomalies, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)')} AS anomaly_rate, count(*) FILTER (ml_risk_score > 70) AS high_risk_companies, {rnd('avg(ml_risk_score)', 4)} AS avg_risk_score, (SELECT count(*) FROM benford WHERE conformity_rating = 'Non-conforming') AS benford_non_conforming FROM t_scored")
def _(t):
    from riskweave.operators.first_digit import company_conformity

    out = R.training_metrics(t.scored, company_conformity(t.facts, t.companies))
    return rounded(out.withColumn("avg_risk_score", F.round("avg_risk_score", 4)))


@query("ag32_treemap", f"SELECT industry_group, ticker, CAST(grouping_id(industry_group, ticker) AS INT) AS level, count(*) AS companies, {rnd('sum(final_risk_score)', 2)} AS score FROM t_scored GROUP BY ROLLUP (industry_group, ticker)")
def _(t):
    return rounded(R.treemap(t.scored), 2)


@query("ag33_industry_profile", f"SELECT industry_group, count(*) AS company_count, {rnd('avg(final_risk_score)', 4)} AS avg_risk, {rnd('median(final_risk_score)', 4)} AS median_risk, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)', 4)} AS anomaly_rate, count(*) FILTER (final_risk_tier = 'CRITICAL') AS critical_count, count(*) FILTER (final_risk_tier = 'HIGH') AS high_count FROM t_scored GROUP BY 1")
def _(t):
    return rounded(R.industry_profile(t.scored), 4)


@query("ag37_communities", f"SELECT community_id, count(*) AS company_count, {rnd('avg(final_risk_score)', 4)} AS avg_risk, count(*) FILTER (is_anomaly) AS anomaly_count, array_to_string(list(ticker ORDER BY ticker)[1:5], ',') AS companies FROM t_scored WHERE community_id >= 0 GROUP BY 1 HAVING avg(final_risk_score) > 50")
def _(t):
    return rounded(R.community_list(t.scored), 4)


@query("ag38_late_filer_comparison", f"SELECT CASE WHEN late_filings_count > 0 THEN 'Late Filer' ELSE 'On-Time Filer' END AS filing_behavior, count(*) AS company_count, {rnd('avg(final_risk_score)', 4)} AS avg_risk_score, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)', 4)} AS anomaly_rate FROM t_scored GROUP BY 1")
def _(t):
    return rounded(R.late_filer_comparison(t.scored), 4)


# --- audit and monitoring ------------------------------------------------------------------------------------


@query("prj27_audit_log", f"SELECT audit_id, cik, event_type, final_risk_score FROM t_audit WHERE generated_at >= {_AS_OF} - INTERVAL 7 DAY AND event_type = 'human_review'")
def _(t):
    return M.audit_log(t.audit, AS_OF, 7, event_type="human_review").select("audit_id", "cik", "event_type", "final_risk_score")


@query("ag11_audit_summary", "SELECT count(*) AS total_events, count(DISTINCT cik) AS companies, count(*) FILTER (event_type = 'risk_score_generated') AS scoring_events, count(*) FILTER (human_reviewed) AS human_reviews, count(*) FILTER (final_risk_tier IN ('HIGH','CRITICAL')) AS high_risk_events, strftime(min(generated_at), '%Y-%m-%d %H:%M:%S') AS first_event, strftime(max(generated_at), '%Y-%m-%d %H:%M:%S') AS last_event FROM t_audit")
def _(t):
    form = "yyyy-MM-dd HH:mm:ss"
    return M.audit_summary(t.audit).withColumns({c: F.date_format(c, form) for c in ("first_event", "last_event")})


@query("gv04_card_statistics", f"SELECT count(*) AS total_events, count(DISTINCT cik) AS companies, count(*) FILTER (event_type = 'risk_score_generated') AS scored, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END) FILTER (event_type = ' + chr(39) + 'risk_score_generated' + chr(39) + ')')} AS anomaly_rate, {rnd('avg(final_risk_score) FILTER (event_type = ' + chr(39) + 'risk_score_generated' + chr(39) + ')', 4)} AS avg_score FROM t_audit")
def _(t):
    return rounded(M.card_statistics(t.audit).withColumn("avg_score", F.round("avg_score", 4)))


@query("ag12_anomaly_rate", f"SELECT {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)')} AS anomaly_rate FROM t_audit WHERE event_type = 'risk_score_generated'")
def _(t):
    return rounded(M.card_statistics(t.audit).select("anomaly_rate"))


@query("ag13_run_summary", f"SELECT count(*) AS n_companies, {rnd('avg(final_risk_score)', 4)} AS avg_score, {rnd('stddev_samp(final_risk_score)', 4)} AS std_score, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)', 4)} AS anomaly_rate, count(*) FILTER (final_risk_tier = 'CRITICAL') AS critical_count FROM t_scored")
def _(t):
    return rounded(M.run_summary(t.scored), 4)


CTES["hours"] = "SELECT date_trunc('hour', generated_at) AS run_hour, count(*) AS n_scored, avg(final_risk_score) AS avg_score, avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END) AS anomaly_rate FROM t_audit WHERE event_type = 'risk_score_generated' GROUP BY 1"


def _stamp(df, column):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


@query("ag14_hourly_runs", f"SELECT strftime(run_hour, '%Y-%m-%d %H:%M:%S') AS run_hour, n_scored, {rnd('avg_score', 4)} AS avg_score, {rnd('anomaly_rate', 4)} AS anomaly_rate FROM hours ORDER BY hours.run_hour DESC LIMIT 5")
def _(t):
    return rounded(_stamp(M.hourly_runs(t.audit), "run_hour"), 4)


CTES["pair"] = "SELECT run_hour, avg_score - lag(avg_score) OVER (ORDER BY run_hour) AS moved, anomaly_rate - lag(anomaly_rate) OVER (ORDER BY run_hour) AS shifted, avg_score, anomaly_rate, lag(avg_score) OVER (ORDER BY run_hour) AS prev_score, lag(anomaly_rate) OVER (ORDER BY run_hour) AS prev_rate FROM hours ORDER BY run_hour DESC LIMIT 1"


@query("wn14_drift_report", f"SELECT CASE WHEN abs(moved) > 10 OR abs(shifted) > 0.05 THEN 'alerts' ELSE 'ok' END AS status, NULL::VARCHAR AS message, {rnd('moved', 2)} AS score_drift, {rnd('shifted', 4)} AS anomaly_rate_drift, 5 AS history_runs, {rnd('avg_score', 1)} AS current_avg_score, {rnd('prev_score', 1)} AS previous_avg_score FROM pair")
def _(t):
    return M.drift_report(M.hourly_runs(t.audit))


@query("prj28_drift_alerts", f"""SELECT type, severity, {rnd('moved', 2)} AS score_drift, {rnd('shifted', 4)} AS anomaly_rate_drift FROM (
 SELECT 'SCORE_DRIFT' AS type, CASE WHEN abs(moved) > 20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, moved, shifted FROM pair WHERE abs(moved) > 10
 UNION ALL SELECT 'ANOMALY_RATE_DRIFT', 'MEDIUM', moved, shifted FROM pair WHERE abs(shifted) > 0.05)""")
def _(t):
    return M.drift_alerts(M.hourly_runs(t.audit)).select("type", "severity", "score_drift", "anomaly_rate_drift")


@query("ag34_daily_trend", f"SELECT CAST(generated_at AS DATE) AS day, count(*) AS total_scored, count(*) FILTER (is_anomaly) AS anomalies_flagged, {rnd('avg(final_risk_score)', 4)} AS avg_risk_score, count(*) FILTER (final_risk_tier IN ('HIGH','CRITICAL')) AS high_risk_count FROM t_audit WHERE event_type = 'risk_score_generated' AND generated_at > {_AS_OF} - INTERVAL 90 DAY GROUP BY 1")
def _(t):
    return rounded(M.daily_trend(t.audit, AS_OF), 4)


@query("ag35_events_by_type", f"SELECT event_type, count(*) AS total_events, count(DISTINCT cik) AS unique_companies, count(*) FILTER (human_reviewed) AS human_reviews, count(*) FILTER (review_action = 'escalated') AS escalations, count(*) FILTER (final_risk_tier IN ('HIGH','CRITICAL')) AS high_risk_flags FROM t_audit WHERE generated_at > {_AS_OF} - INTERVAL 30 DAY GROUP BY 1")
def _(t):
    return M.events_by_type(t.audit, AS_OF)


@query("ag36_weekly_performance", f"SELECT CAST(date_trunc('week', generated_at) AS DATE) AS week, {rnd('avg(ml_risk_score)', 4)} AS avg_ml_score, {rnd('avg(final_risk_score)', 4)} AS avg_final_score, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)', 4)} AS anomaly_rate, {rnd('quantile_cont(final_risk_score, 0.9)', 4)} AS p90_score FROM t_audit WHERE event_type = 'risk_score_generated' AND generated_at > {_AS_OF} - INTERVAL 180 DAY GROUP BY 1")
def _(t):
    return rounded(M.weekly_performance(t.audit, AS_OF), 4)


@query("ag35_sketched_by_type", f"SELECT event_type, count(*) AS total_events, count(*) FILTER (human_reviewed) AS human_reviews, count(*) FILTER (review_action = 'escalated') AS escalations, count(*) FILTER (final_risk_tier IN ('HIGH','CRITICAL')) AS high_risk_flags, TRUE AS companies_within_error FROM t_audit WHERE generated_at >= {_AS_OF} - INTERVAL 30 DAY GROUP BY 1")
def _(t):
    """From a table of days; the estimated number of companies is held against the exact one."""
    path = new_path(t.spark, "days")
    sketches.write_days(t.audit, path)
    told = sketches.events_by_type(sketches.read_days(t.spark, path), AS_OF.date())
    exact = t.audit.where(F.col("generated_at") >= F.lit(AS_OF) - F.make_dt_interval(F.lit(30))).groupBy("event_type").agg(F.countDistinct("cik").alias("_exact"))
    near = F.abs(F.col("unique_companies") - F.col("_exact")) <= F.greatest(F.lit(1.0), sketches.COUNT_ERROR * F.col("_exact"))
    return told.join(exact, "event_type").withColumn("companies_within_error", near).drop("unique_companies", "_exact")


@query("ag36_sketched_performance", f"SELECT CAST(date_trunc('week', generated_at) AS DATE) AS week, {rnd('avg(ml_risk_score)', 4)} AS avg_ml_score, {rnd('avg(final_risk_score)', 4)} AS avg_final_score, {rnd('avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)', 4)} AS anomaly_rate, TRUE AS p90_within_error FROM t_audit WHERE event_type = 'risk_score_generated' AND generated_at >= {_AS_OF} - INTERVAL 180 DAY GROUP BY 1")
def _(t):
    """From a table of days; the 90 % quantile lies between the exact ones of the ranks that the sketch allows."""
    path = new_path(t.spark, "days")
    sketches.write_days(t.audit, path)
    told = sketches.weekly_performance(sketches.read_days(t.spark, path), AS_OF.date())
    used = t.audit.where("event_type = 'risk_score_generated'").where(F.col("generated_at") >= F.lit(AS_OF) - F.make_dt_interval(F.lit(180)))
    weeks = used.withColumn("week", F.date_trunc("week", "generated_at").cast("date"))
    ends = percentiles(weeks, ["final_risk_score"], [0.9 - sketches.RANK_ERROR, 0.9 + sketches.RANK_ERROR], ["week"])
    bounds = ends.join(weeks.groupBy("week").agg(F.count("final_risk_score").alias("_n")), "week").select("week", "p0", "p1", "_n")
    # a week of few events may miss by one place
    inside = F.col("p90_score").between(F.col("p0") - 1e-9, F.col("p1") + 1e-9)
    return rounded(told.join(bounds, "week").withColumn("p90_within_error", inside | (F.col("_n") < 50)).drop("p90_score", "p0", "p1", "_n"), 4)


@query("src18_brief_lookup", "SELECT doc_id AS cik, text AS brief FROM documents WHERE doc_id = 7")
def _(t):
    briefs = t.raw("documents").select(F.col("doc_id").alias("cik"), F.col("text").alias("brief"))
    return R.brief_of(briefs, 7)


# --- bias ------------------------------------------------------------------------------------------------------

CTES["bias_long"] = "SELECT 'industry_group' AS dimension, industry_group AS grp, final_risk_score AS score FROM t_scored UNION ALL SELECT 'state_of_incorporation', state_of_incorporation, final_risk_score FROM t_scored UNION ALL SELECT 'final_risk_tier', final_risk_tier, final_risk_score FROM t_scored"
CTES["bias_groups"] = """
SELECT *, CASE WHEN z_score > 1.5 THEN 'Over-scored' WHEN z_score < -1.5 THEN 'Under-scored' ELSE 'Normal' END AS bias_direction FROM (
SELECT dimension, grp, avg(score) AS mean_score, stddev_samp(score) AS std_score, count(*) AS company_count, count(*) FILTER (score > 70) AS high_risk_count, median(score) AS median_score,
 (avg(score) - (SELECT avg(final_risk_score) FROM t_scored)) / greatest((SELECT stddev_samp(final_risk_score) FROM t_scored), 0.001) AS z_score FROM bias_long GROUP BY 1, 2)"""
_DIMS = ["industry_group", "state_of_incorporation", "final_risk_tier"]


@query("ag15_bias_groups", f"""SELECT dimension, grp AS "group", {rnd('mean_score', 4)} AS mean_score, {rnd('std_score', 4)} AS std_score, company_count, high_risk_count, {rnd('median_score', 4)} AS median_score,
 {rnd('high_risk_count / company_count::DOUBLE', 4)} AS high_risk_rate, {rnd('z_score', 4)} AS z_score, {rnd('mean_score - (SELECT avg(final_risk_score) FROM t_scored)', 1)} AS deviation_from_mean, abs(z_score) > 1.5 AS bias_flag, bias_direction FROM bias_groups""")
def _(t):
    return rounded(M.bias_by_dimension(t.scored, _DIMS), 4)


@query("tk11_bias_by_z", f"""SELECT grp AS "group", {rnd('z_score', 4)} AS z_score FROM bias_groups WHERE dimension = 'industry_group' ORDER BY bias_groups.z_score DESC""")
def _(t):
    return rounded(M.bias_by_dimension(t.scored, ["industry_group"]).select("group", "z_score").orderBy(F.desc("z_score"), "group"), 4)


@query("ag16_bias_summary", f"""SELECT dimension, {rnd('max(abs(z_score))', 4)} AS max_z, count(*) FILTER (abs(z_score) > 1.5) AS flagged_groups, count(*) AS groups,
 CASE WHEN max(abs(z_score)) > 3 THEN 'HIGH' WHEN max(abs(z_score)) > 2 THEN 'MEDIUM' WHEN max(abs(z_score)) > 1.5 THEN 'LOW' ELSE 'NONE' END AS bias_severity, count(*) FILTER (abs(z_score) > 1.5) > 0 AS bias_detected,
 {rnd('(SELECT avg(final_risk_score) FROM t_scored)', 4)} AS overall_mean,
 CASE WHEN count(*) FILTER (abs(z_score) > 1.5) = 0 THEN printf('No systematic bias detected across %s groups. Risk scores are distributed consistently (mean=%.1f).', dimension, (SELECT avg(final_risk_score) FROM t_scored))
 ELSE printf('Bias severity: %s.', CASE WHEN max(abs(z_score)) > 3 THEN 'HIGH' WHEN max(abs(z_score)) > 2 THEN 'MEDIUM' ELSE 'LOW' END)
  || CASE WHEN count(*) FILTER (bias_direction = 'Over-scored') > 0 THEN ' Over-scored groups: ' || array_to_string((list(grp ORDER BY grp) FILTER (bias_direction = 'Over-scored'))[1:3], ', ') || '.' ELSE '' END
  || CASE WHEN count(*) FILTER (bias_direction = 'Under-scored') > 0 THEN ' Under-scored groups: ' || array_to_string((list(grp ORDER BY grp) FILTER (bias_direction = 'Under-scored'))[1:3], ', ') || '.' ELSE '' END
  || ' Recommend: review feature engineering for these groups and validate with domain expert before production deployment.' END AS interpretation
 FROM bias_groups GROUP BY dimension""")
def _(t):
    # all dimensions of the full audit at once
    return rounded(M.bias_summary(M.bias_by_dimension(t.scored, _DIMS), t.scored), 4)


# --- audit trail -----------------------------------------------------------------------------------------------

_AT = datetime(2024, 2, 1)


@query("gv02_scoring_audit", "SELECT sha256('run-1|2024-02-01T00:00:00|' || cik) AS audit_id, 'risk_score_generated' AS event_type, cik, ticker, 'isolation_forest' AS model_name, ml_risk_score, network_risk_score AS network_risk, final_risk_tier, is_anomaly, false AS human_reviewed FROM t_scored")
def _(t):
    rec = governance.scoring_records(t.scored, _AT, "run-1")
    return rec.select("audit_id", "event_type", "cik", "ticker", "model_name", "ml_risk_score", "network_risk", "final_risk_tier", "is_anomaly", "human_reviewed")


@query("gv01_append_only_log", "SELECT event_type, count(*) AS n FROM (SELECT 'risk_score_generated' AS event_type FROM t_scored UNION ALL SELECT 'human_review') GROUP BY 1")
def _(t):
    log = governance.scoring_records(t.scored.where("is_anomaly"), _AT, "run-1")
    log = governance.append_audit(log, governance.scoring_records(t.scored, _AT, "run-1"))
    log = governance.append_audit(log, governance.review_record(t.spark, "0000000001", "analyst", "escalated", "checked", _AT))
    return log.groupBy("event_type").agg(F.count("*").alias("n"))


@query("gv03_review_events", "SELECT '0000000001' AS cik, 'human_review' AS event_type, 'analyst' AS human_reviewer, 'escalated' AS review_action, 'checked' AS review_notes, true AS human_reviewed, count(*) AS scored_before FROM t_audit WHERE cik = '0000000001' GROUP BY ALL")
def _(t):
    rec = governance.review_record(t.spark, "0000000001", "analyst", "escalated", "checked", _AT)
    before = t.audit.groupBy("cik").agg(F.count("*").alias("scored_before"))
    return rec.join(before, "cik").select("cik", "event_type", "human_reviewer", "review_action", "review_notes", "human_reviewed", "scored_before")


# --- explanations over given effects -----------------------------------------------------------------------------

_N = len(K.FEATURES)
_LABELS = [K.FEATURE_LABELS.get(f, f.replace("_", " ")) for f in K.FEATURES]
CTES["effects"] = f"""
SELECT cik, feature_name, friendly_name, {rnd('e', 6)} AS shap_value, v AS feature_value, {rnd('abs(e)', 6)} AS abs_shap_value, CASE WHEN e > 0 THEN 'increases' ELSE 'decreases' END AS direction,
 CAST(row_number() OVER (PARTITION BY cik ORDER BY abs(e) DESC, feature_name) AS INT) AS rank_in_company FROM (
 SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, {sql_list(K.FEATURES)}[i] AS feature_name, {sql_list(_LABELS)}[i] AS friendly_name, (c_custkey * (i + 2) * 37 % 201 - 100) / 100.0::DOUBLE AS e, {rnd('c_acctbal', 4)} AS v FROM customer, range(1, {_N + 1}) r(i))"""


def effects(t):
    # a company becomes a row a feature: companies are spread first, as a small file is read by one task
    spread = spread_by(t.raw("customer").withColumn("cik", F.lpad(F.col("c_custkey").cast("string"), 10, "0")).select("cik", "c_custkey", "c_acctbal"), "cik")
    wide = spread.select(
        "cik",
        F.array(*[(F.col("c_custkey") * (i + 3) * 37 % 201 - 100) / 100.0 for i in range(_N)]).alias("effect"),
        F.array_repeat("c_acctbal", _N).alias("value"),
    )
    return explain.ranked_rows(wide, K.FEATURES)


@query("wn13_ranked_effects", "SELECT * FROM effects")
def _(t):
    return effects(t)


@query("src19_effect_table", "SELECT cik, feature_name, CASE WHEN c THEN shap_value + 1 ELSE shap_value END AS shap_value, rank_in_company FROM (SELECT *, direction = 'decreases' AS c FROM effects)")
def _(t):
    from riskweave.sources.sinks import upsert

    first = effects(t)
    changed = first.where("direction = 'decreases'").withColumn("shap_value", F.col("shap_value") + 1)
    return upsert(first, changed, ["cik", "feature_name"]).select("cik", "feature_name", "shap_value", "rank_in_company")


@query("tk06_top_explanations", "SELECT cik, feature_name, shap_value, rank_in_company FROM effects WHERE rank_in_company <= 10")
def _(t):
    return R.explanation(effects(t), 10).select("cik", "feature_name", "shap_value", "rank_in_company")


_IMP = f"SELECT feature_name, friendly_name, {rnd('avg(abs_shap_value)', 4)} AS mean_abs_shap, {rnd('avg(shap_value)', 4)} AS mean_shap, count(*) AS n, count(DISTINCT cik) AS companies, count(*) FILTER (direction = 'increases') AS risk_increasing, count(*) FILTER (direction = 'decreases') AS risk_decreasing FROM effects GROUP BY 1, 2"


@query("ag18_feature_importance", _IMP)
def _(t):
    return rounded(R.feature_importance(effects(t)), 4)


@query("ag19_top_features", _IMP + " ORDER BY avg(abs_shap_value) DESC, feature_name LIMIT 15")
def _(t):
    return rounded(R.feature_importance(effects(t), 15), 4)


@query("tx13_driver_narratives", f"""SELECT s.cik, s.company_name || ' scores ' || printf('%.0f', {rnd('s.ml_risk_score', 0)}) || '/100 on the ML risk model. Primary risk drivers: ' || coalesce(array_to_string((list(friendly_name ORDER BY rank_in_company) FILTER (direction = 'increases'))[1:3], '; '), 'none identified')
 || '. Mitigating factors: ' || coalesce(array_to_string((list(friendly_name ORDER BY rank_in_company) FILTER (direction = 'decreases'))[1:2], '; '), 'none identified') || '. '
 || CASE WHEN s.ml_risk_score > 70 THEN 'Recommend escalation for detailed analyst review.' ELSE 'Monitor for deterioration next quarter.' END AS narrative
 FROM (SELECT * FROM effects WHERE abs_shap_value > 0) e JOIN t_scored s ON e.cik = s.cik GROUP BY s.cik, s.company_name, s.ml_risk_score
 UNION ALL SELECT cik, '{K.NO_EXPLANATION}' FROM t_scored WHERE cik NOT IN (SELECT cik FROM effects WHERE abs_shap_value > 0)""")
def _(t):
    return explain.narratives(effects(t), t.scored)


@query("wn15_first_in_group", "SELECT cik, min(ticker) AS ticker, count(*) AS n FROM (SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik, l_returnflag AS ticker FROM lineitem) GROUP BY cik")
def _(t):
    li = t.raw("lineitem").select(F.lpad(F.col("l_suppkey").cast("string"), 10, "0").alias("cik"), F.col("l_returnflag").alias("ticker"))
    return li.groupBy("cik").agg(F.min_by("ticker", "ticker").alias("ticker"), F.count("*").alias("n"))


