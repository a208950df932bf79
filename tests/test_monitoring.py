import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions.exprs import tier
from riskweave.operators import governance as A
from riskweave.operators import monitoring as M
from riskweave.operators import quality as Q
from riskweave.operators.facts import period_metrics
from riskweave.operators.first_digit import digit_counts
from riskweave.plans import fusion
from riskweave.plans import reports as R
from riskweave.plans.saved import SAVED


def scores(spark, items):
    return spark.createDataFrame(items, "industry_group string, final_risk_score double")


def test_flat_scores_show_no_bias(spark):
    df = scores(spark, [(g, 50.0 + i) for g in "abcd" for i in (-1, 1)])
    out = M.bias_summary(M.bias_by_dimension(df, ["industry_group"]), df).first()
    assert out["bias_severity"] == "NONE" and not out["bias_detected"] and "No systematic bias" in out["interpretation"]


def test_skewed_scores_are_found(spark):
    df = scores(spark, [("x", 100.0)] * 3 + [(g, 50.0) for g in "abcdefghi" for _ in range(3)])
    groups = M.bias_by_dimension(df, ["industry_group"])
    assert [r["group"] for r in groups.where("bias_flag").collect()] == ["x"]
    out = M.bias_summary(groups, df).first()
    assert out["bias_detected"] and out["bias_severity"] == "MEDIUM" and "Over-scored groups: x." in out["interpretation"]


RUN = "run_hour timestamp, avg_score double, anomaly_rate double"


def test_drift(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    calm = spark.createDataFrame([(t(1), 50.0, 0.10), (t(2), 55.0, 0.12)], RUN)
    assert M.drift_report(calm).first()["status"] == "ok" and M.drift_alerts(calm).count() == 0
    wild = spark.createDataFrame([(t(0), 1.0, 0.0), (t(1), 50.0, 0.10), (t(2), 75.0, 0.20)], RUN)
    got = {r["type"]: (r["severity"], r["message"]) for r in M.drift_alerts(wild).collect()}
    assert got["SCORE_DRIFT"] == ("HIGH", "Average risk score shifted +25.0 points (50.0 → 75.0)")
    assert got["ANOMALY_RATE_DRIFT"] == ("MEDIUM", "Anomaly rate changed +10.0% (10.0% → 20.0%)")
    first = M.drift_report(spark.createDataFrame([(t(1), 50.0, 0.1)], RUN)).first()
    assert first["message"] == "Insufficient history for comparison"


def test_run_summary(spark):
    df = spark.createDataFrame([(65.0, "HIGH", True), (72.0, "CRITICAL", True), (45.0, "LOW", False)], "final_risk_score double, final_risk_tier string, is_anomaly boolean")
    row = M.run_summary(df).first()
    assert row["avg_score"] == pytest.approx(60.6667, abs=1e-4) and row["critical_count"] == 1 and row["anomaly_rate"] == pytest.approx(2 / 3)


def test_contributions(spark):
    df = spark.createDataFrame([("1", 80.0, 40.0, 15.0)], "cik string, ml_risk_score double, benford_risk_score double, network_risk_score double")
    assert [r["contribution"] for r in R.signal_contributions(df, "cik").collect()] == [40.0, 12.0, 3.0]


def test_fusion_fills_missing_signals(spark):
    ml = spark.createDataFrame([(c, c, c, "X", 80.0, False) for c in "abc"], "cik string, ticker string, company_name string, industry_group string, ml_risk_score double, is_anomaly boolean")
    b = spark.createDataFrame([("a", 140.0), ("b", 10.0)], "cik string, benford_risk_score double")
    n = spark.createDataFrame([("a", 100.0)], "cik string, network_risk_score double")
    got = {r["cik"]: (r["final_risk_score"], r["final_risk_tier"]) for r in fusion.final_scores(ml, b, n).collect()}
    assert got == {"a": (100.0, "HIGH"), "b": (43.0, "LOW"), "c": (40.0, "LOW")}


def test_tiers(spark):
    df = spark.createDataFrame([(70.0,), (45.0,), (20.0,), (19.9,), (85.0,)], "s double")
    assert [r[0] for r in df.select(tier("s")).collect()] == ["HIGH", "MEDIUM", "LOW", "CLEAN", "HIGH"]
    assert [r[0] for r in df.select(tier("s", "card")).collect()] == ["HIGH", "LOW", "MINIMAL", "MINIMAL", "CRITICAL"]


def test_audit_log_is_append_only(spark):
    final = spark.createDataFrame([("1", "A", 50.0, 10.0, 5.0, 40.0)], "cik string, ticker string, ml_risk_score double, benford_risk_score double, network_risk_score double, final_risk_score double")
    at = dt.datetime(2024, 1, 1)
    log = A.scoring_records(final, at, "r1")
    assert len(log.columns) == len(S.AUDIT.split(", "))
    again = A.append_audit(log, A.scoring_records(final.withColumn("final_risk_score", F.lit(99.0)), at, "r1"))
    assert [r["final_risk_score"] for r in again.collect()] == [40.0]
    both = A.append_audit(again, A.review_record(spark, "1", "ann", "approved", "ok", at))
    assert both.count() == 2 and len(log.first()["data_hash"]) == 16


def test_saved_queries():
    assert len(SAVED) == 9


def test_saved_queries_run(spark):
    from riskweave.catalog.governance_queries import effects
    from riskweave.operators.first_digit import company_conformity
    from riskweave.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    frames = {"scores": t.scored, "audit": t.audit, "conformity": company_conformity(t.facts, t.companies), "attributions": effects(t)}
    for run in SAVED.values():
        assert run(frames, dt.datetime(2024, 1, 31)).columns


def test_one_company_with_a_third_of_all_facts(spark):
    """A hot company changes neither the periods nor the digits of any company."""
    n = 9000
    rows = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 50) END AS cik", "'Revenues' AS concept", "'USD' AS unit",
        "date_add(date'2020-12-31', CAST(id % 7 AS int)) AS period_end", "date_add(date'2021-01-01', CAST(id % 97 AS int)) AS filed",
        "CAST(id AS string) AS accession_number", "'10-K' AS form", "CAST(1 + id % 900 AS double) AS value")
    pdf = rows.toPandas()
    got = period_metrics(rows).toPandas()
    want = pdf.sort_values(["filed", "accession_number", "value"]).groupby(["cik", "period_end", "form"])["value"].last()
    assert got.set_index(["cik", "period_end", "form"])["revenues"].sort_index().tolist() == want.sort_index().tolist()
    counts = digit_counts(rows, ["cik"]).toPandas().set_index("cik")
    assert counts.loc["hot", "n"] == n // 3 and counts["n"].sum() == n
    assert counts["c7"].to_dict() == pdf[pdf["value"].astype(int).astype(str).str[0] == "7"].groupby("cik").size().reindex(counts.index, fill_value=0).to_dict()


def test_freshness(spark):
    runs = spark.createDataFrame([("r", dt.datetime(2024, 1, 1, 12), "completed")], "id string, started_at timestamp, status string")
    assert Q.freshness(runs, dt.datetime(2024, 1, 9, 11)).first()["status"] == "OK"
    assert Q.freshness(runs, dt.datetime(2024, 1, 9, 12)).first()["status"] == "WARN"
    assert Q.freshness(runs.where("false"), dt.datetime(2024, 1, 9)).first()["status"] == "WARN"


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "id int, v string")
    got = {(r["rule"], r["columns"]): r["violations"] for r in Q.check_rules(df, ["id", "v"], [["id"], ["id", "v"]]).collect()}
    assert got == {("not_null", "id"): 0, ("not_null", "v"): 1, ("unique", "id"): 1, ("unique", "id,v"): 0}


def test_histogram_and_counts(spark):
    df = spark.createDataFrame([(float(i),) for i in range(21)], "v double")
    got = {r["bin"]: r["n"] for r in R.histogram(df, "v").collect()}
    assert sum(got.values()) == 21 and got[19] == 2 and len(got) == 20
    one = R.histogram(df.where("v = 3"), "v").collect()
    assert [(r["bin"], r["n"]) for r in one] == [(0, 1)]
