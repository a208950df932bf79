"""Windows closed once beside late rows, daily sketches, run rows with counts, the scoring job as a whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import monitoring as M
from riskweave.operators import sketches
from riskweave.plans import scoring
from riskweave.sources import runs
from riskweave.streaming import jobs as J
from test_sinks_and_streams import ev, land, write_events

EVENT = "audit_id string, generated_at timestamp, event_type string, is_anomaly boolean, final_risk_score double"


# --- closed windows


def closed_rows(monitor):
    return {r.window_start.day: (r.total_scored, r.anomalies_flagged, r.avg_score) for r in monitor.closed().collect()}


def test_late_row_is_in_the_late_table_alone(spark, tmp_path):
    monitor = J.ClosedMonitor(spark, str(tmp_path / "m"), "1 day")
    monitor.run(land(spark, tmp_path), str(tmp_path / "cp"))
    # the newest event is of the 13th, so the 11th is the last day that may be closed; e6 came when day 1 had been closed
    assert closed_rows(monitor) == {1: (3, 0, 10.0), 2: (1, 0, 10.0)}
    assert [r.audit_id for r in monitor.late(EVENT).collect()] == ["e6"]


def test_every_row_is_counted_once_over_a_restart_and_a_replay(spark, tmp_path):
    import time

    folder, lots = tmp_path / "landed", [[ev(1, 1), ev(2, 3, score=70.0)], [ev(3, 9)], [ev(4, 1), ev(5, 8), ("n", None, "risk_score_generated", False, 1.0)], [ev(6, 20), ev(7, 21)], [ev(8, 30)]]
    schema = None
    monitor = J.ClosedMonitor(spark, str(tmp_path / "m"), "1 day")
    seen = {}
    for i, lot in enumerate(lots):
        write_events(spark, str(folder), f"lot={i}", lot)
        schema = schema or spark.read.parquet(str(folder)).drop("lot").schema
        stream = spark.readStream.schema(schema).parquet(str(folder) + "/*")
        J.ClosedMonitor(spark, str(tmp_path / "m"), "1 day").run(stream, str(tmp_path / "cp"))
        now = closed_rows(monitor)
        assert all(now[day] == row for day, row in seen.items())  # what is out stays as it is
        seen = now
        time.sleep(1.1)
    late = sorted(r.audit_id for r in monitor.late(EVENT).collect())
    assert late == ["e4", "n"]
    assert {d: r[0] for d, r in seen.items()} == {1: 1, 3: 1, 8: 1, 9: 1, 20: 1, 21: 1}
    before = sorted(map(tuple, monitor.closed().collect()))
    monitor.take(spark.createDataFrame(lots[1], EVENT), 1)  # a batch delivered again under its number
    assert sorted(map(tuple, monitor.closed().collect())) == before and monitor.late(EVENT).count() == 2


def test_monitor_without_events(spark, tmp_path):
    monitor = J.ClosedMonitor(spark, str(tmp_path / "m"), "1 day")
    monitor.take(spark.createDataFrame([], EVENT), 0)
    monitor.take(spark.createDataFrame([ev(1, 1)], EVENT), 1)
    assert monitor.closed().count() == 0 and monitor.late(EVENT).count() == 0


# --- sketches

AUDIT = "cik string, generated_at timestamp, event_type string, human_reviewed boolean, review_action string, final_risk_tier string, is_anomaly boolean, ml_risk_score double, final_risk_score double"


def audit(spark, n=40_000, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randrange(28), seconds=rng.randrange(86400))
        score = rng.random() ** 2 * 100
        kind = "risk_score_generated" if rng.random() < 0.8 else "human_review"
        rows.append((f"{rng.randrange(9000):010d}", day, kind, kind == "human_review", rng.choice(["escalated", "approved", None]), rng.choice(["HIGH", "LOW"]), score > 65, score / 2, score))
    return spark.createDataFrame(rows, AUDIT)


def test_sketched_reports_beside_the_exact_ones(spark, tmp_path):
    events = audit(spark).cache()
    path, as_of = str(tmp_path / "days"), dt.datetime(2024, 1, 29)
    sketches.write_days(events, path)
    days = sketches.read_days(spark, path)
    assert days.count() == events.select(F.to_date("generated_at"), "event_type").distinct().count()
    told = {r.event_type: r for r in sketches.events_by_type(days, as_of.date()).collect()}
    for exact in M.events_by_type(events, as_of).collect():
        got = told[exact.event_type]
        assert abs(got.unique_companies - exact.unique_companies) <= sketches.COUNT_ERROR * exact.unique_companies
        assert all(got[c] == exact[c] for c in ("total_events", "human_reviews", "escalations", "high_risk_flags"))
    weeks = {r.week: r for r in sketches.weekly_performance(days, as_of.date()).collect()}
    for exact in M.weekly_performance(events, as_of).collect():
        got = weeks.pop(exact.week)
        assert all(abs(got[c] - exact[c]) < 1e-9 for c in ("avg_ml_score", "avg_final_score", "anomaly_rate"))
        below = events.where("event_type = 'risk_score_generated'").where(F.date_trunc("week", "generated_at").cast("date") == F.lit(exact.week))
        share = below.agg(F.avg((F.col("final_risk_score") <= got.p90_score).cast("double"))).first()[0]
        assert abs(share - 0.9) <= sketches.RANK_ERROR
    assert not weeks


def test_days_are_written_anew_one_by_one(spark, tmp_path):
    events, path = audit(spark, 3000, 5).cache(), str(tmp_path / "days")
    sketches.write_days(events, path)
    again = events.where("to_date(generated_at) = DATE '2024-01-05'").limit(7)
    sketches.write_days(again, path)
    n = {r.day.day: r["n"] for r in sketches.read_days(spark, path).groupBy("day").agg(F.sum("events").alias("n")).collect()}
    assert n[5] == 7 and len(n) == 28
    assert sum(n.values()) == events.count() - events.where("to_date(generated_at) = DATE '2024-01-05'").count() + 7


def test_sketches_of_nulls_and_of_nothing(spark):
    rows = [(None, dt.datetime(2024, 1, 2), "risk_score_generated", None, None, None, None, None, None), ("1", None, "risk_score_generated", None, None, None, None, 1.0, 1.0)]
    days = sketches.daily(spark.createDataFrame(rows, AUDIT))
    week = sketches.weekly_performance(days, dt.date(2024, 1, 9)).first()
    assert (week.avg_ml_score, week.avg_final_score, week.anomaly_rate, week.p90_score) == (None, None, 0.0, None)
    row = sketches.events_by_type(days, dt.date(2024, 1, 9)).first()
    assert (row.total_events, row.unique_companies) == (1, 0)
    assert sketches.weekly_performance(sketches.daily(spark.createDataFrame([], AUDIT)), dt.date(2024, 1, 9)).count() == 0


# --- run rows


def test_load_leaves_its_counts(spark, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "runs"))
    assert ledger.states().count() == 0
    times = iter(dt.datetime(2024, 1, 1, h) for h in range(9))
    runs.load_tables(ledger, str(tmp_path), spark.range(3), spark.range(40).repartition(5), spark.range(0), "a", lambda: next(times))
    row = ledger.states().first()
    assert (row.status, row.companies_processed, row.filings_processed, row.facts_processed, row.error_message) == ("completed", 3, 40, 0, None)
    assert (row.started_at.hour, row.completed_at.hour) == (0, 1)


def test_failed_run_leaves_its_error_and_a_restart_goes_over_it(spark, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "runs"))

    def broken():
        raise OSError("no file")

    with pytest.raises(OSError):
        runs.tracked(ledger, broken, "a")
    row = ledger.states().first()
    assert (row.status, row.error_message) == ("failed", "OSError: no file") and row.completed_at is not None
    runs.tracked(ledger, lambda: {"companies": 2}, "a")
    row = ledger.states().first()
    assert (row.status, row.companies_processed, row.error_message) == ("completed", 2, None) and ledger.states().count() == 1


def test_error_inside_a_write_is_in_the_run_row(spark, tmp_path):
    ledger = runs.Ledger(spark, str(tmp_path / "runs"))
    bad = spark.range(5).select(F.raise_error(F.lit("row is broken")).alias("x"))
    with pytest.raises(Exception, match="row is broken"):
        runs.load_tables(ledger, str(tmp_path), spark.range(1), bad, spark.range(1), "b")
    row = ledger.states().first()
    assert row.status == "failed" and "row is broken" in row.error_message


# --- the scoring job


def test_scoring_job_without_companies(spark, tmp_path):
    from riskweave.catalog.mart_queries import candidates
    from riskweave.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    none = spark.createDataFrame([], candidates(t).schema)
    digits = spark.createDataFrame([], "cik string, benford_risk_score double")
    risk = lambda ml: spark.createDataFrame([], "cik string, network_risk_score double")
    done = scoring.scoring_job(none, t.companies, digits, risk, str(tmp_path), "r", dt.datetime(2024, 1, 1))
    assert done == {"run_id": "r", "status": "failed", "companies": 0, "anomalies": 0, "audited": 0, "reason": scoring.NO_DATA}
    assert spark.read.parquet(f"{tmp_path}/scores").count() == 0 and scoring.audit_log(spark, str(tmp_path)).count() == 0
    row = runs.Ledger(spark, f"{tmp_path}/runs").states().first()
    assert (row.status, row.error_message, row.companies_processed) == ("failed", "no_data", 0)
