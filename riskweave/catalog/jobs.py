"""Model, scoring-job and streaming queries."""

from pyspark.sql import functions as F

from riskweave.catalog.base import query, rnd, rounded
from riskweave.catalog.mart_queries import candidates
from riskweave.operators import forest
from riskweave.plans import scoring
from riskweave.session import cut_lineage, new_path
from riskweave.sources import sinks
from riskweave.sources.tables import Tables
from riskweave.streaming import jobs as J

TREES = 200


def trained(t):
    return scoring.train(candidates(t), trees=TREES)


def scores_of(t):
    """Model scores of all companies, no rows where there are none."""
    found = candidates(t)
    run = scoring.train(found, trees=TREES)
    return scoring.no_scores(found) if run is None else scoring.anomaly_scores(run, t.companies)


@query("ml03_forest_nodes")
def _(t):
    run = trained(t)
    return run.model.nodes.groupBy("tree").agg(
        F.count("*").alias("nodes"), F.max("depth").alias("depth"), F.max("size").alias("rows_in_root"))


@query("ml03_tree_checks", f"SELECT CAST(tree AS INT) AS tree, CAST(least(256, n) AS INT) AS rows_in_root, TRUE AS splits_add_up, TRUE AS within_depth FROM range({TREES}) r(tree), (SELECT count(*) AS n FROM candidates)")
def _(t):
    """Each tree starts from the sample, each split hands all its rows on, and no path is longer than the depth allowed."""
    nodes = trained(t).model.nodes
    parts = nodes.where("feature >= 0").select("tree", "node", F.explode(F.array("left", "right")).alias("child"))
    sizes = nodes.select("tree", F.col("node").alias("child"), F.col("size").alias("part"))
    handed = parts.join(sizes, ["tree", "child"], "left").groupBy("tree", "node").agg(F.sum("part").alias("handed"))
    return nodes.join(handed, ["tree", "node"], "left").groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("size"))).alias("rows_in_root"),
        F.bool_and(F.when(F.col("feature") >= 0, F.coalesce(F.col("handed") == F.col("size"), F.lit(False))).otherwise(True)).alias("splits_add_up"),
        (F.max("depth") <= 8).alias("within_depth"))


@query("ml04_forest_scores")
def _(t):
    return trained(t).scores.select("cik", "score", "decision", (F.col("decision") < 0).alias("is_anomaly"))


@query("ml05_anomaly_scores")
def _(t):
    return scores_of(t)


@query("ml06_saved_model")
def _(t):
    run = trained(t)
    path = new_path(t.spark, "model")
    forest.save(run.model, run.fitted, path)
    model, fitted = forest.load(t.spark, path)
    from riskweave.plans.features import apply_scaler

    again = forest.decisions(forest.raw_scores(apply_scaler(run.features, fitted), model), model)
    return run.scores.select("cik", F.col("decision").alias("fitted")).join(again.select("cik", F.col("decision").alias("loaded")), "cik")


@query("ml07_attributions")
def _(t):
    return scoring.attribution_rows(trained(t))


@query("ml07_company_checks", "SELECT cik, TRUE AS score_in_range, TRUE AS same_after_loading, TRUE AS effects_add_up FROM candidates")
def _(t):
    """Per company: a score within its range, the same decision from the loaded model, and effects that make up the path length."""
    from riskweave.plans.features import apply_scaler

    run = trained(t)
    path = new_path(t.spark, "model")
    forest.save(run.model, run.fitted, path)
    model, fitted = forest.load(t.spark, path)
    again = forest.decisions(forest.raw_scores(apply_scaler(run.features, fitted), model), model).select("cik", F.col("decision").alias("_again"))
    norm = float(forest.mean_path([run.model.sample])[0]) or 1.0
    length = -F.log2(-F.col("score")) * norm
    told = forest.attributions(run.scaled, run.model).select("cik", (F.aggregate("phi", F.lit(0.0), lambda a, x: a + x) + F.col("base")).alias("_told"))
    return run.scores.join(again, "cik").join(told, "cik").select(
        "cik", ((F.col("score") < 0) & (F.col("score") > -1)).alias("score_in_range"),
        (F.abs(F.col("decision") - F.col("_again")) < 1e-12).alias("same_after_loading"),
        (F.abs(length - F.col("_told")) < 1e-6).alias("effects_add_up"))


@query("ml09_scoring_job")
def _(t):
    from riskweave.catalog.graphs import conformity
    from riskweave.operators import graph as G
    from riskweave.plans.fusion import final_scores

    ml = cut_lineage(scores_of(t))
    ties = cut_lineage(t.relationships)
    companies = G.company_nodes(t.companies, ml, ml)
    nodes, edges = G.build_nodes(companies, t.auditors, ties), G.build_edges(companies, t.auditors, ties)
    risk = G.neighbour_risk(nodes, edges).select(F.col("id").alias("cik"), "network_risk_score")
    return final_scores(ml, conformity(t), risk)


def network_of(t):
    from riskweave.operators import graph as G

    ties = cut_lineage(t.relationships)  # the same for every run

    def risk(ml):
        companies = G.company_nodes(t.companies, ml, ml)
        nodes, edges = G.build_nodes(companies, t.auditors, ties), G.build_edges(companies, t.auditors, ties)
        return G.neighbour_risk(nodes, edges).select(F.col("id").alias("cik"), "network_risk_score")

    return risk


@query("ml09_run_record", """SELECT 'completed' AS status, CAST(count(*) AS INT) AS companies_processed, CAST(NULL AS VARCHAR) AS error_message, count(*) AS audit_records, TRUE AS anomalies_within_share, TRUE AS one_record_each
 FROM candidates c WHERE cik IN (SELECT cik FROM t_companies)""")
def _(t):
    """The run row and the audit of the whole scoring job, written twice with the same id as after a restart."""
    from riskweave.catalog.governance_queries import AS_OF
    from riskweave.catalog.graphs import conformity
    from riskweave.sources.runs import Ledger

    folder = new_path(t.spark, "scoring")
    found, digits, network = cut_lineage(candidates(t)), cut_lineage(conformity(t)), network_of(t)
    for _ in range(2):
        done = scoring.scoring_job(found, t.companies, digits, network, folder, "run-1", AS_OF, TREES)
    log = scoring.audit_log(t.spark, folder).groupBy(F.col("mlflow_run_id").alias("id")).agg(
        F.count("*").alias("audit_records"), F.count(F.when(F.col("is_anomaly"), 1)).alias("_a"), F.countDistinct("cik").alias("_c"))
    return Ledger(t.spark, f"{folder}/runs").states().join(log, "id").select(
        "status", "companies_processed", "error_message", "audit_records",
        (F.col("_a") <= F.ceil(0.1 * F.col("audit_records"))).alias("anomalies_within_share"),
        ((F.col("_c") == F.col("audit_records")) & (F.lit(done["audited"]) == 0)).alias("one_record_each"))


# --- streams: each works off the landed files and returns what it wrote --------------------------------------


def audit_stream(t):
    """The audit records as a stream over the event files, every record arriving twice."""
    raw = J.file_stream(t.spark, t.folder, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    view = Tables(t.spark, t.folder)
    view.raw = lambda name: raw
    return view.audit


@query("st01_deduplicated_audit", "SELECT audit_id, event_type, cik, final_risk_score FROM t_audit")
def _(t):
    twice = audit_stream(t).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    path = new_path(t.spark, "audit")
    J.run_available(J.deduplicated(twice, "audit_id", "generated_at"), "append", new_path(t.spark, "audit-state"), path=path)
    return t.spark.read.parquet(path).select("audit_id", "event_type", "cik", "final_risk_score")


_MON = "SELECT CAST({w} AS DATE) AS {n}, count(*) AS total_scored, count(*) FILTER (is_anomaly) AS anomalies_flagged, " + rnd("avg(final_risk_score)", 4) + " AS avg_score, " + rnd("avg(CASE WHEN is_anomaly THEN 1.0::DOUBLE ELSE 0 END)", 4) + " AS anomaly_rate FROM t_audit WHERE event_type = 'risk_score_generated' GROUP BY 1"


@query("st02_daily_monitor", _MON.format(w="generated_at", n="day"))
def _(t):
    out = J.monitor_table(audit_stream(t), "1 day")
    return rounded(out.withColumn("day", F.col("window_start").cast("date")).drop("window_start"), 4)


@query("st02_weekly_monitor", _MON.format(w="date_trunc('week', generated_at)", n="week"))
def _(t):
    out = J.monitor_table(audit_stream(t), "7 days", "4 days")
    return rounded(out.withColumn("week", F.col("window_start").cast("date")).drop("window_start"), 4)


@query("st02_closed_monitor", _MON.format(w="generated_at", n="day").replace(" GROUP BY 1", " AND CAST(generated_at AS DATE) + INTERVAL 1 DAY <= (SELECT max(generated_at) - INTERVAL 2 DAY FROM t_audit WHERE event_type = 'risk_score_generated') GROUP BY 1"))
def _(t):
    """Days that the watermark, two days behind the newest event, has closed; each is given out once."""
    monitor = J.ClosedMonitor(t.spark, new_path(t.spark, "closed"), "1 day")
    monitor.run(audit_stream(t), new_path(t.spark, "closed-state"))
    return rounded(monitor.closed().withColumn("day", F.col("window_start").cast("date")).drop("window_start"), 4)


@query("st03_incremental_filings", "SELECT cik, accession_number, filing_date, ingested_on FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CAST(max(o_orderkey) AS VARCHAR) AS accession_number, CAST(arg_max(o_orderdate, o_orderkey) AS DATE) AS filing_date, DATE '2024-01-01' AS ingested_on FROM orders GROUP BY o_custkey)")
def _(t):
    o = J.file_stream(t.spark, t.folder, "orders.parquet").select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"), F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").cast("string").alias("accession_number"), F.col("o_orderdate").cast("date").alias("filing_date"),
        F.lit("2024-01-01").cast("date").alias("ingested_on"))
    path = new_path(t.spark, "filings")
    J.run_available(o, "append", new_path(t.spark, "filings-state"), each=J.batches_into(path))
    schema = "cik string, seq long, accession_number string, filing_date date, ingested_on date"
    # orders may arrive in any order, so the highest one counts whatever its batch
    changes = t.spark.read.schema(schema).parquet(path)
    return sinks.upsert_changes(changes, ["cik"], F.col("seq"), ["ingested_on"]).drop("seq", sinks.BATCH)


@query("st04_hourly_drift", f"""SELECT strftime(run_hour, '%Y-%m-%d %H:%M:%S') AS window_start, {rnd('s', 4)} AS score_drift, {rnd('r', 4)} AS rate_drift, CASE WHEN abs(s) > 20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM (
 SELECT run_hour, avg_score - lag(avg_score) OVER (ORDER BY run_hour) AS s, anomaly_rate - lag(anomaly_rate) OVER (ORDER BY run_hour) AS r FROM hours) WHERE abs(s) > 10 OR abs(r) > 0.05""")
def _(t):
    hours = J.monitor_table(audit_stream(t), "1 hour")
    return rounded(J.drift_rows(hours).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")), 4)




@query("st04_streamed_drift", f"""SELECT strftime(run_hour, '%Y-%m-%d %H:%M:%S') AS window_start, {rnd('s', 4)} AS score_drift, {rnd('r', 4)} AS rate_drift, CASE WHEN abs(s) > 20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM (
 SELECT run_hour, avg_score - lag(avg_score) OVER (ORDER BY run_hour) AS s, anomaly_rate - lag(anomaly_rate) OVER (ORDER BY run_hour) AS r FROM hours)
 WHERE (abs(s) > 10 OR abs(r) > 0.05) AND run_hour + INTERVAL 1 HOUR <= (SELECT max(generated_at) - INTERVAL 2 DAY FROM t_audit WHERE event_type = 'risk_score_generated')""")
def _(t):
    """Hours that the watermark, two days behind the newest event, has closed."""
    out = J.streamed_drift(audit_stream(t), new_path(t.spark, "drift"), new_path(t.spark, "drift-state"))
    return rounded(out.drop("series").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")), 4)
