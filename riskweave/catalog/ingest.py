"""Landed documents, files, upserts and ledgers."""

from datetime import datetime

from pyspark.sql import functions as F

from riskweave.catalog.base import CTES, query, rnd, rounded
from riskweave.functions import constants as K
from riskweave.session import new_path, spread_by
from riskweave.sources import files, nested, sinks
from riskweave.sources.tables import key10

# --- company facts: one document per order line, with several taxonomies, units and rejected entries ---


DOCUMENT_LINES = 50_000  # order lines a task: a document costs far more than its few bytes of input let the planner see


def fact_documents(t):
    """The text is put together part by part, for its values need no escapes; members that are null are left out."""
    f = t.facts_of(spread_by(t.raw("lineitem"), "l_orderkey", DOCUMENT_LINES))
    text = F.lit
    member = lambda name, value, quote: F.coalesce(
        F.concat(text(f'"{name}":{quote}'), value.cast("string"), text(f"{quote},")), text(""))
    form = lambda value: F.concat(text('"form":"'), value, text('"}'))
    shared = F.concat(member("accn", F.col("accession_number"), '"'), member("end", F.col("period_end"), '"'), member("filed", F.col("filed"), '"'))
    parts = f.select(
        "cik", "concept", F.concat(text("{"), shared).alias("shared"), member("val", F.col("value"), "").alias("val"),
        member("val", F.col("value") * 2, "").alias("twice"), member("val", F.col("line"), "").alias("line"), form(F.col("form")).alias("form"))
    entries = parts.select(
        "cik", "concept", F.concat("shared", "val", "form").alias("reported"), F.concat("shared", "form").alias("empty"),
        F.concat("shared", "twice", form(text("8-K"))).alias("other"), F.concat("shared", "line", form(text("10-Q/A"))).alias("shares"))
    body = F.concat(
        text('{"facts":{"us-gaap":{"'), "concept", text('":{"label":"Label of '), "concept",
        text('","units":{"USD":['), "reported", text(","), "empty", text(","), "other", text('],"EUR":['), "reported",
        text(']}}},"dei":{"SharesOutstanding":{"units":{"shares":['), "shares", text("]}}}}}"))
    return entries.select("cik", body.alias("body"))


_FACT_SQL = """
SELECT md5(cik || '|' || concept || '|' || period_end || '|' || accession_number) AS id, cik, 'us-gaap' AS taxonomy, concept,
  'Label of ' || concept AS label, 'USD' AS unit, accession_number, period_end, value, form, filed
FROM t_facts WHERE period_end >= DATE '1996-01-01'
UNION ALL
SELECT md5(cik || '|SharesOutstanding|' || period_end || '|' || accession_number), cik, 'dei', 'SharesOutstanding', 'SharesOutstanding', 'shares',
  accession_number, period_end, line::DOUBLE, '10-Q/A', filed FROM t_facts WHERE period_end >= DATE '1996-01-01'"""


@query("src01_company_facts", _FACT_SQL)
def _(t):
    return nested.accepted_facts(fact_documents(t), "1996-01-01").drop("period_start")


@query("dq06_rejected_entries", """SELECT reason, count(*) AS n FROM (
 SELECT 'unit' AS reason FROM t_facts UNION ALL
 SELECT CASE WHEN period_end < DATE '1996-01-01' THEN 'period' ELSE 'form' END FROM t_facts UNION ALL
 SELECT CASE WHEN period_end < DATE '1996-01-01' THEN 'period' ELSE 'value' END FROM t_facts UNION ALL
 SELECT 'period' FROM t_facts WHERE period_end < DATE '1996-01-01' UNION ALL
 SELECT 'period' FROM t_facts WHERE period_end < DATE '1996-01-01') GROUP BY 1""")
def _(t):
    return nested.rejected_facts(fact_documents(t), "1996-01-01").groupBy("reason").agg(F.count("*").alias("n"))


# --- submissions: one document per order ---


def submission_documents(t):
    o = t.raw("orders")
    day = F.col("o_orderdate").cast("date")
    text = lambda c: c.cast("string")
    recent = F.struct(
        F.array(F.concat(key10("o_custkey"), F.lit("-"), text(F.year(day)), F.lit("-"), text(F.col("o_orderkey"))), F.lit("x-1"), F.lit("y-2")).alias("accessionNumber"),
        F.array(F.when(F.quarter(day) == 4, "10-K").otherwise("10-Q"), F.lit("8-K"), F.lit("10-K/A")).alias("form"),
        F.array(text(F.date_add(day, 30)), text(day), text(day)).alias("filingDate"),
        F.array(text(day), text(day), F.lit("")).alias("reportDate"),
        F.array(F.concat(F.lit("doc"), text(F.col("o_orderkey")), F.lit(".htm"))).alias("primaryDocument"),
        F.array((F.col("o_orderkey") % 9).cast("int")).alias("documentCount"),
    )
    body = F.struct(
        F.concat(F.lit("Filer "), text(F.col("o_custkey"))).alias("name"),
        F.when(F.col("o_orderstatus") == "O", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("T"), text(F.col("o_orderkey"))), F.lit("ALT"))).alias("tickers"),
        F.lit("7372").alias("sic"), F.lit("Services").alias("sicDescription"), F.lit("00-1").alias("ein"), F.lit("DE").alias("stateOfIncorporation"),
        F.lit("1231").alias("fiscalYearEnd"),
        F.when(F.col("o_orderstatus") == "P", F.array().cast("array<string>")).otherwise(F.array(F.lit("NYSE"), F.col("o_orderpriority"))).alias("exchanges"),
        F.struct(recent.alias("recent")).alias("filings"),
    )
    return o.select(key10("o_custkey").alias("cik"), F.to_json(body).alias("body"))


@query("src02_company_profiles", """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'Filer ' || o_custkey AS name, CASE WHEN o_orderstatus <> 'O' THEN 'T' || o_orderkey END AS ticker,
 '7372' AS sic_code, 'Services' AS sic_description, '00-1' AS ein, 'DE' AS state_of_incorporation, '1231' AS fiscal_year_end, CASE WHEN o_orderstatus <> 'P' THEN 'NYSE,' || o_orderpriority END AS exchanges FROM orders""")
def _(t):
    return nested.company_profiles(submission_documents(t))


@query("src03_filing_rows", """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') || year(o_orderdate) || o_orderkey AS accession_number, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
 CASE WHEN quarter(o_orderdate) = 4 THEN '10-K' ELSE '10-Q' END AS form_type, CAST(o_orderdate AS DATE) + 30 AS filing_date, CAST(o_orderdate AS DATE) AS period_of_report,
 CAST(o_orderkey % 9 AS INT) AS document_count, 'doc' || o_orderkey || '.htm' AS primary_document FROM orders WHERE o_orderdate >= DATE '1997-01-01'""")
def _(t):
    return nested.filing_rows(submission_documents(t), "1997-01-01")


# --- CSV files: written to the shared folder, then read as landed files ---


@query("src04_companies_csv", "SELECT ticker, name, sector, lpad(CAST(('0x' || substr(md5(ticker), 1, 8))::BIGINT % 9000000 + 1000000 AS VARCHAR), 10, '0') AS cik, CASE sector "
       + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SECTOR_SIC.items()) + " ELSE '9999' END AS sic_code FROM t_owners")
def _(t):
    path = new_path(t.spark, "companies-csv")
    t.price_owners.select(F.col("ticker").alias(" Symbol"), F.col("name").alias("Security"), F.col("sector").alias("GICS Sector")).write.csv(path, header=True)
    return files.companies_csv(t.spark, path)


@query("src05_prices_csv", f"SELECT ticker, date, {rnd('open', 4)} AS open, {rnd('close', 4)} AS close, volume FROM t_prices")
def _(t):
    path = new_path(t.spark, "prices-csv")
    none = F.lit(None).cast("double")
    t.prices.select(F.concat(F.col("date").cast("string"), F.lit(" 00:00:00+00:00")).alias("Date"), F.col("ticker").alias("Ticker"), "open", none.alias("High"),
                    none.alias("Low"), "close", "volume", none.alias("Dividends"), none.alias("Stock Splits")).write.csv(path, header=True)
    return rounded(files.prices_csv(t.spark, path).select("ticker", "date", "open", "close", "volume"), 4)


def auditor_documents(t):
    entry = F.struct("auditor", "auditor_id", "audit_opinion", "audit_fee_millions")
    return t.auditors.select(F.to_json(F.create_map(F.col("cik").cast("bigint").cast("string"), entry)).alias("body"))


@query("src06_auditors_json", "SELECT cik, auditor, auditor_id, audit_opinion, audit_fee_millions FROM t_auditors")
def _(t):
    return nested.auditor_rows(auditor_documents(t))


@query("src07_relationships_json", "SELECT *, CASE relationship_type WHEN 'SUBSIDIARY' THEN 'SUBSIDIARY_OF' ELSE relationship_type END AS edge_type FROM t_relationships")
def _(t):
    r = t.relationships
    docs = r.select(F.to_json(F.array(F.struct(*r.columns))).alias("body"))
    return nested.relationship_rows(docs).select(*r.columns, "edge_type")


@query("src09_resolve_tickers", "SELECT w.wanted AS ticker, c.cik, c.cik IS NOT NULL AS resolved FROM (SELECT lower(ticker) AS wanted FROM t_companies UNION ALL SELECT lower(ticker) FROM t_owners) w LEFT JOIN t_companies c ON upper(w.wanted) = upper(c.ticker)")
def _(t):
    wanted = t.companies.select(F.lower("ticker").alias("ticker")).unionByName(t.price_owners.select(F.lower("ticker").alias("ticker")))
    docs = t.companies.select(F.to_json(F.create_map(F.lit("0"), F.struct(
        F.col("cik").cast("bigint").alias("cik_str"), "ticker", F.col("company_name").alias("title")))).alias("body"))
    return nested.resolve_tickers(wanted, nested.ticker_rows(docs))


# --- upserts --------------------------------------------------------------------------------------


def company_versions(t):
    """Existing rows, and a batch that changes half of them and adds others."""
    c, n = t.raw("customer"), t.raw("nation")
    day = F.lit("2020-01-01").cast("timestamp")
    old = c.where("c_acctbal > 2000").select(
        key10("c_custkey").alias("cik"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("sic_description"), day.alias("created_at"), day.alias("updated_at"))
    new = c.where("c_acctbal < 5000").join(n, c.c_nationkey == n.n_nationkey).select(
        key10("c_custkey").alias("cik"), F.upper("c_name").alias("name"), F.col("n_name").alias("sic_description"),
        F.lit("2021-01-01").cast("timestamp").alias("created_at"), F.lit("2021-01-01").cast("timestamp").alias("updated_at"))
    return old, new


@query("src10_upsert_companies", """SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN c_acctbal < 5000 THEN upper(c_name) ELSE c_name END AS name,
 CASE WHEN c_acctbal < 5000 THEN n_name ELSE c_mktsegment END AS sic_description, CASE WHEN c_acctbal > 2000 THEN DATE '2020-01-01' ELSE DATE '2021-01-01' END AS created_on,
 CASE WHEN c_acctbal < 5000 THEN DATE '2021-01-01' ELSE DATE '2020-01-01' END AS updated_on FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    old, new = company_versions(t)
    out = sinks.upsert_table("companies", old, new)
    return out.select("cik", "name", "sic_description", F.col("created_at").cast("date").alias("created_on"), F.col("updated_at").cast("date").alias("updated_on"))


@query("src10_upsert_facts", """SELECT id, cik, concept, label, value FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY filed DESC, value DESC) AS rn,
  first_value(acc) OVER (PARTITION BY id ORDER BY filed, value) AS label FROM (SELECT md5(cik || '|' || concept || '|' || period_end) AS id, cik, concept, value, filed, 'L' || CAST(filed AS VARCHAR) || value AS acc FROM t_facts)) WHERE rn = 1""")
def _(t):
    from riskweave.functions.exprs import strict_key

    f = t.facts.select(strict_key("cik", "concept", "period_end").alias("id"), "cik", "concept", "value", "filed",
                       F.concat(F.lit("L"), F.col("filed").cast("string"), F.col("value").cast("string")).alias("label"))
    # every fact arrives as a change; value and filing date follow the last one, the label stays as first stored
    out = sinks.upsert_changes(f, ["id"], F.struct("filed", "value"), update=["value", "filed"])
    return out.select("id", "cik", "concept", "label", "value")


@query("src10_compacted_facts", """SELECT id, concept, label, value, filed FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY filed DESC, value DESC) AS rn,
  first_value(acc) OVER (PARTITION BY id ORDER BY filed, value) AS label FROM (SELECT md5(cik || '|' || concept || '|' || period_end) AS id, cik, concept, value, filed, 'L' || CAST(filed AS VARCHAR) || value AS acc FROM t_facts)) WHERE rn = 1""")
def _(t):
    from riskweave.functions.exprs import strict_key

    f = t.facts.select(strict_key("cik", "concept", "period_end").alias("id"), "concept", F.concat(F.lit("L"), F.col("filed").cast("string"), F.col("value").cast("string")).alias("label"), "value", "filed")
    shape, rules = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in f.schema), dict(keys=["id"], keep=["label"], order=["filed", "value"])
    path = new_path(t.spark, "facts")
    early = F.col("filed") < F.lit("1996-01-01").cast("date")
    sinks.write_batch(f.where(early), path, 0)
    sinks.compact(t.spark, path, shape, **rules)
    sinks.write_batch(f.where(~early), path, 1)
    return sinks.current_rows(t.spark, path, shape, **rules)


@query("src11_insert_ignore", "SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN c_acctbal > 2000 THEN c_name ELSE upper(c_name) END AS name FROM customer")
def _(t):
    old, new = company_versions(t)
    return sinks.insert_ignore(old, new, ["cik"]).select("cik", "name")


@query("src12_replace_table", "SELECT cik, final_risk_score FROM t_scored")
def _(t):
    path = new_path(t.spark, "final-scores")
    scores = t.scored.select("cik", "final_risk_score")
    sinks.replace_table(scores.where("final_risk_score < 10"), path)
    return sinks.replace_table(scores, path)


_STACK = "SELECT 'final_risk_scores' AS table_name, cik, final_risk_score, NULL::DOUBLE AS ml_risk_score, NULL::VARCHAR AS audit_id FROM t_scored UNION ALL SELECT 'ml_anomaly_scores', cik, NULL, ml_risk_score, NULL FROM t_scored UNION ALL SELECT 'audit_trail', cik, final_risk_score, NULL, audit_id FROM t_audit"


@query("src13_stacked_report", _STACK)
def _(t):
    frames = {
        "final_risk_scores": t.scored.select("cik", "final_risk_score"),
        "ml_anomaly_scores": t.scored.select("cik", "ml_risk_score"),
        "audit_trail": t.audit.select("cik", "final_risk_score", "audit_id"),
    }
    return sinks.stack(frames)


@query("src13_report_export", "SELECT 'audit_trail' AS table_name, count(*) AS n_rows FROM t_audit UNION ALL SELECT 'final_risk_scores', count(*) FROM t_scored")
def _(t):
    path = new_path(t.spark, "report")
    written = sinks.export_report({"final_risk_scores": (t.scored, "final_risk_score"), "audit_trail": (t.audit, "final_risk_score")}, path)
    from riskweave.plans.reports import tables_counts

    return tables_counts({n: t.spark.read.csv(p, header=True) for n, p in written.items()})


@query("src14_table_counts", "SELECT 'companies' AS table_name, count(*) AS n_rows FROM t_companies UNION ALL SELECT 'filings', count(*) FROM t_filings UNION ALL SELECT 'financial_facts', count(*) FROM lineitem UNION ALL SELECT 'final_risk_scores', count(*) FROM t_scored UNION ALL SELECT 'risk_briefs', 0")
def _(t):
    from riskweave.plans.reports import tables_counts

    return tables_counts({"companies": t.companies, "filings": t.filings, "financial_facts": t.raw("lineitem"), "final_risk_scores": t.scored, "risk_briefs": None})


CTES["t_runs"] = """
SELECT 'RUN-' || o_custkey AS id, o_orderdate AS stamp, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status, o_orderkey FROM orders"""


def run_events(t):
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "running").otherwise("failed")
    return t.raw("orders").select(F.concat(F.lit("RUN-"), F.col("o_custkey").cast("string")).alias("id"),
                                  F.col("o_orderdate").cast("timestamp").alias("at"), status.alias("status"), F.col("o_orderkey").alias("seq"))


@query("src15_run_ledger", """SELECT id, CAST(min(stamp) AS DATE) AS started_on, CAST(max(stamp) FILTER (status IN ('completed', 'failed')) AS DATE) AS ended_on, arg_max(status, stamp + to_microseconds(o_orderkey)) AS status, count(*) AS n_events FROM t_runs GROUP BY id""")
def _(t):
    out = sinks.run_states(run_events(t))
    return out.select("id", F.col("started_at").cast("date").alias("started_on"), F.col("ended_at").cast("date").alias("ended_on"), "status", "n_events")


@query("src15_last_runs", """SELECT id, CAST(min(stamp) AS DATE) AS started_on, arg_max(status, stamp + to_microseconds(o_orderkey)) AS status FROM t_runs GROUP BY id ORDER BY 2 DESC, 1 LIMIT 10""")
def _(t):
    return sinks.last_runs(sinks.run_states(run_events(t)), 10).select("id", F.col("started_at").cast("date").alias("started_on"), "status")


@query("src15_counted_load", """SELECT 'load-1' AS id, 'completed' AS status, CAST((SELECT count(*) FROM t_companies) AS INT) AS companies_processed, CAST((SELECT count(*) FROM t_filings) AS INT) AS filings_processed,
 CAST((SELECT count(*) FROM t_facts) AS INT) AS facts_processed, CAST(NULL AS VARCHAR) AS error_message""")
def _(t):
    """Three tables written under one run row, counted by the passes that write them."""
    from riskweave.sources import runs

    folder = new_path(t.spark, "load")
    ledger = runs.Ledger(t.spark, f"{folder}/runs")
    runs.load_tables(ledger, folder, t.companies, t.filings, t.facts, "load-1")
    return ledger.states().drop("started_at", "completed_at")


@query("src16_resolve_mart", "SELECT count(*) AS n_rows, 0 AS n_absent FROM t_companies")
def _(t):
    t.companies.createOrReplaceTempView("riskweave_companies")
    found = sinks.first_table(t.spark, ["marts.riskweave_companies", "riskweave_companies"], "cik string")
    absent = sinks.first_table(t.spark, ["marts.nowhere", "nowhere"], "cik string")
    return found.agg(F.count("*").alias("n_rows")).withColumn("n_absent", absent.agg(F.count("*")).scalar())


@query("src17_first_companies", "SELECT cik, ticker FROM t_companies ORDER BY cik LIMIT 25")
def _(t):
    return sinks.cap(t.companies, "cik", 25).select("cik", "ticker")


@query("src18_point_lookup", f"SELECT period_end, form, {rnd('revenues', 2)} AS revenues FROM metrics WHERE cik = '0000000007'")
def _(t):
    from riskweave.operators.facts import period_metrics

    # the id filter goes below the aggregation and the join, down to the rows
    one = period_metrics(t.facts).where("cik = '0000000007'")
    return rounded(one.select("period_end", "form", "revenues").orderBy("period_end", "form"), 2)


@query("src18_company_lookup", "SELECT cik, ticker, company_name, industry_group FROM t_companies WHERE cik = '0000000003' OR upper(ticker) = 'S7'")
def _(t):
    # by id, and by ticker whatever its case
    return t.companies.where((F.col("cik") == "0000000003") | (F.upper("ticker") == "S7")).select("cik", "ticker", "company_name", "industry_group")


@query("so06_missing_tables", "SELECT 'risk_briefs' AS table_name UNION ALL SELECT 'shap_values'")
def _(t):
    from riskweave.operators.quality import missing_names
    from riskweave.plans.reports import tables_counts

    found = tables_counts({"companies": t.companies, "filings": t.filings})
    return missing_names(["companies", "filings", "risk_briefs", "shap_values"], found, "table_name")


@query("dq05_freshness", """SELECT CAST(max(stamp) AS DATE) AS last_day, CAST(floor((epoch(TIMESTAMP '2001-08-15') - epoch(max(stamp))) / 86400) AS BIGINT) AS age_days,
 CASE WHEN floor((epoch(TIMESTAMP '2001-08-15') - epoch(max(stamp))) / 86400) > 7 THEN 'WARN' ELSE 'OK' END AS status FROM t_runs WHERE status = 'completed'""")
def _(t):
    from riskweave.operators.quality import freshness

    runs = run_events(t).withColumnRenamed("at", "started_at")
    return freshness(runs, datetime(2001, 8, 15)).select(F.col("last_run").cast("date").alias("last_day"), "age_days", "status")


