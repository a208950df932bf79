"""Registered queries with their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.sources.tables import SECTORS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` and, where one exists, the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that sums in another order compare equal."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


def rnd(expr: str, digits: int = 6) -> str:
    """Half-up rounding as Spark does it (on the decimal text, not on the binary value)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def sql_tier(expr: str, scale: str = "scorer") -> str:
    cuts, rest = K.TIERS[scale]
    return "CASE " + " ".join(f"WHEN {expr} >= {c} THEN '{n}'" for c, n in cuts) + f" ELSE '{rest}' END"


def sql_key(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 10, '0')"


CTES: dict[str, str] = {}

CTES["t_companies"] = f"""
SELECT {sql_key('s_suppkey')} AS cik, 'S' || s_suppkey AS ticker, s_name AS company_name,
       {sql_list(SECTORS)}[n_nationkey % {len(SECTORS)} + 1] AS industry_group,
       n_name AS state_of_incorporation, r_name AS region
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["t_facts"] = f"""
SELECT {sql_key('l_suppkey')} AS cik,
       {sql_key('l_suppkey')} || '-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS accession_number,
       l_linenumber AS line, 'us-gaap' AS taxonomy,
       {sql_list(c for c, _ in K.CONCEPT_METRICS)}[CAST(l_partkey % {len(K.CONCEPT_METRICS)} AS INT) + 1] AS concept,
       {sql_list(m for _, m in K.CONCEPT_METRICS)}[CAST(l_partkey % {len(K.CONCEPT_METRICS)} AS INT) + 1] AS metric,
       l_partkey % {len(K.CONCEPT_METRICS)} AS priority,
       l_extendedprice AS value, 'USD' AS unit,
       last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) AS period_end,
       last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) + CAST(l_orderkey % 120 AS INT) AS filed,
       CASE WHEN quarter(o_orderdate) = 4 THEN '10-K' ELSE '10-Q' END AS form
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["t_filings"] = f"""
SELECT DISTINCT {sql_key('l_suppkey')} || '-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS accession_number,
       {sql_key('l_suppkey')} AS cik,
       CASE WHEN quarter(o_orderdate) = 4 THEN '10-K' ELSE '10-Q' END AS form_type,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INT) END AS filing_date,
       CAST(o_orderdate AS DATE) AS period_of_report
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTES["t_prices"] = """
SELECT 'C' || o_custkey AS ticker, CAST(o_orderdate AS DATE) AS date, o_orderkey AS seq,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 0.5 END AS open, o_totalprice AS close,
       coalesce(v.volume, 0) AS volume
FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS volume FROM lineitem GROUP BY 1) v
  ON o_orderkey = l_orderkey"""

CTES["t_owners"] = f"""
SELECT 'C' || c_custkey AS ticker, c_name AS name,
       {sql_list(SECTORS)}[c_nationkey % {len(SECTORS)} + 1] AS sector FROM customer"""

CTES["t_scored"] = f"""
SELECT {sql_key('c_custkey')} AS cik, 'C' || c_custkey AS ticker, c_name AS company_name,
       c_mktsegment AS industry_group, n_name AS state_of_incorporation,
       c_custkey * 7 % 1000 / 10.0::DOUBLE AS ml_risk_score, c_custkey * 13 % 1400 / 10.0::DOUBLE AS benford_risk_score,
       c_custkey * 17 % 300 / 10.0::DOUBLE AS network_risk_score,
       f AS final_risk_score, {sql_tier('f', 'card')} AS final_risk_tier, f >= 65 AS is_anomaly,
       c_custkey % 41 AS community_id, c_nationkey % 4 AS late_filings_count
FROM (SELECT *, {rnd('greatest(least((c_acctbal + 1000) / 110.0::DOUBLE, 100.0::DOUBLE), 0.0::DOUBLE)', 2)} AS f FROM customer)
JOIN nation ON c_nationkey = n_nationkey"""

CTES["t_audit"] = f"""
SELECT 'EV-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS audit_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'risk_score_generated' WHEN event_type = 'purchase' THEN 'human_review'
            WHEN event_type = 'signup' THEN 'model_retrained' ELSE 'pipeline_error' END AS event_type,
       {sql_key('user_id')} AS cik, ts AS generated_at,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ml_risk_score,
       least(value, 100.0::DOUBLE) AS final_risk_score,
       {sql_tier('least(value, 100.0::DOUBLE)', 'card')} AS final_risk_tier, least(value, 100.0::DOUBLE) >= 65 AS is_anomaly,
       event_type = 'purchase' AS human_reviewed,
       CASE WHEN event_type = 'purchase' THEN CASE WHEN least(value, 100.0::DOUBLE) > 70 THEN 'escalated' ELSE 'approved' END END AS review_action
FROM events"""

CTES["t_decisions"] = f"""
SELECT {sql_key('s_suppkey')} AS cik, {rnd('0.2::DOUBLE - s_acctbal / 45000.0::DOUBLE', 4)} AS decision,
       s_suppkey % 5 * 20.0::DOUBLE AS pre_ml_risk_score FROM supplier"""

CTES["t_auditors"] = f"""
SELECT {sql_key('s_suppkey')} AS cik, 'AUD_' || n_nationkey AS auditor_id, n_name || ' Audit' AS auditor,
       CASE WHEN s_acctbal < 0 THEN 'Qualified' ELSE 'Unqualified' END AS audit_opinion,
       {rnd('abs(s_acctbal) / 1000.0::DOUBLE', 1)} AS audit_fee_millions
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTES["t_relationships"] = f"""
SELECT parent_cik, subsidiary_cik, parent_name, subsidiary_name, relationship_type, max(ownership_pct) AS ownership_pct FROM (
  SELECT {sql_key('lead')} AS parent_cik, {sql_key('l_suppkey')} AS subsidiary_cik,
         'Supplier#' || lpad(CAST(lead AS VARCHAR), 9, '0') AS parent_name,
         'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS subsidiary_name,
         ['SUBSIDIARY','PARTNERS_WITH','CUSTOMER_OF','JOINT_VENTURE_WITH'][CAST(l_partkey % 4 AS INT) + 1] AS relationship_type,
         l_quantity AS ownership_pct
  FROM (SELECT *, first_value(l_suppkey) OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_suppkey) AS lead FROM lineitem)
  WHERE lead <> l_suppkey
  UNION ALL
  SELECT {sql_key('l_suppkey')}, 'CUST_' || o_custkey, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0'),
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), 'SUPPLIES', NULL
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_quantity = 50 AND l_discount >= 0.095 AND l_returnflag = 'R') GROUP BY ALL"""

_P = sql_list([p for ps in K.RISK_PHRASES.values() for p in ps] + K.POSITIVE_PHRASES)
_NP = sum(len(p) for p in K.RISK_PHRASES.values()) + len(K.POSITIVE_PHRASES)
CTES["t_texts"] = f"""
SELECT doc_id, {sql_key('doc_id')} AS cik, source AS ticker, 'P' || doc_id AS period_of_report, lang,
       CASE WHEN lang <> 'de' THEN
         'ITEM 1. Business' || chr(10) || text || chr(10) || 'ITEM 1A. Risk Factors' || chr(10) || 'We report ' ||
         {_P}[CAST(doc_id % {_NP} AS INT) + 1] || ' and ' || {_P}[CAST(doc_id % {_NP} AS INT) + 1] || '.' || chr(10) || text ||
         chr(10) || 'ITEM 7. Management''s Discussion' || chr(10) || chr(10) || text ||
         chr(10) || 'ITEM 8. Financial Statements ____ ---- ' || chr(10) || text
       ELSE text END AS text
FROM documents"""

CTES["metrics"] = (
    "SELECT md5(cik || '|' || period_end || '|' || form) AS id, cik, period_end, form, "
    + ", ".join(f"max(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in K.METRICS)
    + """ FROM (SELECT *, row_number() OVER (PARTITION BY cik, period_end, form, metric
              ORDER BY filed DESC, priority, accession_number DESC, value DESC) AS rn FROM t_facts WHERE unit = 'USD')
    WHERE rn = 1 GROUP BY cik, period_end, form"""
)

CTES["growth"] = """
SELECT m.*, CASE WHEN m.form IN ('10-K', '10-K/A') AND p.revenues <> 0 THEN (m.revenues - p.revenues) / abs(p.revenues) END AS revenue_yoy_growth
FROM metrics m LEFT JOIN metrics p ON m.cik = p.cik AND m.form IN ('10-K', '10-K/A') AND p.form IN ('10-K', '10-K/A')
 AND CAST(p.period_end AS VARCHAR) = CAST(CAST(left(CAST(m.period_end AS VARCHAR), 4) AS INT) - 1 AS VARCHAR) || substr(CAST(m.period_end AS VARCHAR), 5)"""

CTES["rated"] = """
SELECT *, year(period_end) AS fiscal_year, quarter(period_end) AS fiscal_quarter,
  CASE WHEN revenues > 0 THEN gross_profit / revenues END AS gross_margin,
  CASE WHEN revenues > 0 THEN operating_income / revenues END AS operating_margin,
  CASE WHEN revenues > 0 THEN net_income / revenues END AS net_margin,
  CASE WHEN revenues > 0 THEN accounts_receivable / revenues END AS ar_to_revenue,
  CASE WHEN revenues > 0 THEN (operating_cashflow - net_income) / revenues END AS cash_earnings_gap,
  CASE WHEN current_liabilities > 0 THEN current_assets / current_liabilities END AS current_ratio,
  CASE WHEN stockholders_equity > 0 THEN long_term_debt / stockholders_equity END AS debt_to_equity,
  CASE WHEN stockholders_equity > 0 THEN net_income / stockholders_equity END AS roe,
  CASE WHEN revenues > 0 THEN sga_expense / revenues END AS sga_ratio,
  CASE WHEN revenues > 0 THEN rd_expense / revenues END AS rd_intensity,
  CASE WHEN revenues > 0 THEN capex / revenues END AS capex_ratio
FROM growth"""

CTES["based"] = """
SELECT *, lag(ar_to_revenue) OVER s AS prior_ar_to_revenue, lag(revenues) OVER s AS prior_revenues,
  lag(accounts_receivable) OVER s AS prior_receivable,
  avg(gross_margin) OVER f AS gross_margin_avg4, avg(operating_margin) OVER f AS operating_margin_avg4,
  avg(net_margin) OVER f AS net_margin_avg4, sum(revenues) OVER f AS revenues_sum4,
  avg(CASE WHEN counts THEN gross_margin END) OVER q AS t4q_gross_margin, avg(CASE WHEN counts THEN operating_margin END) OVER q AS t4q_operating_margin,
  avg(CASE WHEN counts THEN net_margin END) OVER q AS t4q_net_margin, sum(CASE WHEN counts THEN revenues END) OVER q AS t4q_total_revenues,
  row_number() OVER (PARTITION BY cik, fiscal_year ORDER BY period_end DESC, form) AS period_rank_in_year
FROM (SELECT *, row_number() OVER (PARTITION BY cik, fiscal_year, fiscal_quarter ORDER BY form, period_end DESC) = 1 AS counts FROM rated)
WINDOW s AS (PARTITION BY cik, form ORDER BY period_end),
  f AS (PARTITION BY cik, form ORDER BY period_end ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
  q AS (PARTITION BY cik ORDER BY fiscal_year * 4 + fiscal_quarter RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)"""

CTES["flagged"] = """
SELECT *, CASE WHEN ar_to_revenue > prior_ar_to_revenue * 1.15::DOUBLE THEN 1 ELSE 0 END AS flag_ar_acceleration,
  CASE WHEN abs(operating_cashflow - net_income) > abs(net_income) * 0.2::DOUBLE THEN 1 ELSE 0 END AS flag_cashflow_divergence,
  CASE WHEN gross_margin < gross_margin_avg4 - 0.03::DOUBLE THEN 1 ELSE 0 END AS flag_margin_compression,
  CASE WHEN revenues > prior_revenues * 1.10::DOUBLE AND accounts_receivable > prior_receivable * 1.20::DOUBLE THEN 1 ELSE 0 END AS flag_aggressive_recognition,
  CASE WHEN debt_to_equity > 3.0::DOUBLE THEN 1 ELSE 0 END AS flag_high_leverage,
  CASE WHEN current_ratio < 1.0::DOUBLE THEN 1 ELSE 0 END AS flag_liquidity_stress
FROM based"""

CTES["history"] = "SELECT *, " + " + ".join(K.FLAGS) + " AS total_signal_count FROM flagged"

CTES["filing_agg"] = """
SELECT cik, count(filing_date) AS late_filings_count, max(datediff('day', period_of_report, filing_date)) AS max_reporting_lag_days
FROM t_filings GROUP BY cik"""

CTES["summary"] = """
SELECT h.*, c.ticker, c.company_name, c.industry_group FROM
 (SELECT *, row_number() OVER (PARTITION BY cik, fiscal_year, form ORDER BY period_end DESC, id) AS pick FROM history) h
 LEFT JOIN t_companies c ON h.cik = c.cik WHERE h.form <> '10-K' OR h.pick = 1"""

_SCORE = "least(100.0::DOUBLE, " + " + ".join(f"{f} * (100.0::DOUBLE / 6)" for f in K.FLAGS) + ")"
CTES["candidates"] = f"""
SELECT *, {sql_tier('pre_ml_risk_score')} AS risk_tier FROM (
SELECT l.cik, c.company_name, c.ticker, c.industry_group, l.period_end AS latest_period, l.revenues, l.gross_margin,
  l.operating_margin, l.net_margin, coalesce(CASE WHEN current_liabilities > 0 THEN current_assets / current_liabilities ELSE 1.5::DOUBLE END) AS current_ratio,
  CASE WHEN stockholders_equity > 0 THEN long_term_debt / stockholders_equity ELSE 0.5::DOUBLE END AS debt_to_equity,
  CASE WHEN revenues > 0 THEN coalesce(accounts_receivable, 0) / revenues ELSE 0.1::DOUBLE END AS ar_to_revenue,
  revenue_yoy_growth, coalesce(cash_earnings_gap, 0.0::DOUBLE) AS cash_earnings_gap, roe, {', '.join(K.FLAGS)}, total_signal_count,
  coalesce(f.late_filings_count, 0) > 0 AS has_late_filings, coalesce(f.late_filings_count, 0) AS late_filings_count,
  coalesce(f.max_reporting_lag_days, 0) AS max_reporting_lag_days, {rnd(_SCORE, 4)} AS pre_ml_risk_score,
  CASE {' '.join(f"WHEN {x} = 1 THEN '{x[5:]}'" for x in K.FLAGS)} ELSE 'None' END AS dominant_signal,
  t4q_gross_margin, t4q_operating_margin, t4q_net_margin, t4q_total_revenues
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY period_end DESC, form, id) AS rn FROM history) WHERE rn = 1) l
LEFT JOIN t_companies c ON l.cik = c.cik LEFT JOIN filing_agg f ON l.cik = f.cik)"""


def with_ctes(body: str) -> str:
    """Prefix the CTEs that the body names, in order of need."""
    order: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                add(CTES[name])
                order.append(name)

    add(body)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[len('WITH '):]}"
    return f"WITH {head}\n{body}"
