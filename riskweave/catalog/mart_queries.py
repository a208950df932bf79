"""Metrics, ratio, mart and feature queries."""

from pyspark.sql import functions as F

from riskweave.catalog.base import CTES, query, rnd, rounded
from riskweave.functions import constants as K
from riskweave.functions import exprs as X
from riskweave.operators import facts as facts_ops
from riskweave.plans import marts

_M = ", ".join(K.METRICS)
_RATIOS = ["gross_margin", "operating_margin", "net_margin", "ar_to_revenue", "cash_earnings_gap", "current_ratio", "debt_to_equity",
           "roe", "sga_ratio", "rd_intensity", "revenue_yoy_growth", "capex_ratio"]


def _r(names):
    return ", ".join(f"{rnd(n)} AS {n}" for n in names)


def history(t):
    return marts.rated_history(t.facts)


def candidates(t, ranked=False):
    return marts.risk_candidates(history(t), t.companies, t.filings, ranked)


@query("prj01_safe_divide", f"""SELECT l_returnflag, l_linenumber, count(*) AS n, {rnd('sum(l_tax / nullif(l_discount, 0))', 4)} AS tax_per_discount,
  count(l_tax / nullif(l_discount, 0)) AS defined FROM lineitem GROUP BY 1, 2""")
def _(t):
    q = X.safe_divide("l_tax", "l_discount")
    return rounded(t.raw("lineitem").groupBy("l_returnflag", "l_linenumber").agg(
        F.count("*").alias("n"), F.sum(q).alias("tax_per_discount"), F.count(q).alias("defined")), 4)


@query("prj02_guarded_ratios", f"SELECT cik, period_end, form, {_r(_RATIOS)} FROM rated")
def _(t):
    rated = marts.ratios(facts_ops.with_yoy_growth(facts_ops.period_metrics(t.facts)))
    return rounded(rated.select("cik", "period_end", "form", *_RATIOS))


@query("prj03_defaulted_ratios", f"SELECT cik, {_r(['current_ratio', 'debt_to_equity', 'ar_to_revenue', 'cash_earnings_gap'])} FROM candidates")
def _(t):
    return rounded(candidates(t).select("cik", "current_ratio", "debt_to_equity", "ar_to_revenue", "cash_earnings_gap"))


@query("prj04_surrogate_keys", """SELECT md5(coalesce(cik, '') || '|' || coalesce(CAST(filing_date AS VARCHAR), '') || '|' || form_type) AS filing_key,
  md5(cik || '|' || CAST(filing_date AS VARCHAR)) AS strict_key, accession_number FROM t_filings""")
def _(t):
    return t.filings.select(
        X.surrogate_key("cik", "filing_date", "form_type").alias("filing_key"),
        X.strict_key("cik", "filing_date").alias("strict_key"), "accession_number")


@query("prj05_pad_company_ids", """SELECT raw, CASE WHEN regexp_matches(raw, '^\\d+(\\.0*)?$') THEN lpad(CAST(CAST(regexp_replace(raw, '\\..*$', '') AS BIGINT) AS VARCHAR), 10, '0') ELSE raw END AS cik
FROM (SELECT c_custkey || '.0' AS raw FROM customer UNION ALL SELECT 'CUST_' || c_custkey FROM customer UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer)""")
def _(t):
    key = F.col("c_custkey").cast("string")
    forms = F.explode(F.array(F.concat(key, F.lit(".0")), F.concat(F.lit("CUST_"), key), key)).alias("raw")
    return t.raw("customer").select(forms).withColumn("cik", X.pad_cik("raw"))


@query("prj06_derived_ids", """SELECT ticker, lpad(CAST(('0x' || substr(md5(ticker), 1, 8))::BIGINT % 9000000 + 1000000 AS VARCHAR), 10, '0') AS cik FROM t_owners""")
def _(t):
    return t.price_owners.select("ticker", X.derived_cik("ticker").alias("cik"))


@query("prj07_sector_codes", "SELECT sector, CASE sector " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.SECTOR_SIC.items()) + " ELSE '9999' END AS sic_code, count(*) AS n FROM t_owners GROUP BY 1, 2")
def _(t):
    return t.price_owners.groupBy("sector", F.coalesce(X.lookup(K.SECTOR_SIC, "sector"), F.lit(K.DEFAULT_SIC)).alias("sic_code")).agg(F.count("*").alias("n"))


@query("prj08_concept_metrics", f"SELECT concept, metric, priority, count(*) AS n, {rnd('sum(value)', 2)} AS total FROM t_facts GROUP BY ALL")
def _(t):
    return rounded(facts_ops.canonical_facts(t.facts).groupBy("concept", "metric", "priority").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")), 2)


@query("prj10_period_labels", """SELECT year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, make_date(year(d), 12, 31) AS year_end, coalesce(f, '10-K') AS form, count(*) AS n
FROM (SELECT CAST(o_orderdate AS DATE) AS d, CASE WHEN quarter(o_orderdate) < 4 THEN '10-Q' END AS f FROM orders) GROUP BY ALL""")
def _(t):
    d = t.raw("orders").select(F.col("o_orderdate").cast("date").alias("d"))
    form = F.coalesce(F.when(F.quarter("d") < 4, "10-Q"), F.lit("10-K"))
    return d.groupBy(F.year("d").alias("fiscal_year"), F.quarter("d").alias("fiscal_quarter"),
                     F.make_date(F.year("d"), F.lit(12), F.lit(31)).alias("year_end"), form.alias("form")).agg(F.count("*").alias("n"))


@query("prj11_red_flags", f"SELECT cik, period_end, form, {', '.join(K.FLAGS)}, total_signal_count FROM history")
def _(t):
    return history(t).select("cik", "period_end", "form", *K.FLAGS, "total_signal_count")


@query("prj12_rule_score", "SELECT cik, total_signal_count, pre_ml_risk_score, risk_tier, dominant_signal FROM candidates WHERE total_signal_count >= 1")
def _(t):
    return candidates(t).where("total_signal_count >= 1").select("cik", "total_signal_count", "pre_ml_risk_score", "risk_tier", "dominant_signal")


@query("prj33_row_hashes", """SELECT cik, substr(sha256('{"audit_fee_millions":' || audit_fee_millions || ',"auditor":"' || auditor || '","auditor_id":"' || auditor_id || '"}'), 1, 16) AS data_hash FROM t_auditors""")
def _(t):
    return t.auditors.select("cik", X.row_hash(["auditor", "auditor_id", "audit_fee_millions"]).alias("data_hash"))


@query("prj34_synthetic_accession", """SELECT DISTINCT cik, fiscal_year, cik || '-' || fiscal_year || '-10K' || lpad(CAST(('0x' || substr(md5(cik || fiscal_year), 1, 8))::BIGINT % 100000 AS VARCHAR), 5, '0') AS accession_number
FROM (SELECT cik, year(period_end) AS fiscal_year FROM t_facts)""")
def _(t):
    return t.facts.select("cik", F.year("period_end").alias("fiscal_year")).distinct().withColumn(
        "accession_number", X.synthetic_accession("cik", "fiscal_year"))


@query("ag03_period_metrics", f"SELECT id, cik, period_end, form, {_M} FROM metrics")
def _(t):
    return facts_ops.period_metrics(t.facts)


@query("jn01_facts_with_companies", "SELECT c.industry_group, f.form, count(*) AS n, count(DISTINCT f.cik) AS companies FROM t_facts f JOIN t_companies c ON f.cik = c.cik WHERE f.form IN ('10-K','10-Q') AND f.value <> 0 GROUP BY ALL")
def _(t):
    used = t.facts.where(F.col("form").isin("10-K", "10-Q") & (F.col("value") != 0))
    per = used.groupBy("cik", "form").agg(F.count("*").alias("n"))
    return per.join(t.companies, "cik").groupBy("industry_group", "form").agg(F.sum("n").alias("n"), F.count("*").alias("companies"))


@query("jn09_yoy_self_join", f"SELECT cik, period_end, form, revenues, prior_revenues, {rnd('(revenues - prior_revenues) / abs(prior_revenues)')} AS revenue_yoy_growth FROM (SELECT m.cik, m.period_end, m.form, m.revenues, p.revenues AS prior_revenues FROM metrics m JOIN metrics p ON m.cik = p.cik AND m.form = '10-K' AND p.form = '10-K' AND p.period_end = m.period_end - INTERVAL 1 YEAR WHERE m.revenues IS NOT NULL AND p.revenues <> 0)")
def _(t):
    return rounded(facts_ops.yoy_self_join(facts_ops.period_metrics(t.facts)))


@query("jn02_financial_summary", "SELECT " + ", ".join(rnd(c) + f" AS {c}" if c in (*_RATIOS, "revenues") else c for c in marts.SUMMARY_COLUMNS) + " FROM summary")
def _(t):
    return rounded(marts.financial_summary(history(t), t.companies))


_CAND = ["cik", "company_name", "ticker", "industry_group", "latest_period", "has_late_filings", "late_filings_count",
         "max_reporting_lag_days", "pre_ml_risk_score", "dominant_signal", "risk_tier", "total_signal_count", *K.FLAGS]


@query("jn03_risk_candidates", f"""SELECT {', '.join(_CAND)}, {_r(['revenues', 'gross_margin', 'operating_margin', 'net_margin', 'current_ratio', 'debt_to_equity', 'ar_to_revenue', 'cash_earnings_gap', 'revenue_yoy_growth', 'roe'])},
  CAST(row_number() OVER (ORDER BY revenues DESC NULLS LAST, cik) AS INT) AS risk_rank,
  CAST(row_number() OVER (PARTITION BY industry_group ORDER BY revenues DESC NULLS LAST, cik) AS INT) AS risk_rank_in_industry FROM candidates""")
def _(t):
    out = candidates(t, ranked=True)
    return rounded(out.drop("t4q_gross_margin", "t4q_operating_margin", "t4q_net_margin", "t4q_total_revenues"))


CTES["peers"] = """
SELECT *, avg(gross_margin) OVER (PARTITION BY industry_group) AS industry_avg_gross_margin,
  avg(operating_margin) OVER (PARTITION BY industry_group) AS industry_avg_operating_margin,
  median(gross_margin) OVER (PARTITION BY industry_group) AS industry_med_gross_margin,
  median(debt_to_equity) OVER (PARTITION BY industry_group) AS industry_med_debt_to_equity FROM candidates"""


@query("wn16_company_dashboard", f"""SELECT cik, ticker, company_name, industry_group, risk_tier, pre_ml_risk_score, dominant_signal, total_signal_count, latest_period,
 {_r(['revenues', 'gross_margin', 'operating_margin', 'net_margin', 'current_ratio', 'debt_to_equity', 'ar_to_revenue', 'revenue_yoy_growth'])}, has_late_filings, late_filings_count,
 {rnd('t4q_gross_margin')} AS t4q_gross_margin, {rnd('t4q_operating_margin')} AS t4q_operating_margin, {rnd('t4q_net_margin')} AS t4q_net_margin,
 {rnd('revenue_yoy_growth')} AS t4q_revenue_growth, {rnd('t4q_total_revenues')} AS t4q_total_revenues,
 {rnd('gross_margin - industry_med_gross_margin')} AS gross_margin_vs_peers, {rnd('debt_to_equity - industry_med_debt_to_equity')} AS leverage_vs_peers,
 {_r(['industry_avg_gross_margin', 'industry_avg_operating_margin', 'industry_med_gross_margin', 'industry_med_debt_to_equity'])} FROM peers""")
def _(t):
    return rounded(marts.company_dashboard(candidates(t)))


@query("ag08_filing_behaviour", """SELECT cik, count(filing_date) AS late_filings_count, max(datediff('day', period_of_report, filing_date)) AS max_reporting_lag_days,
  count(*) FILTER (datediff('day', period_of_report, filing_date) > CASE form_type WHEN '10-K' THEN 90 ELSE 45 END) AS past_limit_count FROM t_filings GROUP BY cik""")
def _(t):
    return marts.filing_behaviour(t.filings, {"10-K": 90, "10-Q": 45})


@query("ag09_risk_overview", f"""SELECT risk_tier, industry_group, count(*) AS companies, {rnd('avg(pre_ml_risk_score)', 1)} AS avg_risk_score, {rnd('avg(gross_margin) * 100', 1)} AS avg_gross_margin_pct
FROM candidates GROUP BY 1, 2""")
def _(t):
    from riskweave.plans.reports import risk_overview

    return risk_overview(candidates(t))


@query("wn05_newest_companies", """SELECT cik, ticker, updated_at FROM (SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CAST(o_orderkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS updated_at,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders) WHERE rn = 1""")
def _(t):
    rows = t.raw("orders").select(F.col("o_custkey").cast("string").alias("cik"), F.col("o_orderkey").cast("string").alias("ticker"),
                                  F.col("o_orderdate").cast("date").alias("updated_at"))
    return marts.newest_companies(rows)


@query("wn06_one_annual_per_year", "SELECT id, cik, fiscal_year, form FROM summary")
def _(t):
    # both halves of the union in one pass: annual rows are ranked, other forms pass through
    return marts.one_annual_per_year(history(t)).select("id", "cik", "fiscal_year", "form")


@query("wn01_latest_period", "SELECT cik, period_end, form FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY period_end DESC, form) AS rn FROM metrics) WHERE rn = 1")
def _(t):
    return marts.latest_period(facts_ops.period_metrics(t.facts)).select("cik", "period_end", "form")


@query("wn08_trend_windows", f"SELECT cik, period_end, form, {_r(['prior_ar_to_revenue', 'gross_margin_avg4', 'revenues_sum4'])}, CAST(period_rank_in_year AS INT) AS period_rank_in_year FROM based")
def _(t):
    return rounded(history(t).select("cik", "period_end", "form", "prior_ar_to_revenue", "gross_margin_avg4", "revenues_sum4", "period_rank_in_year"))


@query("prj31_staged_companies", "SELECT cik, company_name, ticker, industry_group, state_of_incorporation FROM t_companies")
def _(t):
    raw = t.companies.withColumnsRenamed({"company_name": "name", "industry_group": "sic_description"})
    return marts.staged_companies(raw).select("cik", "company_name", "ticker", "industry_group", "state_of_incorporation")


@query("prj25_staged_metrics", f"SELECT cik, period_end, form, revenues, {rnd('gross_profit / nullif(revenues, 0)')} AS gross_margin, {rnd('operating_income / nullif(revenues, 0)')} AS operating_margin, {rnd('net_income / nullif(revenues, 0)')} AS net_margin, {rnd('current_assets / nullif(current_liabilities, 0)')} AS current_ratio, {rnd('long_term_debt / nullif(stockholders_equity, 0)')} AS debt_to_equity FROM metrics WHERE period_end >= DATE '1996-01-01'")
def _(t):
    return rounded(marts.staged_metrics(facts_ops.period_metrics(t.facts), "1996-01-01"))


@query("stg_filings", """SELECT regexp_replace(accession_number, '[^0-9A-Za-z]', '', 'g') AS accession_key, accession_number, cik, form_type AS form, false AS is_amendment,
  filing_date, period_of_report, CAST(date_diff('day', period_of_report, filing_date) AS INT) AS days_to_file FROM t_filings""")
def _(t):
    return marts.staged_filings(t.filings)


@query("stg_financial_facts", r"""SELECT cik, regexp_replace(accession_number, '[^0-9A-Za-z]', '', 'g') AS accession_key, 'us-gaap:' || concept AS tag, concept,
  regexp_replace(concept, '([a-z0-9])([A-Z])', '\1 \2', 'g') AS concept_label, form, unit, value, period_end, filed FROM t_facts""")
def _(t):
    return marts.staged_facts(t.facts)


# --- price series -------------------------------------------------------------------------------

CTES["annual"] = f"""
SELECT ticker, year(date) AS year, max(date) AS period_end_raw, CAST(sum(CAST(close AS DECIMAL(28,8))) AS DOUBLE) / count(close) AS avg_close, CAST(sum(volume) AS BIGINT) AS total_volume,
  first(open ORDER BY date, seq) FILTER (open IS NOT NULL) AS open_price, last(close ORDER BY date, seq) AS close_price, count(close) AS trading_days,
  CAST(sum(CAST(close AS DECIMAL(28,8))) AS DOUBLE) / count(close) * sum(volume) / 1e3 AS revenues FROM t_prices GROUP BY 1, 2"""


@query("ag01_annual_prices", f"SELECT ticker, year, period_end_raw, {_r(['avg_close', 'open_price', 'close_price'])}, total_volume, trading_days, {rnd('revenues', 2)} AS revenues FROM annual")
def _(t):
    from riskweave.operators.prices import annual_prices

    out = annual_prices(t.prices)
    return rounded(out.withColumn("revenues", F.round("revenues", 2)))


@query("wn07_annual_growth", f"SELECT ticker, year, {rnd('(revenues - prev) / nullif(prev, 0)')} AS revenue_yoy_growth FROM (SELECT *, lag(revenues) OVER (PARTITION BY ticker ORDER BY year) AS prev FROM annual)")
def _(t):
    from riskweave.operators.prices import annual_growth, annual_prices

    return rounded(annual_growth(annual_prices(t.prices)).select("ticker", "year", "revenue_yoy_growth"))


@query("jn15_owned_annual_prices", "SELECT a.ticker, a.year, o.cik, o.sector FROM annual a JOIN (SELECT ticker, lpad(CAST(('0x' || substr(md5(ticker), 1, 8))::BIGINT % 9000000 + 1000000 AS VARCHAR), 10, '0') AS cik, coalesce(sector, 'Unknown') AS sector FROM t_owners) o ON a.ticker = o.ticker")
def _(t):
    from riskweave.operators.prices import annual_prices, with_owner

    owners = t.price_owners.withColumn("cik", X.derived_cik("ticker"))
    return with_owner(annual_prices(t.prices), owners).select("ticker", "year", "cik", "sector")


@query("prj09_statement_proxies")
def _(t):
    from riskweave.operators.prices import annual_growth, annual_prices, statement_proxies, with_owner

    owners = t.price_owners.withColumn("cik", X.derived_cik("ticker"))
    return statement_proxies(with_owner(annual_growth(annual_prices(t.prices)), owners))


@query("jn13_selected_prices", "SELECT p.ticker, count(*) AS days FROM t_prices p WHERE EXISTS (SELECT 1 FROM t_owners o WHERE o.ticker = p.ticker AND o.sector = 'Energy') GROUP BY 1")
def _(t):
    from riskweave.operators.prices import selected

    return selected(t.prices, t.price_owners.where("sector = 'Energy'")).groupBy("ticker").agg(F.count("*").alias("days"))


@query("ag30_load_stats", "SELECT count(*) AS n_rows, count(DISTINCT ticker) AS tickers, min(date) AS first_day, max(date) AS last_day FROM t_prices")
def _(t):
    return t.prices.agg(F.count("*").alias("n_rows"), F.countDistinct("ticker").alias("tickers"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


# --- data quality -------------------------------------------------------------------------------


@query("dq01_revenue_not_negative", "SELECT * FROM (SELECT o_orderkey AS id, o_totalprice - 2000 AS revenues FROM orders) WHERE revenues < 0")
def _(t):
    from riskweave.operators.quality import negative_values

    return negative_values(t.raw("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") - 2000).alias("revenues")), "revenues")


@query("ag10_duplicate_periods", "SELECT cik, fiscal_year, count(*) AS n FROM (SELECT cik, year(period_end) AS fiscal_year FROM t_facts WHERE form = '10-K') GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    from riskweave.operators.quality import duplicates

    return duplicates(t.facts.where("form = '10-K'").withColumn("fiscal_year", F.year("period_end")), ["cik", "fiscal_year"])


@query("dq03_not_null_unique", """SELECT 'not_null' AS rule, 'filing_date' AS columns, count(*) - count(filing_date) AS violations FROM t_filings
UNION ALL SELECT 'not_null', 'accession_number', count(*) - count(accession_number) FROM t_filings
UNION ALL SELECT 'unique', 'accession_number', count(*) FROM (SELECT accession_number FROM t_filings GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'cik,period_of_report', count(*) FROM (SELECT cik, period_of_report FROM t_filings GROUP BY 1, 2 HAVING count(*) > 1)""")
def _(t):
    from riskweave.operators.quality import check_rules

    return check_rules(t.filings, ["filing_date", "accession_number"], [["accession_number"], ["cik", "period_of_report"]])


@query("dq04_references", "SELECT 'filings.cik' AS reference, count(*) AS orphans FROM t_scored s WHERE NOT EXISTS (SELECT 1 FROM t_companies c WHERE c.cik = s.cik)")
def _(t):
    from riskweave.operators.quality import orphans

    return orphans(t.scored, t.companies, ["cik"], "filings.cik")


@query("dq06_rejected_facts", "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN unit NOT IN ('USD','shares','pure') THEN 'unit' WHEN period_end IS NULL OR period_end < DATE '1996-01-01' THEN 'period' WHEN form NOT IN ('10-K','10-K/A','10-Q','10-Q/A') THEN 'form' WHEN value IS NULL THEN 'value' ELSE 'accepted' END AS reason FROM t_facts) GROUP BY 1")
def _(t):
    from riskweave.sources.nested import reject_reason

    return t.facts.groupBy(F.coalesce(reject_reason("1996-01-01"), F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


# --- features ----------------------------------------------------------------------------------

_RATIO_FEATURES = [f for f in K.FEATURES if f not in K.COUNT_FEATURES]
CTES["filled"] = (
    "SELECT cik, " + ", ".join(
        f"coalesce({f}, 0) AS {f}" if f in K.COUNT_FEATURES else f"coalesce(CAST({f} AS DOUBLE), (SELECT median(CAST({f} AS DOUBLE)) FROM candidates)) AS {f}"
        for f in K.FEATURES) + " FROM candidates"
)
CTES["features"] = (
    "SELECT cik, " + ", ".join(
        f"CAST({f} AS DOUBLE) AS {f}" if f in K.COUNT_FEATURES
        else f"greatest(least({f}, (SELECT quantile_cont({f}, 0.99) FROM filled)), (SELECT quantile_cont({f}, 0.01) FROM filled)) AS {f}"
        for f in K.FEATURES) + " FROM filled"
)


def feature_matrix(t):
    from riskweave.plans.features import build

    return build(candidates(t))


@query("ml01_feature_matrix", "SELECT cik, " + ", ".join(f"{rnd(f)} AS {f}" for f in K.FEATURES) + " FROM features")
def _(t):
    return rounded(feature_matrix(t).select("cik", *K.FEATURES))


@query("ml02_robust_scaled", "SELECT cik, " + ", ".join(
    f"{rnd(f'({f} - (SELECT median({f}) FROM features)) / coalesce(nullif((SELECT quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) FROM features), 0), 1)', 5)} AS {f}" for f in K.FEATURES) + " FROM features")
def _(t):
    from riskweave.plans.features import apply_scaler, fit

    return rounded(apply_scaler(*fit(candidates(t))).select("cik", *K.FEATURES), 5)


@query("ml08_trend_slopes", f"""SELECT cik, {', '.join(f"{rnd(f'coalesce(regr_slope(coalesce({c}, med_{c}, 0), x), 0)', 5)} AS {o}" for c, o in [('gross_margin', 'gm_slope_4q'), ('operating_margin', 'om_slope_4q'), ('ar_to_revenue', 'ar_slope_4q'), ('revenues', 'revenue_slope_4q'), ('total_signal_count', 'signal_count_trend')])}
FROM (SELECT *, n - rn AS x, {', '.join(f'median({c}) OVER (PARTITION BY cik) AS med_{c}' for c in ['gross_margin', 'operating_margin', 'ar_to_revenue', 'revenues', 'total_signal_count'])}
 FROM (SELECT *, count(*) OVER (PARTITION BY cik) AS n FROM (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY period_end DESC) AS rn FROM summary WHERE form = '10-Q') WHERE rn <= 4)) WHERE n >= 2 GROUP BY cik""")
def _(t):
    from riskweave.plans.features import trend_slopes

    slopes = trend_slopes(marts.financial_summary(history(t), t.companies))
    return rounded(slopes.drop("ticker", "company_name"), 5)


@query("ag27_feature_correlation", "SELECT a AS feature_a, b AS feature_b, corr FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})', 5)} AS corr FROM features" for i, a in enumerate(K.FEATURES[:8]) for b in K.FEATURES[i:8]) + ")")
def _(t):
    from riskweave.plans.features import correlation

    return rounded(correlation(feature_matrix(t), K.FEATURES[:8]), 5)


@query("ag28_feature_moments", "SELECT feature, mean, std FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {rnd(f'avg({f})', 5)} AS mean, {rnd(f'stddev_samp({f})', 5)} AS std FROM features" for f in K.FEATURES) + ")")
def _(t):
    from riskweave.plans.features import moments

    return rounded(moments(feature_matrix(t), K.FEATURES), 5)





_FLOWS = marts.FLOWS
CTES["one_a_quarter"] = """SELECT *, form IN ('10-K', '10-K/A') AS annual FROM rated
 QUALIFY row_number() OVER (PARTITION BY cik, fiscal_year, fiscal_quarter ORDER BY CASE WHEN form IN ('10-K', '10-K/A') THEN 0 ELSE 1 END, form, period_end DESC) = 1"""
CTES["single_quarters"] = "SELECT cik, fiscal_year, fiscal_quarter, annual, " + ", ".join(
    f"{x}, CASE WHEN NOT annual THEN {x} WHEN count({x}) FILTER (NOT annual) OVER y = 3 THEN {x} - sum({x}) FILTER (NOT annual) OVER y END AS quarter_{x}" for x in _FLOWS
) + " FROM one_a_quarter WINDOW y AS (PARTITION BY cik, fiscal_year)"
CTES["four_quarters"] = "SELECT cik, fiscal_year, fiscal_quarter, annual, " + ", ".join(
    f"quarter_{x}, CASE WHEN annual THEN {x} WHEN count(quarter_{x}) OVER f = 4 THEN sum(quarter_{x}) OVER f END AS t4q_{x}" for x in _FLOWS
) + " FROM single_quarters WINDOW f AS (PARTITION BY cik ORDER BY fiscal_year * 4 + fiscal_quarter RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)"
_MARGINS = [("gross", "gross_profit"), ("operating", "operating_income"), ("net", "net_income")]


@query("wn16_true_quarters", "SELECT cik, fiscal_year, fiscal_quarter, annual, " + ", ".join(f"{rnd(p + x, 4)} AS {p}{x}" for p in ("quarter_", "t4q_") for x in _FLOWS)
    + ", " + ", ".join(f"{rnd(f'CASE WHEN t4q_revenues > 0 THEN t4q_{a} / t4q_revenues END', 4)} AS t4q_{m}_margin" for m, a in _MARGINS) + " FROM four_quarters")
def _(t):
    rated = marts.ratios(facts_ops.with_yoy_growth(facts_ops.period_metrics(t.facts)))
    return rounded(marts.true_quarters(rated), 4)
