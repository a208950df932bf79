"""First-digit queries."""

from pyspark.sql import functions as F

from riskweave.catalog.base import CTES, query, rnd, rounded
from riskweave.functions import constants as K
from riskweave.operators import first_digit as D

_DIGIT = "CAST(floor(abs({v}) / pow(10.0::DOUBLE, floor(log10(abs({v}))))) AS INT)"
_E = K.FIRST_DIGIT_SHARE

CTES["digit_counts"] = (
    "SELECT cik, count(*) AS n, "
    + ", ".join(f"count(*) FILTER (d = {i}) AS c{i}" for i in _E)
    + f" FROM (SELECT cik, {_DIGIT.format(v='value')} AS d FROM t_facts WHERE form IN ('10-K', '10-Q') AND value <> 0) WHERE d BETWEEN 1 AND 9 GROUP BY cik"
)
_GAPS = [f"abs(c{i} / n::DOUBLE - {e}::DOUBLE)" for i, e in _E.items()]


def _stats(source: str, key: str) -> str:
    return f"""
SELECT *, CASE WHEN n < 50 THEN 1.0::DOUBLE ELSE exp(-chi2/2) * (1 + chi2/2 + (chi2/2)*(chi2/2)/2 + (chi2/2)*(chi2/2)*(chi2/2)/6) END AS p,
  CASE WHEN n < 50 THEN 'Insufficient Data' WHEN mad < 0.006::DOUBLE THEN 'Acceptable' WHEN mad < 0.012::DOUBLE THEN 'Marginal' ELSE 'Non-conforming' END AS kind
FROM (SELECT {key}, n,
  CASE WHEN n < 50 THEN 0.0::DOUBLE ELSE ({' + '.join(_GAPS)}) / 9 END AS mad,
  CASE WHEN n < 50 THEN 0.0::DOUBLE ELSE {' + '.join(f'(c{i} - n * {e}::DOUBLE) * (c{i} - n * {e}::DOUBLE) / (n * {e}::DOUBLE)' for i, e in _E.items())} END AS chi2,
  CASE WHEN n < 50 THEN [] ELSE list_filter([{', '.join(f'CASE WHEN {g} > 0.30::DOUBLE * {e}::DOUBLE THEN {i} END' for g, (i, e) in zip(_GAPS, _E.items()))}], lambda x: x IS NOT NULL) END AS digits
 FROM {source})"""


CTES["digit_stats"] = _stats("digit_counts", "cik")
CTES["benford"] = f"""
SELECT s.cik, c.company_name, c.ticker, n AS n_observations, {rnd('mad', 6)} AS mad_score, {rnd('chi2', 4)} AS chi_square_statistic,
  {rnd('p', 4)} AS chi_square_p_value, kind AS conformity_rating,
  CASE WHEN n < 50 THEN 0.0::DOUBLE ELSE {rnd('least(100.0::DOUBLE, mad / 0.020::DOUBLE * 60) + greatest(0.0::DOUBLE, (1 - p) * 40)', 1)} END AS benford_risk_score,
  array_to_string(digits, ',') AS suspicious_digits,
  CASE kind WHEN 'Insufficient Data' THEN 'Insufficient data for Benford analysis (need ≥50 observations)'
   WHEN 'Acceptable' THEN printf('Financial data (%d observations) conforms to Benford''s Law (MAD=%.4f). No forensic concerns from digit analysis.', n, mad)
   WHEN 'Marginal' THEN printf('Marginal Benford conformity (MAD=%.4f, p=%.3f). Suspicious digit positions: %s. Recommend cross-checking with cash flow signals.', mad, p, CASE WHEN len(digits) > 0 THEN array_to_string(digits, ', ') ELSE 'none' END)
   ELSE printf('NON-CONFORMING: Significant Benford deviation (MAD=%.4f, p=%.3f). Suspicious digits: %s. This pattern is consistent with financial data manipulation. Escalate for detailed review.', mad, p, CASE WHEN len(digits) > 0 THEN array_to_string(digits, ', ') ELSE 'multiple' END) END AS interpretation
FROM digit_stats s JOIN t_companies c ON s.cik = c.cik"""


@query("ag04_leading_digits", f"SELECT {_DIGIT.format(v='l_extendedprice')} AS digit, count(*) AS n FROM lineitem WHERE l_extendedprice <> 0 GROUP BY 1")
def _(t):
    return t.raw("lineitem").groupBy(D.leading_digit("l_extendedprice").alias("digit")).agg(F.count("*").alias("n"))


@query(
    "ag05_digit_counts",
    f"SELECT cik, n, digit, observed, {rnd('observed / n::DOUBLE')} AS observed_share, expected_share FROM ("
    + " UNION ALL ".join(f"SELECT cik, n, {i} AS digit, c{i} AS observed, {e}::DOUBLE AS expected_share FROM digit_counts" for i, e in _E.items())
    + ")",
)
def _(t):
    used = t.facts.where(F.col("form").isin("10-K", "10-Q") & (F.col("value") != 0))
    return rounded(D.digit_rows(D.digit_counts(used, ["cik"]), ["cik"]))


@query("ag06_company_conformity", "SELECT * FROM benford")
def _(t):
    return D.company_conformity(t.facts, t.companies)


_POOL = "SELECT l_suppkey, v FROM (SELECT l_suppkey, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v FROM lineitem) WHERE v <> 0"
CTES["pool_counts"] = (
    "SELECT l_suppkey, count(*) AS n, " + ", ".join(f"count(*) FILTER (d = {i}) AS c{i}" for i in _E)
    + f" FROM (SELECT l_suppkey, {_DIGIT.format(v='v')} AS d FROM ({_POOL})) WHERE d BETWEEN 1 AND 9 GROUP BY l_suppkey"
)
CTES["pool_stats"] = _stats("pool_counts", "l_suppkey")


@query(
    "ag07_pooled_conformity",
    f"SELECT l_suppkey, n AS n_observations, {rnd('mad', 6)} AS mad_score, {rnd('chi2', 4)} AS chi_square_statistic, {rnd('p', 4)} AS chi_square_p_value, kind AS conformity_rating FROM pool_stats",
)
def _(t):
    found = D.pooled_conformity(t.raw("lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_suppkey"])
    return found.select("l_suppkey", "n_observations", "mad_score", "chi_square_statistic", "chi_square_p_value", "conformity_rating")


@query(
    "ag25_conformity_counts",
    "SELECT conformity_rating, count(*) AS companies FROM benford GROUP BY 1",
)
def _(t):
    return D.company_conformity(t.facts, t.companies).groupBy("conformity_rating").agg(F.count("*").alias("companies"))


@query(
    "gv05_non_conforming_list",
    "SELECT ticker, company_name, mad_score, benford_risk_score, chi_square_p_value, interpretation FROM benford WHERE conformity_rating = 'Non-conforming' ORDER BY benford_risk_score DESC",
)
def _(t):
    from riskweave.operators.monitoring import non_conforming

    return non_conforming(D.company_conformity(t.facts, t.companies))
