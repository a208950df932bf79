import numpy as np
import pandas as pd
import pytest

from riskweave.functions import constants as K
from riskweave.operators import first_digit as D


def judged(spark, values):
    df = spark.createDataFrame(pd.DataFrame({"cik": "1", "value": np.asarray(values, dtype=float)}))
    return D.conformity(D.digit_counts(df, ["cik"]), ["cik"]).first()


def test_log_uniform_values_conform(spark):
    rng = np.random.default_rng(42)
    row = judged(spark, 10 ** rng.uniform(0, 6, 1000))
    assert row["mad_score"] < 0.012 and row["conformity_rating"] in ("Acceptable", "Marginal") and row["benford_risk_score"] < 60


def test_uniform_values_do_not(spark):
    rng = np.random.default_rng(42)
    row = judged(spark, rng.integers(10, 100, 500))
    assert row["conformity_rating"] == "Non-conforming"
    assert "NON-CONFORMING" in row["interpretation"]


def test_short_series(spark):
    row = judged(spark, [100.0, 200.0, 300.0])
    assert (row["conformity_rating"], row["benford_risk_score"], row["chi_square_p_value"]) == ("Insufficient Data", 0.0, 1.0)
    assert row["suspicious_digits"] == []


def test_statistics_by_hand(spark):
    counts = dict(zip(range(1, 10), [40, 10, 10, 10, 10, 5, 5, 5, 5]))
    values = [d * 10.0 for d, c in counts.items() for _ in range(c)]
    row = judged(spark, values)
    chi2 = sum((c - K.FIRST_DIGIT_SHARE[d] * 100) ** 2 / (K.FIRST_DIGIT_SHARE[d] * 100) for d, c in counts.items())
    h = chi2 / 2
    assert row["chi_square_statistic"] == pytest.approx(chi2, abs=1e-4)
    assert row["chi_square_p_value"] == pytest.approx(np.exp(-h) * (1 + h + h**2 / 2 + h**3 / 6), abs=1e-4)


def test_leading_digit_ignores_sign_zero_and_null(spark):
    df = spark.createDataFrame([(-345.0,), (0.0,), (None,), (0.0072,), (1000.0,)], "v double")
    assert [r[0] for r in df.select(D.leading_digit("v")).collect()] == [3, None, None, 7, 1]


def test_absent_digits_are_kept(spark):
    df = spark.createDataFrame([("1", 11.0)] * 60, "cik string, value double")
    rows = D.digit_rows(D.digit_counts(df, ["cik"]), ["cik"]).collect()
    assert len(rows) == 9 and sum(r["observed"] for r in rows) == 60 and [r["observed"] for r in rows if r["digit"] == 9] == [0]


def test_companies_without_facts_are_left_out(spark):
    facts = spark.createDataFrame([("1", "10-K", 5.0), ("1", "8-K", 5.0), ("1", "10-Q", 0.0)], "cik string, form string, value double")
    companies = spark.createDataFrame([("1", "A", ""), ("2", "B", "B")], "cik string, company_name string, ticker string")
    rows = D.company_conformity(facts, companies).collect()
    assert [(r["cik"], r["ticker"], r["n_observations"]) for r in rows] == [("1", "1", 1)]

