import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riskweave.functions import exprs as X
from riskweave.operators import facts as P
from riskweave.plans import marts
from riskweave.sources import nested


def facts_doc(entries):
    return json.dumps({"facts": {"us-gaap": {"Revenues": {"label": "Revenues", "units": {"USD": entries}}, "Assets": {"units": {"EUR": entries, "shares": entries}}}}})


def entry(end, val, filed, form="10-K", accn="a-1"):
    return {"accn": accn, "end": end, "val": val, "form": form, "filed": filed}


def docs(spark, *bodies):
    return spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "cik string, body string")


def test_latest_filed_value_wins(spark):
    body = facts_doc([entry("2023-09-30", 1.0, "2023-10-01"), entry("2023-09-30", 383285000000.0, "2023-11-03", accn="a-2")])
    rows = P.period_metrics(nested.accepted_facts(docs(spark, body))).collect()
    assert len(rows) == 1 and rows[0]["revenues"] == 383285000000.0 and rows[0]["total_assets"] is None


def test_rejects_say_why(spark):
    body = facts_doc([entry("2018-12-31", 1.0, "2019-01-01"), entry("2023-12-31", 1.0, "2024-01-01", form="8-K"), entry("2023-12-31", None, "2024-01-01")])
    reasons = {r["reason"]: r["n"] for r in nested.rejected_facts(docs(spark, body)).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {"unit": 3, "period": 2, "form": 2, "value": 2}
    assert nested.accepted_facts(docs(spark, body)).count() == 0


def test_label_defaults_to_concept(spark):
    rows = nested.accepted_facts(docs(spark, facts_doc([entry("2023-12-31", 5.0, "2024-01-01")]))).collect()
    assert {(r["concept"], r["label"], r["unit"]) for r in rows} == {("Revenues", "Revenues", "USD"), ("Assets", "Assets", "shares")}


METRICS = "cik string, period_end date, form string, revenues double"


@pytest.mark.parametrize("how", [P.with_yoy_growth, P.yoy_self_join])
def test_growth_needs_the_same_day_one_year_before(spark, how):
    rows = [
        ("1", dt.date(2022, 9, 30), "10-K", 394328e6), ("1", dt.date(2023, 9, 30), "10-K", 383285e6),
        ("2", dt.date(2023, 2, 28), "10-K", 1.0), ("2", dt.date(2024, 2, 29), "10-K", 2.0),
        ("3", dt.date(2022, 12, 31), "10-Q", 1.0), ("3", dt.date(2023, 12, 31), "10-K", 2.0),
        ("4", dt.date(2022, 12, 31), "10-K", 0.0), ("4", dt.date(2023, 12, 31), "10-K", 2.0),
        ("5", dt.date(2022, 12, 31), "10-K", -4.0), ("5", dt.date(2023, 12, 31), "10-K/A", 2.0),
    ]
    out = how(spark.createDataFrame(rows, METRICS)).where("revenue_yoy_growth is not null")
    got = {r["cik"]: r["revenue_yoy_growth"] for r in out.collect()}
    assert got == pytest.approx({"1": (383285 - 394328) / 394328, "5": 1.5})


def test_filings_are_zipped_by_place(spark):
    body = json.dumps({"filings": {"recent": {
        "accessionNumber": ["0-1", "0-2", "0-3"], "form": ["10-K", "10-Q", "10-K"], "filingDate": ["2023-11-03", "2023-08-04", "2018-11-05"],
        "reportDate": ["2023-09-30", "2023-07-01", "2018-09-29"], "primaryDocument": ["a.htm"], "documentCount": [90, 80, 70]}}})
    rows = nested.filing_rows(docs(spark, body)).orderBy("accession_number").collect()
    assert [(r["accession_number"], r["form_type"], r["primary_document"], r["document_count"]) for r in rows] == [("01", "10-K", "a.htm", 90), ("02", "10-Q", None, 80)]
    assert nested.filing_rows(docs(spark, json.dumps({"name": "x"}))).count() == 0


def test_profile_of_a_sparse_document(spark):
    row = nested.company_profiles(docs(spark, json.dumps({"name": "Acme", "tickers": [], "exchanges": None}))).first()
    assert (row["name"], row["ticker"], row["exchanges"]) == ("Acme", None, None)


def test_landed_files_are_read_whole(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text('{"name": "' + name + '",\n "tickers": ["T"]}')
    rows = nested.read_documents(spark, str(tmp_path)).select(F.regexp_extract("path", r"(\w+)\.json", 1).alias("cik"), "body")
    assert {(r["cik"], r["name"], r["ticker"]) for r in nested.company_profiles(rows).collect()} == {("a", "a", "T"), ("b", "b", "T")}


def test_auditors_and_relationships(spark):
    a = json.dumps({"320193": {"auditor": "EY", "auditor_id": "AUD_EY", "audit_opinion": "Unqualified", "audit_fee_millions": 20.1}})
    assert nested.auditor_rows(docs(spark, a)).first()["cik"] == "0000320193"
    r = json.dumps([{"parent_cik": "1", "subsidiary_cik": "AMZN_AWS", "relationship_type": "SUBSIDIARY"}, {"parent_cik": "1", "subsidiary_cik": "2", "relationship_type": "ODD"}])
    got = {(x["subsidiary_cik"], x["edge_type"]) for x in nested.relationship_rows(docs(spark, r)).collect()}
    assert got == {("AMZN_AWS", "SUBSIDIARY_OF"), ("0000000002", "ODD")}


def test_ids(spark):
    df = spark.createDataFrame([("320193",), ("320193.0",), ("0000320193",), ("AMZN_AWS",), (None,)], "c string")
    assert [r[0] for r in df.select(X.pad_cik("c")).collect()] == ["0000320193"] * 3 + ["AMZN_AWS", None]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(X.safe_divide("n", "d")).collect()] == [None, None, 0.25]


def test_one_annual_row_per_year_keeps_other_forms(spark):
    rows = [("1", 2023, "10-K", dt.date(2023, 6, 30), "a"), ("1", 2023, "10-K", dt.date(2023, 12, 31), "b"), ("1", 2023, "10-Q", dt.date(2023, 3, 31), "c"), ("1", 2023, "10-Q", dt.date(2023, 9, 30), "d")]
    df = spark.createDataFrame(rows, "cik string, fiscal_year int, form string, period_end date, id string")
    assert {r["id"] for r in marts.one_annual_per_year(df).collect()} == {"b", "c", "d"}


def test_newest_company_row(spark):
    rows = [("7", "old", 1), ("0000000007", "new", 2), ("8", "only", 1)]
    out = marts.newest_companies(spark.createDataFrame(rows, "cik string, name string, updated_at int"))
    assert {(r["cik"], r["name"]) for r in out.collect()} == {("0000000007", "new"), ("0000000008", "only")}


def test_trailing_quarters_run_across_forms(spark):
    from riskweave.plans.marts import trends

    rows = [("1", q // 4 + 2000, q % 4 + 1, "10-K" if q % 4 == 3 else "10-Q", float(q)) for q in range(8)]
    rows.append(("1", 2001, 4, "10-Q", 1000.0))  # the same quarter once more
    df = spark.createDataFrame(rows, "cik string, fiscal_year int, fiscal_quarter int, form string, revenues double")
    empty = ["gross_margin", "operating_margin", "net_margin", "ar_to_revenue", "accounts_receivable", "operating_cashflow", "net_income", "debt_to_equity", "current_ratio"]
    df = df.withColumns({c: F.lit(None).cast("double") for c in empty}).withColumn("period_end", F.make_date("fiscal_year", F.col("fiscal_quarter") * 3, F.lit(28)))
    got = {(r.fiscal_year, r.fiscal_quarter, r.form): r.t4q_total_revenues for r in trends(df).collect()}
    assert got[2000, 4, "10-K"] == 0 + 1 + 2 + 3 and got[2001, 2, "10-Q"] == 2 + 3 + 4 + 5
    assert got[2001, 4, "10-K"] == got[2001, 4, "10-Q"] == 4 + 5 + 6 + 7
