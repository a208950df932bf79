import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riskweave.catalog import jobs
from riskweave.functions import constants as K
from riskweave.operators import network as N
from riskweave.operators.facts import period_metrics
from riskweave.plans import marts
from riskweave.sources import sinks
from riskweave.sources.tables import Tables


def test_dashboard_works_out_candidates_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    names = {"industry_group": F.when(F.col("id") < 2, "a").otherwise("b"), **{f"t4q_{m}_margin": F.lit(0.1) for m in ("gross", "operating", "net")}}
    for c in ("cik", "ticker", "company_name", "risk_tier", "dominant_signal"):
        names[c] = F.col("id").cast("string")
    for c in ("pre_ml_risk_score", "total_signal_count", "latest_period", "revenues", "gross_margin", "operating_margin", "net_margin", "current_ratio", "debt_to_equity",
              "ar_to_revenue", "revenue_yoy_growth", "has_late_filings", "late_filings_count", "t4q_total_revenues", *K.FLAGS):
        names[c] = F.col("id").cast("double")
    rows = spark.range(5).withColumns(names)
    got = {r["cik"]: r for r in marts.company_dashboard(rows.mapInPandas(counted, rows.schema)).collect()}
    assert seen.value == 5
    assert got["0"]["gross_margin_vs_peers"] == -0.5 and got["4"]["industry_med_gross_margin"] == got["4"]["industry_avg_gross_margin"] == 3.0


def test_ties_of_a_scoring_run_are_worked_out_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(jobs, "cut_lineage", lambda df: calls.append(df) or df)
    t = SimpleNamespace(
        companies=spark.createDataFrame([("a", "A", "A co", "x"), ("b", "B", "B co", "x")], "cik string, ticker string, company_name string, industry_group string"),
        auditors=spark.createDataFrame([], "cik string, auditor_id string, auditor string, audit_opinion string, audit_fee_millions double"),
        relationships=spark.createDataFrame([("a", "b", "A co", "B co", "SUBSIDIARY", 1.0)], "parent_cik string, subsidiary_cik string, parent_name string, subsidiary_name string, relationship_type string, ownership_pct double"))
    risk = jobs.network_of(t)
    for score in (10.0, 50.0):
        ml = spark.createDataFrame([("a", score, "LOW", False, 0.0)], "cik string, ml_risk_score double, risk_tier string, is_anomaly boolean, pre_ml_risk_score double")
        got = {r["cik"]: r["network_risk_score"] for r in risk(ml).collect()}
        assert got == pytest.approx({"a": 0.0, "b": 0.3 * score})
    assert len(calls) == 1


def test_metrics_move_dates_and_join_no_python_rows(spark):
    shape = "cik string, accession_number string, concept string, unit string, value double, period_end date, filed date, form string"
    day = datetime.date(2020, 3, 31)
    rows = [("c", "1", "Revenues", "USD", 1.0, day, None, "10-Q"), ("c", "0", "Revenues", "USD", 2.0, day, datetime.date(2020, 4, 1), "10-Q"),
            ("c", None, "Assets", "USD", 3.0, day, None, "10-Q"), ("c", "2", "Assets", "USD", 4.0, day, None, "10-Q"), ("c", "2", "Assets", "EUR", 5.0, day, None, "10-Q")]
    facts = spark.createDataFrame(rows, shape)
    for df in (facts, facts.withColumn("filed", F.col("filed").cast("string"))):
        got = period_metrics(df).collect()
        assert [(r["revenues"], r["total_assets"]) for r in got] == [(2.0, 4.0)]
    plan = period_metrics(spark.range(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema]))._jdf.queryExecution().analyzed().toString()
    assert "LogicalRDD" not in plan and "max_by" not in plan and "cast(filed" not in plan


def test_batches_move_columns_of_the_order_once(spark, tmp_path):
    path, shape = str(tmp_path / "t"), "id string, label string, value double, filed int"
    rules = dict(keys=["id"], keep=["label"], order=["filed", "value"])
    sinks.write_batch(spark.createDataFrame([("a", "l1", 5.0, 3), ("a", "l0", 4.0, 2), ("b", None, None, None)], shape), path, 0)
    sinks.write_batch(spark.createDataFrame([("a", "l9", 1.0, 1), ("c", "l2", 2.0, None), ("c", "l3", 3.0, None)], shape), path, 1)
    out = sinks.current_rows(spark, path, shape, **rules)
    assert sorted(map(tuple, out.collect()), key=str) == [("a", "l0", 1.0, 1), ("b", None, None, None), ("c", "l2", 3.0, None)]
    assert "max_by" not in out._jdf.queryExecution().toString()
    mapped = f"{shape}, more array<map<string,int>>"
    sinks.write_batch(spark.createDataFrame([("a", "l", 1.0, 1, [{"x": 1}])], mapped), f"{path}-maps", 0)
    assert sinks.current_rows(spark, f"{path}-maps", mapped, **rules).first()["more"] == [{"x": 1}]


def test_moves_count_modularity_on_the_way(spark, monkeypatch):
    edges = spark.createDataFrame([(f"{c}{i}", f"{c}{j}") for c in "abc" for i in range(4) for j in range(i)] + [("a0", "b0"), ("b1", "c1")], "src string, dst string")
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    links = N.undirected(edges).withColumn("w", F.lit(1.0))
    part = links.groupBy(F.col("u").alias("id")).agg(F.sum("w").alias("k")).withColumn("community", F.substring("id", 1, 1))
    moved, score = N._half_move(links, part, links.count(), 0.0, F.lit(False))
    assert score == pytest.approx(N.modularity(edges, part, "community")) and moved.exceptAll(part).isEmpty()
    monkeypatch.delattr(N, "_modularity")
    assert {r["community_id"] for r in N.louvain(nodes, edges).collect()} == {"a0", "b0", "c0"}


def test_leads_of_lots_come_from_one_narrow_pass(spark, tmp_path):
    line = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_returnflag string, l_shipdate timestamp"
    day = datetime.datetime(1997, 1, 1)
    rows = [(2, 1, 8, 5, 1.0, 0.0, "N", day), (1, 2, 8, 6, 2.0, 0.0, "N", day), (1, 1, 8, None, 3.0, 0.0, "N", None), (3, 1, 8, 5, 4.0, 0.0, "N", day), (3, 2, 9, 7, 4.0, 0.0, "N", day)]
    spark.createDataFrame(rows, line).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    ties = Tables(spark, str(tmp_path)).relationships
    assert [(r["parent_cik"], r["subsidiary_cik"], r["ownership_pct"]) for r in ties.collect()] == [("0000000006", "0000000005", 4.0)]
    assert "min_by" not in ties._jdf.queryExecution().analyzed().toString()
