"""Approximate search, sampled betweenness, contagion over auditors, drift in the stream, true quarters."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import graph as G
from riskweave.operators import lsh
from riskweave.operators import network as N
from riskweave.operators import vectors as V
from riskweave.streaming import jobs as J
from test_network import graph

FOLDER = "/root/testdata/sf0.1"


# --- approximate search


def test_recall_and_exactness_of_the_index(spark):
    e = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    index = lsh.build_index(e)
    queries = e.where("vec_id % 40 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    exact = V.cosine_top_k(e.select("vec_id", "embedding"), queries, 6).cache()
    found = lsh.approximate_top_k(index, queries, 6).cache()
    assert lsh.recall(found, exact) >= 0.9
    both = exact.join(found.withColumnRenamed("similarity", "again"), ["query_id", "vec_id"]).collect()
    assert all(abs(r.similarity - r.again) < 1e-5 for r in both)
    assert index.rows == e.count() == index.vectors(spark).count() and index.postings(spark).count() == index.rows * index.tables


def test_recall_with_far_fewer_candidates_than_rows(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, 32))
    x = centres[np.arange(6000) % 60] + 0.35 * rng.normal(size=(6000, 32))
    e = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    index = lsh.build_index(e)
    queries = e.where("vec_id < 60").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    exact = V.cosine_top_k(e, queries, 6)
    found = [lsh.recall(lsh.approximate_top_k(index, queries, 6, flips=f), exact) for f in (0, 1, 4)]
    assert found[0] <= found[1] <= found[2] and found[1] >= 0.9 and found[2] >= 0.95
    assert lsh.candidates(index, queries, flips=1).count() < 0.25 * 60 * 6000


def test_index_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [0.0, 0.0]), (7, [-1.0, 0.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = lsh.build_index(e)
    queries = spark.createDataFrame([(0, [2.0, 0.0])], "query_id long, query array<double>")
    assert index.rows == 4
    got = [(r.vec_id, r.similarity) for r in lsh.approximate_top_k(index, queries, 2).orderBy("place").collect()]
    assert got == [(1, pytest.approx(1.0)), (2, pytest.approx(1.0))]
    none = lsh.build_index(e.limit(0))
    assert none.rows == 0 and lsh.approximate_top_k(none, queries.select("query_id", F.array(F.lit(1.0)).alias("query")), 2).count() == 0


# --- sampled betweenness


def test_sampled_betweenness_keeps_its_bound(spark):
    names, edges, nodes, df = graph(spark, 90, 160, 5)
    exact = {r["id"]: r["betweenness"] for r in N.betweenness(nodes, df).collect()}
    for error in (0.9, 1e-6):
        rows = N.sampled_betweenness(nodes, df, error=error, first=16).collect()
        assert len(rows) == len(names)
        for r in rows:
            assert abs(r["betweenness"] - exact[r["id"]]) <= r["bound"] + 1e-9 and r["bound"] <= error
    assert rows[0]["sources"] == len({x for e in edges for x in e}) and all(r["bound"] == 0 for r in rows)


def test_sampling_stops_early_on_a_larger_graph(spark):
    # ten to a hub, both ways: the hub lies between its nine and nothing else
    nodes = spark.range(1500).select(F.col("id").cast("string").alias("id"))
    edges = spark.range(1500).select(F.col("id").cast("string").alias("src"), (F.col("id") - F.col("id") % 10).cast("string").alias("dst"))
    edges = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst")
    rows = N.sampled_betweenness(nodes, edges, error=0.2, first=64).collect()
    assert rows[0]["sources"] < 750 and max(r["bound"] for r in rows) <= 0.2
    for r in rows:
        exact = 9 * 8 / (1499 * 1498) if int(r["id"]) % 10 == 0 else 0.0
        assert abs(r["betweenness"] - exact) <= r["bound"]


def test_betweenness_of_no_links(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    rows = N.sampled_betweenness(nodes, spark.createDataFrame([], "src string, dst string")).collect()
    assert [(r["betweenness"], r["bound"]) for r in rows] == [(0.0, 0.0)] * 2


# --- contagion


def test_contagion_leaves_the_own_score_out(spark):
    nodes = spark.createDataFrame([("a", "Company", 10.0), ("b", "Company", 50.0), ("c", "Company", 90.0), ("d", "Company", 70.0), ("e", "Company", 5.0), ("X", "Auditor", 0.0), ("Y", "Auditor", 0.0)], "id string, node_type string, ml_risk_score double")
    edges = spark.createDataFrame([("a", "X", "AUDITED_BY"), ("b", "X", "AUDITED_BY"), ("c", "X", "AUDITED_BY"), ("c", "X", "AUDITED_BY"), ("c", "Y", "AUDITED_BY"), ("d", "Y", "AUDITED_BY"), ("e", "d", "SUBSIDIARY_OF")], "src string, dst string, edge_type string")
    df = G.auditor_contagion(nodes, edges)
    got = {r.cik: (r.auditors, r.reached_clients, r.contagion_score) for r in df.collect()}
    assert got == {"a": (1, 2, pytest.approx(0.3 * 70)), "b": (1, 2, pytest.approx(0.3 * 50)), "c": (2, 3, pytest.approx(0.3 * 130 / 3)), "d": (1, 1, pytest.approx(0.3 * 90)), "e": (0, 0, 0.0)}


def test_contagion_of_a_hub_forms_no_pairs(spark):
    nodes = spark.range(20_001).select(F.when(F.col("id") == 0, "X").otherwise(F.col("id").cast("string")).alias("id"), F.when(F.col("id") == 0, "Auditor").otherwise("Company").alias("node_type"), F.lit(40.0).alias("ml_risk_score"))
    edges = spark.range(1, 20_001).select(F.col("id").cast("string").alias("src"), F.lit("X").alias("dst"), F.lit("AUDITED_BY").alias("edge_type"))
    got = G.auditor_contagion(nodes, edges).agg(F.min("contagion_score"), F.max("contagion_score"), F.min("reached_clients")).first()
    assert tuple(got) == (pytest.approx(12.0), pytest.approx(12.0), 19_999)


# --- drift in the stream


def test_drift_leaves_the_stream_over_batches_and_a_restart(spark, tmp_path):
    rng = np.random.default_rng(11)
    start = datetime(2024, 3, 1)
    hours = [float(x) for x in rng.choice([20.0, 28.0, 45.0, 70.0], 60)]
    rows = [(f"{h}-{i}", "risk_score_generated", start + timedelta(hours=h, minutes=7 * i), s + i - 3, s > 40) for h, s in enumerate(hours) for i in range(7)]
    schema = "audit_id string, event_type string, generated_at timestamp, final_risk_score double, is_anomaly boolean"
    landed, out, state = (str(tmp_path / x) for x in ("landed", "out", "state"))

    def land(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landed)

    land(rows[:100])
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    J.streamed_drift(stream(), out, state, delay="2 hours")
    for at in range(100, len(rows), 90):  # each run is a restart from the checkpoint
        land(rows[at : at + 90])
        found = J.streamed_drift(stream(), out, state, delay="2 hours")
    whole = J.windowed_monitor(spark.createDataFrame(rows, schema), "1 hour")
    closed = max(r[2] for r in rows) - timedelta(hours=2)
    wanted = [r for r in J.drift_rows(whole).collect() if r.window_start + timedelta(hours=1) <= closed]
    got = sorted((r.window_start, round(r.score_drift, 6), round(r.rate_drift, 6), r.severity) for r in found.collect())
    assert got == sorted((r.window_start, round(r.score_drift, 6), round(r.rate_drift, 6), r.severity) for r in wanted) and len(got) > 20


# --- quarters


def test_a_year_counts_once_in_four_quarters(spark):
    from riskweave.plans.marts import FLOWS, true_quarters

    rows = [(2022, q, "10-Q", 10.0 * q) for q in (1, 2, 3)] + [(2022, 4, "10-K", 100.0), (2022, 4, "10-Q", 7.0)] + [(2023, 1, "10-Q", 50.0), (2023, 2, "10-Q", 60.0), (2023, 4, "10-K", 300.0), (2024, 1, "10-Q", 70.0)]
    df = spark.createDataFrame([("1", *r) for r in rows], "cik string, fiscal_year int, fiscal_quarter int, form string, revenues double")
    df = df.withColumns({x: F.col("revenues") / 2 for x in FLOWS if x != "revenues"}).withColumn("period_end", F.make_date("fiscal_year", F.col("fiscal_quarter") * 3, F.lit(28)))
    got = {(r.fiscal_year, r.fiscal_quarter): r for r in true_quarters(df).collect()}
    assert len(got) == 8 and got[2022, 4].quarter_revenues == 100 - 60 and got[2022, 4].t4q_revenues == 100.0
    assert got[2023, 1].t4q_revenues == 20 + 30 + 40 + 50 and got[2023, 2].t4q_revenues == 30 + 40 + 50 + 60
    assert got[2023, 4].quarter_revenues is None and got[2023, 4].t4q_revenues == 300.0
    assert got[2024, 1].t4q_revenues is None and got[2022, 3].t4q_revenues is None
    assert got[2023, 1].t4q_gross_margin == 0.5 and got[2022, 4].quarter_net_income == 20.0
