import datetime
from collections import deque

import numpy as np
import pytest

from riskweave.operators import graph as G
from riskweave.operators import network as N
from riskweave.sources.tables import Tables


def graph(spark, n=40, m=55, seed=3):
    rng = np.random.default_rng(seed)
    names = [f"n{i:02d}" for i in range(n)]
    edges = sorted({(names[a], names[b]) for a, b in rng.integers(0, n, (m, 2)) if a != b})
    nodes = spark.createDataFrame([(x, "Company", x, x, float(i), i % 9 == 0) for i, x in enumerate(names)], "id string, node_type string, ticker string, name string, ml_risk_score double, is_anomaly boolean")
    return names, edges, nodes, spark.createDataFrame([(a, b, "PARTNERS_WITH") for a, b in edges], "src string, dst string, edge_type string")


def test_components_match_a_walk(spark):
    names, edges, nodes, df = graph(spark, 60, 45)
    near = {x: set() for x in names}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for x in names:
        if x not in want:
            todo, part = [x], {x}
            while todo:
                for y in near[todo.pop()] - part:
                    part.add(y)
                    todo.append(y)
            want.update({y: min(part) for y in part})
    got = {r["id"]: r["component"] for r in N.connected_components(nodes, df).collect()}
    assert got == want


def test_long_chain_closes(spark):
    nodes = spark.createDataFrame([(f"{i:03d}",) for i in range(90)], "id string")
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(89)], "src string, dst string")
    out = N.connected_components(nodes, edges)
    assert out.select("component").distinct().count() == 1


def test_pagerank_matches_dense_iteration(spark):
    names, edges, nodes, df = graph(spark)
    inside = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(inside)}
    a = np.zeros((len(inside), len(inside)))
    for s, d in edges:
        a[at[d], at[s]] = 1
    out = a.sum(0)
    a = np.where(out > 0, a / np.maximum(out, 1), 1 / len(inside))
    x = np.full(len(inside), 1 / len(inside))
    for _ in range(400):
        x = 0.85 * a @ x + 0.15 / len(inside)
    got = {r["id"]: r["pagerank"] for r in N.pagerank(nodes, df, tol=1e-8).collect()}
    assert sum(got.values()) == pytest.approx(1.0)
    for n in names:
        assert got[n] == pytest.approx(x[at[n]] if n in at else 0.0, abs=1e-5)


@pytest.mark.parametrize("max_states", [10**9, 700])
def test_betweenness_matches_brandes(spark, max_states):
    names, edges, nodes, df = graph(spark, 30, 60)
    inside = sorted({x for e in edges for x in e})
    out = {x: [d for s, d in edges if s == x] for x in names}
    want = dict.fromkeys(names, 0.0)
    for s in inside:
        order, parents, sigma, dist = [], {x: [] for x in names}, dict.fromkeys(names, 0.0), {s: 0}
        sigma[s] = 1.0
        todo = deque([s])
        while todo:
            v = todo.popleft()
            order.append(v)
            for w in out[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    todo.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    parents[w].append(v)
        delta = dict.fromkeys(names, 0.0)
        for w in reversed(order):
            for v in parents[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                want[w] += delta[w]
    n = len(inside)
    got = {r["id"]: r["betweenness"] for r in N.betweenness(nodes, df, max_states).collect()}
    assert got == pytest.approx({x: v / ((n - 1) * (n - 2)) for x, v in want.items()})


def test_betweenness_of_held_and_joined_links_agree(spark):
    _, edges, nodes, df = graph(spark, 40, 90, seed=8)
    links = df.select("src", "dst").distinct()
    sources = links.select(N.F.col("src").alias("id")).distinct()
    rows = lambda part: {r["id"]: (r["delta"], r["squares"]) for r in part.collect()}
    held, joined = rows(N._walker(links, 10**6)(sources)), rows(N._dependencies(sources, links))
    assert held.keys() == joined.keys() and max(d for d, _ in joined.values()) > 1
    assert all(held[k] == pytest.approx(joined[k]) for k in joined)
    assert N._walker(links, len(edges) - 1) is None


def test_betweenness_walks_several_sources_at_once(monkeypatch):
    # 300 rings of six with a chord each; a source reaches its ring alone
    src = np.repeat(np.arange(1800), 1 + (np.arange(1800) % 6 == 0))
    ends = np.concatenate([[6 * r + (i + 1) % 6] if i else [6 * r + 1, 6 * r + 3] for r in range(300) for i in range(6)]).astype(np.int32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(src))])
    walks, single = [], N._dependency
    monkeypatch.setattr(N, "_dependency", lambda sources, *a: walks.append(len(sources)) or single(sources, *a))
    together = N._dependency_sums(np.arange(1800), starts, ends)
    assert len(walks) < 20 and max(walks) == 256
    walks.clear()
    alone = N._dependency_sums(np.arange(1800), starts, ends, cells=1)
    assert walks == [1] * 1800
    walks.clear()
    # where the links of three sources do not fit, two are walked at once
    few = N._dependency_sums(np.arange(1800), starts, ends, room=20)
    assert set(walks) <= {1, 2}
    for other in (alone, few):
        assert all(a == pytest.approx(b) for a, b in zip(together, other, strict=True))
    # by hand: 1 lies before 2 from 0, 3, 4 and 5; 2 lies before 3, 4, 5 and 0 from 1, for from 0 the chord leads to 3
    assert together[2].all() and together[0][:6] == pytest.approx([10, 4, 4, 10, 10, 10])


def test_betweenness_of_a_cycle_takes_few_jobs(spark):
    n = 40
    edges = spark.createDataFrame([(f"c{i:02d}", f"c{(i + 1) % n:02d}") for i in range(n)], "src string, dst string")
    nodes = edges.select(N.F.col("src").alias("id"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = {r["id"]: r["betweenness"] for r in N.betweenness(nodes, edges).collect()}
    # a join of levels takes several jobs a level, of which a cycle has as many as nodes
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before) < n
    assert got == pytest.approx(dict.fromkeys(got, 0.5)) and len(got) == n


def test_louvain_beats_components(spark):
    rng = np.random.default_rng(0)
    blocks = [[f"{c}{i}" for i in range(8)] for c in "abc"]
    edges = [(x, y) for b in blocks for x in b for y in b if x < y and rng.random() < 0.8] + [("a0", "b0"), ("b1", "c1")]
    nodes = spark.createDataFrame([(x,) for b in blocks for x in b], "id string")
    df = spark.createDataFrame(edges, "src string, dst string")
    part = N.louvain(nodes, df)
    whole = N.connected_components(nodes, df).withColumnRenamed("component", "community_id")
    assert part.count() == 24
    assert N.modularity(df, part) > N.modularity(df, whole) + 0.4
    groups = {r["id"]: r["community_id"] for r in part.collect()}
    assert len({groups[x] for x in blocks[0]}) == 1


def test_louvain_does_not_end_unfinished(spark):
    edges = spark.createDataFrame([(f"{c}{i}", f"{c}{j}") for c in "abc" for i in range(4) for j in range(i)] + [("a0", "b0"), ("b1", "c1")], "src string, dst string")
    nodes = edges.select(N.F.col("src").alias("id")).union(edges.select("dst")).distinct()
    for limits in ({"max_rounds": 1}, {"max_levels": 1}):
        with pytest.raises(RuntimeError, match="still change"):
            N.louvain(nodes, edges, **limits)
    defaults = N.louvain.__defaults__
    assert N.louvain(nodes, edges).count() == 12 and min(defaults[:2]) >= 100


def test_neighbour_risk_counts_companies_only(spark):
    nodes = spark.createDataFrame([("a", "Company", 80.0), ("b", "Company", 20.0), ("c", "Company", 0.0), ("x", "Auditor", 0.0), ("z", "Company", 9.0)], "id string, node_type string, ml_risk_score double")
    edges = spark.createDataFrame([("a", "b", "P"), ("b", "a", "P"), ("a", "b", "C"), ("c", "b", "P"), ("a", "x", "AUDITED_BY")], "src string, dst string, edge_type string")
    got = {r["id"]: r["network_risk_score"] for r in G.neighbour_risk(nodes, edges).collect()}
    # b: a twice (both directions) and c once
    assert got == pytest.approx({"a": 0.3 * 20, "b": 0.3 * 160 / 3, "c": 0.3 * 20, "x": 0.3 * 80, "z": 0.0})


def test_top_pairs_equal_all_pairs(spark):
    rng = np.random.default_rng(9)
    rows = [(f"c{i:02d}", "Company", f"T{i}", f"c{i}", float(rng.integers(0, 20))) for i in range(40)]
    nodes = spark.createDataFrame(rows + [(a, "Auditor", None, a, 0.0) for a in ("x", "y")], "id string, node_type string, ticker string, name string, ml_risk_score double")
    client = [(r[0], "x" if i % 3 else "y") for i, r in enumerate(rows)]
    edges = spark.createDataFrame([(c, a, "AUDITED_BY") for c, a in client], "src string, dst string, edge_type string")
    score = {r[0]: r[4] for r in rows}
    pairs = sorted(((score[a] + score[b]) / 2, a, b) for a, x in client for b, y in client if x == y and a < b)
    pairs.sort(key=lambda p: (-p[0], p[1], p[2]))
    for n in (1, 3, 12):
        got = [(r["avg_risk"], r["ticker_a"], r["ticker_b"]) for r in G.top_auditor_pairs(nodes, edges, n).collect()]
        assert sorted(got) == sorted((v, f"T{int(a[1:])}", f"T{int(b[1:])}") for v, a, b in pairs[:n])
    total = {r["auditor_id"]: r["pairs"] for r in G.auditor_groups(nodes, edges).collect()}
    assert sum(total.values()) == len(pairs)


def test_high_risk_threshold(spark):
    nodes = spark.createDataFrame([(f"{i}", "Company", f"T{i}", f"N{i}", 15.0 * i, "X") for i in range(5)], "id string, node_type string, ticker string, name string, ml_risk_score double, risk_tier string")
    assert [r["ml_risk_score"] for r in G.high_risk(nodes, 50.0).collect()] == [60.0]


def test_chains_stop_at_three_hops(spark):
    nodes = spark.createDataFrame([(x, "Company", x.upper()) for x in "abcde"], "id string, node_type string, ticker string")
    edges = spark.createDataFrame([(a, b, "SUBSIDIARY_OF") for a, b in ("ab", "bc", "cd", "de", "ba")], "src string, dst string, edge_type string")
    got = {(r["chain"], r["depth"]) for r in G.ownership_chains(nodes, edges, "a").collect()}
    assert got == {("A > B", 1), ("A > B > C", 2), ("A > B > A", 2), ("A > B > C > D", 3)}


def test_lines_are_moved_once_to_their_lots(spark, tmp_path):
    day, next_day = datetime.datetime(1997, 1, 1), datetime.datetime(1997, 1, 2)
    # part 8 has a lot on each of two days and a line without a day, the lines without a part are no lot
    rows = [(4, 1, 8, 5, day), (2, 2, 8, 6, day), (2, 2, 8, 6, day), (3, 1, 8, 7, day), (1, 1, 8, 9, next_day), (5, 1, 8, 6, next_day), (1, 2, 8, 4, None), (6, 1, None, 1, day), (7, 1, None, 2, day)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp")
    lines.selectExpr("*", "1.0D l_quantity", "0.0D l_discount", "'N' l_returnflag").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    ties = Tables(spark, str(tmp_path)).relationships
    pairs = sorted((int(r["parent_cik"]), int(r["subsidiary_cik"])) for r in ties.collect())
    assert pairs == [(6, 5), (6, 7), (9, 6)]
    # the sales alone are joined, with the orders
    assert str(ties._jdf.queryExecution().optimizedPlan()).count("Join ") == 1
