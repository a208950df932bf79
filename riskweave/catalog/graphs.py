"""Graph queries."""

from pyspark.sql import functions as F

from riskweave.catalog.base import CTES, query, rnd, rounded
from riskweave.operators import graph as G
from riskweave.operators import network as N
from riskweave.plans import fusion
from riskweave.session import cut_lineage

CTES["ml"] = f"""
SELECT d.cik, ticker, company_name, industry_group, decision AS isolation_forest_score, {rnd('pct', 1)} AS anomaly_percentile,
 {rnd('least(100.0::DOUBLE, pct * 0.6::DOUBLE + pre_ml_risk_score * 0.4::DOUBLE)', 1)} AS ml_risk_score, decision < 0 AS is_anomaly, pre_ml_risk_score,
 CASE WHEN pre_ml_risk_score >= 70 THEN 'HIGH' WHEN pre_ml_risk_score >= 45 THEN 'MEDIUM' WHEN pre_ml_risk_score >= 20 THEN 'LOW' ELSE 'CLEAN' END AS risk_tier
FROM (SELECT *, (1 - (rank() OVER (ORDER BY decision) + (count(*) OVER (PARTITION BY decision) - 1) / 2.0::DOUBLE) / count(*) OVER ()::DOUBLE) * 100 AS pct FROM t_decisions) d
JOIN t_companies c ON d.cik = c.cik"""
CTES["comp_nodes"] = """
SELECT c.cik AS id, 'Company' AS node_type, c.ticker, c.company_name AS name, c.industry_group, coalesce(m.ml_risk_score, 0) AS ml_risk_score,
 coalesce(m.risk_tier, 'UNKNOWN') AS risk_tier, coalesce(m.is_anomaly, false) AS is_anomaly, coalesce(d.pre_ml_risk_score, 0) AS rule_risk_score
FROM t_companies c LEFT JOIN ml m ON c.cik = m.cik LEFT JOIN t_decisions d ON c.cik = d.cik"""
CTES["nodes"] = """
SELECT * FROM comp_nodes UNION ALL
SELECT auditor_id, 'Auditor', NULL, min(auditor), NULL, 0, NULL, false, NULL FROM t_auditors GROUP BY auditor_id UNION ALL
SELECT id, 'Company', NULL, min(name), NULL, 0, NULL, false, NULL FROM (SELECT parent_cik AS id, parent_name AS name FROM t_relationships UNION ALL SELECT subsidiary_cik, subsidiary_name FROM t_relationships)
 WHERE id NOT IN (SELECT id FROM comp_nodes) GROUP BY id"""
CTES["edges"] = """
SELECT cik AS src, auditor_id AS dst, 'AUDITED_BY' AS edge_type, audit_opinion, audit_fee_millions, NULL::DOUBLE AS ownership_pct FROM t_auditors UNION ALL
SELECT parent_cik, subsidiary_cik, CASE relationship_type WHEN 'SUBSIDIARY' THEN 'SUBSIDIARY_OF' ELSE relationship_type END, NULL, NULL, ownership_pct FROM t_relationships"""
CTES["links"] = "SELECT DISTINCT src, dst FROM edges"
CTES["bag"] = "SELECT src AS id, dst AS neighbour FROM links UNION ALL SELECT dst, src FROM links"
CTES["net"] = """
SELECT n.*, least(coalesce(x.m * 0.3::DOUBLE, 0), 100) AS network_risk_score FROM nodes n LEFT JOIN
 (SELECT bag.id, CAST(sum(CAST(k.ml_risk_score AS DECIMAL(20,4))) AS DOUBLE) / count(*) AS m FROM bag JOIN nodes k ON k.id = bag.neighbour AND k.node_type = 'Company' GROUP BY bag.id) x ON n.id = x.id"""
CTES["owned"] = "SELECT src AS id, dst AS neighbour FROM edges WHERE edge_type = 'SUBSIDIARY_OF' UNION SELECT dst, src FROM edges WHERE edge_type = 'SUBSIDIARY_OF'"
CTES["groups"] = """
SELECT id, min(root) AS community_id FROM (
 WITH RECURSIVE reach(id, root) AS (SELECT id, id FROM nodes UNION SELECT b.neighbour, r.root FROM reach r JOIN owned b ON b.id = r.id) SELECT * FROM reach) GROUP BY id"""
CTES["cc"] = """
SELECT id, min(root) AS component FROM (
 WITH RECURSIVE reach(id, root) AS (SELECT id, id FROM nodes UNION SELECT b.neighbour, r.root FROM reach r JOIN bag b ON b.id = r.id) SELECT * FROM reach) GROUP BY id"""


def ml_scores(t):
    return fusion.model_scores(t.decisions, t.companies)


def graph(t, ml=None):
    companies = G.company_nodes(t.companies, ml_scores(t) if ml is None else ml, t.decisions)
    ties = cut_lineage(t.relationships)  # read by nodes and edges
    return G.build_nodes(companies, t.auditors, ties), G.build_edges(companies, t.auditors, ties)


def audit_graph(t):
    """Companies and their auditors alone: what reads no ties need not work them out."""
    companies = G.company_nodes(t.companies, ml_scores(t), t.decisions)
    none = t.spark.createDataFrame([], t.relationships.schema)
    return G.build_nodes(companies, t.auditors, none), G.build_edges(companies, t.auditors, none)


def kept_graph(t):
    """The graph of the iterative jobs, stored once for all their rounds."""
    nodes, edges = graph(t)
    return cut_lineage(nodes), cut_lineage(edges)


@query("wn11_model_scores", "SELECT * FROM ml")
def _(t):
    return ml_scores(t)


@query("gr01_nodes", "SELECT * FROM nodes")
def _(t):
    return graph(t)[0]


@query("gr02_edges", "SELECT * FROM edges")
def _(t):
    return graph(t)[1]


@query("jn04_company_nodes", "SELECT * FROM comp_nodes")
def _(t):
    return G.company_nodes(t.companies, ml_scores(t), t.decisions)


@query("gr03_neighbour_risk", f"SELECT id, node_type, {rnd('network_risk_score', 4)} AS network_risk_score FROM net")
def _(t):
    return rounded(G.neighbour_risk(*graph(t)).select("id", "node_type", "network_risk_score"), 4)


@query("so03_neighbour_bag", "SELECT id, count(*) AS n FROM bag GROUP BY id")
def _(t):
    return G.neighbour_bag(graph(t)[1]).groupBy("id").agg(F.count("*").alias("n"))


@query("ag21_graph_stats", "SELECT (SELECT count(*) FROM nodes WHERE node_type = 'Company') AS companies, (SELECT count(*) FROM nodes WHERE node_type = 'Auditor') AS auditors, (SELECT count(*) FROM nodes WHERE node_type = 'Company' AND ml_risk_score >= 70) AS high_risk_nodes, (SELECT count(*) FROM edges WHERE edge_type = 'SUBSIDIARY_OF') AS subsidiary_edges, (SELECT count(*) FROM edges) AS edges")
def _(t):
    return G.stats(*graph(t))


@query("gr08_degrees", "SELECT id, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree FROM (SELECT src AS id, 0 AS i, 1 AS o FROM links UNION ALL SELECT dst, 1, 0 FROM links) GROUP BY id")
def _(t):
    return G.degrees(graph(t)[1])


_PAIRS = "(SELECT a.src AS company_a, b.src AS company_b, a.dst FROM edges a JOIN edges b ON a.dst = b.dst AND a.src < b.src WHERE a.edge_type = 'AUDITED_BY' AND b.edge_type = 'AUDITED_BY')"


@query("gr04_auditor_groups", f"""SELECT n.id AS auditor_id, n.name AS auditor_name, c.clients, coalesce(p.pairs, 0) AS pairs, {rnd('coalesce(p.r, c.r)', 4)} AS mean_pair_risk
 FROM nodes n JOIN (SELECT dst, count(*) AS clients, avg(k.ml_risk_score) AS r FROM edges e JOIN nodes k ON k.id = e.src WHERE edge_type = 'AUDITED_BY' GROUP BY dst) c ON c.dst = n.id
 LEFT JOIN (SELECT p.dst, count(*) AS pairs, avg((x.ml_risk_score + y.ml_risk_score) / 2) AS r FROM {_PAIRS} p JOIN nodes x ON x.id = company_a JOIN nodes y ON y.id = company_b GROUP BY p.dst) p ON p.dst = n.id""")
def _(t):
    return rounded(G.auditor_groups(*audit_graph(t)), 4)


@query("jn10_top_auditor_pairs", f"""SELECT x.ticker AS ticker_a, y.ticker AS ticker_b, n.name AS shared_auditor, x.ml_risk_score AS risk_a, y.ml_risk_score AS risk_b, {rnd('(x.ml_risk_score + y.ml_risk_score) / 2', 4)} AS avg_risk
 FROM {_PAIRS} p JOIN nodes x ON x.id = company_a JOIN nodes y ON y.id = company_b JOIN nodes n ON n.id = p.dst ORDER BY (x.ml_risk_score + y.ml_risk_score) / 2 DESC, company_a, company_b, p.dst LIMIT 50""")
def _(t):
    return rounded(G.top_auditor_pairs(*audit_graph(t)), 4)


@query("jn10_partners_of_company", f"SELECT '0000000007' AS company_a, CASE WHEN company_a = '0000000007' THEN company_b ELSE company_a END AS company_b, dst AS shared_auditor_id FROM {_PAIRS} WHERE '0000000007' IN (company_a, company_b)")
def _(t):
    return G.partners_of(audit_graph(t)[1], "0000000007")


@query("jn11_neighbours", "SELECT n.id AS neighbour_id, edge_type AS relationship, n.ml_risk_score AS neighbour_risk FROM (SELECT dst AS id, edge_type FROM edges WHERE src = '0000000007' UNION ALL SELECT src, edge_type FROM edges WHERE dst = '0000000007') e JOIN nodes n ON n.id = e.id")
def _(t):
    return G.neighbours_of(*graph(t), "0000000007")


@query("jn12_ownership_chains", """WITH RECURSIVE hop(pos, chain, used, depth) AS (
 SELECT id, [coalesce(nullif(ticker, ''), id)], []::VARCHAR[], 0 FROM nodes WHERE id = '0000000003'
 UNION ALL SELECT e.dst, list_append(chain, coalesce(nullif(n.ticker, ''), n.id)), list_append(used, pos || '>' || e.dst), depth + 1
 FROM hop JOIN edges e ON e.src = hop.pos AND e.edge_type = 'SUBSIDIARY_OF' JOIN nodes n ON n.id = e.dst WHERE depth < 3 AND NOT list_contains(used, pos || '>' || e.dst))
 SELECT array_to_string(chain, ' > ') AS chain, depth FROM hop WHERE depth > 0""")
def _(t):
    return G.ownership_chains(*kept_graph(t), "0000000003")


@query("tk03_high_risk", "SELECT id AS cik, ticker, name AS company_name, ml_risk_score, risk_tier FROM nodes WHERE node_type = 'Company' AND ml_risk_score >= 50 ORDER BY ml_risk_score DESC, id LIMIT 20")
def _(t):
    # companies known from ties alone have no score, so they are below the threshold
    return G.high_risk(audit_graph(t)[0], 50.0, 20)


@query("tk07_top_nodes", "SELECT id AS cik, ticker, name AS company_name, ml_risk_score, risk_tier FROM nodes WHERE node_type = 'Company' AND ml_risk_score >= 0 ORDER BY ml_risk_score DESC, id LIMIT 10")
def _(t):
    return G.high_risk(graph(t)[0], 0.0, 10)


@query("jn17_display_edges", "SELECT src, dst, edge_type, dst IN (SELECT cik FROM ml) AS child_scored FROM edges WHERE edge_type <> 'AUDITED_BY' AND src IN (SELECT cik FROM ml)")
def _(t):
    return G.display_edges(graph(t)[1], ml_scores(t))


@query("gr05_components", "SELECT id, component FROM cc")
def _(t):
    return N.connected_components(*kept_graph(t))


@query("gr05_louvain")
def _(t):
    return N.louvain(*kept_graph(t))


@query("gr05_louvain_checks", "SELECT count(*) AS nodes, TRUE AS one_community_each, TRUE AS inside_components, TRUE AS not_below_components FROM nodes")
def _(t):
    """Communities as a partition: each node in one, none across components, modularity not below that of the components."""
    nodes, edges = kept_graph(t)
    part = cut_lineage(N.louvain(nodes, edges))
    whole = cut_lineage(N.connected_components(nodes, edges))
    better = N.modularity(edges, part) >= N.modularity(edges, whole, "component") - 1e-9
    held = nodes.select("id").join(part, "id", "left").join(whole, "id", "left")
    each = held.groupBy("id").agg(F.count("community_id").alias("n"), F.max("community_id").alias("c"), F.max("component").alias("g"))
    groups = each.groupBy("c").agg(F.count(F.lit(1)).alias("nodes"), F.bool_and(F.col("n") == 1).alias("one"), (F.min("g").eqNullSafe(F.max("g"))).alias("inside"))
    return groups.agg(F.sum("nodes").alias("nodes"), F.bool_and("one").alias("one_community_each"), F.bool_and("inside").alias("inside_components")).withColumn("not_below_components", F.lit(better))


_ROUNDS = 90  # of the SQL twin, past any change in the digits compared; the job stops by tolerance
CTES["shares"] = "SELECT l.src, l.dst, 1.0::DOUBLE / o.n AS share FROM links l JOIN (SELECT src, count(*) AS n FROM links GROUP BY src) o ON o.src = l.src"
CTES["inside"] = "SELECT src AS id FROM links UNION SELECT dst FROM links"
CTES["pr0"] = "SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM inside) AS x FROM inside"
for _i in range(1, _ROUNDS + 1):
    CTES[f"pr{_i}"] = (
        f"SELECT i.id, (1 - 0.85::DOUBLE) / (SELECT count(*) FROM inside) + coalesce(sum(p.x * s.share * 0.85::DOUBLE), 0) AS x "
        f"FROM inside i LEFT JOIN shares s ON s.dst = i.id LEFT JOIN pr{_i - 1} p ON p.id = s.src GROUP BY i.id"
    )
CTES["ranked"] = f"SELECT n.id, coalesce(x / (SELECT sum(x) FROM pr{_ROUNDS}), 0) AS pagerank FROM nodes n LEFT JOIN pr{_ROUNDS} p ON n.id = p.id"


@query("gr06_pagerank", f"SELECT id, {rnd('pagerank')} AS pagerank FROM ranked")
def _(t):
    return rounded(N.pagerank(*kept_graph(t), tol=1e-8))


def _level_sql(levels: int) -> str:
    """Shortest path counts from every node level by level, then the dependencies back; the last level must be empty."""
    CTES["bw_links"] = "SELECT src, dst FROM links WHERE src <> dst"
    CTES["bw_inside"] = "SELECT src AS id FROM bw_links UNION SELECT dst FROM bw_links"
    CTES["bf0"] = "SELECT id AS s, id AS v, 1.0::DOUBLE AS paths FROM bw_inside"
    CTES["bs0"] = "SELECT s, v FROM bf0"
    for i in range(1, levels + 1):
        CTES[f"bf{i}"] = f"SELECT f.s, l.dst AS v, sum(f.paths) AS paths FROM bf{i - 1} f JOIN bw_links l ON l.src = f.v WHERE (f.s, l.dst) NOT IN (SELECT (s, v) FROM bs{i - 1}) GROUP BY f.s, l.dst"
        CTES[f"bs{i}"] = f"SELECT s, v FROM bs{i - 1} UNION ALL SELECT s, v FROM bf{i}"
    CTES[f"bd{levels}"] = f"SELECT s, v, paths, 0.0::DOUBLE AS delta FROM bf{levels}"
    for i in range(levels - 1, 0, -1):
        CTES[f"bd{i}"] = (
            f"SELECT f.s, f.v, f.paths, f.paths * coalesce(sum((1 + d.delta) / d.paths), 0) AS delta FROM bf{i} f LEFT JOIN (SELECT l.src, b.* FROM bw_links l JOIN bd{i + 1} b ON b.v = l.dst) d ON d.s = f.s AND d.src = f.v GROUP BY f.s, f.v, f.paths"
        )
    sums = " UNION ALL ".join(f"SELECT v, delta FROM bd{i}" for i in range(1, levels + 1))
    CTES["between"] = f"SELECT n.id, coalesce(b.x, 0) / (SELECT CASE WHEN count(*) > 2 THEN (count(*) - 1) * (count(*) - 2) ELSE 1 END FROM bw_inside) AS betweenness FROM nodes n LEFT JOIN (SELECT v, sum(delta) AS x FROM ({sums}) GROUP BY v) b ON b.v = n.id"
    return f"SELECT id, {rnd('betweenness', 9)} AS betweenness FROM between"


@query("gr07_betweenness", _level_sql(14))
def _(t):
    return rounded(N.betweenness(*kept_graph(t)), 9)


@query("gr07_sampled_betweenness", "SELECT count(*) AS nodes, true AS within_bound, true AS bounds_kept FROM nodes")
def _(t):
    """Whether the sampled values lie within their bounds of the exact ones, over all nodes."""
    nodes, edges = kept_graph(t)
    exact = N.betweenness(nodes, edges).withColumnRenamed("betweenness", "exact")
    both = N.sampled_betweenness(nodes, edges, error=0.1).join(exact, "id")
    return both.agg(F.count(F.lit(1)).alias("nodes"), F.bool_and(F.abs(F.col("betweenness") - F.col("exact")) <= F.col("bound") + 1e-9).alias("within_bound"), F.bool_and(F.col("bound") <= 0.1).alias("bounds_kept"))


@query("gr04_auditor_contagion", f"""SELECT n.id AS cik, coalesce(a.auditors, 0) AS auditors, coalesce(p.reached, 0) AS reached_clients, {rnd('least(coalesce(p.m * 0.3::DOUBLE, 0), 100)', 4)} AS contagion_score FROM nodes n
 LEFT JOIN (SELECT src, count(DISTINCT dst) AS auditors FROM edges WHERE edge_type = 'AUDITED_BY' GROUP BY src) a ON a.src = n.id
 LEFT JOIN (SELECT x.src, count(*) AS reached, CAST(sum(CAST(k.ml_risk_score AS DECIMAL(20,4))) AS DOUBLE) / count(*) AS m FROM edges x JOIN edges y ON x.dst = y.dst AND x.src <> y.src AND x.edge_type = 'AUDITED_BY' AND y.edge_type = 'AUDITED_BY'
  JOIN nodes k ON k.id = y.src GROUP BY x.src) p ON p.src = n.id WHERE n.node_type = 'Company'""")
def _(t):
    return rounded(G.auditor_contagion(*graph(t)), 4)


@query("gr09_risk_clusters", f"""SELECT community_id, count(*) AS size, count(*) FILTER (node_type = 'Company') AS company_count,
 {rnd("coalesce(avg(ml_risk_score) FILTER (node_type = 'Company'), 0)", 4)} AS avg_ml_risk_score, coalesce(max(ml_risk_score) FILTER (node_type = 'Company'), 0) AS max_ml_risk_score,
 count(*) FILTER (node_type = 'Company' AND is_anomaly) AS anomaly_count, {rnd('avg(coalesce(pagerank, 0))', 5)} AS avg_pagerank,
 CASE WHEN coalesce(avg(ml_risk_score) FILTER (node_type = 'Company'), 0) >= 60 THEN 'HIGH' WHEN coalesce(avg(ml_risk_score) FILTER (node_type = 'Company'), 0) >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS cluster_risk_level
 FROM nodes n JOIN groups g ON g.id = n.id LEFT JOIN ranked r ON r.id = n.id GROUP BY community_id""")
def _(t):
    nodes, edges = kept_graph(t)
    # groups held together by ownership
    part = N.connected_components(nodes, edges.where("edge_type = 'SUBSIDIARY_OF'")).withColumnRenamed("component", "community_id")
    out = G.clusters(nodes, part, N.pagerank(nodes, edges, tol=1e-8))
    return out.withColumns({"avg_ml_risk_score": F.round("avg_ml_risk_score", 4), "avg_pagerank": F.round("avg_pagerank", 5)})


@query("gr10_critical_connectors", f"""SELECT n.id AS node_id, n.node_type, coalesce(nullif(n.name, ''), n.id) AS name, {rnd('b.betweenness')} AS betweenness, {rnd('r.pagerank', 5)} AS pagerank,
 (SELECT count(*) FROM links l WHERE l.dst = n.id) AS in_degree, (SELECT count(*) FROM links l WHERE l.src = n.id) AS out_degree, n.ml_risk_score
 FROM between b JOIN nodes n ON n.id = b.id JOIN ranked r ON r.id = n.id ORDER BY round(b.betweenness, 12) DESC, n.id LIMIT 10""")
def _(t):
    nodes, edges = kept_graph(t)
    out = G.critical_connectors(nodes, N.centrality(nodes, edges))
    return out.withColumns({"betweenness": F.round("betweenness", 6), "pagerank": F.round("pagerank", 5)})


@query("gr03_rank_weighted_risk", f"""SELECT n.id, {rnd('least(coalesce(x.m * 0.3::DOUBLE, 0), 100)', 4)} AS network_risk_score FROM nodes n LEFT JOIN
 (SELECT bag.id, sum(k.ml_risk_score * r.pagerank) / sum(r.pagerank) AS m FROM bag JOIN nodes k ON k.id = bag.neighbour AND k.node_type = 'Company' JOIN ranked r ON r.id = k.id GROUP BY bag.id) x ON n.id = x.id""")
def _(t):
    nodes, edges = kept_graph(t)
    ranks = N.pagerank(nodes, edges, tol=1e-8)
    return rounded(G.rank_weighted_risk(nodes, edges, ranks).select("id", "network_risk_score"), 4)


# --- fusion -------------------------------------------------------------------------------------------

CTES["final"] = f"""
SELECT *, CASE WHEN final_risk_score >= 70 THEN 'HIGH' WHEN final_risk_score >= 45 THEN 'MEDIUM' WHEN final_risk_score >= 20 THEN 'LOW' ELSE 'CLEAN' END AS final_risk_tier FROM (
SELECT m.cik, m.ticker, m.company_name, m.industry_group, m.ml_risk_score, coalesce(b.benford_risk_score, 0) AS benford_risk_score, {rnd('coalesce(n.network_risk_score, 0)', 4)} AS network_risk_score,
 {rnd('greatest(least(0.5::DOUBLE * m.ml_risk_score + 0.3::DOUBLE * coalesce(b.benford_risk_score, 0) + 0.2::DOUBLE * coalesce(n.network_risk_score, 0), 100), 0)', 2)} AS final_risk_score, m.is_anomaly
FROM ml m LEFT JOIN benford b ON m.cik = b.cik LEFT JOIN net n ON n.id = m.cik)"""


def conformity(t):
    from riskweave.operators.first_digit import company_conformity

    return company_conformity(t.facts, t.companies)


def final_scores(t, ml=None, digits=None):
    risk = G.neighbour_risk(*graph(t, ml)).where("node_type = 'Company'").select(F.col("id").alias("cik"), "network_risk_score")
    return fusion.final_scores(ml_scores(t) if ml is None else ml, conformity(t) if digits is None else digits, risk)


@query("gr12_final_scores", "SELECT * FROM final")
def _(t):
    return final_scores(t)


_WIDE = f"""SELECT f.cik, f.ticker, f.company_name, f.ml_risk_score, f.benford_risk_score, f.network_risk_score AS network_risk, f.final_risk_score, f.final_risk_tier,
 m.is_anomaly, m.anomaly_percentile, m.isolation_forest_score, b.conformity_rating, b.mad_score, r.dominant_signal, r.total_signal_count, {', '.join('r.' + x for x in fusion.WIDE_FLAGS)},
 r.latest_period, {', '.join(rnd('r.' + x) + ' AS ' + x for x in fusion.WIDE_RATIOS)}, r.late_filings_count, r.has_late_filings, r.industry_group
 FROM final f LEFT JOIN ml m ON f.cik = m.cik LEFT JOIN benford b ON f.cik = b.cik LEFT JOIN candidates r ON f.cik = r.cik"""


def wide(t):
    from riskweave.catalog.mart_queries import candidates

    # model scores and digit tests are worked out once, then read by the fusion and by the wide table
    ml, digits = cut_lineage(ml_scores(t)), cut_lineage(conformity(t))
    return fusion.wide_scores(final_scores(t, ml, digits), ml, digits, candidates(t))


@query("jn06_wide_scores", _WIDE)
def _(t):
    return rounded(wide(t))


@query("jn07_one_company_inputs", _WIDE + " WHERE f.cik = '0000000007'")
def _(t):
    # the id filter is pushed below all four joins
    return rounded(wide(t).where("cik = '0000000007'"))


@query("tx12_evidence_sheets", f"""SELECT f.cik, f.company_name || ' (' || f.ticker || ')' || chr(10) || printf('Final score %.1f/100, tier %s', {rnd('f.final_risk_score', 1)}, f.final_risk_tier) || chr(10) ||
 printf('ML score %.1f, percentile %.0f', f.ml_risk_score, {rnd('m.anomaly_percentile', 0)}) || chr(10) || printf('First-digit MAD %.5f, %s', {rnd('b.mad_score', 5)}, b.conformity_rating) || chr(10) ||
 printf('Network risk %.1f', {rnd('f.network_risk_score', 1)}) || chr(10) || s.signals AS evidence
 FROM final f JOIN ml m ON f.cik = m.cik JOIN benford b ON f.cik = b.cik JOIN (
 SELECT cik, CASE WHEN len(x) = 0 THEN '  • No individual signals triggered' ELSE array_to_string(x, chr(10)) END AS signals FROM (
 SELECT cik, list_filter([CASE WHEN dominant_signal <> 'None' THEN '  • Dominant: ' || dominant_signal || ' (+0.28)' END, CASE WHEN flag_ar_acceleration = 1 THEN '  • AR acceleration (+0.18)' END,
  CASE WHEN flag_cashflow_divergence = 1 THEN '  • Cash-earnings divergence (+0.22)' END, CASE WHEN flag_margin_compression = 1 THEN '  • Margin compression (+0.15)' END], lambda v: v IS NOT NULL) AS x FROM candidates)) s ON s.cik = f.cik""")
def _(t):
    return fusion.evidence_sheets(wide(t)).select("cik", "evidence")
