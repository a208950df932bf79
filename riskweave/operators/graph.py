"""Company graph as two tables: nodes (id, node_type, ...) and edges (src, dst, edge_type, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import at_most, count_if, lookup


def company_nodes(companies: DataFrame, ml: DataFrame, rules: DataFrame) -> DataFrame:
    """Companies with model and rule scores, defaults where they have none."""
    m = ml.select("cik", F.col("ml_risk_score").alias("_ml"), F.col("risk_tier").alias("_tier"), F.col("is_anomaly").alias("_odd"))
    r = rules.select("cik", F.col("pre_ml_risk_score").alias("_rule"))
    return companies.join(m, "cik", "left").join(r, "cik", "left").select(
        F.col("cik").alias("id"), F.lit("Company").alias("node_type"),
        F.coalesce("ticker", F.lit("")).alias("ticker"),
        F.coalesce("company_name", F.lit("")).alias("name"),
        F.coalesce("industry_group", F.lit("")).alias("industry_group"),
        F.coalesce("_ml", F.lit(0.0)).alias("ml_risk_score"),
        F.coalesce("_tier", F.lit("UNKNOWN")).alias("risk_tier"),
        F.coalesce("_odd", F.lit(False)).alias("is_anomaly"),
        F.coalesce("_rule", F.lit(0.0)).alias("rule_risk_score"),
    )


def build_nodes(companies: DataFrame, auditors: DataFrame, relationships: DataFrame) -> DataFrame:
    """Company nodes, auditors, and companies that only a relationship names."""
    aud = auditors.groupBy(F.col("auditor_id").alias("id")).agg(F.min("auditor").alias("name")).withColumn("node_type", F.lit("Auditor"))
    ends = F.array(
        F.struct(F.col("parent_cik").alias("id"), F.col("parent_name").alias("name")),
        F.struct(F.col("subsidiary_cik").alias("id"), F.col("subsidiary_name").alias("name")),
    )
    named = relationships.select(F.inline(ends)).groupBy("id").agg(F.min("name").alias("name"))
    known = companies.select("id").unionByName(aud.select("id"))
    others = named.join(known, "id", "left_anti").withColumn("node_type", F.lit("Company"))
    return (
        companies.unionByName(aud, allowMissingColumns=True)
        .unionByName(others, allowMissingColumns=True)
        .withColumn("ml_risk_score", F.coalesce("ml_risk_score", F.lit(0.0)))
        .withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))
    )


def build_edges(companies: DataFrame, auditors: DataFrame, relationships: DataFrame) -> DataFrame:
    """Typed edges; an auditor edge needs its company among the nodes."""
    audits = auditors.join(companies.select(F.col("id").alias("cik")), "cik", "left_semi").select(
        F.col("cik").alias("src"), F.col("auditor_id").alias("dst"), F.lit("AUDITED_BY").alias("edge_type"),
        "audit_opinion", "audit_fee_millions",
    )
    ties = relationships.select(
        F.col("parent_cik").alias("src"), F.col("subsidiary_cik").alias("dst"),
        F.coalesce(lookup(K.EDGE_TYPES, "relationship_type"), "relationship_type").alias("edge_type"),
        "ownership_pct",
    )
    return audits.unionByName(ties, allowMissingColumns=True)


def pairs(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst)."""
    return edges.select("src", "dst").distinct()


def neighbour_bag(edges: DataFrame) -> DataFrame:
    """(id, neighbour): predecessors and successors; a tie in both directions counts twice."""
    both = F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("neighbour")),
    )
    return pairs(edges).select(F.inline(both))


def neighbour_risk(nodes: DataFrame, edges: DataFrame, weight: float = 0.3) -> DataFrame:
    """0.3 x mean score of company neighbours, at most 100; nodes without any get 0.

    A hub holding a third of the edges is no hot task: means are combined before the shuffle.
    """
    scored = nodes.where("node_type = 'Company'").select(F.col("id").alias("neighbour"), "ml_risk_score")
    # scores are added as decimals, so the mean is the same in whatever order the rows come
    exact = F.sum(F.col("ml_risk_score").cast("decimal(20,4)")).cast("double") / F.count(F.lit(1))
    mean = neighbour_bag(edges).join(scored, "neighbour").groupBy("id").agg(exact.alias("_mean"))
    return nodes.join(mean, "id", "left").withColumn(
        "network_risk_score", F.coalesce(at_most(F.col("_mean") * weight, 100), F.lit(0.0))
    ).drop("_mean")


def rank_weighted_risk(nodes: DataFrame, edges: DataFrame, ranks: DataFrame, weight: float = 0.3) -> DataFrame:
    """As `neighbour_risk`, neighbours weighted by their rank in the graph."""
    scored = nodes.where("node_type = 'Company'").join(ranks.select("id", "pagerank"), "id").select(
        F.col("id").alias("neighbour"), "ml_risk_score", "pagerank"
    )
    mean = neighbour_bag(edges).join(scored, "neighbour").groupBy("id").agg(
        F.try_divide(F.sum(F.col("ml_risk_score") * F.col("pagerank")), F.sum("pagerank")).alias("_mean")
    )
    return nodes.join(mean, "id", "left").withColumn(
        "network_risk_score", F.coalesce(at_most(F.col("_mean") * weight, 100), F.lit(0.0))
    ).drop("_mean")


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    company = F.col("node_type") == "Company"
    n = nodes.agg(
        count_if(company).alias("companies"), count_if(F.col("node_type") == "Auditor").alias("auditors"),
        count_if(company & (F.col("ml_risk_score") >= 70)).alias("high_risk_nodes"),
    )
    e = edges.agg(count_if(F.col("edge_type") == "SUBSIDIARY_OF").alias("subsidiary_edges"), F.count(F.lit(1)).alias("edges"))
    return n.withColumn("_e", e.select(F.struct("subsidiary_edges", "edges")).scalar()).select(
        "companies", "auditors", "high_risk_nodes", "_e.subsidiary_edges", "_e.edges"
    )


def degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree over distinct pairs, one aggregation."""
    marks = F.array(
        F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
        F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
    )
    return pairs(edges).select(F.inline(marks)).groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))


def auditor_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per auditor: clients, number of client pairs and mean pair risk, without forming a pair.

    Every client is in n - 1 pairs, so the mean over pairs is the mean over clients.
    """
    risk = nodes.where("node_type = 'Company'").select(F.col("id").alias("src"), "ml_risk_score")
    names = nodes.where("node_type = 'Auditor'").select(F.col("id").alias("dst"), F.col("name").alias("auditor_name"))
    per = (
        edges.where("edge_type = 'AUDITED_BY'").select("src", "dst").distinct().join(risk, "src").groupBy("dst")
        .agg(F.count(F.lit(1)).alias("clients"), F.avg("ml_risk_score").alias("mean_pair_risk"))
    )
    return per.join(names, "dst", "left").select(
        F.col("dst").alias("auditor_id"), "auditor_name", "clients",
        (F.col("clients") * (F.col("clients") - 1) / 2).cast("bigint").alias("pairs"), "mean_pair_risk",
    )


def auditor_contagion(nodes: DataFrame, edges: DataFrame, weight: float = 0.3) -> DataFrame:
    """Risk that reaches a company over its auditors: cik, auditors, reached clients and `weight` times their mean risk.

    Each auditor passes on the mean score of its other clients, (sum - own) / (clients - 1), so no pair of clients is formed;
    a company with several auditors weights them by their other clients, as the mean over its pairs does. Sums are decimals,
    hence the same in any order. Companies without an auditor, or alone with theirs, are reached by nobody and get 0.
    """
    companies = nodes.where("node_type = 'Company'").select(F.col("id").alias("src"), F.col("ml_risk_score").cast("decimal(20,4)").alias("own"))
    clients = edges.where("edge_type = 'AUDITED_BY'").select("src", "dst").distinct().join(companies, "src")
    hubs = clients.groupBy("dst").agg(F.sum("own").alias("total"), F.count(F.lit(1)).alias("n"))
    met = clients.join(hubs, "dst").groupBy("src").agg(
        F.count(F.lit(1)).alias("auditors"), F.sum(F.col("n") - 1).alias("reached_clients"),
        F.try_divide(F.sum(F.col("total") - F.col("own")).cast("double"), F.sum(F.col("n") - 1)).alias("mean"),
    )
    return companies.join(met, "src", "left").select(
        F.col("src").alias("cik"), F.coalesce("auditors", F.lit(0)).cast("long").alias("auditors"), F.coalesce("reached_clients", F.lit(0)).cast("long").alias("reached_clients"),
        F.coalesce(at_most(F.col("mean") * weight, 100), F.lit(0.0)).alias("contagion_score"),
    )


def top_auditor_pairs(nodes: DataFrame, edges: DataFrame, n: int = 50) -> DataFrame:
    """The n client pairs of one auditor with the highest mean risk, exactly.

    With clients ordered by (risk desc, id), the pair of places i < j comes after every pair with
    smaller or equal places. There are i * j - i * (i + 1) / 2 of those, itself included, so pairs
    for which that number passes n cannot be among the first n and are never formed.
    """
    risk = nodes.where("node_type = 'Company'").select(F.col("id").alias("src"), "ticker", "ml_risk_score")
    clients = edges.where("edge_type = 'AUDITED_BY'").select("src", "dst").distinct().join(risk, "src")
    best = Window.partitionBy("dst").orderBy(F.desc("ml_risk_score"), "src")
    few = clients.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= n + 1)
    a = few.select("dst", F.col("_n").alias("_i"), F.col("src").alias("company_a"), F.col("ticker").alias("ticker_a"), F.col("ml_risk_score").alias("risk_a"))
    b = few.select(F.col("dst").alias("_d"), F.col("_n").alias("_j"), F.col("src").alias("company_b"), F.col("ticker").alias("ticker_b"), F.col("ml_risk_score").alias("risk_b"))
    names = nodes.where("node_type = 'Auditor'").select(F.col("id").alias("dst"), F.col("name").alias("shared_auditor"))
    reach = F.col("_i") * F.col("_j") - F.col("_i") * (F.col("_i") + 1) / 2
    joined = a.join(b, (F.col("dst") == F.col("_d")) & (F.col("_i") < F.col("_j")) & (reach <= n))
    # the company of lower id stands first
    flip = F.col("company_a") > F.col("company_b")
    joined = joined.select("dst", *[
        F.when(flip, F.col(y)).otherwise(F.col(x)).alias(x) if first else F.when(flip, F.col(x)).otherwise(F.col(y)).alias(y)
        for x, y in (("company_a", "company_b"), ("ticker_a", "ticker_b"), ("risk_a", "risk_b")) for first in (True, False)
    ])
    ranked = joined.withColumn("avg_risk", (F.col("risk_a") + F.col("risk_b")) / 2).orderBy(
        F.desc("avg_risk"), "company_a", "company_b", "dst"
    ).limit(n)
    return ranked.join(names, "dst", "left").select("ticker_a", "ticker_b", "shared_auditor", "risk_a", "risk_b", "avg_risk")


def partners_of(edges: DataFrame, company: str) -> DataFrame:
    """Companies that share an auditor with one company: its row of the pair list."""
    audits = edges.where("edge_type = 'AUDITED_BY'").select("src", "dst").distinct()
    mine = audits.where(F.col("src") == company).select("dst")
    return audits.join(mine, "dst", "left_semi").where(F.col("src") != company).select(
        F.lit(company).alias("company_a"), F.col("src").alias("company_b"), F.col("dst").alias("shared_auditor_id")
    )


def neighbours_of(nodes: DataFrame, edges: DataFrame, company: str) -> DataFrame:
    """Neighbours in either direction with the type of the tie and their risk."""
    touching = edges.where((F.col("src") == company) | (F.col("dst") == company)).select(
        F.when(F.col("src") == company, F.col("dst")).otherwise(F.col("src")).alias("neighbour_id"), F.col("edge_type").alias("relationship")
    )
    return touching.join(nodes.select(F.col("id").alias("neighbour_id"), F.col("ml_risk_score").alias("neighbour_risk")), "neighbour_id").orderBy(
        F.desc("neighbour_risk"), "neighbour_id"
    )


def ownership_chains(nodes: DataFrame, edges: DataFrame, start: str, max_hops: int = 3) -> DataFrame:
    """Paths of one to three ownership edges from a company, as names and depth; no edge is used twice."""
    owns = edges.where("edge_type = 'SUBSIDIARY_OF'").select("src", "dst")
    label = nodes.select(F.col("id").alias("dst"), F.coalesce(F.nullif("ticker", F.lit("")), F.col("id")).alias("label"))
    step = owns.join(label, "dst")
    first = nodes.where(F.col("id") == start).select(
        F.col("id").alias("at"), F.array(F.coalesce(F.nullif("ticker", F.lit("")), F.col("id"))).alias("chain"), F.array().cast("array<string>").alias("used")
    )
    found, paths = None, first
    for depth in range(1, max_hops + 1):
        hop = F.concat("at", F.lit(">"), "dst")
        paths = paths.join(step, paths["at"] == step["src"]).where(~F.array_contains("used", hop)).select(
            F.col("dst").alias("at"), F.array_append("chain", F.col("label")).alias("chain"), F.array_append("used", hop).alias("used")
        )
        level = paths.select(F.array_join("chain", " > ").alias("chain"), F.lit(depth).alias("depth"))
        found = level if found is None else found.unionByName(level)
    return found


def high_risk(nodes: DataFrame, threshold: float = 70.0, n: int = 20) -> DataFrame:
    return (
        nodes.where((F.col("node_type") == "Company") & (F.col("ml_risk_score") >= threshold))
        .select(F.col("id").alias("cik"), "ticker", F.col("name").alias("company_name"), "ml_risk_score", "risk_tier")
        .orderBy(F.desc("ml_risk_score"), "cik").limit(n)
    )


def display_edges(edges: DataFrame, scored: DataFrame) -> DataFrame:
    """Edges whose parent is scored, and whether the child is."""
    known = scored.select(F.col("cik").alias("_c")).distinct()
    kept = edges.where("edge_type <> 'AUDITED_BY'").join(known, F.col("src") == F.col("_c"), "left_semi")
    return kept.join(known, F.col("dst") == F.col("_c"), "left").select(
        "src", "dst", "edge_type", F.col("_c").isNotNull().alias("child_scored")
    )


def clusters(nodes: DataFrame, partition: DataFrame, ranks: DataFrame) -> DataFrame:
    """Size and risk per community; risk over companies, rank over all members."""
    company = F.col("node_type") == "Company"
    out = (
        nodes.join(partition, "id").join(ranks.select("id", "pagerank"), "id", "left").groupBy("community_id")
        .agg(
            F.count(F.lit(1)).alias("size"),
            count_if(company).alias("company_count"),
            F.coalesce(F.avg(F.when(company, F.col("ml_risk_score"))), F.lit(0.0)).alias("avg_ml_risk_score"),
            F.coalesce(F.max(F.when(company, F.col("ml_risk_score"))), F.lit(0.0)).alias("max_ml_risk_score"),
            count_if(company & F.col("is_anomaly")).alias("anomaly_count"),
            F.avg(F.coalesce("pagerank", F.lit(0.0))).alias("avg_pagerank"),
        )
    )
    level = F.when(F.col("avg_ml_risk_score") >= 60, "HIGH").when(F.col("avg_ml_risk_score") >= 30, "MEDIUM").otherwise("LOW")
    return out.withColumn("cluster_risk_level", level).orderBy(F.desc("avg_ml_risk_score"), "community_id")


def critical_connectors(nodes: DataFrame, centrality: DataFrame, n: int = 10) -> DataFrame:
    """Nodes on most shortest paths."""
    best = centrality.orderBy(F.desc("betweenness"), "id").limit(n)
    return best.join(nodes, "id").select(
        F.col("id").alias("node_id"), "node_type", F.coalesce(F.nullif("name", F.lit("")), F.col("id")).alias("name"),
        "betweenness", "pagerank", "in_degree", "out_degree", "ml_risk_score",
    )
