"""Aggregates and short lists behind the report pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import count_if, rate, tier_rank
from riskweave.functions.order_stats import percentiles


def top(df: DataFrame, by: str, n: int, key: str = "cik") -> DataFrame:
    """Highest n by a column, ties by key."""
    return df.orderBy(F.desc_nulls_last(by), key).limit(n)


def risk_overview(candidates: DataFrame) -> DataFrame:
    return (
        candidates.groupBy("risk_tier", "industry_group")
        .agg(
            F.count(F.lit(1)).alias("companies"),
            F.round(F.avg("pre_ml_risk_score"), 1).alias("avg_risk_score"),
            F.round(F.avg("gross_margin") * 100, 1).alias("avg_gross_margin_pct"),
        )
        .orderBy("risk_tier", F.desc("avg_risk_score"))
    )


def executive_kpis(scores: DataFrame) -> DataFrame:
    row = scores.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col("final_risk_tier") == "CRITICAL").alias("critical"),
        count_if(F.col("final_risk_tier") == "HIGH").alias("high"),
        count_if(F.col("is_anomaly")).alias("anomalies"),
        F.avg("final_risk_score").alias("avg_score"),
    )
    share = {f"{c}_pct": F.round(F.try_divide(F.col(c) * 100.0, F.col("total")), 1) for c in ("critical", "high", "anomalies")}
    return row.withColumns({**share, "avg_score": F.round("avg_score", 1)})


def tier_counts(scores: DataFrame) -> DataFrame:
    """Counts in the fixed order of tiers."""
    return scores.groupBy(F.col("final_risk_tier").alias("tier")).agg(F.count(F.lit(1)).alias("companies")).orderBy(tier_rank("tier"))


def industry_by_tier(scores: DataFrame, tiers: Sequence[str] = tuple(K.TIER_ORDER)) -> DataFrame:
    return scores.groupBy("industry_group").pivot("final_risk_tier", list(tiers)).agg(F.count(F.lit(1))).na.fill(0)


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over the range of the column; the top edge belongs to the last bin."""
    span = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).select(F.struct("lo", "hi")).scalar()
    width = (F.col("_r.hi") - F.col("_r.lo")) / bins
    at = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_r.lo")) / width), F.lit(bins - 1))).otherwise(0)
    cut = df.where(F.col(value).isNotNull()).withColumn("_r", span).select(
        at.cast("int").alias("bin"), F.col("_r.lo").alias("lo"), width.alias("width")
    )
    return cut.groupBy("bin").agg(
        (F.max("lo") + F.col("bin") * F.max("width")).alias("bin_start"), F.count(F.lit(1)).alias("n")
    )


def treemap(scores: DataFrame) -> DataFrame:
    """Totals for all, per industry and per company."""
    return scores.rollup("industry_group", "ticker").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("companies"), F.sum("final_risk_score").alias("score")
    )


def filtered(scores: DataFrame, industry: str = "All", tier: str = "All", min_score: float = 0.0) -> DataFrame:
    out = scores.where(F.col("final_risk_score") >= min_score)
    if industry != "All":
        out = out.where(F.col("industry_group") == industry)
    if tier != "All":
        out = out.where(F.col("final_risk_tier") == tier)
    return out


def display_rows(df: DataFrame, n: int, by: str = "final_risk_score", key: str = "cik") -> DataFrame:
    """First n rows with doubles at one decimal."""
    shown = top(df, by, n, key)
    return shown.select(*[F.round(f.name, 1).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema])


def signal_contributions(scores: DataFrame, *keys: str) -> DataFrame:
    """Weighted share of each signal as rows."""
    parts = {"ML Anomaly": ("ml_risk_score", "ml"), "Benford": ("benford_risk_score", "benford"), "Network": ("network_risk_score", "network")}
    cells = F.array(*[
        F.struct(F.lit(n).alias("signal"), (F.coalesce(F.col(c), F.lit(0.0)) * K.FUSION_WEIGHTS[w]).alias("contribution"))
        for n, (c, w) in parts.items()
    ])
    return scores.select(*keys, F.inline(cells))


def industry_profile(scores: DataFrame) -> DataFrame:
    """Per industry: size, mean, median, anomaly rate and upper tiers."""
    med = percentiles(scores, ["final_risk_score"], [0.5], ["industry_group"]).select("industry_group", F.col("p0").alias("median_risk"))
    out = scores.groupBy("industry_group").agg(
        F.count(F.lit(1)).alias("company_count"),
        F.avg("final_risk_score").alias("avg_risk"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
        count_if(F.col("final_risk_tier") == "CRITICAL").alias("critical_count"),
        count_if(F.col("final_risk_tier") == "HIGH").alias("high_count"),
    )
    return out.join(med, "industry_group", "left").orderBy(F.desc("avg_risk"), "industry_group")


def community_list(scores: DataFrame, min_avg: float = 50.0, names: int = 5) -> DataFrame:
    """Communities above a mean score, with their first tickers.

    Tickers are cut to the first few per community before they are gathered.
    """
    used = scores.where("community_id >= 0")
    out = used.groupBy("community_id").agg(
        F.count(F.lit(1)).alias("company_count"),
        F.avg("final_risk_score").alias("avg_risk"),
        count_if(F.col("is_anomaly")).alias("anomaly_count"),
    ).where(F.col("avg_risk") > min_avg)
    first = Window.partitionBy("community_id").orderBy("ticker")
    few = used.select("community_id", "ticker").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= names)
    listed = few.groupBy("community_id").agg(F.array_join(F.array_sort(F.collect_list("ticker")), ",").alias("companies"))
    return out.join(listed, "community_id").orderBy(F.desc("avg_risk"), "community_id")


def late_filer_comparison(scores: DataFrame) -> DataFrame:
    kind = F.when(F.col("late_filings_count") > 0, "Late Filer").otherwise("On-Time Filer")
    return scores.groupBy(kind.alias("filing_behavior")).agg(
        F.count(F.lit(1)).alias("company_count"),
        F.avg("final_risk_score").alias("avg_risk_score"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
    )


def feature_importance(values: DataFrame, limit: int | None = None) -> DataFrame:
    """Mean size and direction of attributions per feature."""
    out = values.groupBy("feature_name", "friendly_name").agg(
        F.avg("abs_shap_value").alias("mean_abs_shap"),
        F.avg("shap_value").alias("mean_shap"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("cik").alias("companies"),
        count_if(F.col("direction") == "increases").alias("risk_increasing"),
        count_if(F.col("direction") == "decreases").alias("risk_decreasing"),
    )
    out = out.orderBy(F.desc("mean_abs_shap"), "feature_name")
    return out.limit(limit) if limit else out


def explanation(values: DataFrame, n: int = 10) -> DataFrame:
    """Highest-ranked features of each company."""
    return values.where(F.col("rank_in_company") <= n)


def training_metrics(scores: DataFrame, conformity: DataFrame) -> DataFrame:
    """Metrics row of one training run."""
    a = scores.agg(
        F.count(F.lit(1)).alias("n_companies"),
        count_if(F.col("is_anomaly")).alias("n_anomalies"),
        rate(F.col("is_anomaly")).alias("anomaly_rate"),
        count_if(F.col("ml_risk_score") > 70).alias("high_risk_companies"),
        F.avg("ml_risk_score").alias("avg_risk_score"),
    )
    bad = conformity.agg(count_if(F.col("conformity_rating") == "Non-conforming").alias("n")).scalar()
    return a.withColumn("benford_non_conforming", bad)


def tables_counts(frames: dict[str, DataFrame | None]) -> DataFrame:
    """Row count per table; a missing table counts 0."""
    out: DataFrame | None = None
    for name, df in frames.items():
        if df is None:
            continue
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    absent = [(n, 0) for n, d in frames.items() if d is None]
    if absent and out is not None:
        out = out.unionByName(out.sparkSession.createDataFrame(absent, "table_name string, n_rows bigint"))
    return out


def brief_previews(briefs: DataFrame, chars: int = 200) -> DataFrame:
    """Start of each brief for the list page; the whole text stays in the table."""
    return briefs.withColumn("preview", F.left("brief", F.lit(chars))).drop("brief").orderBy(F.desc("risk_score"), "cik")


def brief_of(briefs: DataFrame, cik) -> DataFrame:
    """The whole brief of one company; the id reaches the scan of a stored table."""
    return briefs.where(F.col("cik") == F.lit(cik)).select("cik", "brief")
