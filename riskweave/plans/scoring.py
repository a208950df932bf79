"""The scoring job: features, forest, model scores, attributions, fused and audited results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.operators import explain, forest, governance
from riskweave.plans import features as feats
from riskweave.plans import fusion
from riskweave.session import cut_lineage
from riskweave.sources import runs


NO_DATA = "no_data"
NO_SCORES = (
    "cik string, ticker string, company_name string, industry_group string, isolation_forest_score double, anomaly_percentile double, "
    "ml_risk_score double, is_anomaly boolean, pre_ml_risk_score double, risk_tier string"
)


@dataclass
class Scored:
    """What one training run yields."""

    features: DataFrame
    scaled: DataFrame
    fitted: dict[str, tuple[float, float]]
    model: forest.Forest
    scores: DataFrame


def train(candidates: DataFrame, trees: int = 200, seed: int = 42, contamination: float = 0.10) -> Scored | None:
    """Fit and score; None for an empty input."""
    built, fitted = feats.fit(candidates)
    matrix = cut_lineage(built)
    if matrix.isEmpty():
        return None
    used = list(fitted)
    scaled = cut_lineage(feats.apply_scaler(matrix, fitted))
    grown = forest.fit(scaled, used, trees=trees, seed=seed)
    raw = cut_lineage(forest.raw_scores(scaled, grown))
    model = forest.with_offset(raw, grown, contamination)
    judged = forest.decisions(raw, model).join(matrix.select("cik", "pre_ml_risk_score"), "cik")
    return Scored(matrix, scaled, fitted, model, judged)


def no_scores(candidates: DataFrame) -> DataFrame:
    """The table of model scores without a row, for an input without companies."""
    return candidates.sparkSession.createDataFrame([], NO_SCORES)


def anomaly_scores(run: Scored, companies: DataFrame) -> DataFrame:
    return fusion.model_scores(run.scores, companies)


def attribution_rows(run: Scored) -> DataFrame:
    """Ranked feature effects: a shorter path is more unusual, so the effect on risk is minus phi."""
    phi = forest.attributions(run.scaled, run.model)
    raw = run.features.select("cik", F.array(*[F.col(c).cast("double") for c in run.model.columns]).alias("value"))
    wide = phi.select("cik", F.transform("phi", lambda p: -p).alias("effect")).join(raw, "cik")
    return explain.ranked_rows(wide, run.model.columns)


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    """Audit records of all runs in a folder; none before the first."""
    path = f"{folder}/audit"
    spark.createDataFrame([], S.AUDIT).write.mode("ignore").parquet(path)
    return spark.read.schema(S.AUDIT).parquet(path)


def scoring_job(
    candidates: DataFrame,
    companies: DataFrame,
    conformity: DataFrame,
    network: Callable[[DataFrame], DataFrame],
    folder: str,
    run_id: str,
    at: datetime,
    trees: int = 200,
) -> dict:
    """Scores all companies into `folder` under a run row: final scores anew, audit records added where their id is new.

    `network` makes (cik, network_risk_score) from the model scores. Returns status, companies, anomalies and new audit
    records, all counted while they were written. Without companies the score table is written without rows and the run
    ends as failed with the reason `no_data`; any other error goes into the run row and is raised.
    """
    spark = candidates.sparkSession
    ledger = runs.Ledger(spark, f"{folder}/runs")
    result = {}

    def work() -> dict:
        trained = train(candidates, trees=trees)
        ml = no_scores(candidates) if trained is None else cut_lineage(anomaly_scores(trained, companies))
        final = fusion.final_scores(ml, conformity, network(ml))
        wrote = runs.write_counted(final, f"{folder}/scores", anomalies=F.count(F.when(F.col("is_anomaly"), 1)))
        stored = spark.read.schema(final.schema).parquet(f"{folder}/scores")
        records = governance.scoring_records(stored, at, run_id)
        fresh = records.join(audit_log(spark, folder).select("audit_id"), "audit_id", "left_anti").select(*records.columns)
        audited = runs.write_counted(fresh, f"{folder}/audit", "append")
        result.update(status="completed", companies=wrote["rows"], anomalies=wrote["anomalies"], audited=audited["rows"])
        if trained is None:
            result.update(status="failed", reason=NO_DATA)
            return {"status": "failed", "error": NO_DATA}
        return {"companies": wrote["rows"]}

    runs.tracked(ledger, work, run_id, lambda: at)
    return {"run_id": run_id, **result}
