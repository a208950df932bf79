"""Audit records of scoring and review."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.sources.sinks import insert_ignore


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of a declared table in declared order, absent ones as null."""
    wanted = df.sparkSession.createDataFrame([], ddl).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])


def scoring_records(final: DataFrame, as_of: datetime, run_id: str = "", model: str = "isolation_forest", version: str = "1.0") -> DataFrame:
    """One audit record per scored company. The id is made from run, company and time, so a repeated write is ignored."""
    rows = final.withColumns({
        "audit_id": F.sha2(F.concat_ws("|", F.lit(run_id), F.lit(as_of.isoformat()), "cik"), 256),
        "event_type": F.lit("risk_score_generated"),
        "model_name": F.lit(model), "model_version": F.lit(version), "mlflow_run_id": F.lit(run_id),
        "network_risk": F.col("network_risk_score"),
        "generated_at": F.lit(as_of), "pipeline_version": F.lit("1.0"), "human_reviewed": F.lit(False),
        "data_hash": F.substring(F.sha2(F.to_json(F.struct("benford_risk_score", "cik", "ml_risk_score", "network_risk_score")), 256), 1, 16),
    })
    return conform(rows, S.AUDIT)


def review_record(spark, cik: str, reviewer: str, action: str, notes: str, at: datetime) -> DataFrame:
    row = spark.createDataFrame([(cik, reviewer, action, notes)], "cik string, human_reviewer string, review_action string, review_notes string")
    rows = row.withColumns({
        "audit_id": F.sha2(F.concat_ws("|", "cik", "human_reviewer", "review_action", F.lit(at.isoformat())), 256),
        "event_type": F.lit("human_review"), "generated_at": F.lit(at), "human_reviewed": F.lit(True),
    })
    return conform(rows, S.AUDIT)


def append_audit(log: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose id is new; what is in the log stays as it is."""
    return insert_ignore(log, records, ["audit_id"])
