"""The saved monitoring queries by name, each a function of the stored tables and the time of the report."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators import monitoring as M
from riskweave.plans import reports as R

Frames = dict[str, DataFrame]


def _high_risk(t: Frames, as_of: datetime) -> DataFrame:
    return R.top(t["scores"].where(F.col("final_risk_score") > 70), "final_risk_score", 50)


SAVED: dict[str, Callable[[Frames, datetime], DataFrame]] = {
    "high_risk_companies": _high_risk,
    "anomaly_trend_over_time": lambda t, as_of: M.daily_trend(t["audit"], as_of, 90),
    "industry_risk_distribution": lambda t, as_of: R.industry_profile(t["scores"]),
    "benford_non_conforming": lambda t, as_of: M.non_conforming(t["conformity"]),
    "audit_trail_summary": lambda t, as_of: M.events_by_type(t["audit"], as_of, 30),
    "model_performance_monitoring": lambda t, as_of: M.weekly_performance(t["audit"], as_of, 180),
    "shap_top_features": lambda t, as_of: R.feature_importance(t["attributions"], 15),
    "network_risk_clusters": lambda t, as_of: R.community_list(t["scores"], 50.0, 5),
    "late_filing_correlation": lambda t, as_of: R.late_filer_comparison(t["scores"]),
}
