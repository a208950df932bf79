"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.catalog import load  # noqa: E402
from riskweave.session import build_session  # noqa: E402

HEADLINE = [
    "ag06_company_conformity", "ag03_period_metrics", "jn02_financial_summary", "jn03_risk_candidates", "wn16_company_dashboard",
    "ag01_annual_prices", "ml01_feature_matrix", "ml05_anomaly_scores", "ml07_attributions", "ml09_scoring_job", "gr12_final_scores", "jn10_top_auditor_pairs",
    "gr05_components", "gr06_pagerank", "tx03_sections", "tx04_recursive_chunks", "tx06_lexicon_scan", "tx09_cosine_top_k",
    "src01_company_facts", "src10_upsert_facts", "ag15_bias_groups", "ag36_weekly_performance", "st02_daily_monitor",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    queries, _ = load()
    wanted = sys.argv[1:] or HEADLINE
    # one untimed pass over a small scan, so that the first query does not pay for the start
    spark.read.parquet(f"{folder}/nation.parquet").count()
    took = {}
    for name in wanted:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - started, 3)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "lineitem_rows": lines,
    }))


if __name__ == "__main__":
    main()
