"""Declared shapes of landed documents and stored tables."""

ENTRY = "struct<accn:string,`start`:string,`end`:string,val:double,form:string,filed:string>"
COMPANY_FACTS = f"struct<facts:map<string,map<string,struct<label:string,units:map<string,array<{ENTRY}>>>>>>"
SUBMISSIONS = (
    "struct<name:string,tickers:array<string>,sic:string,sicDescription:string,ein:string,stateOfIncorporation:string,"
    "fiscalYearEnd:string,exchanges:array<string>,filings:struct<recent:struct<accessionNumber:array<string>,form:array<string>,"
    "filingDate:array<string>,reportDate:array<string>,primaryDocument:array<string>,documentCount:array<int>>>>"
)
AUDITORS = "map<string,struct<auditor:string,auditor_id:string,audit_opinion:string,audit_fee_millions:double>>"
RELATIONSHIPS = (
    "array<struct<parent_cik:string,parent_name:string,subsidiary_cik:string,subsidiary_name:string,"
    "relationship_type:string,ownership_pct:double>>"
)
TICKERS = "map<string,struct<cik_str:bigint,ticker:string,title:string>>"

RUNS = (
    "id string, started_at timestamp, completed_at timestamp, status string, companies_processed int, "
    "filings_processed int, facts_processed int, error_message string"
)
SCORES = (
    "cik string, ticker string, company_name string, industry_group string, ml_risk_score double, benford_risk_score double, "
    "network_risk_score double, final_risk_score double, final_risk_tier string, is_anomaly boolean, community_id int, "
    "late_filings_count int, total_signal_count int, computed_at timestamp"
)
AUDIT = (
    "audit_id string, event_type string, cik string, ticker string, company_name string, period_of_report string, model_name string, "
    "model_version string, mlflow_run_id string, ml_risk_score double, benford_risk_score double, network_risk double, "
    "final_risk_score double, final_risk_tier string, is_anomaly boolean, top_features string, total_signals int, "
    "generated_at timestamp, pipeline_version string, data_hash string, human_reviewed boolean, human_reviewer string, "
    "review_action string, review_notes string"
)
PRICES_CSV = "date string, ticker string, open double, high double, low double, close double, volume bigint, dividends double, `stock splits` double"
