"""Names, tables, thresholds and texts that results depend on."""

# Forms and start of history.
ANNUAL_FORMS = ("10-K", "10-K/A")
QUARTERLY_FORMS = ("10-Q", "10-Q/A")
ACCEPTED_FORMS = ANNUAL_FORMS + QUARTERLY_FORMS
ACCEPTED_UNITS = ("USD", "shares", "pure")
HISTORY_START = "2019-01-01"

# Reported concept -> period metric, in order of priority.
CONCEPT_METRICS = [
    ("RevenueFromContractWithCustomerExcludingAssessedTax", "revenues"),
    ("Revenues", "revenues"),
    ("SalesRevenueNet", "revenues"),
    ("SalesRevenueGoodsNet", "revenues"),
    ("RevenueFromContractWithCustomerIncludingAssessedTax", "revenues"),
    ("NetIncomeLoss", "net_income"),
    ("NetIncomeLossAvailableToCommonStockholdersBasic", "net_income"),
    ("GrossProfit", "gross_profit"),
    ("OperatingIncomeLoss", "operating_income"),
    ("Assets", "total_assets"),
    ("AssetsCurrent", "current_assets"),
    ("Liabilities", "total_liabilities"),
    ("LiabilitiesCurrent", "current_liabilities"),
    ("StockholdersEquity", "stockholders_equity"),
    ("StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "stockholders_equity"),
    ("CashAndCashEquivalentsAtCarryingValue", "cash"),
    ("CashCashEquivalentsAndShortTermInvestments", "cash"),
    ("Cash", "cash"),
    ("AccountsReceivableNetCurrent", "accounts_receivable"),
    ("ReceivablesNetCurrent", "accounts_receivable"),
    ("InventoryNet", "inventory"),
    ("LongTermDebt", "long_term_debt"),
    ("LongTermDebtNoncurrent", "long_term_debt"),
    ("LongTermDebtAndCapitalLeaseObligations", "long_term_debt"),
    ("ResearchAndDevelopmentExpense", "rd_expense"),
    ("SellingGeneralAndAdministrativeExpense", "sga_expense"),
    ("NetCashProvidedByUsedInOperatingActivities", "operating_cashflow"),
    ("PaymentsToAcquirePropertyPlantAndEquipment", "capex"),
    ("PaymentsForCapitalImprovements", "capex"),
]

# The period metrics, in table order.
METRICS = [
    "revenues", "gross_profit", "operating_income", "net_income", "total_assets", "current_assets",
    "total_liabilities", "current_liabilities", "stockholders_equity", "cash", "accounts_receivable",
    "inventory", "long_term_debt", "rd_expense", "sga_expense", "operating_cashflow", "capex",
]

# Sector -> industry code.
SECTOR_SIC = {
    "Information Technology": "7372",
    "Technology": "7372",
    "Health Care": "8099",
    "Healthcare": "8099",
    "Financials": "6020",
    "Consumer Discretionary": "5900",
    "Consumer Staples": "5400",
    "Industrials": "3559",
    "Communication Services": "4813",
    "Energy": "1311",
    "Materials": "2819",
    "Real Estate": "6552",
    "Utilities": "4911",
}
DEFAULT_SIC = "9999"

# Sector -> gross, operating, net margin, capex and research share of revenue.
SECTOR_RATIOS = {
    "Information Technology": (0.55, 0.25, 0.20, 0.04, 0.12),
    "Technology": (0.55, 0.25, 0.20, 0.04, 0.12),
    "Health Care": (0.62, 0.18, 0.14, 0.05, 0.15),
    "Healthcare": (0.62, 0.18, 0.14, 0.05, 0.15),
    "Financials": (0.58, 0.30, 0.22, 0.02, 0.00),
    "Consumer Discretionary": (0.35, 0.10, 0.07, 0.05, 0.01),
    "Consumer Staples": (0.38, 0.12, 0.08, 0.04, 0.01),
    "Industrials": (0.33, 0.12, 0.08, 0.05, 0.02),
    "Communication Services": (0.52, 0.20, 0.14, 0.10, 0.03),
    "Energy": (0.28, 0.12, 0.08, 0.15, 0.01),
    "Materials": (0.28, 0.10, 0.07, 0.08, 0.01),
    "Real Estate": (0.58, 0.32, 0.20, 0.20, 0.00),
    "Utilities": (0.32, 0.18, 0.11, 0.20, 0.00),
}
DEFAULT_RATIOS = (0.40, 0.15, 0.10, 0.06, 0.03)

# Ranges of balance items as multiples of revenue.
REVENUE_MULTIPLES = {
    "total_assets": (1.8, 3.2),
    "current_assets": (0.5, 1.2),
    "total_liabilities": (1.0, 2.2),
    "current_liabilities": (0.3, 0.9),
    "cash": (0.08, 0.30),
    "accounts_receivable": (0.08, 0.25),
    "inventory": (0.02, 0.12),
    "long_term_debt": (0.20, 0.80),
    "sga_expense": (0.05, 0.18),
}

# Expected first-digit shares and the rating cuts.
FIRST_DIGIT_SHARE = {
    1: 0.30103, 2: 0.17609, 3: 0.12494,
    4: 0.09691, 5: 0.07918, 6: 0.06695,
    7: 0.05799, 8: 0.05115, 9: 0.04576,
}
MIN_DIGITS = 50
MAD_ACCEPTABLE = 0.006
MAD_MARGINAL = 0.012

# Fusion weights and tier cuts (first cut reached wins).
FUSION_WEIGHTS = {"ml": 0.5, "benford": 0.3, "network": 0.2}
TIERS = {
    "scorer": ([(70, "HIGH"), (45, "MEDIUM"), (20, "LOW")], "CLEAN"),
    "card": ([(85, "CRITICAL"), (70, "HIGH"), (50, "MEDIUM"), (30, "LOW")], "MINIMAL"),
}
TIER_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "MINIMAL", "CLEAN"]

# Red flags and model features.
FLAGS = [
    "flag_ar_acceleration", "flag_cashflow_divergence", "flag_margin_compression",
    "flag_aggressive_recognition", "flag_high_leverage", "flag_liquidity_stress",
]
FEATURES = [
    "gross_margin", "operating_margin", "net_margin", "revenue_yoy_growth", "ar_to_revenue",
    "current_ratio", "debt_to_equity", "roe",
    *FLAGS,
    "total_signal_count", "late_filings_count", "max_reporting_lag_days",
]
COUNT_FEATURES = [*FLAGS, "total_signal_count", "late_filings_count"]

# Wording of features in narratives.
FEATURE_LABELS = {
    "flag_ar_acceleration": "accounts receivable growing faster than revenue",
    "flag_cashflow_divergence": "cash flow diverging from net income",
    "flag_margin_compression": "sustained gross margin compression",
    "flag_aggressive_recognition": "aggressive revenue recognition pattern",
    "flag_high_leverage": "high debt-to-equity ratio",
    "flag_liquidity_stress": "current ratio below 1.0 (liquidity risk)",
    "ar_to_revenue": "elevated AR-to-revenue ratio",
    "debt_to_equity": "leverage level",
    "gross_margin": "gross margin level",
    "revenue_yoy_growth": "revenue growth rate",
    "total_signal_count": "multiple concurrent risk signals",
    "late_filings_count": "history of late SEC filings",
    "max_reporting_lag_days": "filing lag severity",
}
SIGNAL_TEXT = {
    "flag_ar_acceleration": "AR acceleration (+0.18)",
    "flag_cashflow_divergence": "Cash-earnings divergence (+0.22)",
    "flag_margin_compression": "Margin compression (+0.15)",
}

# Texts where there is nothing to tell.
NO_EXPLANATION = "Insufficient data for explanation."
NO_EXCERPTS = "No relevant filing excerpts found."

# Risk phrases by category, and positive phrases.
RISK_PHRASES = {
    "going_concern": [
        "going concern", "substantial doubt", "ability to continue", "liquidation", "cease operations",
    ],
    "restatement": [
        "restate", "restatement", "material weakness", "significant deficiency", "internal control",
    ],
    "legal_risk": [
        "securities litigation", "class action", "sec investigation", "regulatory inquiry", "subpoena", "indictment",
    ],
    "uncertainty_hedging": [
        "may not", "could result", "cannot assure", "no assurance", "might not", "there can be no guarantee",
    ],
    "revenue_risk": [
        "revenue recognition", "channel stuffing", "bill and hold", "accelerated recognition", "contingent revenue",
    ],
    "auditor_risk": [
        "change in auditor", "auditor disagreement", "qualified opinion", "adverse opinion",
    ],
}
POSITIVE_PHRASES = [
    "record revenue", "strong growth", "exceeded expectations",
    "market leader", "competitive advantage", "robust demand",
]

# Filing sections, heading patterns over lower-cased text, and titles.
SECTIONS = [
    ("business", r"item\s*1[\.\s]*business", "Item 1 - Business"),
    ("risk_factors", r"item\s*1a[\.\s]*risk\s*factor", "Item 1A - Risk Factors"),
    ("mda", r"item\s*7[\.\s]*management.{0,20}discussion", "Item 7 - MD&A"),
    ("market_risk", r"item\s*7a[\.\s]*quantitative", "Item 7A - Market Risk"),
    ("financial_statements", r"item\s*8[\.\s]*financial\s*statement", "Item 8 - Financial Statements"),
]

# Link patterns of a filing index page, first match wins.
PRIMARY_LINK_PATTERNS = [
    r'href="([^"]+\.htm)"[^>]*>(?:10-K|Annual)',
    r'<td>10-K</td>.*?href="([^"]+\.htm)"',
    r'href="([^"]+10k[^"]*\.htm)"',
    r'href="([^"]+annual[^"]*\.htm)"',
]

# Relationship names, and the two levels of drift.
EDGE_TYPES = {
    "SUBSIDIARY": "SUBSIDIARY_OF",
    "PARTNERS_WITH": "PARTNERS_WITH",
    "CUSTOMER_OF": "CUSTOMER_OF",
    "JOINT_VENTURE_WITH": "JOINT_VENTURE_WITH",
}
SCORE_DRIFT = 10.0
RATE_DRIFT = 0.05
BIAS_CUT = 1.5
