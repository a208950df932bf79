"""Staging, ratio, trend and risk marts over period metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import guarded_ratio, pad_cik, safe_divide, tier
from riskweave.functions.order_stats import percentiles, row_numbers
from riskweave.operators.facts import period_metrics, with_yoy_growth
from riskweave.session import cut_lineage

SUMMARY_COLUMNS = [
    "cik", "ticker", "company_name", "industry_group", "period_end", "fiscal_year", "fiscal_quarter", "form", "revenues",
    "gross_margin", "operating_margin", "net_margin", "ar_to_revenue", "cash_earnings_gap", "current_ratio",
    "debt_to_equity", "revenue_yoy_growth", "total_signal_count", *K.FLAGS,
]


def newest_companies(companies: DataFrame, updated: str = "updated_at") -> DataFrame:
    """One row per normalised id, the one updated last."""
    rest = [c for c in companies.columns if c != "cik"]
    picked = companies.withColumn("cik", pad_cik("cik")).groupBy("cik").agg(
        F.max_by(F.struct(*rest), F.struct(F.col(updated), F.struct(*rest))).alias("_row")
    )
    return picked.select("cik", "_row.*")


def staged_companies(companies: DataFrame) -> DataFrame:
    """Staging names of the company columns."""
    return companies.withColumnsRenamed({"name": "company_name", "sic_description": "industry_group"})


def staged_filings(filings: DataFrame) -> DataFrame:
    """Filings under staging names: accession without separators, padded id, form in capitals without its amendment mark."""
    form = F.upper(F.trim("form_type"))
    return filings.select(
        F.regexp_replace("accession_number", "[^0-9A-Za-z]", "").alias("accession_key"), "accession_number", pad_cik("cik").alias("cik"),
        F.regexp_replace(form, "/A$", "").alias("form"), F.endswith(form, F.lit("/A")).alias("is_amendment"),
        F.col("filing_date").cast("date").alias("filing_date"), F.col("period_of_report").cast("date").alias("period_of_report"),
        F.date_diff(F.col("filing_date").cast("date"), F.col("period_of_report").cast("date")).alias("days_to_file"),
    )


def staged_facts(facts: DataFrame) -> DataFrame:
    """Facts under staging names: the words of the concept as its label, taxonomy and concept as one tag."""
    words = F.regexp_replace(F.col("concept"), "([a-z0-9])([A-Z])", "$1 $2")
    return facts.select(
        pad_cik("cik").alias("cik"), F.regexp_replace("accession_number", "[^0-9A-Za-z]", "").alias("accession_key"),
        F.concat_ws(":", "taxonomy", "concept").alias("tag"), "concept", words.alias("concept_label"),
        F.upper(F.trim("form")).alias("form"), "unit", "value", "period_end", "filed",
    )


def staged_metrics(metrics: DataFrame, start: str = K.HISTORY_START) -> DataFrame:
    """Padded ids, history start and the five null-safe ratios."""
    return metrics.where(F.col("period_end") >= F.lit(start).cast("date")).select(
        pad_cik("cik").alias("cik"), "period_end", "form", "revenues",
        safe_divide("gross_profit", "revenues").alias("gross_margin"),
        safe_divide("operating_income", "revenues").alias("operating_margin"),
        safe_divide("net_income", "revenues").alias("net_margin"),
        safe_divide("current_assets", "current_liabilities").alias("current_ratio"),
        safe_divide("long_term_debt", "stockholders_equity").alias("debt_to_equity"),
    )


def ratios(metrics: DataFrame) -> DataFrame:
    """Twelve ratios; null where the denominator is not positive."""
    rev = F.col("revenues")
    return metrics.withColumns({
        "form": F.coalesce("form", F.lit("10-K")),
        "fiscal_year": F.year("period_end"),
        "fiscal_quarter": F.quarter("period_end"),
        "gross_margin": guarded_ratio("gross_profit", rev),
        "operating_margin": guarded_ratio("operating_income", rev),
        "net_margin": guarded_ratio("net_income", rev),
        "ar_to_revenue": guarded_ratio("accounts_receivable", rev),
        "cash_earnings_gap": guarded_ratio(F.col("operating_cashflow") - F.col("net_income"), rev),
        "current_ratio": guarded_ratio("current_assets", "current_liabilities"),
        "debt_to_equity": guarded_ratio("long_term_debt", "stockholders_equity"),
        "roe": guarded_ratio("net_income", "stockholders_equity"),
        "sga_ratio": guarded_ratio("sga_expense", rev),
        "rd_intensity": guarded_ratio("rd_expense", rev),
        "capex_ratio": guarded_ratio("capex", rev),
    })


def trends(rated: DataFrame, leverage_limit: float = 3.0) -> DataFrame:
    """Prior-period values, rolling margin, six flags and their sum.

    A company's periods are few (calendar-bound) after the metrics aggregation; every window
    is keyed by cik first, so the exchange of the growth window serves all of them.
    """
    series = Window.partitionBy("cik", "form").orderBy("period_end")
    last4 = series.rowsBetween(-3, 0)
    year = Window.partitionBy("cik", "fiscal_year").orderBy(F.desc("period_end"), "form")
    # trailing values run over the quarters of a company whatever their form, one row a quarter
    number = F.col("fiscal_year") * 4 + F.col("fiscal_quarter")
    quarter = Window.partitionBy("cik", "fiscal_year", "fiscal_quarter").orderBy("form", F.desc("period_end"))
    trailing = Window.partitionBy("cik").orderBy(number).rangeBetween(-3, 0)
    rated = rated.withColumn("_counts", F.row_number().over(quarter) == 1)

    def counted(name: str) -> Column:
        return F.when(F.col("_counts"), F.col(name))

    base = rated.withColumns({
        "prior_ar_to_revenue": F.lag("ar_to_revenue").over(series),
        "prior_revenues": F.lag("revenues").over(series),
        "prior_receivable": F.lag("accounts_receivable").over(series),
        "gross_margin_avg4": F.avg("gross_margin").over(last4),
        "operating_margin_avg4": F.avg("operating_margin").over(last4),
        "net_margin_avg4": F.avg("net_margin").over(last4),
        "revenues_sum4": F.sum("revenues").over(last4),
        "period_rank_in_year": F.row_number().over(year),
        "t4q_gross_margin": F.avg(counted("gross_margin")).over(trailing),
        "t4q_operating_margin": F.avg(counted("operating_margin")).over(trailing),
        "t4q_net_margin": F.avg(counted("net_margin")).over(trailing),
        "t4q_total_revenues": F.sum(counted("revenues")).over(trailing),
    }).drop("_counts")
    rules = {
        "flag_ar_acceleration": F.col("ar_to_revenue") > F.col("prior_ar_to_revenue") * 1.15,
        "flag_cashflow_divergence": F.abs(F.col("operating_cashflow") - F.col("net_income")) > F.abs("net_income") * 0.2,
        "flag_margin_compression": F.col("gross_margin") < F.col("gross_margin_avg4") - 0.03,
        "flag_aggressive_recognition": (F.col("revenues") > F.col("prior_revenues") * 1.10)
        & (F.col("accounts_receivable") > F.col("prior_receivable") * 1.20),
        "flag_high_leverage": F.col("debt_to_equity") > leverage_limit,
        "flag_liquidity_stress": F.col("current_ratio") < 1.0,
    }
    flagged = base.withColumns({k: F.when(v, 1).otherwise(0) for k, v in rules.items()})
    return flagged.withColumn("total_signal_count", sum((F.col(f) for f in K.FLAGS), F.lit(0)))


FLOWS = ["revenues", "gross_profit", "operating_income", "net_income"]  # amounts of a period, which add up


def true_quarters(rated: DataFrame) -> DataFrame:
    """A row a company and fiscal quarter: amounts of the quarter alone, of the four up to it, and the margins of those four.

    `trends` takes each report as one quarter. Here an annual report holds the amounts of its year, so its quarter is what
    the three others leave of them, unknown if one of these is missing; the four quarters up to it are then the year itself.
    Any other report stands for its own quarter (an annual one comes first, then the latest). Amounts of four quarters are
    null unless all four are known.
    """
    annual = F.col("form").isin(*K.ANNUAL_FORMS)
    pick = Window.partitionBy("cik", "fiscal_year", "fiscal_quarter").orderBy(F.when(annual, 0).otherwise(1), "form", F.desc("period_end"))
    rows = rated.withColumn("_place", F.row_number().over(pick)).where("_place = 1").withColumn("_n", F.col("fiscal_year") * 4 + F.col("fiscal_quarter"))
    year = Window.partitionBy("cik", "fiscal_year")
    four = Window.partitionBy("cik").orderBy("_n").rangeBetween(-3, 0)
    single, trailing = {}, {}
    for name in FLOWS:
        other = F.when(~annual, F.col(name))
        rest = F.when(F.count(other).over(year) == 3, F.col(name) - F.sum(other).over(year))
        single[f"quarter_{name}"] = F.when(annual, rest).otherwise(F.col(name))
        q = F.col(f"quarter_{name}")
        trailing[f"t4q_{name}"] = F.when(annual, F.col(name)).otherwise(F.when(F.count(q).over(four) == 4, F.sum(q).over(four)))
    margins = {f"t4q_{m}_margin": guarded_ratio(f"t4q_{a}", "t4q_revenues") for m, a in (("gross", "gross_profit"), ("operating", "operating_income"), ("net", "net_income"))}
    out = rows.withColumns(single).withColumns(trailing).withColumns(margins)
    return out.select("cik", "fiscal_year", "fiscal_quarter", annual.alias("annual"), *single, *trailing, *margins)


def rated_history(facts: DataFrame) -> DataFrame:
    """Facts to the full ratio and flag history."""
    return trends(ratios(with_yoy_growth(period_metrics(facts))))


def one_annual_per_year(rows: DataFrame) -> DataFrame:
    """One 10-K per company and fiscal year (the latest); every other form stays."""
    pick = Window.partitionBy("cik", "fiscal_year", "form").orderBy(F.desc("period_end"), "id")
    ranked = rows.withColumn("_pick", F.row_number().over(pick))
    return ranked.where((F.col("form") != "10-K") | (F.col("_pick") == 1)).drop("_pick")


def financial_summary(history: DataFrame, companies: DataFrame) -> DataFrame:
    who = companies.select("cik", "ticker", "company_name", "industry_group")
    return one_annual_per_year(history).join(who, "cik", "left").select(*SUMMARY_COLUMNS)


def latest_period(history: DataFrame) -> DataFrame:
    newest = Window.partitionBy("cik").orderBy(F.desc("period_end"), "form", "id")
    return history.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def filing_behaviour(filings: DataFrame, late_after: dict[str, int] | None = None) -> DataFrame:
    """Dated filings and longest delay per company; with `late_after`, also those past the limit of their form."""
    lag = F.datediff("filing_date", "period_of_report")
    aggs = [F.count("filing_date").alias("late_filings_count"), F.max(lag).alias("max_reporting_lag_days")]
    if late_after:
        limit = F.lit(None).cast("int")
        for form, days in late_after.items():
            limit = F.when(F.col("form_type") == form, days).otherwise(limit)
        aggs.append(F.count(F.when(lag > limit, 1)).alias("past_limit_count"))
    return filings.groupBy("cik").agg(*aggs)


def rule_score(weights: dict[str, float] | None = None) -> Column:
    weights = weights or {f: 100.0 / len(K.FLAGS) for f in K.FLAGS}
    return F.least(F.lit(100.0), sum((F.col(f) * w for f, w in weights.items()), F.lit(0.0)))


def dominant_signal() -> Column:
    """Name of the first flag raised, in declared order."""
    return F.coalesce(*[F.when(F.col(f) == 1, F.lit(f.removeprefix("flag_"))) for f in K.FLAGS], F.lit("None"))


def risk_candidates(history: DataFrame, companies: DataFrame, filings: DataFrame, ranked: bool = False) -> DataFrame:
    """Latest period per company with defaults, flags, filing behaviour, rule score and tier."""
    who = companies.select("cik", "ticker", "company_name", "industry_group")
    rev = F.col("revenues")
    out = (
        latest_period(history)
        .join(who, "cik", "left")
        .join(filing_behaviour(filings), "cik", "left")
        .select(
            "cik", "company_name", "ticker", "industry_group",
            F.col("period_end").alias("latest_period"),
            "revenues", "gross_margin", "operating_margin", "net_margin",
            guarded_ratio("current_assets", "current_liabilities", 1.5).alias("current_ratio"),
            guarded_ratio("long_term_debt", "stockholders_equity", 0.5).alias("debt_to_equity"),
            guarded_ratio(F.coalesce("accounts_receivable", F.lit(0.0)), rev, 0.1).alias("ar_to_revenue"),
            "revenue_yoy_growth",
            F.coalesce("cash_earnings_gap", F.lit(0.0)).alias("cash_earnings_gap"),
            "roe", *K.FLAGS, "total_signal_count",
            (F.coalesce("late_filings_count", F.lit(0)) > 0).alias("has_late_filings"),
            F.coalesce("late_filings_count", F.lit(0)).alias("late_filings_count"),
            F.coalesce("max_reporting_lag_days", F.lit(0)).alias("max_reporting_lag_days"),
            F.round(rule_score(), 4).alias("pre_ml_risk_score"),
            dominant_signal().alias("dominant_signal"),
            "t4q_gross_margin", "t4q_operating_margin", "t4q_net_margin", "t4q_total_revenues",
        )
        .withColumn("risk_tier", tier("pre_ml_risk_score"))
    )
    if not ranked:
        return out
    by_revenue = [F.desc_nulls_last("revenues"), F.col("cik")]
    return row_numbers(row_numbers(out, by_revenue, "risk_rank"), by_revenue, "risk_rank_in_industry", ["industry_group"])


def company_dashboard(candidates: DataFrame) -> DataFrame:
    """Trailing values and distance to the industry; industry figures are aggregated first and joined back."""
    candidates = cut_lineage(candidates)  # read by the averages, the medians and the rows
    averages = candidates.groupBy("industry_group").agg(
        F.avg("gross_margin").alias("industry_avg_gross_margin"),
        F.avg("operating_margin").alias("industry_avg_operating_margin"),
    )
    long = percentiles(candidates, ["gross_margin", "debt_to_equity"], [0.5], ["industry_group"])
    medians = long.groupBy("industry_group").agg(
        F.max(F.when(F.col("metric") == "gross_margin", F.col("p0"))).alias("industry_med_gross_margin"),
        F.max(F.when(F.col("metric") == "debt_to_equity", F.col("p0"))).alias("industry_med_debt_to_equity"),
    )
    return (
        candidates.join(averages, "industry_group", "left")
        .join(medians, "industry_group", "left")
        .select(
            "cik", "ticker", "company_name", "industry_group", "risk_tier", "pre_ml_risk_score",
            *[c for c in ("risk_rank", "risk_rank_in_industry") if c in candidates.columns],
            "dominant_signal", "total_signal_count", "latest_period", "revenues",
            "gross_margin", "operating_margin", "net_margin", "current_ratio", "debt_to_equity", "ar_to_revenue",
            "revenue_yoy_growth", "has_late_filings", "late_filings_count",
            "t4q_gross_margin", "t4q_operating_margin", "t4q_net_margin",
            F.col("revenue_yoy_growth").alias("t4q_revenue_growth"),
            "t4q_total_revenues",
            (F.col("gross_margin") - F.col("industry_med_gross_margin")).alias("gross_margin_vs_peers"),
            (F.col("debt_to_equity") - F.col("industry_med_debt_to_equity")).alias("leverage_vs_peers"),
            "industry_avg_gross_margin", "industry_avg_operating_margin",
            "industry_med_gross_margin", "industry_med_debt_to_equity",
        )
    )
