"""Daily price series to annual rows and statement proxies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import safe_divide, strict_key, unit_noise


def annual_prices(prices: DataFrame) -> DataFrame:
    """Ticker-years: last day, mean close, volume, first open and last close that are not null."""
    at = F.struct("date", "seq")
    # closes are added as decimals, so the mean is the same in whatever order the rows come
    mean = F.sum(F.col("close").cast("decimal(28,8)")).cast("double") / F.count("close")
    return prices.groupBy("ticker", F.year("date").alias("year")).agg(
        F.max("date").alias("period_end_raw"),
        mean.alias("avg_close"),
        F.sum("volume").alias("total_volume"),
        F.min_by("open", F.when(F.col("open").isNotNull(), at)).alias("open_price"),
        F.max_by("close", F.when(F.col("close").isNotNull(), at)).alias("close_price"),
        F.count("close").alias("trading_days"),
    ).withColumn("revenues", F.col("avg_close") * F.col("total_volume") / 1e3)


def annual_growth(annual: DataFrame) -> DataFrame:
    prior = F.lag("revenues").over(Window.partitionBy("ticker").orderBy("year"))
    return annual.withColumn("revenue_yoy_growth", safe_divide(F.col("revenues") - prior, prior))


def with_owner(annual: DataFrame, owners: DataFrame) -> DataFrame:
    """Id and sector of the company; series without a company fall out."""
    who = owners.select("ticker", "cik", F.coalesce("sector", F.lit("Unknown")).alias("sector"))
    return annual.join(who.where(F.col("cik").isNotNull()), "ticker")


def selected(prices: DataFrame, owners: DataFrame) -> DataFrame:
    return prices.join(owners.select("ticker"), "ticker", "left_semi")


def statement_proxies(annual: DataFrame) -> DataFrame:
    """Statement items as sector shares or multiples of revenue, with noise fixed by company, year and item."""

    def spread(item: str, low: float, high: float):
        return F.lit(low) + unit_noise(F.lit(item), "cik", "year") * (high - low)

    names = ["gm", "om", "nm", "capex_r", "rnd_r"]
    rows = [(s, *v) for s, v in K.SECTOR_RATIOS.items()]
    # thirteen fixed rows
    shares = F.broadcast(annual.sparkSession.createDataFrame(rows, "sector string, " + ", ".join(f"{n} double" for n in names)))
    rated = annual.join(shares, "sector", "left")
    for n, d in zip(names, K.DEFAULT_RATIOS):
        rated = rated.withColumn(n, F.coalesce(n, F.lit(d)))
    rev = F.col("revenues")
    items = {
        "gross_profit": rev * F.col("gm") * spread("gross_profit", 0.92, 1.08),
        "operating_income": rev * F.col("om") * spread("operating_income", 0.92, 1.08),
        "net_income": rev * F.col("nm") * spread("net_income", 0.92, 1.08),
        "rd_expense": rev * F.col("rnd_r") * spread("rd_expense", 0.85, 1.15),
        "capex": rev * F.col("capex_r") * spread("capex", 0.80, 1.20),
        **{m: rev * spread(m, lo, hi) for m, (lo, hi) in K.REVENUE_MULTIPLES.items()},
    }
    full = rated.withColumns(items).withColumns({
        "stockholders_equity": F.col("total_assets") - F.col("total_liabilities"),
        "operating_cashflow": F.col("net_income") * spread("operating_cashflow", 1.0, 1.4),
        "period_end": F.make_date("year", F.lit(12), F.lit(31)),
        "form": F.lit("10-K"),
    })
    return full.select(
        strict_key("cik", "period_end", "form").alias("id"), "cik", "ticker", "sector", "period_end", "form", *K.METRICS, "revenue_yoy_growth"
    )
