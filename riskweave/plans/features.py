"""Feature matrix, scaling, trends and feature statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import clamp
from riskweave.functions.order_stats import order_statistics, percentile_row, value_counts, with_positions
from riskweave.session import cut_lineage

META = ["cik", "ticker", "company_name", "industry_group", "risk_tier", "pre_ml_risk_score"]


def available(df: DataFrame, wanted: Sequence[str] = K.FEATURES) -> tuple[list[str], list[str]]:
    """Wanted columns split into present and missing."""
    have = set(df.columns)
    return [c for c in wanted if c in have], [c for c in wanted if c not in have]


def _number(c: str) -> Column:
    """The column as a double, with not-a-number as null."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


CUTS, QUARTILES = (0.01, 0.99), (0.25, 0.5, 0.75)


def _places(n: int, p: float) -> tuple[int, int, float]:
    """Positions around a percentile of n sorted values, and the weight of the upper one."""
    at = (n - 1) * p
    return math.floor(at), math.ceil(at), at - math.floor(at)


def _between(low: float, high: float, weight: float) -> float:
    return low + (high - low) * weight


class _Filled:
    """Percentiles of a column whose nulls became its median, from a row of order statistics of its known values."""

    def __init__(self, row, n: int) -> None:
        self.row, self.n, self.known = row, n, row["total"]
        self.median = _between(row["mid_lo"], row["mid_hi"], _places(self.known, 0.5)[2])
        self.below = row["mid_lo_before"] if self.median <= row["mid_lo"] else row["mid_hi_before"]

    def value(self, name: str, position: int) -> float:
        """The value at a position: known ones below the median, the filled ones, the other known ones."""
        if position < self.below:
            return self.row[name]
        return self.median if position < self.below + self.n - self.known else self.row[f"{name}_behind"]

    def percentile(self, p: float, cut: tuple[float, float] | None = None) -> float:
        lo, hi, weight = _places(self.n, p)
        ends = self.value(f"lo_{p}", lo), self.value(f"hi_{p}", hi)
        if cut:
            ends = tuple(max(min(v, cut[1]), cut[0]) for v in ends)
        return _between(*ends, weight)


def fit(candidates: DataFrame) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """The feature matrix and its scaler from one table of sorted values.

    Filling with the median moves known values by the number of nulls, and clipping keeps their order, so the clip points
    of the filled column and the quartiles of the clipped one follow from order statistics of the known values. Like any
    fitted transformer this brings statistics to the driver, a row a feature.
    """
    present, _ = available(candidates)
    counts = [c for c in present if c in K.COUNT_FEATURES]
    ratios = [c for c in present if c not in counts]
    # one row per company, read by the statistics and the result
    base = cut_lineage(candidates.select(
        *[c for c in META if c in candidates.columns],
        *[F.coalesce(_number(c), F.lit(0.0)).alias(c) for c in counts],
        *[_number(c).alias(c) for c in ratios],
    ))
    n = base.count()
    at = {"mid_lo": F.floor((F.col("total") - 1) * F.lit(0.5)), "mid_hi": F.ceil((F.col("total") - 1) * F.lit(0.5))}
    for p in (*CUTS, *QUARTILES):
        for name, position in zip((f"lo_{p}", f"hi_{p}"), _places(n, p)[:2], strict=True):
            at |= {name: F.lit(position), f"{name}_behind": F.lit(position) - (F.lit(n) - F.col("total"))}
    # `total` is that of the metric in every row
    placed = with_positions(value_counts(base, [], present), [])
    known = {r["metric"]: _Filled(r, n) for r in order_statistics(placed, at).collect()}
    fill = {c: F.lit(known[c].median if c in known else None).cast("double") for c in ratios}
    cut = {c: tuple(known[c].percentile(p) for p in CUTS) for c in ratios if c in known}
    features = base.withColumns({c: F.coalesce(F.col(c), fill[c]) for c in ratios})
    features = features.withColumns({c: clamp(c, F.lit(lo), F.lit(hi)) for c, (lo, hi) in cut.items()})
    fitted = {}
    for c in present:
        if c in known:
            low, mid, high = (known[c].percentile(p, cut.get(c)) for p in QUARTILES)
            fitted[c] = (mid, (high - low) or 1.0)
    return features, fitted


def build(candidates: DataFrame) -> DataFrame:
    """Counts: null -> 0. Ratios: null -> median, then clipped at the 1st and 99th percentile of the filled column."""
    return fit(candidates)[0]


def scaler(features: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Median and interquartile range per column; a zero range counts as 1."""
    q = percentile_row(features, columns, [0.25, 0.5, 0.75]).first()
    known = [c for c in columns if q[f"{c}_p1"] is not None]
    return {c: (q[f"{c}_p1"], (q[f"{c}_p2"] - q[f"{c}_p0"]) or 1.0) for c in known}


def apply_scaler(features: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return features.withColumns({c: (F.col(c) - F.lit(mid)) / F.lit(width) for c, (mid, width) in fitted.items()})


def scale(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scaler(features, scaler(features, columns))


TRENDS = {
    "gm_slope_4q": "gross_margin",
    "om_slope_4q": "operating_margin",
    "ar_slope_4q": "ar_to_revenue",
    "revenue_slope_4q": "revenues",
    "signal_count_trend": "total_signal_count",
}


def trend_slopes(summary: DataFrame) -> DataFrame:
    """Slopes over the last four quarters, for companies with two or more."""
    newest = Window.partitionBy("cik").orderBy(F.desc("period_end"))
    last4 = summary.where("form = '10-Q'").withColumn("_rn", F.row_number().over(newest)).where("_rn <= 4")
    # four rows at most from here on
    whole = Window.partitionBy("cik")
    med = {f"_med_{c}": F.median(c).over(whole) for c in TRENDS.values()}
    ready = last4.withColumns({"_x": -F.col("_rn"), **med})
    slopes = [
        F.coalesce(F.regr_slope(F.coalesce(F.col(c), F.col(f"_med_{c}"), F.lit(0.0)).cast("double"), F.col("_x").cast("double")), F.lit(0.0)).alias(o)
        for o, c in TRENDS.items()
    ]
    return (
        ready.groupBy("cik")
        .agg(F.max("ticker").alias("ticker"), F.max("company_name").alias("company_name"), F.count(F.lit(1)).alias("_n"), *slopes)
        .where("_n >= 2")
        .drop("_n")
    )


def correlation(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle of the correlation matrix in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = features.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs])
    return row.select(F.inline(cells))


def moments(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per feature, one pass."""
    row = features.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_samp(c).alias(f"{c}_s") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_m").alias("mean"), F.col(f"{c}_s").alias("std")) for c in columns])
    return row.select(F.inline(cells))
