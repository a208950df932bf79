"""First-digit conformity of reported values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import clamp

DIGITS = list(K.FIRST_DIGIT_SHARE)


def leading_digit(value: Column | str) -> Column:
    """Leading decimal digit of |value|; null for null and zero."""
    v = F.abs(F.col(value) if isinstance(value, str) else value)
    digit = F.floor(v / F.pow(F.lit(10.0), F.floor(F.log10(v)).cast("double"))).cast("int")
    return F.when((v > 0) & digit.between(1, 9), digit)


def digit_counts(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """keys, n and c1..c9: one combining aggregation, at most one row per key and task is shuffled."""
    d = df.select(*keys, leading_digit(value).alias("_digit")).where(F.col("_digit").isNotNull())
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(F.col("_digit") == i, 1)).alias(f"c{i}") for i in DIGITS],
    )


def digit_rows(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All nine digits per key with observed and expected shares, absent digits as zero."""
    cells = F.array(*[
        F.struct(F.lit(i).alias("digit"), F.col(f"c{i}").alias("observed"), F.lit(K.FIRST_DIGIT_SHARE[i]).alias("expected_share"))
        for i in DIGITS
    ])
    return counts.select(*keys, "n", F.inline(cells)).withColumn(
        "observed_share", F.when(F.col("n") > 0, F.col("observed") / F.col("n")).otherwise(F.lit(0.0))
    )


def rating(mad: Column, n: Column) -> Column:
    return (
        F.when(n < K.MIN_DIGITS, "Insufficient Data")
        .when(mad < K.MAD_ACCEPTABLE, "Acceptable")
        .when(mad < K.MAD_MARGINAL, "Marginal")
        .otherwise("Non-conforming")
    )


def chi_square_p(x: Column) -> Column:
    """Upper tail of chi-square with 8 degrees of freedom, closed form."""
    h = x / 2
    return F.exp(-h) * (F.lit(1.0) + h + h * h / 2 + h * h * h / 6)


def interpretation(kind: Column, mad: Column, p: Column, digits: Column, n: Column) -> Column:
    listed = F.array_join(digits, ", ")
    # Wording of the findings.
    fine = F.format_string(
        "Financial data (%d observations) conforms to Benford's Law (MAD=%.4f). No forensic concerns from digit analysis.", n, mad
    )
    marginal = F.format_string(
        "Marginal Benford conformity (MAD=%.4f, p=%.3f). Suspicious digit positions: %s. "
        "Recommend cross-checking with cash flow signals.",
        mad, p, F.when(F.size(digits) > 0, listed).otherwise("none"),
    )
    bad = F.format_string(
        "NON-CONFORMING: Significant Benford deviation (MAD=%.4f, p=%.3f). Suspicious digits: %s. "
        "This pattern is consistent with financial data manipulation. Escalate for detailed review.",
        mad, p, F.when(F.size(digits) > 0, listed).otherwise("multiple"),
    )
    short = F.lit("Insufficient data for Benford analysis (need ≥50 observations)")
    return (
        F.when(kind == "Insufficient Data", short)
        .when(kind == "Acceptable", fine)
        .when(kind == "Marginal", marginal)
        .otherwise(bad)
    )


def conformity(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Test statistics, rating, score and findings per key."""
    n = F.col("n").cast("double")
    gaps = {i: F.abs(F.col(f"c{i}") / n - F.lit(e)) for i, e in K.FIRST_DIGIT_SHARE.items()}
    mad = sum(gaps.values(), F.lit(0.0)) / len(DIGITS)
    chi2 = sum(
        ((F.col(f"c{i}") - n * e) * (F.col(f"c{i}") - n * e) / (n * e) for i, e in K.FIRST_DIGIT_SHARE.items()), F.lit(0.0)
    )
    odd = F.array_compact(F.array(*[F.when(gaps[i] > 0.30 * e, F.lit(i)) for i, e in K.FIRST_DIGIT_SHARE.items()]))
    enough = F.col("n") >= K.MIN_DIGITS
    base = (
        counts.withColumn("_mad", F.when(enough, mad).otherwise(F.lit(0.0)))
        .withColumn("_chi2", F.when(enough, chi2).otherwise(F.lit(0.0)))
        .withColumn("_p", F.when(enough, chi_square_p(F.col("_chi2"))).otherwise(F.lit(1.0)))
        .withColumn("suspicious_digits", F.when(enough, odd).otherwise(F.array().cast("array<int>")))
        .withColumn("conformity_rating", rating(F.col("_mad"), F.col("n")))
    )
    # the score adds two parts and may pass 100
    score = F.least(F.lit(100.0), F.col("_mad") / 0.020 * 60) + F.greatest(F.lit(0.0), (1 - F.col("_p")) * 40)
    return base.select(
        *keys,
        F.col("n").alias("n_observations"),
        F.round("_mad", 6).alias("mad_score"),
        F.round("_chi2", 4).alias("chi_square_statistic"),
        F.round("_p", 4).alias("chi_square_p_value"),
        "conformity_rating",
        F.when(enough, F.round(score, 1)).otherwise(F.lit(0.0)).alias("benford_risk_score"),
        "suspicious_digits",
        interpretation(F.col("conformity_rating"), F.col("_mad"), F.col("_p"), F.col("suspicious_digits"), F.col("n")).alias("interpretation"),
    )


def company_conformity(facts: DataFrame, companies: DataFrame) -> DataFrame:
    """All companies at once. Counting precedes the join, so the join sees one row per company."""
    used = facts.where(F.col("form").isin("10-K", "10-Q") & (F.col("value") != 0))
    found = conformity(digit_counts(used, ["cik"]), ["cik"])
    who = companies.select("cik", "company_name", F.coalesce(F.nullif("ticker", F.lit("")), F.col("cik")).alias("ticker"))
    return found.join(who, "cik").withColumn("suspicious_digits", F.array_join("suspicious_digits", ","))


def pooled_conformity(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """All numeric columns of a frame as one series per key."""
    long = df.select(*keys, F.explode(F.array(*[F.col(c).cast("double") for c in columns])).alias("value"))
    return conformity(digit_counts(long, keys), keys)
