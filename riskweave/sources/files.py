"""Landed CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions import constants as K
from riskweave.functions.exprs import derived_cik, lookup, pad_cik

# Header names of the listing file and what they are called here.
LISTING_HEADERS = {
    "symbol": "ticker",
    "security": "name",
    "gics sector": "sector",
    "gics sub-industry": "sub_industry",
    "headquarters location": "hq",
}


def tidy_headers(df: DataFrame, names: dict[str, str]) -> DataFrame:
    plain = {c: c.strip().lower() for c in df.columns}
    return df.withColumnsRenamed({c: names.get(p, p) for c, p in plain.items()})


def companies_csv(spark: SparkSession, path: str) -> DataFrame:
    """Listing file, all columns read as text: known headers, missing columns as 'Unknown', ids and industry codes."""
    df = tidy_headers(spark.read.csv(path, header=True), LISTING_HEADERS)
    for c in ("ticker", "name", "sector"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("Unknown"))
    given = pad_cik(F.coalesce("cik", F.lit("0"))) if "cik" in df.columns and not df.where("cik is not null").isEmpty() else None
    return df.withColumns({
        "cik": derived_cik("ticker") if given is None else given,
        "sic_code": F.coalesce(lookup(K.SECTOR_SIC, "sector"), F.lit(K.DEFAULT_SIC)),
    })


def prices_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily prices with a declared schema; the stamp is read as UTC."""
    df = spark.read.schema(S.PRICES_CSV).csv(path, header=True, enforceSchema=True)
    return df.withColumn("date", F.to_timestamp("date").cast("date"))
