"""Landed JSON documents to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave import schemas as S
from riskweave.functions import constants as K
from riskweave.functions.exprs import lookup, pad_cik, strict_key


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One whole file per row: path and text."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.input_file_name().alias("path"), F.col("value").alias("body"))


def fact_entries(docs: DataFrame, body: str = "body") -> DataFrame:
    """One row per taxonomy, concept, unit and entry of company-facts documents (cik, body)."""
    parsed = docs.select("cik", F.from_json(body, S.COMPANY_FACTS).alias("d"))
    concepts = parsed.select("cik", F.explode("d.facts").alias("taxonomy", "concepts"))
    units = concepts.select("cik", "taxonomy", F.explode("concepts").alias("concept", "detail"))
    lists = units.select("cik", "taxonomy", "concept", F.coalesce("detail.label", "concept").alias("label"),
                         F.explode("detail.units").alias("unit", "entries"))
    rows = lists.select("cik", "taxonomy", "concept", "label", "unit", F.inline("entries"))
    return rows.select(
        "cik", "taxonomy", "concept", "label", "unit",
        F.nullif("accn", F.lit("")).alias("accession_number"),
        F.col("start").cast("date").alias("period_start"),
        F.expr("try_cast(`end` AS date)").alias("period_end"),
        F.col("val").alias("value"),
        F.coalesce("form", F.lit("")).alias("form"),
        F.expr("try_cast(filed AS date)").alias("filed"),
    )


def reject_reason(start: str = K.HISTORY_START) -> Column:
    """Why an entry is not taken; null for accepted entries."""
    return (
        F.when(~F.col("unit").isin(*K.ACCEPTED_UNITS), "unit")
        .when(F.col("period_end").isNull() | (F.col("period_end") < F.lit(start).cast("date")), "period")
        .when(~F.col("form").isin(*K.ACCEPTED_FORMS), "form")
        .when(F.col("value").isNull(), "value")
    )


def accepted_facts(docs: DataFrame, start: str = K.HISTORY_START) -> DataFrame:
    rows = fact_entries(docs).where(reject_reason(start).isNull())
    key = strict_key("cik", "concept", "period_end", F.coalesce("accession_number", F.lit("")))
    return rows.select(key.alias("id"), *rows.columns)


def rejected_facts(docs: DataFrame, start: str = K.HISTORY_START) -> DataFrame:
    return fact_entries(docs).withColumn("reason", reject_reason(start)).where(F.col("reason").isNotNull())


def company_profiles(docs: DataFrame, body: str = "body") -> DataFrame:
    """Company row of each submissions document: first ticker, exchanges joined, empty text as null."""
    d = docs.select("cik", F.from_json(body, S.SUBMISSIONS).alias("d"))
    return d.select(
        "cik",
        F.coalesce("d.name", F.lit("")).alias("name"),
        F.nullif(F.get("d.tickers", F.lit(0)), F.lit("")).alias("ticker"),
        F.col("d.sic").alias("sic_code"),
        F.col("d.sicDescription").alias("sic_description"),
        F.col("d.ein").alias("ein"),
        F.col("d.stateOfIncorporation").alias("state_of_incorporation"),
        F.col("d.fiscalYearEnd").alias("fiscal_year_end"),
        F.nullif(F.array_join(F.coalesce("d.exchanges", F.array().cast("array<string>")), ","), F.lit("")).alias("exchanges"),
    )


def filing_rows(docs: DataFrame, start: str = K.HISTORY_START, body: str = "body") -> DataFrame:
    """Filings of submissions documents: parallel arrays zipped by position."""
    recent = docs.select("cik", F.from_json(body, S.SUBMISSIONS).getField("filings").getField("recent").alias("r"))
    names = ["accessionNumber", "form", "filingDate", "reportDate", "primaryDocument", "documentCount"]
    empty = {n: F.coalesce(F.col(f"r.{n}"), F.array().cast("array<int>" if n == "documentCount" else "array<string>")) for n in names}
    zipped = F.arrays_zip(*[empty[n].alias(n) for n in names])
    rows = recent.withColumn("_z", zipped).select("cik", F.inline("_z").alias(*names))
    return rows.where(F.col("form").isin(*K.ACCEPTED_FORMS) & (F.col("reportDate") >= start)).select(
        F.regexp_replace(F.coalesce("accessionNumber", F.lit("")), "-", "").alias("accession_number"),
        "cik",
        F.col("form").alias("form_type"),
        F.expr("try_cast(filingDate AS date)").alias("filing_date"),
        F.expr("try_cast(reportDate AS date)").alias("period_of_report"),
        F.col("documentCount").alias("document_count"),
        F.col("primaryDocument").alias("primary_document"),
    )


def auditor_rows(docs: DataFrame, body: str = "body") -> DataFrame:
    """Entries of auditor documents keyed by company id."""
    return docs.select(F.explode(F.from_json(body, S.AUDITORS)).alias("cik", "a")).select(pad_cik("cik").alias("cik"), "a.*")


def relationship_rows(docs: DataFrame, body: str = "body") -> DataFrame:
    """Entries of relationship documents; known kinds get their edge name, unknown ones pass through."""
    rows = docs.select(F.inline(F.from_json(body, S.RELATIONSHIPS)))
    return rows.withColumns({
        "parent_cik": pad_cik("parent_cik"),
        "subsidiary_cik": pad_cik("subsidiary_cik"),
        "edge_type": F.coalesce(lookup(K.EDGE_TYPES, "relationship_type"), "relationship_type"),
    })


def ticker_rows(docs: DataFrame, body: str = "body") -> DataFrame:
    return docs.select(F.explode(F.from_json(body, S.TICKERS)).alias("_k", "t")).select(
        pad_cik("t.cik_str").alias("cik"), F.upper("t.ticker").alias("ticker"), F.col("t.title").alias("company_name")
    )


def resolve_tickers(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """Company id per wanted ticker, whatever its case; null with resolved = false where unknown."""
    names = known.select(F.upper("ticker").alias("_t"), "cik")
    out = wanted.join(names, F.upper("ticker") == F.col("_t"), "left").drop("_t")
    return out.withColumn("resolved", F.col("cik").isNotNull())
