"""The given tables, seen as companies, filings, facts, prices, events and texts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import clamp, lookup, tier

# Sectors handed to the given nations in turn; the last one has no industry code.
SECTORS = [*K.SECTOR_SIC, "Diversified"]


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def key10(c: Column | str) -> Column:
    return F.lpad((F.col(c) if isinstance(c, str) else c).cast("string"), 10, "0")


class Tables:
    """Lazy views over one folder of tables; each scan reads only the columns asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def companies(self) -> DataFrame:
        s, n, r = self.raw("supplier"), self.raw("nation"), self.raw("region")
        sector = pick(SECTORS, F.col("n_nationkey"))
        return (
            s.join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                key10("s_suppkey").alias("cik"),
                F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
                F.col("s_name").alias("company_name"),
                sector.alias("industry_group"),
                F.coalesce(lookup(K.SECTOR_SIC, sector), F.lit(K.DEFAULT_SIC)).alias("sic_code"),
                F.col("n_name").alias("state_of_incorporation"),
                F.col("r_name").alias("region"),
            )
        )

    @cached_property
    def facts(self) -> DataFrame:
        """One reported fact per order line."""
        return self.facts_of(self.raw("lineitem"))

    def facts_of(self, lines: DataFrame) -> DataFrame:
        """The facts of the given order lines."""
        li = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        o = self.raw("orders").select("o_orderkey", "o_orderdate")
        concept = pick([c for c, _ in K.CONCEPT_METRICS], F.col("l_partkey"))
        quarter_end = F.last_day(F.add_months(F.trunc(F.col("o_orderdate").cast("date"), "quarter"), 2))
        return (
            li.join(o, li.l_orderkey == o.o_orderkey)
            .withColumn("period_end", quarter_end)
            .select(
                key10("l_suppkey").alias("cik"),
                F.concat(key10("l_suppkey"), F.lit("-"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("accession_number"),
                F.col("l_linenumber").alias("line"),
                F.lit("us-gaap").alias("taxonomy"),
                concept.alias("concept"),
                F.col("l_extendedprice").alias("value"),
                F.lit("USD").alias("unit"),
                "period_end",
                F.date_add("period_end", (F.col("l_orderkey") % 120).cast("int")).alias("filed"),
                F.when(F.quarter("period_end") == 4, "10-K").otherwise("10-Q").alias("form"),
            )
        )

    @cached_property
    def filings(self) -> DataFrame:
        """One filing per company and order; undated while the order is pending."""
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey").distinct()
        o = self.raw("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
        day = F.col("o_orderdate").cast("date")
        filed = F.date_add(day, (F.col("o_orderkey") % 120).cast("int"))
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.concat(key10("l_suppkey"), F.lit("-"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("accession_number"),
            key10("l_suppkey").alias("cik"),
            F.when(F.quarter(day) == 4, "10-K").otherwise("10-Q").alias("form_type"),
            F.when(F.col("o_orderstatus") != "P", filed).alias("filing_date"),
            day.alias("period_of_report"),
        )

    @cached_property
    def prices(self) -> DataFrame:
        """Daily rows: one order is one trading day of its customer."""
        volume = self.raw("lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("volume"))
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
        return o.join(volume, o.o_orderkey == volume.l_orderkey, "left").select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderkey").alias("seq"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * 0.5).alias("open"),
            F.col("o_totalprice").alias("close"),
            F.coalesce(F.col("volume"), F.lit(0)).alias("volume"),
        )

    @cached_property
    def price_owners(self) -> DataFrame:
        """Companies behind the price series, as a listing file would name them."""
        c = self.raw("customer")
        return c.select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"),
            F.col("c_name").alias("name"),
            pick(SECTORS, F.col("c_nationkey")).alias("sector"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        """A scored company per customer: input of the reporting and monitoring jobs."""
        c, n = self.raw("customer"), self.raw("nation")
        final = F.round(clamp((F.col("c_acctbal") + 1000) / 110.0, 0, 100), 2)
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            key10("c_custkey").alias("cik"),
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("industry_group"),
            F.col("n_name").alias("state_of_incorporation"),
            (F.col("c_custkey") * 7 % 1000 / 10.0).alias("ml_risk_score"),
            (F.col("c_custkey") * 13 % 1400 / 10.0).alias("benford_risk_score"),
            (F.col("c_custkey") * 17 % 300 / 10.0).alias("network_risk_score"),
            final.alias("final_risk_score"),
            tier(final, "card").alias("final_risk_tier"),
            (final >= 65).alias("is_anomaly"),
            (F.col("c_custkey") % 41).alias("community_id"),
            (F.col("c_nationkey") % 4).alias("late_filings_count"),
        )

    @cached_property
    def audit(self) -> DataFrame:
        """Audit records from the event log."""
        score = F.least(F.col("value"), F.lit(100.0))
        kind = (
            F.when(F.col("event_type").isin("click", "view"), "risk_score_generated")
            .when(F.col("event_type") == "purchase", "human_review")
            .when(F.col("event_type") == "signup", "model_retrained")
            .otherwise("pipeline_error")
        )
        return self.raw("events").select(
            F.concat(F.lit("EV-"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("audit_id"),
            kind.alias("event_type"),
            key10("user_id").alias("cik"),
            F.col("ts").cast("timestamp").alias("generated_at"),
            F.get_json_object("props", "$.k").cast("double").alias("ml_risk_score"),
            score.alias("final_risk_score"),
            tier(score, "card").alias("final_risk_tier"),
            (score >= 65).alias("is_anomaly"),
            (F.col("event_type") == "purchase").alias("human_reviewed"),
            F.when(F.col("event_type") == "purchase", F.when(score > 70, "escalated").otherwise("approved")).alias("review_action"),
        )

    @cached_property
    def decisions(self) -> DataFrame:
        """A decision value per company, negative for the unusual ones."""
        s = self.raw("supplier")
        return s.select(
            key10("s_suppkey").alias("cik"),
            F.round(0.2 - F.col("s_acctbal") / 45000.0, 4).alias("decision"),
            (F.col("s_suppkey") % 5 * 20.0).alias("pre_ml_risk_score"),
        )

    @cached_property
    def auditors(self) -> DataFrame:
        """Auditor of each company."""
        s, n = self.raw("supplier"), self.raw("nation")
        return s.join(n, s.s_nationkey == n.n_nationkey).select(
            key10("s_suppkey").alias("cik"),
            F.concat(F.lit("AUD_"), F.col("n_nationkey").cast("string")).alias("auditor_id"),
            F.concat(F.col("n_name"), F.lit(" Audit")).alias("auditor"),
            F.when(F.col("s_acctbal") < 0, "Qualified").otherwise("Unqualified").alias("audit_opinion"),
            F.round(F.abs(F.col("s_acctbal")) / 1000.0, 1).alias("audit_fee_millions"),
        )

    @cached_property
    def relationships(self) -> DataFrame:
        """Corporate ties.

        Lines of one part shipped on one day form a lot; the lot's first supplier is tied to the
        others (a star, so ties grow with rows). Returned full-size lines at the top discount tie
        a supplier to the customer, who is no listed company.
        """
        li = self.raw("lineitem").select(
            "l_partkey", "l_shipdate", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag"
        )
        # lines are moved once, to their lot; a join with the leads would move them twice
        first = F.min(F.struct("l_orderkey", "l_linenumber", "l_suppkey")).over(Window.partitionBy("l_partkey", "l_shipdate"))
        kinds = ["SUBSIDIARY", "PARTNERS_WITH", "CUSTOMER_OF", "JOINT_VENTURE_WITH"]
        ties = (
            li.where("l_partkey is not null and l_shipdate is not null").withColumn("lead", first["l_suppkey"])
            .where(F.col("lead") != F.col("l_suppkey"))
            .select(
                key10("lead").alias("parent_cik"),
                key10("l_suppkey").alias("subsidiary_cik"),
                F.concat(F.lit("Supplier#"), F.lpad(F.col("lead").cast("string"), 9, "0")).alias("parent_name"),
                F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("subsidiary_name"),
                pick(kinds, F.col("l_partkey")).alias("relationship_type"),
                F.col("l_quantity").alias("ownership_pct"),
            )
        )
        big = li.where("l_quantity = 50 and l_discount >= 0.095 and l_returnflag = 'R'")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        sales = big.join(o, big.l_orderkey == o.o_orderkey).select(
            key10("l_suppkey").alias("parent_cik"),
            F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("subsidiary_cik"),
            F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("parent_name"),
            F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("subsidiary_name"),
            F.lit("SUPPLIES").alias("relationship_type"),
            F.lit(None).cast("double").alias("ownership_pct"),
        )
        return ties.unionByName(sales).groupBy(
            "parent_cik", "subsidiary_cik", "parent_name", "subsidiary_name", "relationship_type"
        ).agg(F.max("ownership_pct").alias("ownership_pct"))

    @cached_property
    def filing_texts(self) -> DataFrame:
        """A filing per document: headings and risk wording around the whole text."""
        said = pick([p for ps in K.RISK_PHRASES.values() for p in ps] + K.POSITIVE_PHRASES, F.col("doc_id"))
        body = F.concat(
            F.lit("ITEM 1. Business\n"), F.col("text"),
            F.lit("\nITEM 1A. Risk Factors\nWe report "), said, F.lit(" and "), said, F.lit(".\n"), F.col("text"),
            F.lit("\nITEM 7. Management's Discussion\n\n"), F.col("text"),
            F.lit("\nITEM 8. Financial Statements ____ ---- \n"), F.col("text"),
        )
        return self.raw("documents").select(
            "doc_id",
            key10("doc_id").alias("cik"),
            F.col("source").alias("ticker"),
            F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias("period_of_report"),
            F.col("lang"),
            F.when(F.col("lang") != "de", body).otherwise(F.col("text")).alias("text"),
        )
