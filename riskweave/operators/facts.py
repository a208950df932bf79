"""Reported facts -> one row of metrics per company, period end and form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import strict_key


def concept_table(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("concept"), F.lit(m).alias("metric"), F.lit(i).alias("priority")) for i, (c, m) in enumerate(K.CONCEPT_METRICS)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def canonical_facts(facts: DataFrame) -> DataFrame:
    """Dollar facts of known concepts, with the metric they feed."""
    # the concept table is fixed and tiny
    known = F.broadcast(concept_table(facts.sparkSession))
    return facts.where(F.col("unit") == "USD").join(known, "concept")


def period_metrics(facts: DataFrame) -> DataFrame:
    """Per metric the value filed last; ties go to the concept of higher priority."""
    known = canonical_facts(facts).withColumn("_place", F.array_position(F.array(*[F.lit(m) for m in K.METRICS]), F.col("metric")))
    # a date is moved as one; nulls come first in a struct, as the empty text did
    dated = known.schema["filed"].dataType.typeName() == "date"
    newest = F.struct(
        F.col("filed") if dated else F.coalesce(F.col("filed").cast("string"), F.lit("")).alias("filed"),
        (-F.col("priority")).alias("priority"),
        F.coalesce("accession_number", F.lit("")).alias("accession"),
        F.col("value"),
    )
    # one ordered buffer per metric row, which holds the value and a number for the metric; the pivot then only moves doubles
    last = known.groupBy("cik", "period_end", "form", "_place").agg(F.max(newest).alias("_last"))
    aggs = [F.max(F.when(F.col("_place") == i, F.col("_last.value"))).alias(m) for i, m in enumerate(K.METRICS, 1)]
    return last.groupBy("cik", "period_end", "form").agg(*aggs).select(
        strict_key("cik", "period_end", "form").alias("id"), "cik", "period_end", "form", *K.METRICS
    )


def with_yoy_growth(metrics: DataFrame) -> DataFrame:
    """Annual revenue against the same month and day one year before.

    With yyyymmdd as an integer the prior year's day is exactly 10000 less, so a range
    frame of that one offset finds it in the pass that later windows reuse.
    """
    annual = F.col("form").isin(*K.ANNUAL_FORMS) & F.col("revenues").isNotNull()
    day = F.year("period_end") * 10000 + F.month("period_end") * 100 + F.dayofmonth("period_end")
    year_ago = Window.partitionBy("cik").orderBy("_day").rangeBetween(-10000, -10000)
    prior = F.max_by(F.when(annual, F.col("revenues")), F.when(annual, F.col("form"))).over(year_ago)
    growth = F.when(
        annual & (F.col("_prior") != 0), (F.col("revenues") - F.col("_prior")) / F.abs("_prior")
    )
    return (
        metrics.withColumn("_day", day)
        .withColumn("_prior", prior)
        .withColumn("revenue_yoy_growth", growth)
        .drop("_day", "_prior")
    )


def yoy_self_join(metrics: DataFrame) -> DataFrame:
    """The same growth as an equi-join on the text of the prior period end."""
    annual = metrics.where(F.col("form").isin(*K.ANNUAL_FORMS) & F.col("revenues").isNotNull())
    end = F.col("period_end").cast("string")
    prior = annual.groupBy("cik", end.alias("prior_end")).agg(F.max_by("revenues", "form").alias("prior_revenues"))
    now = annual.select(
        "cik", "period_end", "form", "revenues",
        F.concat(F.lpad((F.substring(end, 1, 4).cast("int") - 1).cast("string"), 4, "0"), F.substring(end, 5, 6)).alias("prior_end"),
    )
    return (
        now.join(prior.where("prior_revenues <> 0"), ["cik", "prior_end"])
        .withColumn("revenue_yoy_growth", (F.col("revenues") - F.col("prior_revenues")) / F.abs("prior_revenues"))
        .drop("prior_end")
    )
