"""Attributions as ranked rows, and their narrative."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions.exprs import lookup


def friendly(name: Column) -> Column:
    return F.coalesce(lookup(K.FEATURE_LABELS, name), F.regexp_replace(name, "_", " "))


def ranked_rows(wide: DataFrame, columns: Sequence[str], key: str = "cik") -> DataFrame:
    """One row per company and feature, ranked by size.

    `wide` holds arrays `effect` and `value` in column order. A company's features sit in one row,
    so they are ranked inside it and no shuffle is needed.
    """
    names = F.array(*[F.lit(c) for c in columns])
    cells = F.transform(
        F.arrays_zip(names.alias("f"), F.col("effect"), F.col("value")),
        lambda c: F.struct((-F.abs(c["effect"])).alias("_o"), c["f"].alias("feature_name"), c["effect"].alias("e"), c["value"].alias("v")),
    )
    rows = wide.select(key, F.posexplode(F.array_sort(cells)).alias("_p", "c"))
    return rows.select(
        key, "c.feature_name", friendly(F.col("c.feature_name")).alias("friendly_name"),
        F.round("c.e", 6).alias("shap_value"), F.round("c.v", 4).alias("feature_value"), F.round(F.abs("c.e"), 6).alias("abs_shap_value"),
        F.when(F.col("c.e") > 0, "increases").otherwise("decreases").alias("direction"),
        (F.col("_p") + 1).cast("int").alias("rank_in_company"),
    )


def narratives(values: DataFrame, scores: DataFrame) -> DataFrame:
    """Three strongest drivers, two strongest mitigations and the advice, as text per scored company.

    Companies without effects get a text that says so. A company has as many rows as the model has features, so the gathered lists are short.
    """
    def listed(sign: str, n: int) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col("direction") == sign, F.struct("rank_in_company", "friendly_name"))))
        text = F.array_join(F.transform(F.slice(rows, 1, n), lambda c: c["friendly_name"]), "; ")
        return F.when(F.size(rows) > 0, text).otherwise("none identified")

    told = values.where("abs_shap_value > 0").groupBy("cik").agg(listed("increases", 3).alias("drivers"), listed("decreases", 2).alias("easing"))
    advice = F.when(F.col("ml_risk_score") > 70, "Recommend escalation for detailed analyst review.").otherwise("Monitor for deterioration next quarter.")
    text = F.format_string(
        "%s scores %.0f/100 on the ML risk model. Primary risk drivers: %s. Mitigating factors: %s. %s",
        "company_name", F.round("ml_risk_score", 0), "drivers", "easing", advice,
    )
    everyone = scores.select("cik", "company_name", "ml_risk_score").join(told, "cik", "left")
    return everyone.select("cik", F.when(F.col("drivers").isNull(), K.NO_EXPLANATION).otherwise(text).alias("narrative"))
