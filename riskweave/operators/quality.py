"""Data-quality rules; each returns violations or one row per rule."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def negative_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_rules(df: DataFrame, required: Sequence[str], unique: Sequence[Sequence[str]]) -> DataFrame:
    """Rows that break each not-null rule, keys that break each unique rule."""
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required])
    cells = F.array(*[F.struct(F.lit("not_null").alias("rule"), F.lit(c).alias("columns"), F.col(c).alias("violations")) for c in required])
    out = nulls.select(F.inline(cells))
    for keys in unique:
        broken = duplicates(df, keys).agg(F.count(F.lit(1)).alias("violations"))
        out = out.unionByName(broken.select(F.lit("unique").alias("rule"), F.lit(",".join(keys)).alias("columns"), "violations"))
    return out


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    missing = child.join(parent.select(*keys), list(keys), "left_anti")
    return missing.agg(F.lit(name).alias("reference"), F.count(F.lit(1)).alias("orphans"))


def missing_names(expected: Sequence[str], found: DataFrame, column: str) -> DataFrame:
    """Expected names that are not found."""
    wanted = found.sparkSession.createDataFrame([(n,) for n in expected], f"{column} string")
    return wanted.join(found.select(column), column, "left_anti")


def freshness(runs: DataFrame, as_of: datetime, limit_days: int = 7) -> DataFrame:
    """Age of the last completed run: WARN when there is none or it is older than the limit."""
    last = runs.where("status = 'completed'").agg(F.max("started_at").alias("last_run"))
    # whole days passed, not calendar days
    age = F.floor((F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp("last_run")) / 86400)
    return last.select(
        "last_run",
        age.alias("age_days"),
        F.when(F.col("last_run").isNull() | (age > limit_days), "WARN").otherwise("OK").alias("status"),
    )
