import datetime as dt
import math

from pyspark.sql import functions as F

from riskweave.catalog.ingest import fact_documents
from riskweave.sources import nested
from riskweave.sources.tables import Tables

LINE = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double"
ORDER = "o_orderkey bigint, o_orderdate timestamp_ntz"
DAY = dt.datetime(1997, 2, 3)


def tables(spark, folder, lines, orders=((1, DAY), (2, None))):
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(orders, ORDER).write.parquet(f"{folder}/orders.parquet")
    return Tables(spark, str(folder))


def test_lines_of_one_small_file_are_dealt_to_several_tasks(spark, tmp_path):
    lines = spark.range(120_000, numPartitions=1).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1.5).alias("l_extendedprice"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(120_000, numPartitions=1).select(F.col("id").alias("o_orderkey"), F.lit(DAY).cast("timestamp_ntz").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    docs = fact_documents(Tables(spark, str(tmp_path)))
    sizes = [r["n"] for r in docs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 120_000 and len(sizes) == 3 and max(sizes) < 60_000


def test_numbers_come_back_as_they_were(spark, tmp_path):
    given = [1.5, -0.0, 1e-7, 12345678.9, 0.1 + 0.2, 1.7976931348623157e308, float("inf"), float("-inf"), float("nan")]
    t = tables(spark, tmp_path, [(1, i, 1, i, v) for i, v in enumerate(given)])
    rows = nested.accepted_facts(fact_documents(t), "1996-01-01").where("unit = 'USD'").orderBy("cik").collect()
    assert [str(r["value"]) for r in rows] == [str(v) for v in given]
    doubled = nested.rejected_facts(fact_documents(t), "1996-01-01").where("form = '8-K'").orderBy("cik").collect()
    assert [str(r["value"]) for r in doubled] == [str(v * 2) for v in given]


def test_null_members_are_left_out(spark, tmp_path):
    t = tables(spark, tmp_path, [(1, 3, 1, 7, 5.0), (1, None, 1, 7, None), (1, 4, 1, None, 6.0), (2, 5, 1, 7, 8.0)])
    docs = fact_documents(t)
    got = {(r["cik"], r["unit"], r["value"], r["form"], r["accession_number"]) for r in nested.accepted_facts(docs, "1996-01-01").collect()}
    seven = "0000000007-000000000001"
    assert got == {
        ("0000000007", "USD", 5.0, "10-Q", seven), ("0000000007", "shares", 3.0, "10-Q/A", seven),
        (None, "USD", 6.0, "10-Q", None), (None, "shares", 4.0, "10-Q/A", None)}
    reasons = {r["reason"]: r["count"] for r in nested.rejected_facts(docs, "1996-01-01").groupBy("reason").count().collect()}
    # the undated order gives four times 'period'; of the other three lines two have a value, and one has neither value nor number
    assert reasons == {"unit": 4, "period": 4, "form": 3, "value": 5}
    assert all(math.isfinite(r["value"]) for r in nested.accepted_facts(docs, "1996-01-01").collect())
