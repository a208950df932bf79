import pyarrow as pa
from pyspark.sql import functions as F

from riskweave.operators import text as T
from riskweave.session import spread_by


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sections_are_cleaned_once(spark):
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.concat(F.lit("ITEM 1. Business "), F.repeat(F.lit("a b"), 60)).alias("text"))
    out = T.sections(docs)
    assert plan(out).count("_{3,}") == 1 and out.count() == 3


def test_clean_of_uneven_blanks(spark):
    told = {"a b": "a b", "  a  b ": "a b", "\ta b": "a b", "   ": "", "a \x0b\x85\u2003b\n": "a b", "a\nb": "a b", "a____b --- c": "ab  c"}
    df = spark.createDataFrame([(x,) for x in told], "text string")
    assert {r["text"]: r["c"] for r in df.select("text", T.clean("text").alias("c")).collect()} == told


def test_chunks_of_a_batch_come_in_small_parts(spark):
    texts = [None, ""] + [f"w{i} " * 700 for i in range(3 * T.AT_ONCE)]
    parts = [*T.cut_batches(iter([pa.array(texts, pa.string())]), 1000, 200, T.SEPARATORS)]
    assert max(map(len, parts)) <= T.AT_ONCE
    assert [c for p in parts for c in p.to_pylist()] == [T.split_text(t or "") for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = T.chunks(df).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {i: len(T.split_text(t)) for i, t in enumerate(texts) if t}


def test_samples_work_out_whole_texts_once_more_at_most(spark):
    rows = spark.range(40).select(
        (F.col("id") % 3).alias("ticker"), F.col("id").alias("doc_id"), F.when(F.col("id") % 6 == 1, "risk_factors").otherwise("business").alias("section_key"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    out = T.tone_sample(rows, ["ticker"], ["doc_id", "section_key"])
    assert plan(out).count("Range (") <= 1
    got = {r["ticker"]: (r["sample_of"], r["sample"]) for r in out.collect()}
    assert got[1] == ("risk_factors", "text 1")
    assert got[0] == ("start", " ".join(f"text {i}" for i in range(0, 40, 3)))


def test_rows_are_spread_by_their_number(spark):
    assert spread_by(spark.range(50_000), "id").rdd.getNumPartitions() == 3
    assert spread_by(spark.range(0), "id").rdd.getNumPartitions() == 1
