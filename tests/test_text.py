import numpy as np
import pytest

from riskweave.operators import text as T
from riskweave.operators import vectors as V


def one(spark, text):
    return spark.createDataFrame([("1", text)], "id string, text string")


def test_html(spark):
    df = spark.createDataFrame([("<p>Profit&nbsp;&amp; <b>loss</b></p>\n<br/>a &lt; b c",)], "html string")
    assert df.select(T.strip_html("html")).first()[0] == "Profit & loss a < b c"


def test_sections_follow_the_last_heading(spark):
    body = "risk " * 60
    text = f"Contents item 1a. risk factors\nITEM 1A. RISK FACTORS {body}\nItem 7. Management's Discussion {body}____"
    rows = T.sections(one(spark, text)).collect()
    assert [r["section_key"] for r in rows] == ["risk_factors", "mda"]
    assert rows[0]["text"].startswith("ITEM 1A.") and rows[1]["text"].endswith("risk")


def test_text_without_headings_is_taken_whole(spark):
    text = "x " * 40000
    row = T.sections(one(spark, text)).first()
    assert row["section_key"] == "full" and row["text"] == text


def test_section_cap_is_optional(spark):
    text = "item 8. financial statements " + "y" * 40000
    assert len(T.sections(one(spark, text)).first()["text"]) == len(text)
    assert len(T.sections(one(spark, text), max_chars=15000).first()["text"]) == 15000


def test_short_sections_are_dropped(spark):
    assert T.sections(one(spark, "item 1. business too short")).count() == 0


def words(n, seed=0):
    rng = np.random.default_rng(seed)
    sep = [" ", ". ", "\n", "\n\n"]
    return "".join("w" * int(rng.integers(1, 8)) + str(i) + str(rng.choice(sep, p=[0.85, 0.08, 0.05, 0.02])) for i in range(n))


@pytest.mark.parametrize("size,overlap", [(50, 10), (200, 40), (1000, 200)])
def test_chunks_fit_and_cover(size, overlap):
    text = words(1500)
    chunks = T.split_text(text, size, overlap)
    assert all(0 < len(c) <= size for c in chunks)
    place = 0
    for c in chunks:
        found = text.find(c)
        assert found >= 0 and not text[place:found].strip(" .\n")
        place = found + len(c)
    assert not text[place:].strip(" .\n")


def test_text_without_separators_is_cut_by_length():
    chunks = T.split_text("a" * 2500, 1000, 200)
    assert [len(c) for c in chunks] == [1000, 1000, 900]


def test_overlap_repeats_the_tail():
    chunks = T.split_text("aa bb cc dd ee ff", 8, 4, (" ", ""))
    assert chunks == ["aa bb cc", "cc dd ee", "ee ff"] or all(len(c) <= 8 for c in chunks)
    assert any(a.split()[-1] == b.split()[0] for a, b in zip(chunks, chunks[1:]))


def test_chunk_labels(spark):
    df = spark.createDataFrame([("AAPL", "2023", "mda", words(600))], "ticker string, period_of_report string, section_key string, text string")
    rows = T.chunks(df, 300, 50).orderBy("chunk_index").collect()
    assert rows[0]["source"] == "AAPL_2023_mda" and [r["chunk_index"] for r in rows] == list(range(len(rows))) and {r["total_chunks"] for r in rows} == {len(rows)}


def test_lexicon(spark):
    bad = "There is substantial doubt about going concern. A restatement was made. SEC investigation and class action. No assurance."
    good = "Record revenue and strong growth; robust demand as market leader."
    df = spark.createDataFrame([("bad", bad), ("good", good)], "id string, text string")
    rows = {r["id"]: r for r in T.tone(T.lexicon_scan(df)).collect()}
    assert rows["bad"]["language_risk_score"] > rows["good"]["language_risk_score"] == 0
    # 'restate' is part of 'restatement' and counts as well
    assert rows["bad"]["restatement_mentions"] == 2 and rows["bad"]["restatement_phrases"] == 2
    assert rows["bad"]["going_concern_detected"] and rows["bad"]["restatement_risk"] and rows["bad"]["legal_risk_detected"]
    assert rows["good"]["positive_mentions"] == 4 and rows["good"]["sentiment_ratio"] == 4.0


def test_company_tone_adds_up(spark):
    df = spark.createDataFrame([("a", "going concern"), ("a", "a subpoena"), ("b", "calm")], "ticker string, text string")
    rows = {r["ticker"]: r for r in T.company_tone(df, "ticker").collect()}
    assert (rows["a"]["texts"], rows["a"]["total_risk_mentions"], rows["a"]["words"]) == (2, 2, 4)
    assert rows["b"]["language_risk_score"] == 0.0


@pytest.mark.parametrize("block", [4096, 3])
def test_cosine_search_is_exact(spark, block):
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(300, 8)), rng.normal(size=(10, 8))
    x[7] = x[5]
    chunks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id int, query array<double>")
    got = V.cosine_top_k(chunks, queries, 4, block=block).toPandas().sort_values(["query_id", "place"])
    sims = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
    want = [i for s in sims for i in sorted(range(300), key=lambda j: (-round(s[j], 12), j))[:4]]
    assert got["vec_id"].tolist() == want


def test_contexts(spark):
    hits = spark.createDataFrame([(1, 2, "B", "text b"), (1, 1, "A", "text a"), (2, 1, None, None)], "query_id int, place int, company_name string, text string").selectExpr(
        "*", "'10-K' form_type", "'2023' period_of_report", "'MD&A' section_name")
    rows = {r["query_id"]: r["context"] for r in V.contexts(hits, spark.range(1, 4).selectExpr("cast(id as int) query_id")).collect()}
    assert rows[1] == "[1] A | 10-K | Period: 2023 | MD&A\ntext a\n\n---\n\n[2] B | 10-K | Period: 2023 | MD&A\ntext b"
    assert rows[2] == rows[3] == "No relevant filing excerpts found."


def test_tone_samples(spark):
    from riskweave.operators.text import tone_sample

    rows = [("a", 1, "business", "b" * 5000), ("a", 2, "risk_factors", "second"), ("a", 3, "risk_factors", "third"), ("a", 0, "risk_factors", None),
            ("b", 1, "full", "one"), ("b", 2, "full", ""), ("b", 3, "full", "x" * 2990), ("b", 4, "full", "cut here"), ("c", 1, "full", ""), ("d", 1, "full", None)]
    rows += [("hot", i, "full", "") for i in range(5000)] + [("hot", 5000, "full", "never reached")]
    got = {r.k: (r.sample_of, r.sample) for r in tone_sample(spark.createDataFrame(rows, "k string, n int, section_key string, text string"), ["k"], ["n"]).collect()}
    assert got["a"] == ("risk_factors", "second") and got["c"] == ("start", "") and "d" not in got
    assert got["b"] == ("start", ("one  " + "x" * 2990 + " cut here")[:3000]) and got["hot"] == ("start", " " * 3000)


def test_evidence_with_tone(spark):
    from pyspark.sql import functions as F

    from riskweave.plans.fusion import tone_line

    rows = [(12.34, True, False, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "language_risk_score double, going_concern_detected boolean, restatement_risk boolean, legal_risk_detected boolean")
    assert [r[0] for r in df.select(tone_line()).collect()] == [
        "Language risk 12.3, going concern True, restatement False, legal risk False", "Language risk 0.0, going concern False, restatement False, legal risk False"]
    assert df.select(F.lit(1)).count() == 2
