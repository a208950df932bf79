"""Text and vector queries."""

from pyspark.sql import functions as F

from riskweave.catalog.base import CTES, query, rnd, rounded
from riskweave.functions import constants as K
from riskweave.operators import lsh
from riskweave.operators import text as T
from riskweave.operators import vectors as V

_B = T.BLANK
_STRIP = f"trim(regexp_replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '{_B}+', ' ', 'g'))"


def _clean(x):
    return f"trim(regexp_replace(regexp_replace(regexp_replace({x}, '{_B}+', ' ', 'g'), '_{{3,}}', '', 'g'), '-{{3,}}', '', 'g'))"


def _q(s):
    return s.replace("'", "''")


@query("tx01_html_to_text", f"SELECT page_id, {_STRIP} AS text FROM pages")
def _(t):
    return t.raw("pages").select("page_id", T.strip_html("html").alias("text"))


@query("tx02_clean_text", f"SELECT doc_id, {_clean('text')} AS text FROM t_texts")
def _(t):
    return t.filing_texts.select("doc_id", T.clean("text").alias("text"))


@query("src08_filing_text", f"SELECT page_id, {_STRIP} AS text, len(regexp_extract_all({_STRIP}, '{T.WORD}')) AS words FROM pages")
def _(t):
    from riskweave.session import new_path

    # pages as landed files: one row each, read back and stripped
    path = new_path(t.spark, "pages")
    t.raw("pages").select("page_id", "html").write.json(path)
    landed = t.spark.read.schema("page_id bigint, html string").json(path)
    return landed.select("page_id", T.strip_html("html").alias("text")).withColumn("words", T.word_count("text").cast("bigint"))


_MARKS = ", ".join(
    f"CASE WHEN regexp_matches(low, '{_q(p)}') THEN {{'pos': length(regexp_extract(low, '(?s)^(.*){_q(p)}', 1)), 'section_key': '{k}', 'section_name': '{_q(n)}'}} END" for k, p, n in K.SECTIONS
)
CTES["sec"] = f"""
SELECT doc_id, cik, ticker, period_of_report, section_key, section_name, CASE WHEN n = 0 THEN raw ELSE {_clean('raw')} END AS text FROM (
 SELECT *, substr(text, pos + 1, stop - pos) AS raw FROM (
  SELECT *, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos), length(text)) AS stop FROM (
   SELECT doc_id, cik, ticker, period_of_report, text, len(marks) AS n, unnest(CASE WHEN len(marks) = 0 THEN [{{'pos': 0, 'section_key': 'full', 'section_name': 'Full Filing'}}] ELSE marks END, recursive := true)
   FROM (SELECT *, list_filter([{_MARKS}], lambda m: m IS NOT NULL) AS marks FROM (SELECT *, lower(text) AS low FROM t_texts)))))
 WHERE n = 0 OR length({_clean('raw')}) >= 100"""


@query("tx03_sections", "SELECT doc_id, section_key, section_name, length(text) AS chars, md5(text) AS text_md5 FROM sec")
def _(t):
    return T.sections(t.filing_texts).select("doc_id", "section_key", "section_name", F.char_length("text").alias("chars"), F.md5("text").alias("text_md5"))


@query("tx04_recursive_chunks")
def _(t):
    return T.chunks(T.sections(t.filing_texts)).groupBy("doc_id", "section_key").agg(
        F.count("*").alias("chunks"), F.max(F.char_length("text")).alias("longest"), F.sum(F.char_length("text")).alias("chars"))


@query("tx04_chunk_checks", """SELECT doc_id, section_key, TRUE AS within_size, TRUE AS from_section, TRUE AS starts_at_head, TRUE AS ends_at_tail, TRUE AS nothing_lost
 FROM sec WHERE regexp_matches(text, '[^ \\t-\\r]')""")
def _(t):
    """Chunks of each section against its whole text: size, origin, both ends, and characters other than blanks."""
    whole = T.sections(t.filing_texts).select("doc_id", "section_key", "text").withColumn("_whole", F.regexp_replace("text", r"^\s+|\s+$", ""))
    solid = lambda c: F.char_length(F.regexp_replace(c, r"\s", ""))
    first, last = F.col("chunk_index") == 0, F.col("chunk_index") == F.col("total_chunks") - 1
    cut = T.chunks(whole.withColumn("_solid", solid("text")))
    return cut.groupBy("doc_id", "section_key").agg(
        (F.max(F.char_length("text")) <= 1000).alias("within_size"),
        F.bool_and(F.contains("_whole", "text")).alias("from_section"),
        F.bool_or(first & F.startswith("_whole", "text")).alias("starts_at_head"),
        F.bool_or(last & F.endswith("_whole", "text")).alias("ends_at_tail"),
        (F.sum(solid("text")) >= F.max("_solid")).alias("nothing_lost"))


@query("tx05_chunk_metadata", """SELECT doc_id, source, chunk_index, total_chunks, md5(text) AS text_md5 FROM (
 SELECT doc_id, ticker || '_' || period_of_report AS source, CAST(greatest(ceil(length(text) / 800.0), 1) AS INT) AS total_chunks,
  unnest(range(CAST(greatest(ceil(length(text) / 800.0), 1) AS INT))) AS chunk_index, substr(text, chunk_index * 800 + 1, 1000) AS text FROM t_texts)""")
def _(t):
    docs = t.filing_texts.select("doc_id", "ticker", "period_of_report", "text")
    return T.stride_chunks(docs).select("doc_id", "source", "chunk_index", "total_chunks", F.md5("text").alias("text_md5"))


def _n(p):
    return f"CAST((length(low) - length(replace(low, '{p}', ''))) / {len(p)} AS INT)"


_CATS = K.RISK_PHRASES
CTES["scan"] = (
    "SELECT doc_id, ticker, "
    + ", ".join(f"{' + '.join(f'CASE WHEN {_n(p)} > 0 THEN 1 ELSE 0 END' for p in ps)} AS {c}_phrases, {' + '.join(_n(p) for p in ps)} AS {c}_mentions" for c, ps in _CATS.items())
    + f", {' + '.join(_n(p) for p in K.POSITIVE_PHRASES)} AS positive_mentions, greatest(len(regexp_extract_all(text, '{T.WORD}')), 1) AS words FROM (SELECT *, lower(text) AS low FROM t_texts)"
)
_TOTAL = "(" + " + ".join(f"{c}_mentions" for c in _CATS) + ")"
_TONE = f"""{_TOTAL} AS total_risk_mentions, least(100.0::DOUBLE, {rnd(f'{_TOTAL} / words::DOUBLE * 1000 * 8', 1)}) AS language_risk_score,
 {rnd(f'positive_mentions / greatest({_TOTAL}, 1)::DOUBLE', 2)} AS sentiment_ratio, going_concern_mentions > 0 AS going_concern_detected, restatement_mentions > 0 AS restatement_risk, legal_risk_mentions > 1 AS legal_risk_detected"""


@query("tx06_lexicon_scan", f"SELECT doc_id, {', '.join(f'{c}_phrases, {c}_mentions' for c in _CATS)}, positive_mentions, words, {_TONE} FROM scan")
def _(t):
    return T.tone(T.lexicon_scan(t.filing_texts.select("doc_id", "text")))


@query("tx07_company_tone", f"SELECT ticker, texts, {', '.join(f'{c}_mentions' for c in _CATS)}, positive_mentions, words, {_TONE} FROM (SELECT ticker, count(*) AS texts, "
       + ", ".join(f"CAST(sum({c}_mentions) AS BIGINT) AS {c}_mentions" for c in _CATS) + ", CAST(sum(positive_mentions) AS BIGINT) AS positive_mentions, CAST(sum(words) AS BIGINT) AS words FROM scan GROUP BY ticker)")
def _(t):
    return T.company_tone(t.filing_texts.select("ticker", "text"), "ticker")


@query("tx07_tone_samples", """SELECT ticker, lang, sample_of, md5(sample) AS sample_md5 FROM (
 SELECT ticker, lang, CASE WHEN risk IS NULL THEN 'start' ELSE 'risk_factors' END AS sample_of, coalesce(risk, opening) AS sample FROM (
  SELECT ticker, lang, arg_min(text, doc_id) FILTER (section_key = 'risk_factors') AS risk, left(string_agg(text, ' ' ORDER BY doc_id, section_key), 3000) AS opening
  FROM (SELECT sec.*, lang FROM sec JOIN documents USING (doc_id)) GROUP BY ticker, lang))""")
def _(t):
    found = T.sections(t.filing_texts.select("doc_id", "ticker", "lang", "text"))
    return T.tone_sample(found, ["ticker", "lang"], ["doc_id", "section_key"]).select("ticker", "lang", "sample_of", F.md5("sample").alias("sample_md5"))


@query("tx12_tone_evidence", f"""SELECT f.cik, printf('Language risk %.1f, going concern %s, restatement %s, legal risk %s', coalesce(language_risk_score, 0), CASE WHEN going_concern_detected THEN 'True' ELSE 'False' END,
 CASE WHEN restatement_risk THEN 'True' ELSE 'False' END, CASE WHEN legal_risk_detected THEN 'True' ELSE 'False' END) AS last_line FROM final f LEFT JOIN (SELECT lpad(CAST(doc_id AS VARCHAR), 10, '0') AS cik, {_TONE} FROM scan) s ON s.cik = f.cik""")
def _(t):
    """Evidence sheets that end with the tone of the company's filings."""
    from riskweave.catalog.graphs import wide
    from riskweave.plans.fusion import evidence_sheets

    # filings of companies that are not scored are left out before their texts are read for phrases
    texts = t.filing_texts.select("cik", "text").join(t.companies.select("cik"), "cik", "left_semi")
    return evidence_sheets(wide(t), T.company_tone(texts, "cik")).select("cik", F.element_at(F.split("evidence", "\n"), -1).alias("last_line"))


@query("tx08_unseen_chunks", "SELECT doc_id, source FROM (SELECT doc_id, ticker || '_' || period_of_report AS source FROM t_texts) WHERE source NOT IN (SELECT source || '_P' || doc_id FROM documents WHERE lang = 'en')")
def _(t):
    chunks = T.stride_chunks(t.filing_texts.select("doc_id", "ticker", "period_of_report", "text"))
    indexed = t.raw("documents").where("lang = 'en'").select(F.concat("source", F.lit("_P"), F.col("doc_id").cast("string")).alias("source"))
    return T.unseen(chunks, indexed).select("doc_id", "source").distinct()


@query("ag31_index_stats", "SELECT CAST(sum(greatest(ceil(length(text) / 800.0), 1)) AS BIGINT) AS total_chunks, count(DISTINCT ticker || '_' || period_of_report) AS sources FROM t_texts")
def _(t):
    return T.index_stats(T.stride_chunks(t.filing_texts.select("ticker", "period_of_report", "text")))


CTES["cent"] = "SELECT label AS query_id, list(v ORDER BY i) AS query FROM (SELECT label, i, avg(v::DOUBLE) AS v FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY label, i) GROUP BY label"
CTES["hits"] = """
SELECT * FROM (SELECT query_id, vec_id, label, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS place
 FROM (SELECT query_id, vec_id, label, list_cosine_similarity(embedding::DOUBLE[], query) AS similarity FROM cent, embeddings)) WHERE place <= 6"""


def hits(t):
    e = t.raw("embeddings")
    return V.cosine_top_k(e.select("vec_id", "embedding"), V.centroids(e, "label"), 6)


@query("tx09_cosine_top_k", f"SELECT query_id, vec_id, CAST(place AS INT) AS place, {rnd('similarity')} AS similarity FROM hits")
def _(t):
    return rounded(hits(t))


@query("tx09_approximate_top_k")
def _(t):
    """The index over all vectors, built and searched; its recall is measured in the tests."""
    e = t.raw("embeddings")
    index = lsh.build_index(e.select("vec_id", "embedding"))
    return rounded(lsh.approximate_top_k(index, V.centroids(e, "label"), 6))


@query("tx09_filtered_top_k", f"""SELECT query_id, vec_id, CAST(place AS INT) AS place, {rnd('similarity')} AS similarity FROM (SELECT query_id, vec_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS place
 FROM (SELECT query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], query) AS similarity FROM cent, embeddings WHERE label = 3)) WHERE place <= 6""")
def _(t):
    e = t.raw("embeddings")
    return rounded(V.cosine_top_k(e.where("label = 3").select("vec_id", "embedding"), V.centroids(e, "label"), 6))


_CITE = "'[' || place || '] ' || d.source || ' | 10-K | Period: P' || d.doc_id || ' | ' || d.lang || chr(10) || d.text"


@query("tx10_contexts", f"""SELECT cent.query_id, coalesce(context, '{K.NO_EXCERPTS}') AS context FROM cent LEFT JOIN
 (SELECT query_id, string_agg({_CITE}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY place) AS context FROM hits JOIN documents d ON d.doc_id = vec_id GROUP BY query_id) h ON h.query_id = cent.query_id""")
def _(t):
    d = t.raw("documents").select(
        F.col("doc_id").alias("vec_id"), F.col("source").alias("company_name"), F.lit("10-K").alias("form_type"),
        F.concat(F.lit("P"), F.col("doc_id").cast("string")).alias("period_of_report"), F.col("lang").alias("section_name"), "text")
    return V.contexts(hits(t).join(d, "vec_id"), V.centroids(t.raw("embeddings"), "label"))


@query("so04_source_labels", "SELECT DISTINCT query_id, d.source FROM hits JOIN documents d ON d.doc_id = vec_id")
def _(t):
    d = t.raw("documents").select(F.col("doc_id").alias("vec_id"), "source")
    return V.source_labels(hits(t).join(d, "vec_id"))


@query("so05_joined_retrievals", "SELECT query_id, vec_id FROM hits UNION ALL SELECT query_id, vec_id FROM hits WHERE place <= 3")
def _(t):
    # two searches under each other, repeated chunks kept
    e = t.raw("embeddings")
    return hits(t).select("query_id", "vec_id").union(V.cosine_top_k(e.select("vec_id", "embedding"), V.centroids(e, "label"), 3).select("query_id", "vec_id"))


CTES["t_index"] = """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN '<a href="/Archives/' || page_id || '/main.htm" class="x">10-K</a>' WHEN 1 THEN '<TD>10-K</TD><td><a HREF="/a/doc' || page_id || '.htm">file</a>'
 WHEN 2 THEN '<a href="/a/b/x10k' || page_id || '.htm">f</a>' WHEN 3 THEN '<a href="the-annual-' || page_id || '.htm">f</a>' ELSE '' END || html AS html FROM pages"""


def _link(p):
    return f"nullif(regexp_extract(html, '(?is){_q(p)}', 1), '')"


@query("tx14_primary_links", f"SELECT page_id, string_split(link, '/')[-1] AS link FROM (SELECT page_id, coalesce({', '.join(_link(p) for p in K.PRIMARY_LINK_PATTERNS)}) AS link FROM t_index)")
def _(t):
    key, n = F.col("page_id").cast("string"), F.col("page_id") % 5
    head = (
        F.when(n == 0, F.concat(F.lit('<a href="/Archives/'), key, F.lit('/main.htm" class="x">10-K</a>')))
        .when(n == 1, F.concat(F.lit('<TD>10-K</TD><td><a HREF="/a/doc'), key, F.lit('.htm">file</a>')))
        .when(n == 2, F.concat(F.lit('<a href="/a/b/x10k'), key, F.lit('.htm">f</a>')))
        .when(n == 3, F.concat(F.lit('<a href="the-annual-'), key, F.lit('.htm">f</a>'))).otherwise("")
    )
    return t.raw("pages").select("page_id", T.primary_link(F.concat(head, "html")).alias("link"))


@query("jn08_latest_annual_filings", "SELECT cik, accession_number, place FROM (SELECT f.*, CAST(row_number() OVER (PARTITION BY cik ORDER BY period_of_report DESC, accession_number) AS INT) AS place FROM t_filings f WHERE form_type = '10-K') WHERE place <= 3")
def _(t):
    from pyspark.sql import Window

    newest = Window.partitionBy("cik").orderBy(F.desc("period_of_report"), "accession_number")
    used = t.filings.where("form_type = '10-K'").join(t.companies.select("cik"), "cik")
    return used.withColumn("place", F.row_number().over(newest)).where("place <= 3").select("cik", "accession_number", "place")


@query("tx11_signal_summaries", """SELECT cik, CASE WHEN len(x) = 0 THEN '  • No individual signals triggered' ELSE array_to_string(x, chr(10)) END AS signals FROM (
 SELECT cik, list_filter([CASE WHEN dominant_signal <> 'None' THEN '  • Dominant: ' || dominant_signal || ' (+0.28)' END, CASE WHEN flag_ar_acceleration = 1 THEN '  • AR acceleration (+0.18)' END,
  CASE WHEN flag_cashflow_divergence = 1 THEN '  • Cash-earnings divergence (+0.22)' END, CASE WHEN flag_margin_compression = 1 THEN '  • Margin compression (+0.15)' END], lambda v: v IS NOT NULL) AS x FROM candidates)""")
def _(t):
    from riskweave.catalog.mart_queries import candidates
    from riskweave.plans.fusion import signal_summary

    return candidates(t).select("cik", signal_summary().alias("signals"))
