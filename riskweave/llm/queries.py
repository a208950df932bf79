"""Registered queries of the operators, and their SQL twins for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import archives, exact_stream, filter_audit, impact_index, language, mixing, near_duplicates, periodic_runs, private_data, substrings, token_shards, toxicity, winnowing
from riskweave.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every document in the mixture of all sources, weights by the square root of their sizes."""
    return mixing.mix(table(spark, folder, "documents"))


def op2_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a WARC record in ZIP packages, read back from them."""
    return archives.archive_round_trip(table(spark, folder, "pages"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op4_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return private_data.digests(private_data.personal_data(table(spark, folder, "documents")))


def op6_exact_stream(spark: SparkSession, folder: str) -> DataFrame:
    return exact_stream.deduplicate(spark, f"{folder.rstrip('/')}/documents.parquet")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("spans")


def op9_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return token_shards.read_shards(token_shards.write_shards(table(spark, folder, "documents"), TOKENIZER))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents")).drop("spans")


def op11_impact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best other rows of every fiftieth vector."""
    return impact_index.top_k_among(table(spark, folder, "embeddings"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every text, in one of ten after the contract's loops were written into it."""
    found = periodic_runs.periodic_runs(periodic_runs.with_loops(table(spark, folder, "documents")))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters in all orders over every document, by language."""
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_warc_archives,
        op3_near_duplicates,
        op4_repeated_passages,
        op5_personal_data,
        op6_exact_stream,
        op7_toxicity,
        op8_decontamination,
        op9_token_shards,
        op10_language,
        op11_impact_top_k,
        op12_periodic_runs,
        op13_filter_audit,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_warc_archives": """
        WITH p AS (
            SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), k AS (SELECT html, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY html)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN kept IS NULL OR kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN kept <> page_id THEN kept END AS refers_to, p.url AS url
        FROM p LEFT JOIN k ON p.html = k.html AND payload_bytes >= 1000
    """,
    "op3_near_duplicates": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w
        ), n AS (SELECT doc_id, len(s) AS n FROM s
        ), c AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM s) GROUP BY s
        ), t AS (SELECT rep, n, unnest(s) AS t FROM c
        ), l AS (
            SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.t = b.t AND a.rep < b.rep
            AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
        ), r(x, y) AS (SELECT a, b FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a
        ), m AS (SELECT c.rep, c.s, least(c.rep, coalesce(min(r.y), c.rep)) AS component FROM c LEFT JOIN r ON r.x = c.rep GROUP BY c.rep, c.s)
        SELECT s.doc_id, len(s.s) AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE m.component END AS component_id,
            CASE WHEN len(s.s) = 0 THEN true ELSE s.doc_id = m.component END AS kept
        FROM s LEFT JOIN m ON m.s = list_sort(s.s)
    """,
    "op4_repeated_passages": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), p AS (
            SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM w WHERE len(w) >= 20
        ), g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS g FROM p
        ), f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again FROM g
        ), d AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS gone FROM f WHERE again GROUP BY doc_id)
        SELECT w.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
            sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' '), '')) AS kept_sha256
        FROM w LEFT JOIN d ON w.doc_id = d.doc_id
    """,
    "op6_exact_stream": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS same FROM documents
        ), k AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY same ORDER BY n DESC, doc_id) AS keep_id,
                row_number() OVER (PARTITION BY same ORDER BY n DESC, doc_id) AS place, count(*) OVER (PARTITION BY same) AS group_size FROM t
        ) SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(same) AS text_sha256 FROM k
    """,
    "op8_decontamination": rf"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), bw AS (
            SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 8, 2)), lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM b WHERE len(w) > 0
        ), lengths AS (SELECT DISTINCT n FROM bw
        ), dw AS (
            SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM w, lengths WHERE len(w) >= n
        ), dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM dw
        ), hit AS (SELECT doc_id, dg.n AS n, i, item FROM dg JOIN bw ON dg.g = bw.g AND dg.n = bw.n
        ), per AS (
            SELECT doc_id, len(list_distinct(flatten(list(range(i, i + n))))) AS n_hit, count(DISTINCT item) AS n_items,
                sha256(array_to_string(list_sort(list_distinct(list(item))), ',')) AS items_sha256 FROM hit GROUP BY doc_id
        )
        SELECT w.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM w LEFT JOIN per ON w.doc_id = per.doc_id
    """,
    "op11_impact_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) <= 5
    """,
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
        ), w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t
        ), m AS (SELECT t, min(doc_id) AS first FROM t GROUP BY t
        ), f AS (
            SELECT doc_id, part, concat(
                CASE WHEN len(w) < 200 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 3 * length(w.t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails
            FROM w JOIN m ON w.t = m.t
        ), g AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
        ), c AS (SELECT part, fails, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS bad FROM f LEFT JOIN g ON f.doc_id = g.doc_id
        ), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
        ), o AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM l a, l b, l c, l d, l e
            WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
        ), s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, filter_order[:step - 1] AS before FROM o, range(1, 6) r(step)
        ), x AS (
            SELECT part, filter_order, step, letter, good, bad, contains(fails, letter) AS fail, fails = letter AS alone,
                length(translate(before, fails, '')) < length(before) AS early FROM c, s
        ), y AS (
            SELECT part, filter_order, step, letter, count(*) FILTER (NOT early AND NOT fail) AS kept, count(*) FILTER (NOT early AND fail) AS removed,
                count(*) FILTER (early AND fail) AS redundant, count(*) FILTER (alone) AS unique_fails,
                count(*) FILTER (NOT early AND fail AND good) AS good_lost, count(*) FILTER (NOT early AND fail AND bad) AS toxic_lost
            FROM x GROUP BY ALL
        )
        SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM y
    """,
}

# crc32 of a decimal number, bit by bit
_CRC = """
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(c, b)),
        4294967295), 4294967295)
"""


def _runs_sql(scales: int = 24, least: int = 24, first: int = 16) -> str:
    """Runs by neighbouring occurrences of grams of 16, 32, 64 ... words, each gram named by its two halves."""
    ctes = []
    k = 1
    for n in range(scales):
        if n:
            old = k
            k *= 2
            halves = f"SELECT doc_id, i, n, md5(g || lead(g, {old}) OVER d) AS g, lead(i, {old}) OVER d AS other FROM g{old} WINDOW d AS (PARTITION BY doc_id ORDER BY i)"
            if old < first:
                ctes.append(f"g{k} AS (SELECT doc_id, i, n, g FROM ({halves}) WHERE i + {k} <= n)")
            else:  # only grams whose halves both recur can recur; what stands between them may be gone
                ctes.append(
                    f"g{k} AS MATERIALIZED (SELECT a.doc_id, a.i, a.n, md5(a.g || b.g) AS g FROM n{old} a JOIN n{old} b ON a.doc_id = b.doc_id AND b.i = a.i + {old} WHERE a.next + a.prior > 0 AND b.next + b.prior > 0 AND a.i + {k} <= a.n)"
                )
        if k >= first:
            ctes.append(
                f"n{k} AS MATERIALIZED (SELECT *, coalesce(lead(i) OVER w - i, 0) AS next, coalesce(i - lag(i) OVER w, 0) AS prior FROM g{k} WINDOW w AS (PARTITION BY doc_id, g ORDER BY i))"
            )
            low = 0 if k == first else k // 2
            ctes.append(f"r{k} AS (SELECT doc_id, min(i) AS s, max(i) - min(i) + {k} + next AS l, next AS q FROM (SELECT doc_id, i, next, i - row_number() OVER (PARTITION BY doc_id, next ORDER BY i) AS island FROM n{k} WHERE next > {low} AND next <= {k}) GROUP BY doc_id, next, island)")
    ks = [first << j for j in range(scales) if first << j <= k]
    union = " UNION ALL ".join(f"SELECT * FROM r{x}" for x in ks)
    return rf"""
        WITH h AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w, {_CRC} AS h FROM documents
        ), v AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS looped, h // 10 AS g FROM h
        ), a AS (SELECT *, CASE WHEN looped THEN g % n ELSE n END AS a, CASE WHEN looped THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM v
        ), t AS (
            SELECT doc_id, n, CASE WHEN looped THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM a
        ), g1 AS (SELECT doc_id, unnest(range(n)) AS i, n, unnest(w) AS g FROM t
        ), {", ".join(ctes)}, runs AS (SELECT * FROM ({union}) WHERE l >= greatest({least}, 3 * q)
        ), d AS (
            SELECT doc_id, count(*) AS n_runs, first(s ORDER BY l / q DESC, s, q) AS start, first(l ORDER BY l / q DESC, s, q) AS length, first(q ORDER BY l / q DESC, s, q) AS period,
                string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed, list_distinct(flatten(list(range(s + q, s + l)))) AS gone
            FROM runs GROUP BY doc_id
        )
        SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
            CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
            sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)) END, ' '), '')) AS collapsed_sha256
        FROM t LEFT JOIN d ON t.doc_id = d.doc_id
    """


ORACLE["op12_periodic_runs"] = _runs_sql()
