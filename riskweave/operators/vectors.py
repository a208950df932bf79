"""Exact cosine search and context assembly."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K

BLOCK = 4096
ROWS = 512  # chunks compared with a block of queries at a time


def centroids(vectors: DataFrame, label: str, column: str = "embedding") -> DataFrame:
    """Mean vector per label; components are averaged in a combining aggregation."""
    parts = vectors.select(label, F.posexplode(column).alias("_i", "_v")).groupBy(label, "_i").agg(F.avg(F.col("_v").cast("double")).alias("_v"))
    # one entry per dimension is gathered
    rows = parts.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_a"))
    return rows.select(F.col(label).alias("query_id"), F.transform("_a", lambda s: s["_v"]).alias("query"))


def cosine_top_k(chunks: DataFrame, queries: DataFrame, k: int = 6, key: str = "vec_id", column: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, key, similarity, place: the k nearest chunks of every query, exactly.

    Queries go to the tasks in blocks of about `block`; more queries make more passes, none is
    dropped. A task keeps k rows per query, whatever it reads, and compares ROWS chunks at a time:
    arrays of some 50 MB.
    """
    count = queries.count()
    blocks = max(1, -(-count // block))
    numbered = queries.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        part = _one_block(chunks, numbered.where(F.col("_b") == b), k, key, column)
        out = part if out is None else out.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), key)
    return out.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def _one_block(chunks: DataFrame, queries: DataFrame, k: int, key: str, column: str) -> DataFrame:
    rows = queries.select("query_id", "query").toPandas()  # at most about one block
    ids = rows["query_id"].to_numpy()
    q = np.array(rows["query"].tolist(), dtype=np.float64).reshape(len(rows), -1)
    q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
    held = chunks.sparkSession.sparkContext.broadcast((ids, q))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, q = held.value
        best_keys, best = None, np.zeros((len(names), 0))
        for pdf in batches:
            if not len(names):
                continue
            # equal similarities keep the lower key, as the final ranking does
            pdf = pdf.sort_values(key, kind="stable")
            for at in range(0, len(pdf), ROWS):
                part = pdf.iloc[at : at + ROWS]
                x = np.array(part[column].tolist(), dtype=np.float64)
                x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                sims = q @ x.T
                picked = _largest(sims, k)
                keys, sims = part[key].to_numpy()[picked], np.take_along_axis(sims, picked, axis=1)
                if best_keys is not None:
                    keys, sims = np.concatenate([best_keys, keys], axis=1), np.concatenate([best, sims], axis=1)
                order = np.lexsort((keys, -sims), axis=1)[:, :k]
                best_keys, best = np.take_along_axis(keys, order, axis=1), np.take_along_axis(sims, order, axis=1)
        if best_keys is not None:
            yield pd.DataFrame({"query_id": np.repeat(names, best.shape[1]), key: best_keys.ravel(), "similarity": best.ravel()})

    id_type = dict(queries.dtypes)["query_id"]
    key_type = dict(chunks.dtypes)[key]
    return chunks.select(key, column).mapInPandas(nearest, f"query_id {id_type}, {key} {key_type}, similarity double")


def _largest(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest entries of each row, the first columns among equal ones."""
    if sims.shape[1] <= k:
        return np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    bound = np.partition(sims, sims.shape[1] - k, axis=1)[:, -k][:, None]
    above, equal = sims > bound, sims == bound
    room = k - above.sum(axis=1, keepdims=True)
    picked = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= room))
    return np.nonzero(picked)[1].reshape(-1, k)


def contexts(hits: DataFrame, queries: DataFrame, empty: str = K.NO_EXCERPTS) -> DataFrame:
    """Numbered citations with their texts for each row of `queries`, the `empty` text where nothing was found.

    `hits` holds at most k rows per query.
    """
    cited = F.concat(
        F.lit("["), F.col("place").cast("string"), F.lit("] "), F.coalesce("company_name", F.lit("Unknown")), F.lit(" | "), F.coalesce("form_type", F.lit("")),
        F.lit(" | Period: "), F.coalesce("period_of_report", F.lit("")), F.lit(" | "), F.coalesce("section_name", F.lit("")), F.lit("\n"), F.col("text"),
    )
    rows = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct(F.col("place").alias("p"), cited.alias("t")))))
    joined = F.array_join(F.transform(rows, lambda r: r["t"]), "\n\n---\n\n")
    found = hits.groupBy("query_id").agg(F.when(F.size(rows) > 0, joined).alias("context"))
    return queries.select("query_id").join(found, "query_id", "left").withColumn("context", F.coalesce("context", F.lit(empty)))


def source_labels(hits: DataFrame) -> DataFrame:
    """Distinct sources cited per query."""
    return hits.select("query_id", "source").distinct()


# tasks get these helpers with the job, so workers need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
