"""Approximate cosine search: signs of random projections, several tables, probes of the least certain signs.

The index holds every row. A table keeps, for each row, the signs of its unit vector on `bits` random directions as one
number. A query looks into the bucket of its own signs and into those that differ in its `flips` least certain ones. Rows
met in any table are rescored exactly, so what is found has its true similarity and place among the found; what no table
brings up is missed. Tables hold keys alone: vectors are read for candidates only.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.session import new_path

TABLES = 24
FLIPS = 4  # signs of a query taken both ways, so 2^FLIPS buckets of a table are looked into
BUCKET_ROWS = 16  # rows of a bucket on average
MOST_BITS = 30
BROADCAST_ROWS = 200_000  # probes or candidates that may be broadcast; beyond that Spark joins by shuffle
SEED = 20240


@dataclass(frozen=True)
class LshIndex:
    """Folders of the keys by bucket and of the unit vectors by key, with what is needed to probe them."""

    path: str
    key: str
    key_type: str
    rows: int
    dims: int
    tables: int
    bits: int

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"tab int, code long, {self.key} {self.key_type}").parquet(f"{self.path}/postings")

    def vectors(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{self.key} {self.key_type}, unit array<float>").parquet(f"{self.path}/vectors")


def directions(dims: int, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """Normal directions, one matrix a table; the same for index and queries."""
    return np.random.default_rng(seed).normal(size=(tables, bits, dims))


def unit_rows(vectors: pd.Series, dims: int) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), dims)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _codes(signs: np.ndarray) -> np.ndarray:
    return (signs.astype(np.int64) << np.arange(signs.shape[-1])).sum(axis=-1)


def build_index(chunks: DataFrame, key: str = "vec_id", column: str = "embedding", tables: int = TABLES, bits: int | None = None) -> LshIndex:
    """Write the index of all rows with a vector; all vectors must have one length.

    Null vectors and such with a null or non-finite component take no part. Bits follow from the number of rows, so that
    buckets keep their size as the table grows.
    """
    spark = chunks.sparkSession
    v = F.col(column).cast("array<double>")
    used = chunks.select(key, v.alias("v")).where("v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf'))")
    n, dims = used.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    dims = dims or 1
    bits = bits or min(MOST_BITS, max(2, math.ceil(math.log2(max(n, 2) / BUCKET_ROWS))))
    planes = directions(dims, tables, bits)
    path, key_type = new_path(spark, "lsh"), dict(chunks.dtypes)[key]

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = unit_rows(pdf["v"], dims)
            codes = _codes(np.einsum("nd,tbd->ntb", x, planes) > 0)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "unit": list(x.astype(np.float32)), "codes": list(codes)})

    found = used.mapInPandas(coded, f"{key} {key_type}, unit array<float>, codes array<bigint>")
    found.write.parquet(f"{path}/rows")
    rows = spark.read.schema(found.schema).parquet(f"{path}/rows")
    rows.select(F.posexplode("codes").alias("tab", "code"), key).repartitionByRange("tab", "code").sortWithinPartitions("tab", "code").select("tab", "code", key).write.parquet(f"{path}/postings")
    rows.select(key, "unit").repartitionByRange(key).sortWithinPartitions(key).write.parquet(f"{path}/vectors")
    return LshIndex(path, key, key_type, n, dims, tables, bits)


def probes(index: LshIndex, queries: DataFrame, flips: int = FLIPS) -> DataFrame:
    """(query_id, tab, code): the buckets that each query of (query_id, query) looks into."""
    planes, flips = directions(index.dims, index.tables, index.bits), min(flips, index.bits)
    turned = [c for r in range(flips + 1) for c in combinations(range(flips), r)]
    dims = index.dims

    def looked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.einsum("nd,tbd->ntb", unit_rows(pdf["query"], dims), planes)
            weak = np.argsort(np.abs(x), axis=2, kind="stable")[:, :, :flips]
            bit = np.int64(1) << weak
            change = np.stack([np.bitwise_xor.reduce(bit[:, :, list(c)], axis=2) if c else np.zeros(bit.shape[:2], np.int64) for c in turned], axis=2)
            codes = _codes(x > 0)[:, :, None] ^ change
            n, t, p = codes.shape
            yield pd.DataFrame({"query_id": np.repeat(pdf["query_id"].to_numpy(), t * p), "tab": np.tile(np.repeat(np.arange(t, dtype=np.int32), p), n), "code": codes.ravel()})

    return queries.select("query_id", F.col("query").cast("array<double>").alias("query")).mapInPandas(looked, f"query_id {dict(queries.dtypes)['query_id']}, tab int, code bigint")


def candidates(index: LshIndex, queries: DataFrame, flips: int = FLIPS) -> DataFrame:
    """(query_id, key) of the rows that share a probed bucket with a query."""
    wanted = probes(index, queries, flips)
    few = queries.count() * index.tables * 2**flips <= BROADCAST_ROWS
    return index.postings(queries.sparkSession).join(F.broadcast(wanted) if few else wanted, ["tab", "code"]).select("query_id", index.key).distinct()


def approximate_top_k(index: LshIndex, queries: DataFrame, k: int = 6, flips: int = FLIPS) -> DataFrame:
    """query_id, key, similarity, place: the k most similar rows among those that the index brings up for each query.

    Similarities are exact up to the 32-bit components that the index stores, ties go to the lower key. A query that meets
    no row gets none. More flips and tables find more and read more.
    """
    met = candidates(index, queries, flips)
    dims = index.dims

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("nd,nd->n", unit_rows(a, dims), unit_rows(b, dims)) if len(a) else np.zeros(0))

    pairs = met.join(index.vectors(queries.sparkSession), index.key).join(queries.select("query_id", F.col("query").cast("array<double>").alias("query")), "query_id")
    scored = pairs.select("query_id", index.key, cosine("unit", "query").alias("similarity"))
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), index.key)
    return scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)


def recall(found: DataFrame, exact: DataFrame, key: str = "vec_id") -> float:
    """Share of the exact rows that were found."""
    total = exact.count()
    return exact.join(found.select("query_id", key), ["query_id", key], "left_semi").count() / total if total else 1.0


cloudpickle.register_pickle_by_value(sys.modules[__name__])
