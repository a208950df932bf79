"""Exact top-k inner products from an impact-ordered index, read score at a time.

The index cuts the vectors into blocks. A block posts each component under its dimension and its quantised size; all
postings of one dimension, size and sign are a segment, and the segments lie by descending size. For each vector the norm
of what is not yet posted is stored at a few cuts through the segments.

A query adds its weight times the size of a segment to all vectors of the segment, largest sizes first. At a cut, the sum of
a vector plus the norm of its rest times the norm of the query bounds its score (Cauchy and Schwarz). Vectors whose bound
stays below the k-th exact score found so far are proven out. The query stops once so few are left that to rescore them
costs less than to read on, and these are rescored exactly, on the integers themselves. A block read to its end is handled
alike. Queries are taken in groups and share the reading of the segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import BATCH_BYTES, BATCH_ROWS, cut_lineage, filesystem, give_back, new_path, settings

BLOCK_ROWS = 4096
BLOCK_VALUES = 1 << 20  # components of a block, which closes earlier for long vectors
FILE_ROWS = 1 << 20  # vectors of an index file on large tables
SHARDS = 32  # parts of the index that are searched side by side for one group of queries
GROUP = 256  # queries that share the reading of a block
LEVELS = 4  # quantisation steps within the root mean square of the components
CUTS = (0.5, 0.8, 0.9, 0.95, 0.98)  # shares of the squared norms of a block read at the cuts, besides its end
RESCORE_COST = 2.0  # of one component of one pair, against one posting of one query
RESCORED = 1 << 16  # pairs rescored at once
CELLS = 10_000  # tasks of a search at most

_BLOCK = "block long, n int, dims int, width int, ids binary, named binary, `values` binary, dim binary, level binary, stop binary, docs binary, cuts binary, rest binary"


@dataclass(frozen=True)
class ImpactIndex:
    """Files of an index in the shared folder."""

    path: str
    rows: int
    shards: int

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{_BLOCK}, shard int").parquet(self.path)

    def vectors(self, spark: SparkSession) -> DataFrame:
        """vec_id, vector and the place (block, row) of every indexed vector, shorter ones with zeros behind."""
        rows = self.blocks(spark).select("block", "n", "dims", "width", "ids", "named", "values")
        return rows.mapInArrow(_unpacked, "vec_id long, vector array<long>, block long, row int")


def _width(values: np.ndarray) -> int:
    most = int(max(values.max(initial=0), -int(values.min(initial=0)) - 1))
    return next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of integers as rows, shorter ones with zeros behind."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def segments(values: np.ndarray, cuts: tuple[float, ...] = CUTS) -> dict[str, np.ndarray]:
    """Postings of a block by descending size: `docs` of all segments, their `dim`, signed `level` and `stop` in docs.

    `cuts` are numbers of segments, the last one all of them; `rest` has for each cut the norms of what lies behind it.
    """
    n, dims = values.shape
    size = np.abs(values.astype(np.float64))
    step = max(1.0, np.ceil(np.sqrt(np.mean(size**2)) / LEVELS)) if size.size else 1.0
    grade = np.floor(size / step).astype(np.int64)
    doc, dim = np.nonzero(grade)
    grade = grade[doc, dim]
    minus = values[doc, dim] < 0
    key = ((grade.max(initial=0) - grade) * dims + dim) * 2 + minus
    order = np.argsort(key, kind="stable")
    key, doc, dim, grade, minus = (x[order] for x in (key, doc, dim, grade, minus))
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    middle = grade * step + (step - 1) / 2
    level = np.where(minus, -middle, middle)
    mine = values[doc, dim].astype(np.float64)
    energy = (size**2).sum(axis=1)
    gain = mine**2 - (mine - level) ** 2  # of the squared norm, by which a posting lessens the rest
    read = np.cumsum(gain)
    stop = np.append(starts[1:], len(key)) if len(starts) else starts
    at = np.searchsorted(read[stop - 1], np.array(cuts) * energy.sum()) + 1 if len(stop) else np.zeros(0, np.int64)
    at = np.unique(np.append(at[at < len(stop)], len(stop)))
    rest, posting = [], 0
    for cut in at.tolist():
        upto = int(stop[cut - 1]) if cut else 0
        energy = energy - np.bincount(doc[posting:upto], weights=gain[posting:upto], minlength=n)
        posting = upto
        rest.append(np.sqrt(np.maximum(energy, 0)))
    return {"docs": doc.astype(np.uint16), "dim": dim[starts].astype(np.int32), "level": level[starts], "stop": stop.astype(np.int32), "cuts": at.astype(np.int32), "rest": np.array(rest)}


def _blocks(shards: int):
    """Index rows of a task's vectors."""

    def packed(ids: list, vectors: list[pa.Array], block: int) -> pa.RecordBatch:
        values = _matrix(pa.chunked_array(vectors).combine_chunks())
        ids = pa.concat_arrays(ids)
        width = _width(values)
        found = segments(values)
        columns = {
            "block": block, "n": len(ids), "dims": values.shape[1], "width": width, "ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
            "named": ids.is_valid().to_numpy(zero_copy_only=False).tobytes(), "values": values.astype(f"<i{width}").tobytes(),
            **{k: found[k].tobytes() for k in ("dim", "level", "stop", "docs", "cuts", "rest")}, "shard": TaskContext.get().partitionId() % shards,
        }
        return pa.RecordBatch.from_pylist([columns], schema=_BLOCK_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, vectors, rows, longest = [], [], 0, 0
        for batch in batches:
            at = 0
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            while at < batch.num_rows:
                room = BLOCK_ROWS - rows
                widest = np.maximum.accumulate(np.maximum(sizes[at : at + room], longest))
                fits = np.flatnonzero((rows + 1 + np.arange(len(widest))) * widest <= BLOCK_VALUES)
                take = int(fits[-1]) + 1 if len(fits) else 0
                if not take and not rows:
                    take = 1  # a vector longer than a block is one of its own
                if take:
                    ids.append(batch.column("vec_id")[at : at + take])
                    vectors.append(batch.column("v")[at : at + take])
                    rows, longest, at = rows + take, int(widest[take - 1]), at + take
                if rows and (at < batch.num_rows or rows == BLOCK_ROWS):
                    yield packed(ids, vectors, block)
                    block, ids, vectors, rows, longest = block + 1, [], [], 0, 0
        if rows:
            yield packed(ids, vectors, block)
        give_back()

    return run


_BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), *((c, pa.int32()) for c in ("n", "dims", "width")), *((c, pa.binary()) for c in ("ids", "named", "values", "dim", "level", "stop", "docs", "cuts", "rest")), ("shard", pa.int32())]
)


def _values(row: dict) -> np.ndarray:
    return np.frombuffer(row["values"], f"<i{row['width']}").reshape(row["n"], row["dims"]).astype(np.int64)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n"]
            ids = pa.array(np.frombuffer(row["ids"], "<i8"), mask=~np.frombuffer(row["named"], bool))
            flat = pa.array(_values(row).ravel())
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * row["dims"], pa.int32()), flat)
            whole = pa.RecordBatch.from_arrays([ids, vectors, pa.array([row["block"]] * n, pa.int64()), pa.array(np.arange(n), pa.int32())], names=["vec_id", "vector", "block", "row"])
            yield from (whole.slice(at, BATCH_ROWS) for at in range(0, n, BATCH_ROWS))


def build_index(vectors: DataFrame) -> ImpactIndex:
    """Write the index of all rows of (vec_id, vector of integers); rows without a vector take no part.

    Equal rows are indexed each, null identifiers too; vectors may differ in length, and missing components count as zero.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<bigint>").alias("v")).filter("v is not null and not exists(v, x -> x is null)"))
    n = rows.count()
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // FILE_ROWS))
    parts = max(1, min(-(-n // BLOCK_ROWS), wide))
    shards = min(parts, SHARDS)
    path = new_path(spark, "impacts")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS), spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        rows.repartition(parts).mapInArrow(_blocks(shards), f"{_BLOCK}, shard int").write.partitionBy("shard").parquet(path)
    return ImpactIndex(path, n, shards)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries in groups: their identifiers, places of their own rows and vectors."""
    group = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP):
            part = batch.slice(at, GROUP)
            values = _matrix(part.column("vector"))
            places = [part.column(c).fill_null(-1).to_numpy().astype("<i8").tobytes() for c in ("block", "row")]
            names = part.column("query_id")
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (group, values.shape[1])] + [pa.array([x], pa.binary()) for x in (names.fill_null(0).to_numpy().astype("<i8").tobytes(), names.is_valid().to_numpy(zero_copy_only=False).tobytes(), *places, values.astype("<i8").tobytes())],
                names=["grp", "dims", "ids", "named", "block", "row", "values"],
            )
            group += 1


class Best:
    """The k best exact scores of each query of a group so far, and the k-th of them."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        ids, unnamed = np.concatenate([self.id, ids]), np.concatenate([self.unnamed, unnamed])
        order = np.lexsort((ids, unnamed, ~score, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        stays = place < self.k
        order, full = order[stays], place[stays] == self.k - 1
        self.query, self.score, self.id, self.unnamed = query[stays], score[order], ids[order], unnamed[order]
        self.least[self.query[full]] = self.score[full]


def exact_scores(values: np.ndarray, queries: np.ndarray, doc: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs of rows; beyond 64 bits they end at the largest and smallest such integer."""
    most = float(np.abs(values.astype(np.float64)).max(initial=0)) * float(np.abs(queries.astype(np.float64)).max(initial=0)) * max(values.shape[1], 1)
    kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object
    values, queries = values.astype(kind), queries.astype(kind)
    out = np.zeros(len(doc), np.int64)
    for at in range(0, len(doc), RESCORED):
        d, q = doc[at : at + RESCORED], query[at : at + RESCORED]
        if kind is object:
            sums = [int(x) for x in (values[d] * queries[q]).sum(axis=1)]
            out[at : at + RESCORED] = [max(min(x, 2**63 - 1), -(2**63)) for x in sums]
        else:
            out[at : at + RESCORED] = np.einsum("ij,ij->i", values[d], queries[q]).astype(np.int64)
    return out


def search_block(row: dict, queries: np.ndarray, own: np.ndarray, best: Best) -> int:
    """Bring the vectors of a block into the best of some queries; `own` is each query's row of the block, or -1.

    Returns the number of postings read, for a group of queries at once.
    """
    values = _values(row)
    n, dims = values.shape
    ids, unnamed = np.frombuffer(row["ids"], "<i8"), ~np.frombuffer(row["named"], bool)
    dim, level, stop = np.frombuffer(row["dim"], np.int32), np.frombuffer(row["level"], np.float64), np.frombuffer(row["stop"], np.int32)
    docs, cuts = np.frombuffer(row["docs"], np.uint16).astype(np.int64), np.frombuffer(row["cuts"], np.int32)
    rest = np.frombuffer(row["rest"], np.float64).reshape(len(cuts), n)
    fitted = np.zeros((len(queries), dims), np.int64)
    shared = min(dims, queries.shape[1])
    fitted[:, :shared] = queries[:, :shared]
    norms = np.sqrt((fitted.astype(np.float64) ** 2).sum(axis=1))
    longest = float(np.sqrt((values.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
    kind = np.float32 if norms.max(initial=0) * longest < 1e30 else np.float64
    slack = (norms * longest * 1e-5 + 1).astype(kind)  # far beyond what rounding can take
    weights = np.ascontiguousarray(fitted.T, dtype=kind)
    norms = norms.astype(kind)
    score = np.zeros((n, len(queries)), kind)
    mine = np.flatnonzero(own >= 0)
    score[own[mine], mine] = -np.inf  # no query is its own answer
    segment, posting = 0, 0

    def rescored(doc: np.ndarray, query: np.ndarray) -> None:
        found = exact_scores(values, fitted, doc, query)
        good = found >= best.least[query]
        best.add(query[good], found[good], ids[doc[good]], unnamed[doc[good]])

    seeded = np.zeros((n, len(queries)), bool) if np.isinf(best.least).any() else None
    for number, cut in enumerate(cuts.tolist()):
        for s in range(segment, cut):
            upto = int(stop[s])
            score[docs[posting:upto]] += weights[dim[s]] * kind(level[s])
            posting = upto
        segment = cut
        new = np.flatnonzero(np.isinf(best.least))
        if len(new) and n > best.k and (number or len(cuts) == 1):  # a first k-th score from the largest sums
            doc = np.argpartition(score[:, new], n - best.k, axis=0)[n - best.k :]
            query = np.broadcast_to(new, doc.shape)
            doc, query = doc.ravel(), query.ravel()
            real = np.isfinite(score[doc, query])
            doc, query = doc[real], query[real]
            rescored(doc, query)
            seeded[doc, query] = True
        floor = np.maximum(best.least - slack, np.finfo(kind).min).astype(kind)
        possible = score + rest[number].astype(kind)[:, None] * norms >= floor
        possible[own[mine], mine] = False
        if seeded is not None:
            possible &= ~seeded
        left = int(np.count_nonzero(possible))
        if cut == cuts[-1] or left * dims * RESCORE_COST <= (len(docs) - posting) * len(queries):
            rescored(*np.nonzero(possible))
            break
    return posting


def _search(path: str, k: int):
    schema = pa.schema([("grp", pa.int64()), ("at", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    wanted = [f.name for f in _BLOCK_ARROW if f.name != "shard"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        for batch in batches:
            for cell in batch.to_pylist():
                names = np.frombuffer(cell["ids"], "<i8")
                named = np.frombuffer(cell["named"], bool)
                block, row = np.frombuffer(cell["block"], "<i8"), np.frombuffer(cell["row"], "<i8")
                queries = np.frombuffer(cell["values"], "<i8").reshape(len(names), cell["dims"])
                best = Best(len(names), k)
                listed = store.get_file_info(pafs.FileSelector(f"{root}/shard={cell['shard']}", allow_not_found=True))
                for file in sorted(f.path for f in listed if f.base_name.endswith(".parquet")):
                    with store.open_input_file(file) as source:
                        for part in pq.ParquetFile(source).iter_batches(batch_size=1, columns=wanted):
                            for found in part.to_pylist():
                                search_block(found, queries, np.where(block == found["block"], row, -1), best)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cell["grp"]] * len(best.query), pa.int64()),
                        pa.array(best.query, pa.int32()),
                        pa.array(names[best.query], mask=~named[best.query]),
                        pa.array(best.id, mask=best.unnamed),
                        pa.array(best.score),
                    ],
                    schema=schema,
                )
        give_back()

    return run


def search(index: ImpactIndex, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best vectors of each query, of equal scores the smaller vec_id (null last).

    `queries` has (query_id, vector), and (block, row) where a query is a row of the index that is no answer to itself.
    Each group of queries meets each shard of the index in a task of its own, which reads the index files of that shard
    block by block and holds one block; shards give at most k rows a query. All scores are exact.
    """
    spark = queries.sparkSession
    own = [F.col(c).cast("long").alias(c) if c in queries.columns else F.lit(None).cast("long").alias(c) for c in ("block", "row")]
    rows = cut_lineage(queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("vector").cast("array<bigint>").alias("vector"), *own))
    groups = max(1, -(-rows.count() // GROUP))
    packed = cut_lineage(rows.repartition(groups).mapInArrow(_grouped, "grp long, dims long, ids binary, named binary, block binary, row binary, `values` binary"))
    cells = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))))
    found = cells.repartition(min(groups * index.shards, CELLS)).mapInArrow(_search(index.path, k), "grp long, at int, query_id long, vec_id long, score long")
    order = Window.partitionBy("grp", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(vectors: DataFrame, factor: int = 256) -> DataFrame:
    """(vec_id, vector) with components floor(factor * x); null where a vector is null or holds a null or non-finite one."""
    v = F.col("embedding").cast("array<double>")
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.select("vec_id", F.when(whole, F.transform(v, lambda x: F.floor(F.lit(float(factor)) * x))).alias("vector"))


def top_k_among(vectors: DataFrame, every: int = 50, k: int = 5, factor: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the rows of (vec_id, embedding) whose vec_id is a multiple of `every`, over all others.

    A query's own row is left out, other rows of the same vec_id are not. Rows whose vector is null or holds a null or
    non-finite component take no part; null identifiers are candidates, the last of equal scores, and no queries. Equal
    rows each count, as queries too. An empty vector scores 0. Further columns are ignored; an empty table gives no rows.
    """
    index = build_index(scaled(vectors, factor))
    rows = index.vectors(vectors.sparkSession).withColumnRenamed("vec_id", "query_id")
    return search(index, rows.filter(F.col("query_id") % every == 0), k)
