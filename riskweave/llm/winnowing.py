"""Benchmark decontamination by winnowing.

Documents and benchmark items keep the smallest five-word hash of every six in a row, so any ten words they share hold
a fingerprint that both kept. Fingerprints are joined, and each hit is extended over the five words on either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import cut_lineage, free_names, give_back

WINDOW = 10  # words of a benchmark window
GRAM = 5
BROADCAST_HITS = 200_000  # digests of texts with a hit (64 bytes each) that may be broadcast; beyond that Spark joins by shuffle
BROADCAST_PRINTS = 2_000_000  # benchmark fingerprints (8 bytes each) that may be broadcast as a filter

# a fingerprint: its hash, its length in words if it is a whole short item (else 0), its place, the words around
_PRINT = pa.struct([("h", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("around", pa.binary())])
_PRINTED = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("prints", pa.list_(_PRINT))])
_PRINTED_DDL = "key long, n_words long, prints array<struct<h:long,n:int,at:int,around:binary>>"


def _around(words: W.Words, at: np.ndarray, side: int, gram: int, missing: int) -> np.ndarray:
    """Hashes of the words from `side` before each place to `side` behind its gram; `missing` beyond the text."""
    span = np.arange(-side, gram + side)
    where = at[:, None] + span
    text = np.searchsorted(words.first, at, side="right") - 1
    inside = (where >= words.first[text][:, None]) & (where < words.first[text + 1][:, None])
    return np.where(inside, words.hash[np.where(inside, where, 0)], np.uint64(missing))


def fingerprints(column: pa.Array, window: int, gram: int, short: list[int], items: bool, wanted: np.ndarray | None) -> Iterator[tuple[list[int], list[list[dict]]]]:
    """Word counts and fingerprints of texts, slice by slice; `wanted`: sorted hashes that alone are given out."""
    for lo, hi in W.slices(column):
        words = W.cut(column[lo:hi], W.ALPHANUMERIC, lower=True)
        text = words.text_of_word()
        counts = words.counts
        prints: list[list[dict]] = [[] for _ in range(hi - lo)]
        if len(words.hash):
            found = []
            h, fits = W.grams(words, gram)
            at = W.winnow(h, fits, window - gram + 1)
            found.append((0, at, h[at]))
            for n in short:
                h, fits = W.grams(words, n)
                at = words.first[:-1][counts == n] if items else np.flatnonzero(fits)
                found.append((n, at, W.mix(h[at] + np.uint64(n))))
            for n, at, h in found:
                if wanted is not None and len(at):
                    near = np.searchsorted(wanted, h.view(np.int64))
                    hit = wanted[np.minimum(near, len(wanted) - 1)] == h.view(np.int64) if len(wanted) else np.zeros(len(at), bool)
                    at, h = at[hit], h[hit]
                if not len(at):
                    continue
                around = _around(words, at, window - gram, gram, 1 if items else 0) if n == 0 else None
                for i, (place, value) in enumerate(zip(at.tolist(), h.view(np.int64).tolist(), strict=True)):
                    t = int(text[place])
                    prints[t].append({"h": value, "n": n, "at": place - int(words.first[t]), "around": around[i].tobytes() if n == 0 else b""})
        yield counts.tolist(), prints


def _print_batches(window: int, gram: int, short: list[int], items: bool, wanted=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = wanted.value if wanted is not None else None
        for batch in batches:
            column, keys, at = batch.column("text"), batch.column("key"), 0
            for counts, prints in fingerprints(column, window, gram, short, items, hashes):
                yield pa.RecordBatch.from_arrays([keys[at : at + len(counts)], pa.array(counts, pa.int64()), pa.array(prints, pa.list_(_PRINT))], schema=_PRINTED)
                at += len(counts)

    return run


def extend(window: int, gram: int):
    """Of joined fingerprints, those whose words agree over a whole window or short item, with the words covered."""
    side = window - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at = batch.column("n").to_numpy(), batch.column("at").to_numpy().astype(np.int64)
            lo, hi, hit = at.copy(), at + n, n > 0
            long = np.flatnonzero(n == 0)
            if len(long):
                width = gram + 2 * side
                mine, theirs = (np.frombuffer(b"".join(batch.column(c).take(pa.array(long)).to_pylist()), np.uint64).reshape(-1, width) for c in ("around", "item_around"))
                same = mine == theirs
                left = np.cumprod(same[:, :side][:, ::-1], axis=1).sum(axis=1)
                right = np.cumprod(same[:, side + gram :], axis=1).sum(axis=1)
                lo[long] = at[long] - left
                hi[long] = at[long] + gram + right
                hit[long] = same[:, side : side + gram].all(axis=1) & (left + gram + right >= window)
            keep = pa.array(np.flatnonzero(hit))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(keep), batch.column("item").take(keep), pa.array(lo[hit], pa.int64()), pa.array(hi[hit], pa.int64())], names=["key", "item", "lo", "hi"]
            )

    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for each row of (doc_id, text).

    `spans` lists the hit words as [first, last) ranges of word numbers. Null and empty texts have no words, on either
    side. Rows are judged one by one, so repeated rows and identifiers each get their result; a null item_id counts as
    an item with an empty name, items of one item_id as one. Without items nothing is hit. Further columns are ignored.
    """
    spark = docs.sparkSession
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    # the lengths of short items decide which grams of documents count as fingerprints; at most window - 1 numbers
    numbered = cut_lineage(texts.withColumn("key", F.monotonically_increasing_id()))
    lengths = numbered.select("key", "text").mapInArrow(_print_batches(window, gram, [], True), _PRINTED_DDL)
    short = sorted(r.n_words for r in lengths.filter(f"n_words between 1 and {window - 1}").select("n_words").distinct().collect())
    printed = numbered.select("key", "text").mapInArrow(_print_batches(window, gram, short, True), _PRINTED_DDL)
    theirs = printed.join(numbered.select("key", "item"), "key").select("item", F.explode("prints").alias("p"))
    theirs = cut_lineage(theirs.select("item", F.col("p.h").alias("h"), F.col("p.n").alias("n"), F.col("p.around").alias("item_around")).distinct())
    wanted = None
    distinct = theirs.select("h").distinct()
    if distinct.count() <= BROADCAST_PRINTS:
        wanted = spark.sparkContext.broadcast(np.sort(distinct.toArrow().column("h").to_numpy()))
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", F.monotonically_increasing_id())
    mine = cut_lineage(_with_ids(rows, window, gram, short, wanted))
    prints = mine.filter(F.size("prints") > 0).select("key", F.explode("prints").alias("p"))
    met = prints.select("key", F.col("p.h").alias("h"), F.col("p.n").alias("n"), F.col("p.at").alias("at"), F.col("p.around").alias("around")).join(theirs, ["h", "n"])
    hits = met.mapInArrow(extend(window, gram), "key long, item string, lo long, hi long")
    spans = hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("ranges"), F.sort_array(F.collect_set("item")).alias("names"))
    spans = spans.select(
        "key",
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "names").cast("binary"), 256).alias("items_sha256"),
        _merged("ranges").alias("spans"),
    )
    out = mine.select("key", "doc_id", "n_words").join(spans, "key", "left")
    covered = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"]), F.lit(0).cast("long"))
    return out.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
        "spans",
    )


def _with_ids(rows: DataFrame, window: int, gram: int, short: list[int], wanted) -> DataFrame:
    """Fingerprints of documents beside their doc_id."""
    kind = rows.schema["doc_id"].dataType
    inner = _print_batches(window, gram, short, False, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in inner(iter([batch])):
                ids = batch.column("doc_id")[at : at + part.num_rows]
                yield pa.RecordBatch.from_arrays([ids, *part.columns], names=["doc_id", *part.schema.names])
                at += part.num_rows
        give_back()

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, {_PRINTED_DDL}")


def _merged(ranges: str):
    """Sorted ranges joined where they touch or overlap."""
    empty = F.expr("cast(array() as array<struct<lo:bigint,hi:bigint>>)")

    def add(done, r):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], r["hi"]).alias("hi"))))
        return F.when((F.size(done) > 0) & (last["hi"] >= r["lo"]), joined).otherwise(F.concat(done, F.array(F.struct(r["lo"].alias("lo"), r["hi"].alias("hi")))))

    return F.aggregate(ranges, empty, add)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` without a hit, with all their columns; rows are judged by their text, whatever their identifier."""
    gone, own = free_names(docs, "digest", "own_digest")
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    hit = contamination(docs.select(digest.alias("doc_id"), "text"), items, **options).filter("contaminated")
    hit = cut_lineage(hit.select(F.col("doc_id").alias(gone)).distinct())
    few = hit.count() <= BROADCAST_HITS
    return docs.withColumn(own, digest).join(F.broadcast(hit) if few else hit, F.col(own) == F.col(gone), "left_anti").select(*docs.columns)
