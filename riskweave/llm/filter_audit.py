"""What each of several filters removes in every order in which they can be applied.

Each document becomes a mask of the filters that it fails. Failing the duplicate filter takes a look at the whole table: a
counting Bloom sketch over all texts clears those that certainly occur once, and only the texts of the others are shuffled,
for the smallest identifier of each text. Documents are then counted by mask, and as counts add up, every order, step and
share follows from at most one row for each mask and part.

The sketch is built in parts. Each task counts the places of its texts and gives out those that it touched, by segment; the
tasks of a segment's counts add them up and keep one bit for each place: met twice or not. The bits together are bounded by
MOST_PLACES and broadcast. A corpus beyond that is only cleared less well; results do not depend on the sketch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import cut_lineage, give_back, in_runs, uint64s

FILTERS = "ABCDE"  # short, repetitive, shouting, symbols, copy
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SYMBOLS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")

HASHES = 3  # places of a text in the sketch
PLACES_A_TEXT = 8
SEGMENT_BITS = 16  # places of a segment
MOST_PLACES = 1 << 29  # 64 MB of bits, enough for 67 million texts at PLACES_A_TEXT each
HELD_PLACES = 1 << 22  # places that a task holds before it gives them out
SALTS = 16  # tasks among which the copies of one text are dealt

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_POINT = np.ones(256, bool)  # bytes that begin a code point
_POINT[0x80:0xC0] = False


def _sums(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def own_masks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row behind, masks) of the filters A to D, which look at one text alone, slice by slice."""
    for lo, hi in W.slices(column):
        words = W.cut(column[lo:hi], W.NOT_SPACE, lower=False)
        offsets, data = W.text_bytes(column[lo:hi])
        key = np.lexsort((words.hash, words.text_of_word()))
        text, h = words.text_of_word()[key], words.hash[key]
        new = np.ones(len(h), bool)
        new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
        distinct = np.bincount(text[new], minlength=hi - lo)
        fails = [
            words.counts < LEAST_WORDS,
            100 * distinct < DISTINCT_PERCENT * words.counts,
            100 * _sums(_UPPER[data], offsets) > UPPER_PERCENT * _sums(_POINT[data], offsets),
            _sums(_SYMBOL[data], offsets) > 0,
        ]
        yield lo, hi, sum(np.asarray(f, np.int32) << i for i, f in enumerate(fails))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, masks in own_masks(batch.column("text")):
            columns = [batch.column(c)[lo:hi] for c in ("doc_id", "part", "h", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(masks, pa.int32())], names=["doc_id", "part", "h", "digest", "mask"])
    give_back()


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """Places of hashed texts in a sketch of 2^bits, a row for each hash function."""
    return np.stack([W.mix(h + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) >> np.uint64(64 - bits) for i in range(HASHES)]).astype(np.int64)


def _count_places(bits: int):
    """Counts of the places that a task's texts touch, by segment; counts beyond one are given as two."""
    schema = pa.schema([("segment", pa.int32()), ("at", pa.binary()), ("n", pa.binary())])

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        at, n = np.unique(np.concatenate(held), return_counts=True)
        segment = at >> SEGMENT_BITS
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        inside, n = (at & ((1 << SEGMENT_BITS) - 1)).astype(np.uint16), np.minimum(n, 2).astype(np.uint8)
        for part in range(0, len(starts), 256):
            bounds = np.append(starts, len(at))[part : part + 257]
            pairs = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(segment[bounds[:-1]], pa.int32()), pa.array([inside[a:b].tobytes() for a, b in pairs], pa.binary()), pa.array([n[a:b].tobytes() for a, b in pairs], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            # a text whose places fall together still counts once there
            found = np.sort(places(uint64s(batch.column("h")), bits), axis=0)
            own = np.ones(found.shape, bool)
            own[1:] = found[1:] != found[:-1]
            held.append(found[own])
            size += len(held[-1])
            if size >= HELD_PLACES:
                yield from counted(held)
                held, size = [], 0
        if size:
            yield from counted(held)

    return run


def _merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bits of the places of each segment that were met twice or more, from the counts of all tasks; sorted input."""
    for run in in_runs(batches, ["segment"]):
        total = np.zeros(1 << SEGMENT_BITS, np.uint8)
        for at, n in zip(run.column("at").to_pylist(), run.column("n").to_pylist(), strict=True):
            at = np.frombuffer(at, np.uint16)
            total[at] = np.minimum(total[at] + np.frombuffer(n, np.uint8), 2)
        bits = np.packbits(total > 1).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([run.column("segment")[0].as_py()], pa.int32()), pa.array([bits], pa.binary())], names=["segment", "bits"])


def repeat_sketch(hashes: DataFrame, texts: int) -> np.ndarray:
    """Bits of the places that two or more of the hashes `h` may share, 2^n of them packed in bytes."""
    bits = SEGMENT_BITS
    while 1 << bits < min(texts * PLACES_A_TEXT, MOST_PLACES):
        bits += 1
    counts = hashes.select("h").mapInArrow(_count_places(bits), "segment int, at binary, n binary")
    merged = counts.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge_segments, "segment int, bits binary")
    sketch = np.zeros(1 << bits >> 3, np.uint8)
    for row in merged.toLocalIterator():  # at most MOST_PLACES bits in all, a segment at a time
        at = row.segment << SEGMENT_BITS >> 3
        sketch[at : at + (1 << SEGMENT_BITS >> 3)] = np.frombuffer(row.bits, np.uint8)
    return sketch


def _may_repeat(shared: Broadcast):
    """Rows that the sketch does not clear."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        bits = (len(sketch) * 8).bit_length() - 1
        for batch in batches:
            at = places(uint64s(batch.column("h")), bits)
            met = (sketch[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=0)
            yield batch.filter(pa.array(met))

    return run


def first_copies(docs: DataFrame, sketch: Broadcast) -> DataFrame:
    """(digest, first): the smallest identifier of each text that occurs twice or more, by the full text."""
    rows = docs.mapInArrow(_may_repeat(sketch), docs.schema)
    same = rows.groupBy("text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return same.filter("n > 1 and first is not null").select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "first")


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): how often rows of (doc_id, text, lang) fail just the filters whose bits the mask has.

    Part is the language, the empty string where it is null. A null text is empty. A row is a copy if its text occurs with a
    smaller doc_id; a null doc_id is neither smaller nor larger than any, and rows of one doc_id are no copies of each other.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    digested = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).select("doc_id", "text", "part", "h", "digest")
    thin = cut_lineage(digested.mapInArrow(_masked, "doc_id long, part string, h long, digest string, mask int"))
    sketch = docs.sparkSession.sparkContext.broadcast(repeat_sketch(thin, thin.count()))
    first = first_copies(rows.select("doc_id", "text", "h"), sketch)
    dealt = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    doubtful = thin.filter("doc_id is not null").mapInArrow(_may_repeat(sketch), thin.schema)
    doubtful = doubtful.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    doubtful = doubtful.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    copies = doubtful.join(dealt, ["digest", "salt"]).filter("doc_id > first").select("doc_id", "part", "mask", "n")
    # a copy counts once more with its bit and once less without
    moves = F.explode(F.array(F.struct("mask", (-F.col("n")).alias("n")), F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), "n")))
    moved = copies.select("doc_id", "part", moves.alias("move")).select("doc_id", "part", "move.mask", "move.n")
    counted = thin.select("doc_id", "part", "mask", F.lit(1).cast("long").alias("n")).unionAll(moved)
    return counted.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).filter("n > 0")


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents that fail just the filters named in `fails`, and those labelled 1."""
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    letters = F.concat(*(F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.lit(c)).otherwise(F.lit("")) for i, c in enumerate(FILTERS)))
    marked = masks.withColumn("fails", letters).join(known, "doc_id", "left")

    def of(label: str):
        return F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(F.lit(0))).cast("long").alias("good" if label == "quality" else label)

    return marked.groupBy("part", "fails").agg(F.sum("n").alias("n"), of("quality"), of("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    `docs` has (doc_id, text, lang), `labels` has (doc_id, quality, toxic); of several labels of a document the largest
    counts. Nulls, empty texts and repeated identifiers as in failure_masks; equal rows each count. Further columns are
    ignored. Every part that has a row gets all orders and steps, zeros included; an empty table gives no rows.
    """
    counts = mask_counts(failure_masks(docs), labels)
    orders = ["".join(p) for p in permutations(FILTERS)]
    rows = counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    rows = rows.withColumns({"letter": F.expr("substring(filter_order, step, 1)"), "before": F.expr("left(filter_order, step - 1)")})
    earlier = F.expr("length(translate(before, fails, '')) < length(before)")
    fails = F.expr("instr(fails, letter) > 0")

    def total(where, what="n"):
        return F.sum(F.when(where, F.col(what)).otherwise(F.lit(0))).cast("long")

    # of all orders, as many have a filter before the others that a document fails as fall to it by lot
    first = F.when(fails, F.expr(f"n * {len(orders)} div length(fails)")).otherwise(F.lit(0))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~earlier & ~fails).alias("kept"),
        total(~earlier & fails).alias("removed"),
        total(earlier & fails).alias("redundant"),
        total(F.col("fails") == F.col("letter")).alias("unique_fails"),
        total(~earlier & fails, "good").alias("good_lost"),
        total(~earlier & fails, "toxic").alias("toxic_lost"),
        F.sum(first).cast("long").alias("shapley"),
    )
