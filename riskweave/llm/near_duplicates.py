"""Near duplicates by MinHash signatures and an inverted join over their coordinates.

Documents with equal shingle sets are one class. Each class posts its rarest shared (coordinate, value) pairs; classes
that meet in a posting count the coordinates they agree in, skipping those already linked there. Classes that agree in
enough coordinates form candidate groups, and inside a group every pair is settled on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import components, cut_lineage, free_names, give_back, in_runs

SHINGLE = 4
PERCENT = 80  # similarity that links two documents
COORDINATES = 64
MATCHES = 33  # coordinates that must agree; a pair at 80 % agrees in fewer with chance 8e-8
POSTING_BLOCK = 4000  # classes of one posting compared in one go
GROUP_BLOCK = 2_000_000  # shingles of a candidate group settled in one go
BROADCAST_IDS = 200_000  # identifiers that may be broadcast; beyond that Spark joins by shuffle

_MULTIPLIERS = np.random.default_rng(20240601).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has one, without words none."""
    for lo, hi in W.slices(column):
        words = W.cut(column[lo:hi], W.NOT_SPACE, lower=True)
        hashes, fits = W.grams(words, size)
        for first, stop in zip(words.first[:-1], words.first[1:], strict=True):
            n = stop - first
            if n >= size:
                yield np.unique(hashes[first : stop - size + 1])
            elif n:
                h = np.zeros(1, np.uint64)
                for w in words.hash[first:stop]:
                    h = W.mix(h * W._ODD + w)
                yield W.mix(h + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signature_rows(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (int32) of non-empty sets."""
    if not sets:
        return np.zeros((0, COORDINATES), np.int32)
    flat = np.concatenate(sets)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k, a in enumerate(_MULTIPLIERS):
        out[:, k] = np.minimum.reduceat((flat * a) >> np.uint64(32), first)
    return out.view(np.int32)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo, hi in W.slices(column):
                sets = list(shingle_sets(column[lo:hi], size))
                full = [s for s in sets if len(s)]
                signed = iter(signature_rows(full))
                rows = [next(signed) if len(s) else None for s in sets]
                keys = [c for c in batch.schema.names if c != "text"]
                found = [pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()), pa.array(rows, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[lo:hi] for c in keys), *found], names=[*keys, "n_shingles", "node", "signature"])
            give_back()

    return run


def signatures(docs: DataFrame, size: int = SHINGLE, with_digest: bool = False) -> DataFrame:
    text = F.col("text").cast("string")
    key = [text_digest().alias("digest")] if with_digest else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *key, text.alias("text"))
    return rows.mapInArrow(_sign(size), f"doc_id long, {'digest string, ' * with_digest}n_shingles long, node binary, signature array<int>")


def text_digest() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def in_blocks(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Copies of rows for each pair of blocks (lo, hi) of their group, so that every two rows meet in one group."""
    block = F.pmod(F.xxhash64("node"), F.col(blocks))
    pairs = F.transform(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")), lambda j: F.struct(F.least(block.cast("int"), j).alias("lo"), F.greatest(block.cast("int"), j).alias("hi")))
    return rows.withColumn("pair", F.explode(pairs)).withColumns({"lo": F.col("pair.lo"), "hi": F.col("pair.hi")}).drop("pair", blocks)


def _stars(nodes: list[bytes], near) -> Iterator[dict]:
    """Links of each row to the first row of its component; near(i, rest) tells which of the rows `rest` link with i."""
    rest = np.arange(len(nodes))
    while len(rest):
        root, queue = rest[0], [rest[0]]
        rest = rest[1:]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            found, rest = rest[hit], rest[~hit]
            queue.extend(found)
            for i in found:
                yield {"a": nodes[i], "b": nodes[root]}


_LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _link_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def links():
        for group in in_runs(batches, ["token", "lo", "hi"]):
            if group.num_rows < 2:
                continue
            signed = group.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
            yield from _stars(group.column("node").to_pylist(), lambda i, rest, s=signed: (s[rest] == s[i]).sum(axis=1) >= MATCHES)

    schema = _LINKS
    held = []
    for link in links():
        held.append(link)
        if len(held) == 20_000:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)
    give_back()


def candidate_links(classes: DataFrame) -> DataFrame:
    """Links (a, b) that join the classes agreeing in MATCHES coordinates, as stars inside postings.

    Coordinates shared with no other class cannot agree, so they take the head of each list; of the shared ones,
    rarest first, the last MATCHES - 1 can be left out without losing a pair.
    """
    posted = classes.select("node", F.posexplode("signature").alias("at", "value"))
    posted = posted.select("node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long") + F.lit(1 << 31)).alias("token"))
    shared = posted.groupBy("token").count().filter("count > 1")
    lists = (
        posted.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("count", "token"))).alias("tokens"))
        .filter(F.size("tokens") >= MATCHES)
        .select("node", F.explode(F.slice("tokens", F.lit(1), F.size("tokens") - (MATCHES - 1))).alias("t"))
        .select("node", F.col("t.token").alias("token"))
    )
    lists = cut_lineage(lists)
    sizes = lists.groupBy("token").count().filter("count > 1").select("token", F.ceil(F.col("count") / POSTING_BLOCK).alias("blocks"))
    rows = in_blocks(lists.join(sizes, "token"), "token", "blocks").join(classes.select("node", "signature"), "node")
    rows = rows.select("token", "lo", "hi", "node", "signature")
    met = rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")
    return met.mapInArrow(_link_postings, "a binary, b binary").distinct()


def _sets_of(size: int):
    schema = pa.schema([("grp", pa.binary()), ("blocks", pa.int64()), ("node", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, wanted = batch.column("text"), batch.column("node").to_pylist()
            at = 0
            for lo, hi in W.slices(column):
                keep, sets = [], []
                for s in shingle_sets(column[lo:hi], size):
                    if digest(s) == wanted[at]:  # another row may bear the same identifier
                        keep.append(at)
                        sets.append(s.tobytes())
                    at += 1
                picked = batch.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([picked.column("grp"), picked.column("blocks"), picked.column("node"), pa.array(sets, pa.binary())], schema=schema)

    return run


def _settle(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in in_runs(batches, ["grp", "lo", "hi"]):
            nodes, first = np.unique(np.array(group.column("node").to_pylist(), dtype=object), return_index=True)
            packed = group.column("shingles")
            sets = [np.frombuffer(packed[int(i)].as_py(), np.uint64) for i in first]
            if len(sets) < 2:
                continue
            sizes = np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            values, flat = np.unique(np.concatenate(sets), return_inverse=True)
            order = np.argsort(flat, kind="stable")
            owner_by_value = owner[order]
            bounds = np.searchsorted(flat[order], np.arange(len(values) + 1))
            starts = np.concatenate([[0], np.cumsum(sizes)])

            def near(i, rest, flat=flat, starts=starts, bounds=bounds, owners=owner_by_value, sizes=sizes):
                mine = flat[starts[i] : starts[i + 1]]
                met = np.concatenate([owners[bounds[v] : bounds[v + 1]] for v in mine])
                both = np.bincount(met, minlength=len(sizes))[rest]
                return 100 * both >= percent * (sizes[i] + sizes[rest] - both)

            links = list(_stars(list(nodes), near))
            yield pa.RecordBatch.from_pylist(links, _LINKS)
        give_back()

    return run


def components_of(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, with_digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, [digest,] n_shingles, node, signature) of each row, and (node, label, component_id) of each class."""
    signed = cut_lineage(signatures(docs, size, with_digest))
    classes = signed.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep_id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
    classes = cut_lineage(classes)
    groups = components(cut_lineage(candidate_links(classes)))
    members = groups.join(classes.select("node", "rep_id", "n"), "node")
    totals = members.groupBy("label").agg(F.ceil(F.sum("n") / GROUP_BLOCK).alias("blocks"))
    members = cut_lineage(members.join(totals, "label").select(F.col("label").alias("grp"), "blocks", "node", "rep_id"))
    few = members.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(members) if few else members, F.col("doc_id").eqNullSafe(F.col("rep_id")))
    sets = texts.select("grp", "blocks", "node", "text").mapInArrow(_sets_of(size), "grp binary, blocks long, node binary, shingles binary")
    met = in_blocks(sets, "grp", "blocks").repartition("grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi")
    links = cut_lineage(met.mapInArrow(_settle(percent), "a binary, b binary").distinct())
    found = components(links)
    named = classes.select("node", "rep_id").join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("rep_id").alias("component_id"))
    return signed, cut_lineage(named.join(smallest, "label").select("node", "label", "component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of (doc_id, text).

    Null and empty texts have no shingles and link with nothing. Rows of equal doc_id and text are in one class and
    share all results. A null doc_id takes part, is never the smallest, and its row is kept only if its component
    holds no other identifier. Further columns are ignored. An empty table gives no rows.
    """
    signed, named = components_of(docs, percent, size)
    out = signed.select("doc_id", "n_shingles", "node").join(named.drop("label"), "node", "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One row of `docs` for each component, with all its columns, and every row without a shingle.

    The row of the smallest doc_id stays (a null one comes last), of equal ones that whose text has the smallest digest,
    and any one of equal rows. Rows of different texts are told apart whatever their identifiers.
    """
    signed, named = components_of(docs, percent, size, with_digest=True)
    members = signed.filter("node is not null").groupBy("doc_id", "digest", "node").agg(F.count(F.lit(1)).alias("n"))
    members = cut_lineage(members.join(named.select("node", "label"), "node").select("label", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest").alias("who"), "n"))
    firsts = members.groupBy("label").agg(F.min("who").alias("first"))
    judged = cut_lineage(members.join(firsts, "label").select("who.doc_id", "who.digest", (F.col("who") == F.col("first")).alias("stays"), "n").filter("not stays or n > 1"))
    gone, again = judged.filter("not stays"), judged.filter("stays")
    key, text, own = free_names(docs, "id", "digest", "own_digest")
    rows = docs.withColumn(own, text_digest())

    def met(pairs: DataFrame, how: str) -> DataFrame:
        pairs = pairs.select(F.col("doc_id").alias(key), F.col("digest").alias(text))
        few = pairs.count() <= BROADCAST_IDS
        return rows.join(F.broadcast(pairs) if few else pairs, F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.col(own) == F.col(text)), how)

    if again.limit(1).count():  # equal rows of which one stays
        return met(judged, "left_anti").unionByName(met(again, "left_semi").dropDuplicates(["doc_id", own])).select(*docs.columns)
    return met(gone, "left_anti").select(*docs.columns)
