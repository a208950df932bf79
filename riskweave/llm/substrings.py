"""Repeated passages, found with suffix automata of reference shards.

Every passage of 20 words has one anchor, the smallest six-word hash among its fifteen. The passages of a text that share
an anchor go with it, as one stretch of words, to the shard of the anchor's hash, so all occurrences of a passage meet in
one shard. There the stretches of an anchor are streamed, in order of their places, through a suffix automaton of those
before them: for each word it gives the longest match that ends there and where that first occurred. A stretch that holds
anything new is then added. Passages that first occur earlier are removed.

Automata are built where their shard lies and are not broadcast: every document against every shard would grow with the
square of the corpus. Their size is bounded: an anchor that occurs more than ANCHOR_STRETCHES times has its passages dealt
by their own 128-bit hash instead, with the first place of each as a minimum that Spark combines before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import cut_lineage, give_back, int64s

LENGTH = 20
GRAM = 6
SHARD_STRETCHES = 8000  # stretches that meet in one shard, about
ANCHOR_STRETCHES = 20_000  # at worst some 300 MB of automaton, if all differ throughout
FIRST_ID = -(1 << 63)  # a null doc_id comes before all others


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state knows where its words first ended.

    Sequences must be added in the order of their places; `place` is any value that is passed through.
    """

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first: list[tuple] = [()]  # (place, words up to and with the last one)

    def add(self, words: list, place) -> None:
        last = 0
        for i, w in enumerate(words):
            last = self._extend(last, w, (place, i + 1))

    def _clone(self, p: int, q: int, w) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.first.append(self.first[q])
        self.link[q] = new
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, w, first: tuple) -> int:
        known = self.next[last].get(w)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, known, w)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        self.first.append(first)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return new

    def statistics(self, words: list, cap: int) -> Iterator[tuple[int, tuple]]:
        """For each word, the longest match that ends there (at most `cap` words) and where it first ended."""
        state = n = 0
        for w in words:
            while state and w not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                n += 1
            while state and self.length[self.link[state]] >= cap:
                state = self.link[state]
            n = min(n, cap, self.length[state])
            yield n, self.first[state]


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Rows with one long as their key, and whether keys may repeat: the identifier, or a hash of identifier and text where identifiers do."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ids = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(ids, F.lit(FIRST_ID)).alias("doc_id"), ids.isNull().alias("unnamed"), text.alias("text"))
    repeated = rows.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    return rows.withColumn("key", F.xxhash64("doc_id", "text") if repeated else F.col("doc_id")), bool(repeated)


def _anchors(length: int, gram: int):
    schema = pa.schema([("key", pa.int64()), ("anchor", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = int64s(batch.column("key"))
            for lo, hi in W.slices(batch.column("text")):
                words = W.cut(batch.column("text")[lo:hi], W.NOT_SPACE, lower=False)
                h, fits = W.grams(words, gram)
                at = W.winnow(h, fits, length - gram + 1)
                text = np.searchsorted(words.first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo + text]), pa.array(h[at].view(np.int64)), pa.array((at - words.first[text]).astype(np.int32))], schema=schema)

    return run


_PLACE = np.dtype([("anchor", "<i8"), ("key", "<i8"), ("doc_id", "<i8"), ("start", "<i8")])


def _stretches(batch: pa.RecordBatch, length: int, gram: int, frequent: bool) -> Iterator[tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Words of each slice; places of its repeated anchors' stretches; their first words and ends in the slice."""
    keys, ids = int64s(batch.column("key")), int64s(batch.column("doc_id"))
    found = batch.column("found")
    for lo, hi in W.slices(batch.column("text")):
        words = W.cut(batch.column("text")[lo:hi], W.NOT_SPACE, lower=False)
        h, fits = W.grams(words, gram)
        at, first, last = W.winnow_runs(h, fits, length - gram + 1)
        part = found[lo:hi]
        texts = np.repeat(np.arange(hi - lo), np.array([len(f) for f in part], np.int64))
        where = part.flatten().to_numpy().astype(np.int64)  # the complement of the position if the anchor is frequent
        mine = (where < 0) == frequent
        wanted = words.first[texts[mine]] + np.where(where < 0, ~where, where)[mine]
        picked = np.searchsorted(at, np.sort(wanted))
        text = np.searchsorted(words.first, at[picked], side="right") - 1
        places = np.zeros(len(picked), _PLACE)
        places["anchor"], places["key"], places["doc_id"] = h[at[picked]].view(np.int64), keys[lo + text], ids[lo + text]
        places["start"] = first[picked] - words.first[text]
        yield words, places, first[picked], last[picked] + length


def _join_words(words: W.Words, data: bytes, lo: int, hi: int) -> bytes:
    return b" ".join([data[s:e] for s, e in zip(words.start[lo:hi].tolist(), words.end[lo:hi].tolist(), strict=True)])


def _pack(length: int, gram: int, shards: int):
    """Stretches of anchors that are not frequent, packed by shard."""
    schema = pa.schema([("shard", pa.int32()), ("places", pa.binary()), ("texts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            parts, texts = [], []
            for words, places, lo, hi in _stretches(batch, length, gram, False):
                data = words.data.tobytes()
                parts.append(places)
                texts += [_join_words(words, data, a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
            places = np.concatenate(parts) if parts else np.zeros(0, _PLACE)
            shard = (W.mix(places["anchor"].view(np.uint64)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            bounds = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
            rows = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                some = order[a:b]
                rows.append({"shard": int(shard[some[0]]), "places": packer.compress(b"".join([places[name][some].tobytes() for name in _PLACE.names])), "texts": packer.compress(b"\n".join([texts[i] for i in some.tolist()]))})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def earlier_passages(stretches: list[list[bytes]], places: list[tuple], length: int) -> Iterator[list[int]]:
    """For stretches of words in the order of their places (identifier, start): the passages that start earlier, as offsets."""
    automaton, known = SuffixAutomaton(), {}
    for words, (doc_id, start) in zip(stretches, places, strict=True):
        text = tuple(words)
        if text in known:  # an earlier stretch of the same words
            yield list(range(len(words) - length + 1)) if known[text] < (doc_id, start) else []
            continue
        known[text] = (doc_id, start)
        out, new = [], False
        for i, (n, first) in enumerate(automaton.statistics(words, length)):
            if i >= length - 1:
                if n < length:
                    new = True
                else:
                    (first_id, first_start), ends = first
                    if (first_id, first_start + ends - length) < (doc_id, start + i - length + 1):
                        out.append(i - length + 1)
        if new:
            automaton.add(words, (doc_id, start))
        yield out


def _match_shards(length: int):
    """Rows of one shard at a time; runs [lo, hi] of starts of passages that start earlier."""
    schema = pa.schema([("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def flush(rows: list[dict]) -> pa.RecordBatch:
        unpacker = zstandard.ZstdDecompressor()
        parts = []
        for r in rows:
            columns = np.frombuffer(unpacker.decompress(r["places"]), "<i8").reshape(len(_PLACE.names), -1)
            parts.append(np.zeros(columns.shape[1], _PLACE))
            for name, column in zip(_PLACE.names, columns, strict=True):
                parts[-1][name] = column
        places = np.concatenate(parts)
        texts = [t for r in rows for t in unpacker.decompress(r["texts"]).split(b"\n")]
        order = np.lexsort((places["start"], places["doc_id"], places["anchor"]))
        places = places[order]
        bounds = np.flatnonzero(np.diff(places["anchor"], prepend=places["anchor"][:1] - 1, append=places["anchor"][-1:] + 1))
        keys, los, his = [], [], []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            some = places[a:b]
            stretches = [texts[i].split(b" ") for i in order[a:b].tolist()]
            where = list(zip(some["doc_id"].tolist(), some["start"].tolist(), strict=True))
            for key, (_, start), hit in zip(some["key"].tolist(), where, earlier_passages(stretches, where, length), strict=True):
                at = 0
                while at < len(hit):
                    end = at
                    while end + 1 < len(hit) and hit[end + 1] == hit[end] + 1:
                        end += 1
                    keys.append(key)
                    los.append(start + hit[at])
                    his.append(start + hit[end])
                    at = end + 1
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(los, pa.int32()), pa.array(his, pa.int32())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != shard and held:
                    yield flush(held)
                    held = []
                shard = r["shard"]
                held.append(r)
        if held:
            yield flush(held)
        give_back()

    return run


def _single_passages(length: int, gram: int):
    """Each passage of frequent anchors by its hash."""
    schema = pa.schema([("code", pa.binary()), ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, places, lo, hi in _stretches(batch, length, gram, True):
                data = words.data.tobytes()
                counts = hi - lo - length + 1
                which = np.repeat(np.arange(len(places)), counts)
                inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = lo[which] + inside
                codes = [hashlib.blake2b(_join_words(words, data, a, a + length), digest_size=16).digest() for a in at.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes, pa.binary()), pa.array(places["key"][which]), pa.array(places["doc_id"][which]), pa.array(places["start"][which] + inside)], schema=schema
                )

    return run


def _cut_out(length: int, with_text: bool):
    names = ["doc_id", "unnamed", "n_words", "n_removed", "kept_sha256", "spans", *(["kept_text"] if with_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            for lo, hi in W.slices(batch.column("text")):
                words = W.cut(batch.column("text")[lo:hi], W.NOT_SPACE, lower=False)
                drop = np.zeros(len(words.start) + 1, np.int64)
                for row in range(lo, hi):
                    found = runs[row].as_py()
                    if found:
                        bounds = words.first[row - lo] + np.array([(r["lo"], r["hi"] + length) for r in found])
                        np.add.at(drop, bounds[:, 0], 1)
                        np.add.at(drop, bounds[:, 1], -1)
                gone = np.cumsum(drop)[:-1] > 0
                kept = np.flatnonzero(~gone)
                text = words.text_of_word()
                n_kept = np.bincount(text[kept], minlength=hi - lo)
                # each kept word with the byte behind it, turned into a space; none behind the last one of a text
                data = words.data.copy()
                final = np.ones(len(kept), bool)
                final[:-1] = text[kept][1:] != text[kept][:-1]
                data[words.end[kept[~final]]] = 0x20
                edge = np.zeros(len(data) + 2, np.int32)
                np.add.at(edge, words.start[kept], 1)
                np.add.at(edge, words.end[kept] + ~final, -1)
                stays = np.cumsum(edge)[: len(data)] > 0
                sizes = np.zeros(hi - lo, np.int64)
                np.add.at(sizes, text[kept], words.end[kept] - words.start[kept] + ~final)
                rest = data[stays].tobytes()
                ends = np.cumsum(sizes)
                texts = [rest[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                opens, closes = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                spans: list[list[dict]] = [[] for _ in range(hi - lo)]
                for a, b in zip(opens.tolist(), closes.tolist(), strict=True):
                    while a < b:  # a run may go on into the next text
                        t = int(text[a])
                        stop = min(b, int(words.first[t + 1]))
                        spans[t].append({"lo": a - int(words.first[t]), "hi": stop - int(words.first[t])})
                        a = stop
                columns = [
                    batch.column("doc_id")[lo:hi],
                    batch.column("unnamed")[lo:hi],
                    pa.array(words.counts, pa.int64()),
                    pa.array(words.counts - n_kept, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                ]
                if with_text:
                    columns.append(pa.array([t.decode("utf-8", "replace") for t in texts]))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def repeated_runs(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, runs): first and last starts [lo, hi] of neighbouring passages of `length` words that also start earlier."""
    anchors = keyed.select("key", "text").mapInArrow(_anchors(length, gram), "key long, anchor long, at int")
    repeated = cut_lineage(anchors.groupBy("anchor").count().filter("count > 1").select("anchor", "count"))
    shards = max(1, -(-(repeated.agg(F.sum("count")).first()[0] or 0) // SHARD_STRETCHES))
    marked = F.when(F.col("count") > ANCHOR_STRETCHES, F.bitwise_not("at")).otherwise(F.col("at"))
    found = anchors.join(repeated, "anchor").groupBy("key").agg(F.collect_list(marked).alias("found"))
    # all columns of `keyed`, so that remove_repeats joins over the same exchange of texts
    rows = keyed.join(found, "key").select(*keyed.columns, "found")
    packed = rows.mapInArrow(_pack(length, gram, shards), "shard int, places binary, texts binary")
    met = packed.repartition(shards, "shard").sortWithinPartitions("shard")
    runs = met.mapInArrow(_match_shards(length), "key long, lo int, hi int")
    single = rows.filter(F.exists("found", lambda f: f < 0)).mapInArrow(_single_passages(length, gram), "code binary, key long, doc_id long, start long")
    first = single.groupBy("code").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = single.join(first, "code").filter(F.struct("doc_id", "start") > F.col("first"))
    later = later.select("key", F.col("start").cast("int").alias("lo"), F.col("start").cast("int").alias("hi"))
    return runs.union(later).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (and kept_text) for each row of (doc_id, text).

    `spans` are the removed [first, last) word numbers. A null text is empty and has no words; a null doc_id comes before
    all others. Equal rows are one document and share their result; rows of one doc_id with different texts are ordered by
    the start of the passage alone. Further columns are ignored. An empty table gives no rows.
    """
    keyed, repeated = _keyed(docs)
    runs = repeated_runs(keyed.dropDuplicates(["key"]) if repeated else keyed)
    extra = ", kept_text string" if with_text else ""
    out = (
        keyed.join(runs, "key", "left")
        .select("doc_id", "unnamed", "text", "runs")
        .mapInArrow(_cut_out(LENGTH, with_text), f"doc_id long, unnamed boolean, n_words long, n_removed long, kept_sha256 string, spans array<struct<lo:long,hi:long>>{extra}")
    )
    return out.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id"))).drop("unnamed")
