"""Token ids as binary shards with a minimal perfect hash index.

A shard is three files: raw little-endian ids (`.ids`, two bytes each while the vocabulary allows), the index (`.idx`)
and nothing else to read a document by its key: the index gives its slot in constant time (one displacement, one record),
the record's stored fingerprint tells whether the key is there, and the id slice is range-read. Which shard holds a key is
found the same way: keys are dealt by hash to buckets, each a file with a perfect hash of its own (`keys/*.idx`).
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import cut_lineage, filesystem, give_back, in_runs, new_path

END_ID = 2
MAGIC = b"RWTOKIX1"
BUCKET_KEYS = 4  # mean keys of one displacement
READ_BYTES = 8 << 20
CACHE_WORDS = 600_000  # distinct words of each of the two stores of a worker
_ENCODE = 5_000  # words given to the tokenizer at once
_JOIN = 1_000  # words of letters joined to one text
SHARD_ROWS = 5_000  # about as many documents to a shard

_RECORD = np.dtype([("fingerprint", "<u8"), ("doc_id", "<i8"), ("named", "u1"), ("first", "<i8"), ("count", "<i8")])
_KEY = np.dtype([("fingerprint", "<u8"), ("doc_id", "<i8"), ("named", "u1"), ("shard", "S48"), ("copies", "<i8")])


# -- minimal perfect hash -------------------------------------------------------------------------


def key_hashes(doc_ids: np.ndarray, named: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of keys: identifier, whether there is one, number among rows of the same identifier.

    One to one for the first row of each identifier; further rows are told apart by a second mixing.
    """
    h = W.mix(doc_ids.view(np.uint64) ^ np.where(named, np.uint64(0), np.uint64(0x5851F42D4C957F2D)))
    return np.where(copy == 0, h, W.mix(h + copy.astype(np.uint64) * W._ODD))


def _slot(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    return (W.mix(h ^ (displacement.astype(np.uint64) * W._ODD)) % np.uint64(n)).astype(np.int64)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def build_hash(h: np.ndarray) -> np.ndarray:
    """Displacements (hash and displace) that send the n distinct hashes to the slots 0 .. n-1, one each.

    Buckets are placed from the largest on; each tries displacements until its keys fall into free slots.
    """
    n = len(h)
    buckets = max(1, -(-n // BUCKET_KEYS))
    out = np.zeros(buckets, np.uint32)
    if not n:
        return out
    bucket = _bucket(h, buckets)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(bounds)
    taken = np.zeros(n, bool)
    step = 64
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        keys = h[order[bounds[b] : bounds[b + 1]]]
        base = 0
        while True:
            tries = np.arange(base, base + step, dtype=np.uint64)
            slots = (W.mix(keys[None, :] ^ (tries[:, None] * W._ODD)) % np.uint64(n)).astype(np.int64)
            good = ~taken[slots].any(axis=1)
            if len(keys) > 1:
                s = np.sort(slots, axis=1)
                good &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            hit = np.flatnonzero(good)
            if len(hit):
                out[b] = base + hit[0]
                taken[slots[hit[0]]] = True
                break
            base += step
            if base >= 1 << 32:
                raise ValueError("keys have equal fingerprints")
            step = min(step * 2, 1 << 14)
        step = 64
    return out


class ShardIndex:
    """The index of one shard, read from its bytes."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token index")
        self.n, buckets, self.width = struct.unpack("<qqq", raw[8:32])
        self.displacements = np.frombuffer(raw, "<u4", buckets, 32)
        self.records = np.frombuffer(raw, _RECORD, self.n, 32 + 4 * buckets)

    @staticmethod
    def to_bytes(displacements: np.ndarray, records: np.ndarray, width: int) -> bytes:
        return MAGIC + struct.pack("<qqq", len(records), len(displacements), width) + displacements.astype("<u4").tobytes() + records.tobytes()

    def find(self, h: np.ndarray) -> np.ndarray:
        """Slots of key hashes; -1 where the stored fingerprint differs."""
        if not self.n:
            return np.full(len(h), -1, np.int64)
        slot = _slot(h, self.displacements[_bucket(h, len(self.displacements))], self.n)
        return np.where(self.records["fingerprint"][slot] == h, slot, -1)


# -- encoding -------------------------------------------------------------------------------------


class WordStore:
    """Ids of words by the hash of the word."""

    def __init__(self):
        self.known = np.zeros(0, np.uint64)  # sorted hashes
        self.bounds = np.zeros((0, 2), np.int64)  # of each, in the ids
        self.ids = np.zeros(0, np.uint32)

    def add(self, hashes: np.ndarray, flat: np.ndarray, bounds: np.ndarray) -> None:
        """Further words, by ascending hash."""
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")  # merges two sorted runs
        self.known, self.bounds = known[order], np.concatenate([self.bounds, bounds + len(self.ids)])[order]
        self.ids = np.concatenate([self.ids, flat])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return at, self.known[at] == hashes


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space, from the ids of their words.

    Words end at ASCII white space, where this kind of tokenizer always splits, and before closing punctuation that follows
    an ASCII letter; a tokenizer that lower-cases gets them so. Ids of words are kept by hash between texts, so a word is encoded once; of two stores of
    words the newer one fills up with all that are met, and then takes the place of the older one. Texts that may hold a
    special token are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        splits = json.dumps(spec["pre_tokenizer"])
        self.drops_space = "\\s" in splits and '"Removed"' in splits
        self.lowers = '"Lowercase"' in json.dumps(spec["normalizer"])
        suffix = spec["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece of text between splits
        if suffix:
            self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.newer, self.older = WordStore(), WordStore()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        ids: list[list[int]] = []
        for i in range(0, len(words), _ENCODE):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(words[i : i + _ENCODE], add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

    def _joined(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As `_each` for words of letters, from many in one text; told apart by the ids that end a piece.

        Each word has one such id or more; if there are as many in all as words, each has one.
        """
        for i in range(0, len(words), _JOIN):
            part = words[i : i + _JOIN]
            flat = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[flat])
            yield (flat, np.diff(ends, prepend=-1)) if len(ends) == len(part) else self._each(part)

    def _learn(self, hashes: np.ndarray, raw: list[bytes]) -> None:
        words = [r.decode("utf-8") for r in raw]
        letters = np.array([w.isalpha() for w in words], bool) & bool(self.ends_word.any() and self.drops_space)
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        found = [*self._joined([words[i] for i in np.flatnonzero(letters)]), self._each([words[i] for i in np.flatnonzero(~letters)])]
        sizes = np.concatenate([f[1] for f in found])
        bounds = np.empty((len(words), 2), np.int64)
        bounds[order, 1] = np.cumsum(sizes)
        bounds[order, 0] = bounds[order, 1] - sizes
        self.newer.add(hashes, np.concatenate([f[0] for f in found]), bounds)

    def _places(self, hashes: np.ndarray, raw: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Where the newer store has the ids of words, given by ascending hash; those it lacks are taken over or learned."""
        if len(self.newer.known) + len(hashes) > CACHE_WORDS:
            self.older, self.newer = self.newer, WordStore()
        _, there = self.newer.find(hashes)
        lacking = np.flatnonzero(~there)
        at, old = self.older.find(hashes[lacking])
        if old.any():
            bounds = self.older.bounds[at[old]]
            sizes = bounds[:, 1] - bounds[:, 0]
            stop = np.cumsum(sizes)
            self.newer.add(hashes[lacking[old]], self.older.ids[np.arange(sizes.sum()) - np.repeat(stop - sizes - bounds[:, 0], sizes)], np.stack([stop - sizes, stop], axis=1))
        new = lacking[~old]
        if len(new):
            self._learn(hashes[new], raw(new))
        return self.newer.bounds[self.newer.find(hashes)[0]]

    def encode(self, column: pa.Array, end: int | None = END_ID) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids one after another, ids of each text) for slices of the column; null is empty."""
        for lo, hi in W.slices(column):
            part = column[lo:hi]
            words = split_punctuation(W.cut(part, W.NOT_SPACE, lower=self.lowers))
            distinct, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
            bounds = self._places(distinct, lambda new: [words.raw(i) for i in first[new].tolist()])[back]
            sizes = bounds[:, 1] - bounds[:, 0]
            before = np.concatenate([[0], np.cumsum(sizes)])
            spot = np.arange(before[-1]) - np.repeat(before[:-1] - bounds[:, 0], sizes)
            flat = self.newer.ids[spot]
            cuts = before[words.first]
            special = words.data.tobytes().find(b"<|") >= 0
            if special or not self.drops_space or end is not None:
                texts = part.to_pylist() if special or not self.drops_space else None
                pieces = []
                for i in range(hi - lo):
                    if texts is not None and texts[i] and (not self.drops_space or "<|" in texts[i]):
                        pieces.append(self.whole(texts[i]))
                    else:
                        pieces.append(flat[cuts[i] : cuts[i + 1]])
                    if end is not None:
                        pieces[-1] = np.append(pieces[-1], np.uint32(end))
                yield np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
            else:
                yield flat, np.diff(cuts)


_STOPS = np.zeros(256, bool)
_STOPS[list(b".,;:!?*#$%&")] = True
_ASCII_LETTER = W.LETTERS & (np.arange(256) < 0x80)
_ASCII_LETTER[0x41:0x5B] = True


def split_punctuation(words: W.Words) -> W.Words:
    """Words cut before the punctuation marks that end them, where an ASCII letter stands before these."""
    stop = words.end.copy()
    live = np.arange(len(stop))
    while len(live):  # as often as the longest run of closing marks
        live = live[(stop[live] > words.start[live])]
        live = live[_STOPS[words.data[stop[live] - 1]]]
        stop[live] -= 1
    cut = np.flatnonzero((stop < words.end) & (stop > words.start))
    cut = cut[_ASCII_LETTER[words.data[stop[cut] - 1]]]
    head_end = words.end.copy()
    head_end[cut] = stop[cut]
    start = np.insert(words.start, cut + 1, stop[cut])
    end = np.insert(head_end, cut + 1, words.end[cut])
    hashes = words.hash.copy()
    hashes[cut] = W.hash_words(words.data, words.start[cut], stop[cut])
    hashes = np.insert(hashes, cut + 1, W.hash_words(words.data, stop[cut], words.end[cut]))
    added = np.concatenate([[0], np.cumsum(np.bincount(cut, minlength=len(words.start)))])
    return W.Words(words.data, start, end, words.first + added[words.first], hashes)


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, shared by its tasks."""
    return WordEncoder(path)


# -- writing and reading --------------------------------------------------------------------------

_MANIFEST = "shard int, path string, n long, ids long, width int"
_MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n", pa.int64()), ("ids", pa.int64()), ("width", pa.int32())])


def _write(folder: str, tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        fs, root = filesystem(folder)
        codec = encoder(tokenizer)
        width = 2 if codec.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4
        path = f"{root}/{shard:06d}-{uuid.uuid4().hex}"  # a repeated attempt writes beside, only listed files count
        ids, named, counts = [], [], []
        out = None
        for batch in batches:
            if out is None:
                out = fs.open_output_stream(f"{path}.ids")
            ids.append(batch.column("doc_id").fill_null(0).to_numpy())
            named.append(batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
            for flat, sizes in codec.encode(batch.column("text"), end):
                out.write(flat.astype(f"<u{width}").tobytes())
                counts.append(sizes)
        if out is None:
            return
        out.close()
        doc_ids, named, counts = np.concatenate(ids).astype(np.int64), np.concatenate(named), np.concatenate(counts)
        copy = _copies(doc_ids, named)
        h = key_hashes(doc_ids, named, copy)
        displacements = build_hash(h)
        slot = _slot(h, displacements[_bucket(h, len(displacements))], len(h))
        records = np.zeros(len(h), _RECORD)
        for name, values in (("fingerprint", h), ("doc_id", doc_ids), ("named", named), ("first", np.cumsum(counts) - counts), ("count", counts)):
            records[name][slot] = values
        with fs.open_output_stream(f"{path}.idx") as f:
            f.write(ShardIndex.to_bytes(displacements, records, width))
        give_back()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n": len(h), "ids": int(counts.sum()), "width": width}], _MANIFEST_ARROW)

    return run


def _copies(doc_ids: np.ndarray, named: np.ndarray) -> np.ndarray:
    """Number of each row among the rows of its identifier, in order."""
    order = np.lexsort((np.arange(len(doc_ids)), doc_ids, named))
    same = np.zeros(len(order), bool)
    same[1:] = (doc_ids[order][1:] == doc_ids[order][:-1]) & (named[order][1:] == named[order][:-1])
    run = np.arange(len(order)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    out = np.empty(len(order), np.int64)
    out[order] = run
    return out


def write_shards(docs: DataFrame, tokenizer: str, order: list[str] | None = None, end: int = END_ID, shards: int | None = None) -> DataFrame:
    """Write the ids of `docs` (doc_id, text and the columns of `order`) and return the manifest: shard, path, n, ids, width, start.

    Documents lie in ascending `order` (doc_id unless given) within and across shards, ties in no set order; a null key
    comes first. Null and empty texts are only the end id. Each shard is one task's range of the order.
    """
    spark = docs.sparkSession
    keys = order or ["doc_id"]
    if shards is None:
        shards = max(spark.sparkContext.defaultParallelism, -(-docs.count() // SHARD_ROWS))
    folder = new_path(spark, "tokens")
    filesystem_root(f"{folder}/keys")
    rows = docs.select(*dict.fromkeys(["doc_id", "text", *keys])).withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    placed = rows.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    manifest = cut_lineage(placed.mapInArrow(_write(folder, tokenizer, end), _MANIFEST))
    _write_keys(manifest, folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))


def _key_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mix(h) % np.uint64(buckets)).astype(np.int64)


def _keys(buckets: int):
    """A row for each identifier of a shard, with the bucket of its key and the number of its rows there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, path = filesystem(path)
                with fs.open_input_file(f"{path}.idx") as f:
                    records = ShardIndex(f.read()).records
                keys, copies = np.unique(records[["named", "doc_id"]], return_counts=True)
                doc_ids, named = keys["doc_id"].astype(np.int64), keys["named"].astype(bool)
                bucket = _key_bucket(key_hashes(doc_ids, named, np.zeros(len(keys), np.int64)), buckets)
                shard = pa.array([path.rsplit("/", 1)[1]] * len(keys), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(doc_ids), pa.array(named), shard, pa.array(copies.astype(np.int64))], names=["bucket", "doc_id", "named", "shard", "copies"])

    return run


def _write_buckets(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for rows in in_runs(batches, ["bucket"]):
            doc_ids, named = rows.column("doc_id").to_numpy(), rows.column("named").to_numpy()
            h = key_hashes(doc_ids, named, _copies(doc_ids, named))  # shards that hold one identifier are numbered in order
            displacements = build_hash(h)
            slot = _slot(h, displacements[_bucket(h, len(displacements))], len(h))
            records = np.zeros(len(h), _KEY)
            for name, values in (("fingerprint", h), ("doc_id", doc_ids), ("named", named), ("shard", rows.column("shard").to_pylist()), ("copies", rows.column("copies").to_numpy())):
                records[name][slot] = values
            bucket = rows.column("bucket")[0].as_py()
            with fs.open_output_stream(f"{root}/keys/{bucket:06d}.idx") as f:  # a repeated attempt writes the same bytes
                f.write(ShardIndex.to_bytes(displacements, records, 0))
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([len(h)], pa.int64())], names=["bucket", "n"])

    return run


def _write_keys(manifest: DataFrame, folder: str) -> None:
    """The index from keys to shards: as many buckets as shards, so that a bucket stays as small as a shard's index.

    An identifier has a key for each shard that it lies in, whatever the number of its rows there.
    """
    buckets = max(1, manifest.count())
    rows = manifest.select("path").repartition(buckets, "path").mapInArrow(_keys(buckets), "bucket long, doc_id long, named boolean, shard string, copies long")
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "named", "doc_id", "shard")
    dealt.mapInArrow(_write_buckets(folder), "bucket long, n long").agg(F.sum("n")).collect()
    fs, root = filesystem(folder)
    with fs.open_output_stream(f"{root}/keys/buckets") as f:
        f.write(struct.pack("<q", buckets))


def filesystem_root(folder: str) -> None:
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            fs, path = filesystem(shard["path"])
            with fs.open_input_file(f"{path}.idx") as f:
                index = ShardIndex(f.read())
            by_place = np.argsort(index.records["first"], kind="stable")
            keys = index.records[by_place]
            # each key goes through the hash, as a keyed reader's would; places are then read in file order
            slots = index.find(key_hashes(keys["doc_id"].astype(np.int64), keys["named"].astype(bool), _copies(keys["doc_id"].astype(np.int64), keys["named"].astype(bool))))
            if (slots != by_place).any():
                raise ValueError(f"index of {path} does not give its own keys")
            with fs.open_input_file(f"{path}.ids") as f:
                lo = 0
                while lo < len(slots):
                    begin = int(keys["first"][lo])
                    stop = int(np.searchsorted(keys["first"] + keys["count"], begin + READ_BYTES // index.width, side="right"))
                    hi = min(max(stop, lo + 1), len(slots))
                    size = int(keys["first"][hi - 1] + keys["count"][hi - 1]) - begin
                    f.seek(begin * index.width)
                    ids = np.frombuffer(f.read(size * index.width), f"<u{index.width}").astype("<u4")
                    if len(ids) != size:
                        raise ValueError(f"{path} ends early")
                    raw = memoryview(ids).cast("B")
                    some = keys[lo:hi]
                    at = (some["first"] - begin).tolist()
                    crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at, some["count"].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some["doc_id"].astype(np.int64), mask=some["named"] == 0),
                            pa.array(some["first"].astype(np.int64) + shard["start"]),
                            pa.array(some["count"].astype(np.int64)),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    lo = hi


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the shards, one task a shard."""
    rows = manifest.repartition(max(1, manifest.count()), "shard")
    return rows.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _hash_of(doc_id: int | None, copy: int) -> np.ndarray:
    return key_hashes(np.array([doc_id or 0], np.int64), np.array([doc_id is not None]), np.array([copy]))


def _record(fs: pafs.FileSystem, path: str, h: np.ndarray, kind: np.dtype):
    """The record of a key hash in an index and the width of the ids, by two range reads; None if absent."""
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_file(path) as f:
        head = f.read(32)
        if head[:8] != MAGIC:
            raise ValueError("not a token index")
        n, buckets, width = struct.unpack("<qqq", head[8:])
        if not n:
            return None
        f.seek(32 + 4 * int(_bucket(h, buckets)[0]))
        displacement = np.frombuffer(f.read(4), "<u4")
        f.seek(32 + 4 * buckets + kind.itemsize * int(_slot(h, displacement, n)[0]))
        record = np.frombuffer(f.read(kind.itemsize), kind)[0]
    return (record, width) if record["fingerprint"] == h[0] else None


def look_up(path: str, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
    """Ids of one document by its key, from a shard or from the folder of all shards; None if absent.

    A shard takes two range reads of its index and one of the ids. In a folder the key's bucket, read likewise, names the
    shard; a `copy` of an identifier that lies in several shards is counted through them.
    """
    fs, path = filesystem(path)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        with fs.open_input_file(f"{path}/keys/buckets") as f:
            buckets = struct.unpack("<q", f.read())[0]
        bucket = int(_key_bucket(_hash_of(doc_id, 0), buckets)[0])
        turn = 0
        while (found := _record(fs, f"{path}/keys/{bucket:06d}.idx", _hash_of(doc_id, turn), _KEY)) is not None:
            key = found[0]
            if copy < key["copies"]:
                return look_up(f"{path}/{key['shard'].decode()}", doc_id, copy)
            copy -= int(key["copies"])
            turn += 1
        return None
    found = _record(fs, f"{path}.idx", _hash_of(doc_id, copy), _RECORD)
    if found is None:
        return None
    record, width = found
    with fs.open_input_file(f"{path}.ids") as f:
        f.seek(int(record["first"]) * width)
        return np.frombuffer(f.read(int(record["count"]) * width), f"<u{width}").astype(np.uint32)

