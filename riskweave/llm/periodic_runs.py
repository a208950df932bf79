"""Runs of words that repeat with a period, by seeds on diagonals that are extended.

A run of period q and length L = max(least, repeats * q) or more matches itself q words on over L - q words. Lags are taken
in bands: the first reaches up to k, the smallest such overlap of any period, each further one to twice the lag before. A
seed of a band is a pair of neighbouring occurrences of one k-gram at a lag of the band, k being the largest lag of it.
Every overlap in the band holds whole k-grams, and between two occurrences at a run's smallest period there is no third:
it would give the stretch a smaller period still. So neighbouring occurrences suffice, and there are at most as many seeds
as words in a band, however often a gram recurs. Seeds that lie within what their lag has covered are passed over; the
others are extended word by word to either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import give_back

LEAST = 24  # words of a run
REPEATS = 3  # periods of a run
FIRST_STRIDE = 64  # words compared at once when a seed is extended, doubled from step to step


def guaranteed_overlap(least: int, repeats: int) -> int:
    """The words over which any run at least matches itself one period on, for periods up to that number."""
    return min(max(least, repeats * q) - q for q in range(1, least + 1))


def _joined_grams(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Hash of the gram of `a` at each place and that of `b` `shift` words on (garbage at the end, where none is)."""
    out = np.zeros(len(a), np.uint64)
    if shift < len(a):
        out[: len(a) - shift] = W.mix(a[: len(a) - shift] * np.uint64(0x9E3779B97F4A7C15) + b[shift:])
    return out


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, from grams of powers of two."""
    whole, size, power = None, 0, h
    for bit in range(k.bit_length()):
        if k >> bit & 1:
            whole = power if whole is None else _joined_grams(whole, power, size)
            size += 1 << bit
        power = _joined_grams(power, power, 1 << bit)
    return whole


def _neighbours(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of neighbouring occurrences of one key; `at` are the places of the keys, ascending."""
    if not len(key):
        return at, at
    bits = max(10, int(len(key)).bit_length() + 2)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    some = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)  # a key alone in its slot occurs once
    key, at = key[some], at[some]
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    same = key[1:] == key[:-1]
    return at[:-1][same], at[1:][same]


def seeds(words: W.Words, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, place, lag) of each band, from neighbouring occurrences of one k-gram in one text at lags of the band."""
    total = len(words.hash)
    text = words.text_of_word()
    last = words.first[1:][text] if total else np.zeros(0, np.int64)
    h = _grams(words.hash, k)
    own = text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at = np.flatnonzero(np.arange(total) + k <= last)
    low = 0
    while len(at):
        a, b = _neighbours(W.mix(h[at] ^ own[at]), at)
        lag = b - a
        mine = (lag > low) & (lag <= k)
        yield k, a[mine], lag[mine]
        # a gram of twice the size recurs only if both its halves do
        again = np.zeros(total, bool)
        again[a] = again[b] = True
        at = np.flatnonzero(again[: max(total - k, 0)] & again[k:])
        at = at[at + 2 * k <= last[at]]
        h = _joined_grams(h, h, k)
        low, k = k, 2 * k


def _matching(h: np.ndarray, at: int, lag: int, stop: int, step: int) -> int:
    """The first place from `at` towards `stop` (not reached) where words `lag` apart differ."""
    stride = FIRST_STRIDE
    while at != stop:
        size = min(stride, abs(stop - at))
        lo = at if step > 0 else at - size + 1
        differ = np.flatnonzero(h[lo : lo + size] != h[lo + lag : lo + lag + size])
        if len(differ):
            return lo + int(differ[0] if step > 0 else differ[-1])
        at += step * size
        stride *= 2
    return stop


def runs_of(words: W.Words, least: int = LEAST, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(words.first) - 1)]
    h, first = words.hash, words.first
    for k, place, lag in seeds(words, guaranteed_overlap(least, repeats)):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        follows = np.zeros(len(place), bool)  # the seed one word before covers this one
        follows[1:] = (lag[1:] == lag[:-1]) & (place[1:] == place[:-1] + 1)
        place, lag = place[~follows], lag[~follows]
        texts = np.searchsorted(first, place, side="right") - 1
        covered: dict[int, int] = {}  # of each lag: the first word that no extension has reached
        for at, q, t in zip(place.tolist(), lag.tolist(), texts.tolist(), strict=True):
            if at < covered.get(q, 0):
                continue
            lo, hi = int(first[t]), int(first[t + 1])
            end = _matching(h, at, q, hi - q, 1)
            start = _matching(h, at, q, lo - 1, -1) + 1
            covered[q] = end
            length = end - start + q
            if length >= max(least, repeats * q):
                out[t].append((start - lo, length, q))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the most periods, exactly; ties go to the smaller start, then to the smaller period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(least: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in W.slices(batch.column("text")):
                words = W.cut(batch.column("text")[lo:hi], W.NOT_SPACE, lower=False)
                found = runs_of(words, least, repeats)
                edges = np.zeros(len(words.hash) + 1, np.int64)
                for t, runs in enumerate(found):
                    for start, length, period in runs:
                        edges[words.first[t] + start + period] += 1
                        edges[words.first[t] + start + length] -= 1
                kept = np.cumsum(edges)[:-1] == 0
                best = [_strongest(runs) or (None, None, None) for runs in found]
                columns = [pa.array([b[i] for b in best], pa.int64()) for i in range(3)]
                runs = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], pa.list_(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[lo:hi], pa.array(words.counts, pa.int64()), pa.array([len(r) for r in found], pa.int64()), *columns, runs, W.join_kept(words, kept)],
                    names=["doc_id", "n_words", "n_runs", "start", "length", "period", "runs", "collapsed"],
                )
        give_back()

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """doc_id, n_words, n_runs, start, length, period, runs, collapsed for each row of (doc_id, text).

    A run is a stretch of words with smallest period q, at least max(least, repeats * q) words long, that neither neighbour
    extends; repeats must be 3 or more. `start`, `length` and `period` are those of the run of the most periods (ties: the
    smaller start, then the smaller period), null without a run; `runs` lists all by start, then period. `collapsed` holds
    the words that no run contains behind its first period, joined by one space. A null text has no words. Every row is
    judged on its own, so null and repeated identifiers, equal rows and further columns change nothing; an empty table
    gives no rows. Memory grows with the longest single text, work in proportion to its words times the log of its length.
    """
    if repeats < 3 or least < 2:
        raise ValueError("runs need at least three periods and two words")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shape = "n_words long, n_runs long, start long, length long, period long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_collapse(least, repeats), f"doc_id {kind}, {shape}")


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with loops written into the texts of one identifier in ten, where and how long by a hash of it.

    Of h = crc32 of the decimal doc_id and g = h div 10, texts of n > 0 words with h mod 10 = 0 repeat from word a = g mod n
    on the next 1 + (n - a) div (3 + g mod 8) words up to their end. Other texts, and those without an identifier, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    looped = """
        transform(sequence(0, size(_words) - 1), i -> _words[int(CASE WHEN i < _g % size(_words) THEN i
            ELSE _g % size(_words) + (i - _g % size(_words)) % (1 + (size(_words) - _g % size(_words)) div (3 + _g % 8)) END)])
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("_h"))
    rows = rows.withColumns({"_g": F.expr("_h div 10"), "_words": F.when(F.col("_h") % 10 == 0, words)})
    text = F.when(F.size("_words") > 0, F.array_join(F.expr(looped), " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
