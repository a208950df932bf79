"""Words of a batch of texts as flat arrays, hashed and windowed without a loop over rows.

A batch is cut into slices of bounded bytes; a single text longer than that is a slice of its own.
Word hashes have 64 bits: words of up to eight bytes of one length never collide, others do with chance 2^-64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_LONG_WORD = 64  # bytes from which a word is hashed on its own
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_KEEP = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# bytes that words consist of
NOT_SPACE = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = ~_byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # after lower-casing; every byte beyond ASCII counts
LETTERS = ALPHANUMERIC & ~_byte_set((0x30, 0x39))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts in order: byte bounds in `data`, the first word of each text, the hashes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # texts + 1 entries
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def raw(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the texts (one more than texts, from 0) and their bytes; a null is empty."""
    offsets, data = _buffers(column)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return offsets - lo, data[lo:hi]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes of text, or of one row."""
    if not len(column):
        return
    offsets, _ = _buffers(column)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, stop
        row = stop


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    h = mix(length.astype(np.uint64) * _ODD + np.uint64(1))
    at = 0
    while at < _LONG_WORD:
        if at == 0:
            chunk = eight[start] & _KEEP[np.minimum(length, 8)]
            h = mix((h ^ chunk) * _ODD)
        else:
            live = np.flatnonzero(length > at)
            if not len(live):
                break
            chunk = eight[start[live] + at] & _KEEP[np.minimum(length[live] - at, 8)]
            h[live] = mix((h[live] ^ chunk) * _ODD)
        at += 8
    for i in np.flatnonzero(length > _LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def cut(column: pa.Array, members: np.ndarray, lower: bool) -> Words:
    """Maximal runs of member bytes of each text (null: none)."""
    offsets, data = _buffers(column)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    data = data[lo:hi]
    offsets = offsets - lo
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = members[data]
    body = inside[1:-1]
    opens = body & ~inside[:-2]
    closes = body & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = body[edges]  # no word runs on into the next text
    closes[edges - 1] = body[edges - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets, side="left").astype(np.int64)
    return Words(data, start, end, first, hash_words(data, start, end))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n words from each position on, and whether they lie within one text."""
    total = len(words.hash)
    if total < n:
        return np.zeros(total, np.uint64), np.zeros(total, bool)
    h = np.zeros(total - n + 1, np.uint64)
    for i in range(n):
        h = mix(h * _ODD + words.hash[i : total - n + 1 + i])
    last = np.repeat(words.first[1:], words.counts)  # end of the text of each word
    fits = np.arange(total) + n <= last
    return np.concatenate([h, np.zeros(n - 1, np.uint64)]), fits


def winnow(h: np.ndarray, fits: np.ndarray, window: int) -> np.ndarray:
    """Positions holding the smallest hash (leftmost on ties) of some run of `window` positions of one text.

    `fits` marks positions that hold a gram; a run must consist of such positions only.
    """
    return winnow_runs(h, fits, window)[0]


def winnow_runs(h: np.ndarray, fits: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `winnow`, with the first and the last run that each position wins; every run has one winner."""
    if len(h) < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    whole = np.cumsum(np.concatenate([[0], fits]))
    runs = np.flatnonzero(whole[window:] - whole[:-window] == window)
    winner = np.empty(len(runs), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, window)
    for at in range(0, len(runs), 1 << 17):
        part = runs[at : at + (1 << 17)]
        winner[at : at + (1 << 17)] = part + view[part].argmin(axis=1)
    # the runs of one winner follow one another
    first = np.flatnonzero(np.diff(winner, prepend=-1))
    last = np.append(first[1:], len(runs)) - 1 if len(first) else first
    return winner[first], runs[first], runs[last]


def join_kept(words: Words, kept: np.ndarray) -> pa.Array:
    """Of each text, the words marked in `kept` (one flag a word), joined by one space."""
    which = np.flatnonzero(kept)
    text = words.text_of_word()[which]
    final = np.ones(len(which), bool)
    final[:-1] = text[1:] != text[:-1]
    data = words.data.copy()
    data[words.end[which[~final]]] = 0x20  # a word that is not the last of its text has a byte of space behind it
    stop = words.end[which] + ~final
    edges = np.zeros(len(data) + 1, np.int8)
    edges[words.start[which]] += 1
    np.subtract.at(edges, stop, 1)
    sizes = np.bincount(text, weights=stop - words.start[which], minlength=len(words.first) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    joined = data[np.cumsum(edges, dtype=np.int8)[:-1].astype(bool)]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(joined)).cast(pa.string())
