"""Language of texts and of their spans.

Each word is scored under every learned language by the byte trigrams of the word; the script of its first letter leaves
only languages that use that script. Viterbi with a penalty for switching then labels the words of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import give_back, held_out, thinned

TRAIN_DOCS = 1000  # training texts of each language, those of the smallest hash of their identifier
BUCKETS = 1 << 16  # of hashed trigrams
SWITCH = 12.0  # nats that a change of language costs
SCRIPT_SHARE = 0.01  # of its training words that a language must write in a script to be a candidate there
UNKNOWN = "und"
SLICE = 2 << 20

# Unicode ranges of scripts (fixed values)
SCRIPTS = [
    ("latin", [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("kana", [(0x3040, 0x30FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)]),
    ("hangul", [(0xAC00, 0xD7AF)]),
]


def _script_table() -> np.ndarray:
    """Script number by the first two bytes of a character (one byte and zero for ASCII); 0 is none."""
    out = np.zeros(1 << 16, np.int8)
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for lo, hi in ranges:
            for point in range(lo, hi + 1):
                raw = chr(point).encode("utf-8", "surrogatepass")
                if len(raw) == 1:
                    out[raw[0] << 8 : (raw[0] + 1) << 8] = number
                else:
                    out[raw[0] << 8 | raw[1]] = number
    return out


_SCRIPT = _script_table()


@dataclass
class LanguageModel:
    languages: list[str]  # sorted
    trigrams: np.ndarray  # log probabilities, buckets x languages
    allowed: np.ndarray  # scripts x languages


def _trigram_codes(data: np.ndarray) -> np.ndarray:
    a, b, c = (data[i : len(data) - 2 + i].astype(np.uint64) for i in range(3))
    return (W.mix(a | b << np.uint64(8) | c << np.uint64(16)) % np.uint64(BUCKETS)).astype(np.int64)


def _padded(words: W.Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words with a border byte around each, and the word of each trigram."""
    sizes = words.end[which] - words.start[which]
    stop = np.cumsum(sizes + 1)
    out = np.ones(int(stop[-1]) + 1 if len(stop) else 1, np.uint8)
    owner = np.repeat(np.arange(len(which)), sizes)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(stop - sizes, sizes) + inner  # a border stands before each word
    out[at] = words.data[words.start[which][owner] + inner]
    return out, owner  # as many trigrams in a word as bytes, centred on them


def _scripts(words: W.Words, which: np.ndarray) -> np.ndarray:
    first = words.start[which]
    second = np.where(first + 1 < words.end[which], words.data[np.minimum(first + 1, len(words.data) - 1)], 0)
    return _SCRIPT[words.data[first].astype(np.int64) << 8 | second]


def _cut(column: pa.Array) -> W.Words:
    return W.cut(pc.utf8_lower(column), W.LETTERS, lower=False)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts of the training texts of each language, summed over the task."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        names = batch.column("lang").to_pylist()
        for lo, hi in W.slices(batch.column("text"), SLICE):
            words = _cut(batch.column("text")[lo:hi])
            if not len(words.start):
                continue
            data, owner = _padded(words, np.arange(len(words.start)))
            centre = np.flatnonzero(data != 1)
            codes = _trigram_codes(data)[centre - 1]
            text = words.text_of_word()
            scripts = _scripts(words, np.arange(len(words.start)))
            for name in set(names[lo:hi]):
                mine = np.array([n == name for n in names[lo:hi]])
                counts = total.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
                counts[:BUCKETS] += np.bincount(codes[mine[text[owner]]], minlength=BUCKETS)
                counts[BUCKETS:] += np.bincount(scripts[mine[text]], minlength=len(SCRIPTS) + 1)
    for name, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"lang": [name] * len(at), "bucket": at.astype(np.int32), "n": counts[at]})


def fit(docs: DataFrame, per_language: int = TRAIN_DOCS) -> LanguageModel | None:
    """Learn from rows with a language that are not held out; None if there are none."""
    ids = docs.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).filter(F.col("_lang").isNotNull() & ~held_out(F.col("_id")))
    order = [F.xxhash64("_id"), "_id"]
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(*order))
    ids = thinned(ids, per_language, order, "_lang").withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("_id").distinct()
    # bounded: per_language identifiers for each language
    rows = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.join(F.broadcast(ids), rows["doc_id"].eqNullSafe(ids["_id"]), "left_semi").select("lang", "text")
    counted = rows.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    if not counted.num_rows:
        return None
    names = counted.column("lang").to_pylist()
    languages = sorted(set(names))
    numbers = {name: i for i, name in enumerate(languages)}
    table = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(languages)))
    table[counted.column("bucket").to_numpy(), [numbers[n] for n in names]] = counted.column("n").to_numpy()
    seen = table[:BUCKETS] + 0.5
    scripts = table[BUCKETS:]
    return LanguageModel(languages, np.log(seen / seen.sum(axis=0)).astype(np.float32), scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))


def word_scores(words: W.Words, model: LanguageModel) -> np.ndarray:
    """Log scores of each word under each language, the best one at 0."""
    distinct, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    if not len(distinct):
        return np.zeros((0, len(model.languages)), np.float32)
    data, owner = _padded(words, first)
    codes = _trigram_codes(data)[np.flatnonzero(data != 1) - 1]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    scores = np.add.reduceat(model.trigrams[codes], starts, axis=0)
    allowed = model.allowed[_scripts(words, first)]
    none = ~allowed.any(axis=1)
    scores[none] = 0  # no learned language writes like that
    scores[~allowed & ~none[:, None]] = -1e4
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, -50)[back]


def _one_language(scores: np.ndarray, first: np.ndarray, switch: float) -> tuple[np.ndarray, np.ndarray]:
    """The language with the best sum in each text, and whether no switch can beat it.

    It cannot if no run of words gains more than two switches (one at either end of the text) even when each of
    its words takes its best language.
    """
    total = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0, dtype=np.float64)])
    sums = total[first[1:]] - total[first[:-1]]
    best = sums.argmax(axis=1)
    counts = np.diff(first)
    gain = np.concatenate([[0], np.cumsum(-scores[np.arange(len(scores)), np.repeat(best, counts)], dtype=np.float64)])  # best is at 0
    sure = np.ones(len(counts), bool)
    for i in np.flatnonzero(counts):
        g = gain[first[i] : first[i + 1] + 1]
        sure[i] = g[-1] - g[0] <= switch  # all gains are positive, so the whole text is the best run
    return best, sure


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word of several texts at once, a word of each text a step (ties: the earlier language)."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, counts = first[:-1][order], counts[order]
    width = scores.shape[1]
    came = np.zeros((len(scores), width), np.int16)
    value = np.zeros((len(order), width))
    live = len(order)
    for t in range(int(counts[0]) if len(counts) else 0):
        live = int(np.searchsorted(-counts[:live], -t, side="left"))
        at = begin[:live] + t
        if t:
            v = value[:live]
            top = v.argmax(axis=1)
            jump = v[np.arange(live), top] - switch
            stay = v >= jump[:, None]
            came[at] = np.where(stay, np.arange(width), top[:, None])
            value[:live] = np.where(stay, v, jump[:, None]) + scores[at]
        else:
            value[:live] = scores[at]
    out = np.zeros(len(scores), np.int64)
    state = value.argmax(axis=1)
    for t in range(int(counts[0]) - 1 if len(counts) else -1, -1, -1):
        live = int(np.searchsorted(-counts, -t, side="left"))
        at = begin[:live] + t
        out[at] = state[:live]
        state[:live] = came[at, state[:live]]
    return out


_SPAN = pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("lang", pa.string())])


def _labels(column: pa.Array, model: LanguageModel, switch: float) -> Iterator[tuple[int, int, list[str], np.ndarray, list[list[dict]]]]:
    """(first row, row behind, languages, scores, spans) of texts, slice by slice."""
    for lo, hi in W.slices(column, SLICE):
        part = column[lo:hi]
        words = _cut(part)
        scores = word_scores(words, model)
        best, sure = _one_language(scores, words.first, switch)
        path = np.repeat(best, words.counts)
        text = words.text_of_word()
        unsure = np.flatnonzero(~sure)
        if len(unsure):
            mine = ~sure[text]
            path[mine] = viterbi(scores[mine], np.concatenate([[0], np.cumsum(words.counts[unsure])]), switch)
        sizes = (words.end - words.start).astype(np.float64)
        width = len(model.languages)
        letters = np.bincount(text * width + path, weights=sizes, minlength=(hi - lo) * width).reshape(-1, width)
        total = np.zeros((hi - lo, width))
        np.add.at(total, text, scores)
        weight = np.exp(total - total.max(axis=1, keepdims=True))
        chosen = letters.argmax(axis=1)
        rows = np.arange(hi - lo)
        share = letters[rows, chosen] / np.maximum(letters.sum(axis=1), 1)
        sure_of = weight[rows, chosen] / weight.sum(axis=1)
        bounds = np.flatnonzero(np.diff(path, prepend=-1) | np.diff(text, prepend=-1))  # none in a slice without words
        spans: list[list[dict]] = [[] for _ in range(hi - lo)]
        for a, b in zip(bounds.tolist(), np.append(bounds, len(path))[1:].tolist(), strict=True):
            t = int(text[a])
            spans[t].append({"lo": a - int(words.first[t]), "hi": b - int(words.first[t]), "lang": model.languages[int(path[a])]})
        lettered = [any(map(str.isalpha, t)) if n and t else False for t, n in zip(part.to_pylist(), words.counts, strict=True)]
        named = [model.languages[c] if ok else UNKNOWN for c, ok in zip(chosen.tolist(), lettered, strict=True)]
        score = np.where(lettered, share * np.maximum(sure_of, 1 / width) if width > 1 else share, 0.0)
        yield lo, hi, named, score, [s if ok else [] for s, ok in zip(spans, lettered, strict=True)]


def _label(shared, switch: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, named, score, spans in _labels(batch.column("text"), shared.value, switch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], pa.array(named, pa.string()), pa.array(score), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "lang_pred", "score", "spans"])
            give_back()

    return run


def _known(shared, least: float, switch: float):
    """Rows with all their columns whose text has a known language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, named, score, _ in _labels(batch.column("text").cast(pa.string()), shared.value, switch):
                yield batch.slice(lo, hi - lo).filter(pa.array((np.array(named) != UNKNOWN) & (score >= least)))
            give_back()

    return run


def identify(docs: DataFrame, model: LanguageModel | None = None, switch: float = SWITCH) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans for each row of (doc_id, text, lang).

    A text without a letter, empty or null, is `und` with score 0, and so is every text if no row has a language to learn
    from. `spans` label word ranges (words are runs of letters); `score` is the share of letters in spans of the predicted
    language times its posterior over the whole text. Repeated rows get equal results; further columns are ignored.
    """
    model = model or fit(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if model is None:
        none = F.expr("cast(array() as array<struct<lo:bigint,hi:bigint,lang:string>>)")
        out = rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("spans"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of buckets for each language
        out = rows.mapInArrow(_label(shared, switch), f"doc_id {kind}, lang_pred string, score double, spans array<struct<lo:long,hi:long,lang:string>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")


def keep_identified(docs: DataFrame, least: float = 0.0, switch: float = SWITCH) -> DataFrame:
    """The rows of `docs` whose language is known with at least the score `least`, with all their columns.

    Each row is judged by its own text, whatever its identifier; a null text goes. No row is known if none has a language
    to learn from.
    """
    model = fit(docs)
    if model is None:
        return docs.limit(0)
    return docs.mapInArrow(_known(docs.sparkSession.sparkContext.broadcast(model), least, switch), docs.schema)
