"""Toxicity by non-negative positive-unlabelled learning.

The classifier sees confirmed toxic texts and unlabelled ones only. Its risk on the unlabelled side is corrected by the
class prior and kept from going negative: where the corrected part does, its gradient is turned round.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import words as W
from riskweave.llm.common import held_out, thinned, thinning

POSITIVES = 2500  # confirmed texts to learn from, those of the smallest hash of their identifier
UNLABELLED = 5000
LEAST_TEXTS = 3  # confirmed texts that a word must occur in to be a feature
LEAST_EXCESS = 4.0  # standard errors by which it must be more frequent there than in unlabelled texts
PREFIXES = (4, 5, 6, 7)  # bytes of the beginnings of words that are features beside the words
THRESHOLD = 0.3
ROUNDS = 400
STEP = 0.05
DECAY = 1e-3


@dataclass
class ToxicModel:
    words: np.ndarray  # sorted hashes of features
    weights: np.ndarray
    bias: float


def _cut(column: pa.Array) -> W.Words:
    return W.cut(pc.utf8_lower(column), W.LETTERS, lower=False)


def _features(words: W.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words and of their beginnings, each with the numbers of their words."""
    out = [(words.hash, np.arange(len(words.hash)))]
    for n in PREFIXES:
        longer = np.flatnonzero(words.end - words.start > n)
        start = words.start[longer]
        out.append((W.mix(W.hash_words(words.data, start, start + n) + np.uint64(n)), longer))
    return out


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in W.slices(batch.column("text")):
            words = _cut(batch.column("text")[lo:hi])
            text = words.text_of_word()
            found = _features(words)
            flat, owner = np.concatenate([h for h, _ in found]), np.concatenate([text[i] for _, i in found])
            order = np.argsort(owner, kind="stable")
            flat, first = flat[order], np.searchsorted(owner[order], np.arange(hi - lo + 1))
            bags = [np.unique(flat[a:b]).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("positive")[lo:hi], pa.array(bags, pa.binary())], names=["positive", "bag"])


def nnpu(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, width: int, prior: float, rounds: int = ROUNDS, step: float = STEP, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with logistic loss over sparse binary features.

    Risk: prior * mean loss(+1 | positive) + max(0, mean loss(-1 | unlabelled) - prior * mean loss(-1 | positive)).
    """
    n = len(positive)
    p, u = positive / max(positive.sum(), 1), ~positive / max((~positive).sum(), 1)
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        f = np.bincount(rows, weights=w[columns], minlength=n) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        as_negative = np.logaddexp(0, f)
        rest = (u * as_negative).sum() - prior * (p * as_negative).sum()
        unlabelled = u * s - prior * p * s  # slope of the corrected part
        slope = prior * p * (s - 1) + unlabelled if rest >= 0 else -unlabelled
        g = np.append(np.bincount(columns, weights=slope[rows], minlength=width), slope.sum())
        g[:-1] += decay * w[:-1] / max(width, 1)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> ToxicModel | None:
    """Learn from rows that are not held out; None without a confirmed toxic text.

    The prior is the share of toxic rows among the labelled training rows; other labels than confirmed toxic are not used.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").alias("_toxic")).filter(F.col("_id").isNotNull() & F.col("_toxic").isNotNull() & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    mean = known.agg(F.avg(F.col("_toxic").cast("double"))).first()[0]
    if not mean:
        return None
    prior = float(np.clip(mean, 0.01, 0.99))
    shuffled = [F.xxhash64("_id"), "_id"]
    chosen = thinned(known.filter("_toxic = 1"), positives, shuffled).orderBy(*shuffled).limit(positives).select("_id", F.lit(True).alias("positive"))
    others = docs.select(F.col("doc_id").cast("long").alias("_id")).filter(F.col("_id").isNotNull() & ~held_out(F.col("_id"))).distinct()
    chosen = chosen.union(thinned(others, unlabelled, shuffled).orderBy(*shuffled).limit(unlabelled).select("_id", F.lit(False).alias("positive")))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("text")).filter("text is not null")
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("positive", "text")  # bounded: positives + unlabelled identifiers
    with thinning(docs.sparkSession, max(positives, unlabelled)):
        found = rows.mapInArrow(_bags, "positive boolean, bag binary").toArrow()
    if not found.num_rows:
        return None
    positive = found.column("positive").to_numpy()
    order = np.lexsort((np.array([hash_of(b) for b in found.column("bag").to_pylist()], np.uint64), positive))  # rows come in any order
    bags = [np.frombuffer(b, np.uint64) for b in found.column("bag").to_pylist()]
    bags = [bags[i] for i in order]
    positive = positive[order]
    if not positive.any() or positive.all():
        return None
    sizes = [len(b) for b in bags]
    flat, owner = np.concatenate(bags), np.repeat(np.arange(len(bags)), sizes)
    vocabulary = telling_words(flat, positive[owner], int(positive.sum()), int((~positive).sum()))
    at = np.searchsorted(vocabulary, flat)
    hit = vocabulary[np.minimum(at, max(len(vocabulary) - 1, 0))] == flat if len(vocabulary) else np.zeros(len(flat), bool)
    weights, bias = nnpu(owner[hit], at[hit], positive, len(vocabulary), prior)
    return ToxicModel(vocabulary, weights, bias)


def telling_words(words: np.ndarray, positive: np.ndarray, n_positive: int, n_unlabelled: int) -> np.ndarray:
    """Sorted words that occur in clearly more of the confirmed texts than of the unlabelled ones."""
    seen, back = np.unique(words, return_inverse=True)
    a, b = np.bincount(back[positive], minlength=len(seen)), np.bincount(back[~positive], minlength=len(seen))
    p, u = a / n_positive, b / n_unlabelled
    both = (a + b) / (n_positive + n_unlabelled)
    error = np.sqrt(both * (1 - both) * (1 / n_positive + 1 / n_unlabelled))
    return seen[(a >= LEAST_TEXTS) & (p - u > LEAST_EXCESS * error)]


def hash_of(raw: bytes) -> int:
    values = np.frombuffer(raw, np.uint64)
    return int(W.mix(np.append(values, np.uint64(len(values)))).sum(dtype=np.uint64))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi in W.slices(batch.column("text")):
                words = _cut(batch.column("text")[lo:hi])
                total = np.full(hi - lo, model.bias)
                if len(model.words) and len(words.hash):
                    text, pairs = words.text_of_word(), []
                    for h, i in _features(words):
                        at = np.minimum(np.searchsorted(model.words, h), len(model.words) - 1)
                        hit = np.flatnonzero(model.words[at] == h)
                        pairs.append(np.stack([text[i[hit]], at[hit]], axis=1))
                    pairs = np.unique(np.concatenate(pairs), axis=0)  # a feature counts once in a text
                    total += np.bincount(pairs[:, 0], weights=model.weights[pairs[:, 1]], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[lo:hi], pa.array(1 / (1 + np.exp(-np.clip(total, -40, 40))))], names=["doc_id", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: ToxicModel | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of (doc_id, text), learning from labels (doc_id, toxic).

    Null and empty texts have no words and get the score of the bias alone. Without confirmed toxic training texts all
    scores are 0. Labels without identifier or value are skipped; of several for one identifier the largest counts.
    Repeated rows get equal results; further columns are ignored.
    """
    model = model or fit(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if model is None:
        out = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # at most the words of POSITIVES texts
        out = rows.mapInArrow(_score(shared), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
