"""Personal data: fixed patterns, and a skip-chain conditional random field for what they miss.

The field labels the tokens of a text as one of the four kinds or as other. Tokens inside pattern matches are evidence and
take no messages; neighbours share a weak potential. Tokens that repeat or resemble a matched one (an address without its
host, a number written another way) hear from the nearest such token over a strong link however far away it is, and do not
answer: a mention without a label of its own is no evidence for being other. Loopy belief propagation spreads the evidence,
so a thing is labelled alike wherever and however often it occurs in a document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import BATCH_ROWS

KINDS = ["email", "ip", "card", "phone"]
ADDED = [f"{k}_like" for k in KINDS]  # kinds of the spans that the field adds
ORDER = {k: i for i, k in enumerate(KINDS + ADDED)}

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_TOKEN = re.compile(r"\S+")
_MARKS = ".,;:!?()[]{}<>\"'"


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern; each @ is tried once, so long runs without one cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        host = _HOST.match(text, at) if start < at else None
        if host:
            out.append((start, host.end()))
            done = host.end()
            at = text.find("@", done)
        else:
            done = at + 1  # what stands before this @ belongs to no later match
            at = text.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns, by start, then kind."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]], s[2]))


# -- the field ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """Log potentials; states are other and the four kinds."""

    other: float = 3.0  # of a token without evidence for being other
    fixed: float = 12.0  # of a token inside a pattern match for its kind
    cue: float = 1.0  # of a token behind a word that announces a kind
    shape: float = 1.0  # of a token shaped like a kind
    neighbour: float = 0.3  # of two neighbours with one state
    skip: float = 4.5  # of a token with the state of the distant one that it hears from
    rounds: int = 20
    damping: float = 0.3


# words that announce a kind (fixed values)
CUES = {"email": 1, "e-mail": 1, "mail": 1, "ip": 2, "host": 2, "server": 2, "card": 3, "visa": 3, "phone": 4, "tel": 4, "call": 4, "fax": 4, "mobile": 4}


LEAST_PART = 4  # digits of a token by which a number over several tokens is known; fewer (+1, 20) occur anywhere


def _resemblance(token: str) -> list[str]:
    """Names under which a token resembles others; words without anything of personal data have none."""
    plain = token.strip(_MARKS).lower()
    out = []
    if "@" in plain:
        local = plain.split("@")[0]
        out.append(plain)
        if len(local) >= 5 or any(c in "0123456789._" for c in local):
            out.append(local)
    elif any(c.isdigit() for c in plain) or (len(plain) >= 3 and "." in plain):
        out.append(plain)
    digits = _NOT_DIGIT.sub("", plain)
    if len(digits) >= 7:
        out.append("#" + digits[-7:])
    return out


def skip_links(names: dict[str, list[int]], fixed: np.ndarray) -> list[tuple[int, int]]:
    """Links (from, to) that lead away from fixed tokens, at most one a name and token.

    A token hears from the nearest fixed one of each of its names. Names without a fixed one lead on from the tokens that were
    reached before, to those that were not.
    """
    known, out = fixed.copy(), []
    left = {name: np.unique(held) for name, held in names.items()}
    of_token: dict[int, list[str]] = {}
    for name, held in left.items():
        for i in held.tolist():
            of_token.setdefault(i, []).append(name)
    turn = [name for name, held in left.items() if known[held].any()]
    while turn:
        found = []
        for name in turn:
            held = left.pop(name)
            sources, others = held[known[held]], held[~known[held]]
            at = np.searchsorted(sources, others)
            before, behind = sources[np.maximum(at - 1, 0)], sources[np.minimum(at, len(sources) - 1)]
            nearest = np.where(np.abs(others - before) <= np.abs(behind - others), before, behind)
            out += zip(nearest.tolist(), others.tolist(), strict=True)
            found += others.tolist()
        known[found] = True  # after the turn, so that all names with a fixed token start from those alone
        turn = list(dict.fromkeys(name for i in found for name in of_token[i] if name in left))
    return out


def field_of(text: str, base: list[tuple[str, int, int]], field: Field) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a text, their potentials, the links (pairs of tokens), their weights, which lead one way, which tokens are fixed."""
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    unary = np.zeros((len(tokens), len(KINDS) + 1))
    unary[:, 0] = field.other
    starts = np.array([t[0] for t in tokens])
    fixed, part = np.zeros(len(tokens), bool), np.zeros(len(tokens), bool)
    names: dict[str, list[int]] = {}
    for kind, lo, hi in base:
        first = max(int(np.searchsorted(starts, lo, side="right")) - 1, 0)
        inside = range(first, int(np.searchsorted(starts, hi, side="left")))
        for i in inside:
            unary[i, 0] = 0.0
            unary[i, KINDS.index(kind) + 1] += field.fixed
            fixed[i] = True
            part[i] |= len(inside) > 1
        digits = _NOT_DIGIT.sub("", text[lo:hi])
        if len(digits) >= 7 and len(inside):  # a number over several tokens goes by its first one
            names.setdefault("#" + digits[-7:], []).append(inside[0])
    for i, (lo, hi) in enumerate(tokens):
        token = text[lo:hi]
        if i and (cue := CUES.get(text[slice(*tokens[i - 1])].strip(_MARKS).lower())):
            unary[i, cue] += field.cue
        if not fixed[i]:
            if "@" in token[1:-1]:
                unary[i, 1] += field.shape
            elif token.count(".") == 3 and token.strip(_MARKS).replace(".", "").isdigit():
                unary[i, 2] += field.shape
        if part[i] and sum(map(str.isdigit, token)) < LEAST_PART:
            continue
        for name in _resemblance(token):
            names.setdefault(name, []).append(i)
    skips = dict.fromkeys(skip_links(names, fixed))
    links = [(i, i + 1) for i in range(len(tokens) - 1) if (i, i + 1) not in skips and (i + 1, i) not in skips]
    pairs = np.array([*links, *skips], np.int64).reshape(-1, 2)
    one_way = np.arange(len(pairs)) >= len(links)
    return tokens, unary, pairs, np.where(one_way, field.skip, field.neighbour), one_way, fixed


def beliefs(unary: np.ndarray, pairs: np.ndarray, weights: np.ndarray, rounds: int, damping: float, one_way: np.ndarray | None = None, fixed: np.ndarray | None = None) -> np.ndarray:
    """Log marginals by sum-product message passing, all messages at once; exact where the links form no loop.

    Links that lead one way carry no message from their second token to their first; fixed tokens receive none.
    """
    states = unary.shape[1]
    if not len(pairs):
        return unary - np.logaddexp.reduce(unary, axis=1, keepdims=True)
    source = np.concatenate([pairs[:, 0], pairs[:, 1]])
    target = np.concatenate([pairs[:, 1], pairs[:, 0]])
    back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
    gain = np.expm1(np.concatenate([weights, weights]))[:, None]
    silent = np.zeros(len(source), bool)
    if one_way is not None:
        silent[len(pairs) :] = one_way
    if fixed is not None:
        silent |= fixed[target]
    messages = np.zeros((len(source), states))
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, target, messages)
        out = belief[source] - messages[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(out.sum(axis=1, keepdims=True) + gain * out)  # equal states gain by the weight
        new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
        new[silent] = 0.0
        change = np.abs(new - messages).max()
        messages = damping * messages + (1 - damping) * new
        if change < 1e-6:
            break
    belief = unary.copy()
    np.add.at(belief, target, messages)
    return belief - np.logaddexp.reduce(belief, axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[str, int, int]], field: Field) -> list[tuple[str, int, int]]:
    """Tokens that the field labels beside the pattern matches; evidence starts at matches, so without one there are none."""
    if not base:
        return []
    tokens, unary, pairs, weights, one_way, fixed = field_of(text, base, field)
    if not one_way.any():
        return []
    labels = beliefs(unary, pairs, weights, field.rounds, field.damping, one_way, fixed).argmax(axis=1)
    out = []
    for i in np.flatnonzero((labels > 0) & ~fixed):
        lo, hi = tokens[i]
        while lo < hi and text[lo] in _MARKS:
            lo += 1
        while hi > lo and text[hi - 1] in _MARKS:
            hi -= 1
        if lo < hi:
            out.append((ADDED[labels[i] - 1], lo, hi))
    return out


def all_spans(text: str, field: Field = Field()) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and base and added ones together, each by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, field), key=lambda s: (s[1], ORDER[s[0]], s[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _find(field: Field):
    def listed(spans):
        return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                found = [all_spans(t.as_py() or "", field) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([listed(b) for b, _ in found], pa.list_(_SPAN)), pa.array([listed(s) for _, s in found], pa.list_(_SPAN))],
                    names=["doc_id", "base", "found"],
                )

    return run


def personal_data(docs: DataFrame, field: Field = Field()) -> DataFrame:
    """doc_id, base, found for each row of (doc_id, text): spans (kind, start, end) of the patterns, and those with added ones.

    Positions count code points, ends are exclusive. Null and empty texts have no spans. Repeated rows get equal results;
    further columns are ignored. Added spans are of kinds of their own (email_like and so on), base spans stay as they are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    span = "array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(_find(field), f"doc_id {kind}, base {span}, found {span}")


def _joined(spans: str):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of `personal_data`; the counts are of base spans, the added kinds are others."""

    def of_kind(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("found").alias("spans"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first is named."""
    out, at = [], 0
    for kind, lo, hi in spans:
        if lo >= at:
            out += [text[at:lo], f"[{kind}]"]
        at = max(at, hi)
    return "".join([*out, text[at:]])
