"""Impact-ordered search, periodic runs and the filter audit beside plain Python."""

import hashlib
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm import filter_audit, impact_index, periodic_runs
from riskweave.llm import words as W
from riskweave.llm.queries import op12_periodic_runs

SPACE = re.compile("[ \t-\r]+")
ODD = [(None, "no id here at all"), (900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "one"), (905, "x" * 300_000), (906, "Ä ß 日本 é́"), (907, "a\x00b c"), (None, "a " * 30)]


def split(text):
    return [w for w in SPACE.split(text or "") if w]


# --- impact-ordered search


def vectors_of(spark, rows):
    shape = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return spark.createDataFrame(rows, shape).withColumns({c: F.lit(c) for c in ("block", "n", "shard", "vector", "query_id", "score", "row", "v")})


def best_of(rows, every=50, k=5):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (query, q) in enumerate(whole):
        if query is None or query % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), i is None, i or 0, i) for m, (i, v) in enumerate(whole) if m != n]
        out += [(query, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found_rows(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()), key=str)


def test_search_like_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.1, 16)]) for i in range(120)]
    rows += [(i, rows[i % 3][1]) for i in range(200, 240)]  # ties
    rows += [(50, rows[4][1]), (50, rows[4][1]), (None, rows[0][1]), (None, rows[0][1])]
    rows += [(300, None), (350, []), (301, [None] * 16), (302, [float("nan")] * 16), (303, [float("inf")] * 16), (304, [0.0] * 16), (305, [0.5, 0.25]), (400, [0.5] * 40)]
    assert found_rows(impact_index.top_k_among(vectors_of(spark, rows))) == best_of(rows)


def test_search_of_few_rows_and_none(spark):
    assert found_rows(impact_index.top_k_among(vectors_of(spark, []))) == []
    assert found_rows(impact_index.top_k_among(vectors_of(spark, [(0, [1.0]), (1, [-1.0])]))) == [(0, 1, 1, -(256**2))]
    assert found_rows(impact_index.top_k_among(vectors_of(spark, [(0, [1.0])]))) == []


def test_search_of_other_queries_against_an_index(spark):
    index = impact_index.build_index(spark.createDataFrame([(i, [i, 1]) for i in range(10)], "vec_id long, vector array<long>"))
    queries = spark.createDataFrame([(7, [1, 0]), (7, [-1, 0]), (None, [0, 3])], "query_id long, vector array<long>")
    assert found_rows(impact_index.search(index, queries, 2)) == sorted([(7, 1, 9, 9), (7, 2, 8, 8), (7, 1, 0, 0), (7, 2, 1, -1), (None, 1, 0, 3), (None, 2, 1, 3)], key=str)


def block_row(values, ids):
    found = impact_index.segments(values)
    return {"n": len(values), "dims": values.shape[1], "width": 8, "values": values.astype("<i8").tobytes(), "ids": np.array(ids, "<i8").tobytes(), "named": np.ones(len(ids), bool).tobytes()} | {
        k: found[k].tobytes() for k in ("dim", "level", "stop", "docs", "cuts", "rest")
    }


@pytest.mark.parametrize("scale", [1, 30, 10**6, 2**40])
def test_blocks_leave_out_only_what_is_proven_out(scale):
    rng = np.random.default_rng(scale)
    values = np.round(rng.normal(0, scale, (900, 24))).astype(np.int64)
    values[100:140] = values[7]
    queries = np.concatenate([values[5:12], np.round(rng.normal(0, scale, (20, 24))).astype(np.int64)])
    best, read = impact_index.Best(len(queries), 5), []
    for at in range(0, 900, 300):
        row = block_row(values[at : at + 300], range(at, at + 300))
        own = np.where((np.arange(len(queries)) < 7) & (at == 0), np.arange(len(queries)) + 5, -1)
        read.append(impact_index.search_block(row, queries, own, best))
    exact = values.astype(object) @ queries.T.astype(object)
    for q in range(len(queries)):
        scored = sorted((-max(min(int(exact[d, q]), 2**63 - 1), -(2**63)), d) for d in range(900) if q >= 7 or d != q + 5)[:5]
        mine = best.query == q
        assert [(-s, d) for s, d in zip(best.score[mine].tolist(), best.id[mine].tolist())] == scored
    if 1 < scale < 2**40:
        assert read[-1] < 0.95 * 300 * 24  # stopped before the end


def test_rests_bound_what_is_not_read():
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(0, 30, (200, 16))).astype(np.int64)
    found = impact_index.segments(values)
    posted, at = np.zeros(values.shape), 0
    sizes = np.abs(found["level"])
    assert (np.diff(sizes) <= 0).all()
    for number, cut in enumerate(found["cuts"]):
        for s in range(at, cut):
            posted[found["docs"][found["stop"][s - 1] if s else 0 : found["stop"][s]].astype(int), found["dim"][s]] = found["level"][s]
        at = cut
        assert np.allclose(np.sqrt(((values - posted) ** 2).sum(axis=1)), found["rest"][number])


# --- periodic runs


def brute_runs(words, least=24, repeats=3):
    out = []
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, repeats * q):
                part = words[i : i + length]
                if not any(part[r:] == part[: length - r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def looped_texts(seed, n):
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.integers(0, 6)):
            letters = list("abcdef")[: int(rng.integers(1, 6))]
            block = list(rng.choice(letters, rng.integers(1, 50)))
            if rng.random() < 0.3:
                block = block * 2 + ["z"]
            times = int(rng.integers(1, 7))
            parts += (block * times)[: len(block) * times - int(rng.integers(0, len(block)))]
        texts.append(" ".join(parts))
    return texts


def test_runs_like_brute_force(documents):
    rows = list(enumerate(looped_texts(0, 120))) + ODD + [(1000, "a " * 23), (1001, "a " * 24), (1002, "a b c d e f g h " * 3), (1003, "\t".join("abcdefghi" * 200))]
    wanted = []
    for doc_id, text in rows:
        words = split(text)
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        wanted.append((doc_id, len(words), len(runs), *best, runs, collapsed(words, runs)))
    found = periodic_runs.periodic_runs(documents(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_runs, r.start, r.length, r.period, [tuple(x) for x in r.runs], r.collapsed) for r in found), key=str) == sorted(wanted, key=str)
    assert sum(len(w[6]) for w in wanted) > 80


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=90), st.integers(2, 12), st.integers(3, 5))
def test_runs_of_short_words(words, least, repeats):
    assert periodic_runs.runs_of(W.cut(pa.array([" ".join(words)]), W.NOT_SPACE, False), least, repeats) == [brute_runs(words, least, repeats)]


def test_a_gram_that_recurs_often_gives_few_seeds():
    words = W.cut(pa.array(["a " * 20_000]), W.NOT_SPACE, False)
    assert sum(len(at) for _, at, _ in periodic_runs.seeds(words, 16)) <= 20_000
    assert periodic_runs.runs_of(words) == [[(0, 20_000, 1)]]


@pytest.mark.parametrize("text", [None, "", " \n", "a", "x" * 3_000_000, "日本 " * 40])
def test_runs_of_a_text_alone(documents, text):
    row = periodic_runs.periodic_runs(documents([(1, text)])).first()
    assert row.n_runs == len(brute_runs(split(text))) and row.collapsed == collapsed(split(text), brute_runs(split(text)))


def test_runs_of_nothing(documents):
    assert periodic_runs.periodic_runs(documents([])).collect() == []


def test_loops_and_digests_of_the_query(spark, documents, tmp_path):
    rows = [(i, t) for i, t in enumerate(looped_texts(1, 90))] + ODD + [(10 * i + 3, " ".join(f"w{j}" for j in range(i))) for i in range(60, 120)]
    documents(rows, False).write.parquet(str(tmp_path / "documents.parquet"))
    wanted = []
    for doc_id, text in rows:
        words, h = split(text), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        s, n, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        wanted.append((doc_id, len(runs), s, n, q, 1000 * n // q if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    found = op12_periodic_runs(spark, str(tmp_path)).collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r[c] for c in names) for r in found), key=str) == sorted(wanted, key=str)


# --- filter audit


def fails_of(rows):
    out = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = split(text)
        fails = "A" if len(words) < 200 else ""
        fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows) else ""
        out.append((doc_id, lang or "", fails))
    return out


def audited(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = fails_of(rows)
    out = []
    for part in {p for _, p, _ in fails}:
        mine = [(d, f) for d, p, f in fails if p == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if letter in f]
                again = sum(letter in f and any(c in f for c in order[: step - 1]) for _, f in mine)
                left = [(d, f) for d, f in left if letter not in f]
                removed_by[letter] += len(gone)
                lines.append((part, order, step, len(left), len(gone), again, sum(f == letter for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), letter))
        out += [(*line[:-1], removed_by[line[-1]]) for line in lines]
    return sorted(out)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows(seed):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"{'W' if rng.random() < 0.4 else 'w'}{rng.integers(150 + i)}{'$' if rng.random() < 0.002 else ''}" for _ in range(rng.integers(150, 260))) for i in range(40)]
    rows = [(int(i), str(texts[rng.integers(len(texts))]), [None, "", "en", "de"][rng.integers(4)]) for i in range(90)]
    return rows + [(*r, [None, "en"][i % 2]) for i, r in enumerate(ODD)] + [rows[3], rows[3], (rows[3][0], "other", "en"), (None, rows[5][1], "de"), (None, rows[5][1], "de")]


@pytest.mark.parametrize("sketch", ["own", "full"])
def test_audit_like_brute_force(spark, documents, monkeypatch, sketch):
    rows = audit_rows(4)
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(60)] + [(3, 0, 1), (7, None, None), (None, 1, 1), (5000, 1, 1)]
    if sketch == "full":  # every text may repeat: the exact stage alone decides
        monkeypatch.setattr(filter_audit, "repeat_sketch", lambda hashes, n: np.full(1 << 13, 255, np.uint8))
    docs = documents(rows).withColumns({c: F.lit(c) for c in ("mask", "part", "h", "salt", "first", "n", "fails", "quality", "toxic")})
    found = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1)))
    assert sorted(tuple(r[c] for c in AUDIT) for r in found.collect()) == audited(rows, labels)


def test_audit_of_nothing(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents([]), labels).collect() == []
    assert filter_audit.audit(documents([(1, None, None)]), labels).count() == 600


def test_sketch_keeps_every_repeat_and_clears_most_others(spark):
    once, twice = list(range(4000)), list(range(10_000, 10_500))
    df = spark.createDataFrame([(int(h),) for h in once + twice + twice], "id long").select(F.xxhash64("id").alias("h"), "id").repartition(6)
    sketch = spark.sparkContext.broadcast(filter_audit.repeat_sketch(df, df.count()))
    left = [r.id for r in df.mapInArrow(filter_audit._may_repeat(sketch), df.schema).collect()]
    assert sorted(x for x in left if x >= 10_000) == sorted(twice + twice)
    assert sum(x < 10_000 for x in left) < 0.1 * len(once)
