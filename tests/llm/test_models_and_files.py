"""Mixing, archives, exact copies, learned models, token files and the pipeline."""

import hashlib
import io
import os
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from oracle import compare, connect
from riskweave.llm import archives, exact_stream, language, mixing, near_duplicates, token_shards, toxicity, winnowing
from riskweave.llm.common import new_path
from riskweave.llm.queries import ORACLE, QUERIES, TOKENIZER

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows_as_sql(spark, name):
    state, _, _, note = compare(spark, connect(FOLDER), name, QUERIES, ORACLE, FOLDER)
    assert state == "ok", note


# -- mixing


@pytest.mark.parametrize("sizes", [{"a": 500, "b": 90, "c": 7}, {"a": 1}, {"a": 40, "b": 40}])
def test_schedule_stays_within_a_block_of_the_weights(sizes):
    weights = {s: n**0.5 for s, n in sizes.items()}
    plan = mixing.phases(sizes, weights, slots=100)
    slots = {(s, j): mixing.slot_of(plan, s, j) for s, n in sizes.items() for j in range(n)}
    assert sorted(slots.values()) == list(range(sum(sizes.values())))
    for start in sorted({r["start"] for r in plan}):
        phase = [r for r in plan if r["start"] == start]
        period, length = phase[0]["period"], sum(r["stop"] - r["first"] for r in phase)
        for r in phase:
            share = r["quota"] / period
            taken = sorted(slots[r["source"], j] - start for j in range(r["first"], r["stop"]))
            for t in range(length + 1):
                assert abs(np.searchsorted(taken, t) - share * t) < 1


@pytest.mark.parametrize("n", [5, 20, 100, 1000])
def test_a_heavy_source_gets_its_target_weight(n):
    blocks, weights = {"hot": 4000} | {f"s{i}": 4000 for i in range(n - 1)}, {"hot": n - 1} | {f"s{i}": 1 for i in range(n - 1)}
    taken, total = Counter(), sum(weights.values())
    for t, (s, j) in zip(range(1, 4001), mixing.schedule(mixing.Fluid(blocks, weights))):
        assert j == taken[s]
        taken[s] += 1
        assert abs(taken["hot"] - t * weights["hot"] / total) < 1
        if t % 500 == 0:
            assert all(abs(taken[s] - t * w / total) < 1 for s, w in weights.items())


def test_schedule_stays_within_a_block_of_the_weights_while_sources_run_dry():
    rng = np.random.default_rng(4)
    blocks = {"hot": 400} | {f"s{i:03}": int(rng.integers(1, 9)) for i in range(150)}
    weights = {"hot": 60.0} | {s: float(rng.choice([0.1, 1.0, 2.5])) for s in blocks if s != "hot"}
    order = list(mixing.schedule(mixing.Fluid(blocks, weights)))
    assert sorted(order) == sorted((s, j) for s, n in blocks.items() for j in range(n))
    taken, wanted = Counter(), dict.fromkeys(blocks, 0.0)
    for s, _ in order:
        left = 1.0  # of the slot; a source may run dry inside it
        while left > 1e-9:
            rate = sum(weights[x] for x in blocks if wanted[x] < blocks[x] - 1e-9)
            step = min([left, *((blocks[x] - wanted[x]) * rate / weights[x] for x in blocks if wanted[x] < blocks[x] - 1e-9)])
            for x in blocks:
                if wanted[x] < blocks[x] - 1e-9:
                    wanted[x] += step * weights[x] / rate
            left -= step
        taken[s] += 1
        assert all(abs(taken[x] - wanted[x]) < 1 + 1e-6 for x in blocks)


def test_every_document_has_a_place(documents):
    rows = [(i, "t", "en", ["big", "big", "small", None][i % 4]) for i in range(300)] + [(None, None, None, None)]
    found = mixing.mix(documents(rows), block=8, slots=20).collect()
    assert sorted(r.position for r in found) == list(range(301))
    assert Counter((r.doc_id, r.source) for r in found) == Counter((r[0], r[3]) for r in rows)
    by_slot = {}
    for r in sorted(found, key=lambda r: r.position):
        by_slot.setdefault(r.slot, set()).add(r.source)
    assert all(len(s) == 1 for s in by_slot.values()) and list(by_slot) == sorted(by_slot)
    heavy = mixing.mix(documents(rows), weights={"small": 0.9, "big": 0.05, None: 0.05}, block=1, slots=20).collect()
    assert Counter(r.source for r in heavy if r.position < 40)["small"] > 30
    assert mixing.mix(documents([])).collect() == []


def test_more_sources_than_fit_a_plan(documents):
    n = 10_500
    rows = [(i, "t", "en", f"site{i % n}") for i in range(2 * n)] + [(2 * n + i, "t", "en", "hot") for i in range(3000)]
    found = mixing.mix(documents(rows, clashing=False), weights={"hot": float(n)} | {f"site{i}": 1.0 for i in range(n)}, block=1).collect()
    assert sorted(r.position for r in found) == list(range(len(rows)))
    assert Counter((r.doc_id, r.source) for r in found) == Counter((r[0], r[3]) for r in rows)
    assert sum(r.source == "hot" for r in found if r.position < 2000) == 1000


# -- archives


def test_archives_round_trip(spark):
    page = "<p>" + "é" * 700 + "</p>"
    rows = [(1, "http://a", page), (5, "http://b", page), (3, None, page), (4, "http://c\r\nX: y", "short"), (6, "u", "short"), (7, "u", None), (8, "u", ""), (9, "u", "a\r\n\r\nb" * 400), (None, "u", page), (5, "u2", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    packages = archives.write_archives(pages)
    found = archives.read_archives(packages, with_payload=True).collect()
    wanted = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        again = html == page and page_id != 5
        wanted.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 5 if again else None, None if again else raw))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in found], key=str) == sorted(wanted, key=str)
    path = packages.first().path
    fs, path = archives.filesystem(path)
    with fs.open_input_file(path) as f:
        assert zipfile.ZipFile(io.BytesIO(f.read())).testzip() is None
    assert archives.archive_round_trip(pages.limit(0)).collect() == []


def test_directory_with_zip64_end_and_comment():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        with z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as f:
            f.write(b"stored")
        z.writestr("b", b"x" * 100, zipfile.ZIP_DEFLATED)
    plain = raw.getvalue()
    end = plain.rfind(b"PK\x05\x06")
    count, size, at = (int.from_bytes(plain[end + a : end + b], "little") for a, b in ((10, 12), (12, 16), (16, 20)))
    wide = b"PK\x06\x06" + (44).to_bytes(8, "little") + b"\x2d\0\x2d\0" + bytes(8) + b"".join(x.to_bytes(8, "little") for x in (count, count, size, at))
    locator = b"PK\x06\x07" + bytes(4) + end.to_bytes(8, "little") + (1).to_bytes(4, "little")
    tail = b"PK\x05\x06" + bytes(4) + b"\xff" * 12 + (5).to_bytes(2, "little") + b"hello"
    for whole in (plain, plain[:end] + wide + locator + tail):
        f = io.BytesIO(whole)
        members = archives.read_directory(f, len(whole))
        f.seek(archives.member_start(f, members["a"]))
        assert f.read(members["a"]["size"]) == b"stored"
        with pytest.raises(ValueError):
            archives.member_start(f, members["b"])
    with pytest.raises(ValueError):
        archives.read_directory(io.BytesIO(b"nothing"), 7)


# -- exact copies


def plain_copies(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub("[ \t-\r]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for same, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), hashlib.sha256(same.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_copies_over_several_batches(spark, documents, weak):
    rows = [(i, ["a b", "ab", " a\tb", "é", None, "", " ", "long " * 20_000, "x"][i % 9]) for i in range(40)] + [(None, "a  b  "), (3, "same"), (3, "same")]
    path = new_path(spark, "docs")
    documents(rows).repartition(5).write.parquet(path)
    digest = (lambda c: exact_stream.F.substring(exact_stream.sha256(c), 1, 1)) if weak else exact_stream.sha256  # many texts share a weak digest
    found = exact_stream.deduplicate(spark, path, digest, files_per_batch=2).collect()
    wanted, groups = plain_copies(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == wanted
    assert sum(r.kept for r in found) == groups and all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_copies_of_nothing(spark, documents):
    path = new_path(spark, "docs")
    documents([]).write.parquet(path)
    assert exact_stream.deduplicate(spark, path).collect() == []


# -- learned models


def tongue(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))


def test_languages_of_texts_and_spans(documents):
    rng = np.random.default_rng(0)
    kinds = {"en": ["th", "er", "on", "ing"], "fr": ["eau", "ou", "é", "que"], "ru": ["при", "вет", "мир"]}
    rows = [(i, tongue(rng, kinds[k], 40), k) for i, k in enumerate(list(kinds) * 40)]
    mixed = tongue(rng, kinds["en"], 30) + " " + tongue(rng, kinds["fr"], 60)
    rows += [(1000, mixed, None), (1001, None, "en"), (1002, "12 !! ", "en"), (1003, "", None), (None, mixed, None), (1004, "ελληνικά", None), (1005, "q" * 100_000, None)]
    found = {r.doc_id: r for r in language.identify(documents(rows)).collect()}
    for i, _, k in rows[:120]:
        assert found[i].lang_pred == k and 0 <= found[i].score <= 1
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert found[1000].lang_pred == "fr" and [s.lang for s in found[1000].spans] == ["en", "fr"]
    assert abs(found[1000].spans[0].hi - 30) <= 2
    assert [found[i].lang_pred for i in (1001, 1002, 1003)] == ["und"] * 3
    assert found[1004].lang_pred in kinds and found[None].lang_pred == "fr"
    nothing = documents([(1, "text", None), (2, None, "en")])
    assert [r.lang_pred for r in language.identify(nothing).collect()] == ["und", "und"]
    assert language.identify(documents([])).collect() == []
    kept = language.keep_identified(documents(rows[-7:] + rows[:30]))
    assert {1001, 1002, 1003}.isdisjoint(r.doc_id for r in kept.collect()) and kept.count() == 34


def test_viterbi_like_all_paths():
    rng = np.random.default_rng(1)
    first = np.array([0, 4, 4, 5, 9])
    scores = rng.normal(size=(9, 3)) * 3
    path = language.viterbi(scores, first, 2.0)
    best, sure = language._one_language(scores - scores.max(axis=1, keepdims=True), first, 2.0)
    for t, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if a == b:
            continue

        def value(states, a=a):
            return sum(scores[a + i, s] for i, s in enumerate(states)) - 2.0 * sum(x != y for x, y in zip(states[:-1], states[1:]))

        top = max(value(s) for s in np.ndindex(*[3] * (b - a)))
        assert np.isclose(value(path[a:b]), top)
        if sure[t]:
            assert np.isclose(value([best[t]] * (b - a)), top)


def test_toxicity_on_held_out_texts(spark, documents):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(600):
        words = tongue(rng, ["th", "er", "on", "ing"], 30).split()
        toxic = i % 5 == 0
        if toxic:
            words[rng.integers(30)] = ["idiot", "scum", "moron"][i % 3]
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "idiot scum"), (1002, "x" * 100_000)]
    labels += [(None, 1, 1), (3, None, None), (10_000, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(documents(rows), table).collect()}
    held = [i for i in range(600) if found[i].held_out]
    wrong = sum(found[i].predicted != int(i % 5 == 0) for i in held)
    assert len(found) == 604 and wrong < 0.03 * len(held)
    assert found[1000].score == found[1001].score and all(0 <= r.score <= 1 for r in found.values())
    none = toxicity.toxicity(documents(rows), table.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.toxicity(documents([]), table).collect() == []


def test_tasks_pass_on_no_more_learning_rows_than_are_picked(spark, documents, monkeypatch):
    docs, plans = documents([(i, f"word{i % 7} idiot") for i in range(50)]), []
    frame = type(docs)

    def seen(self, whole=frame.toArrow):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return whole(self)

    monkeypatch.setattr(frame, "toArrow", seen)
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int"))
    for k in (toxicity.POSITIVES, toxicity.UNLABELLED):
        assert re.search(rf"WindowGroupLimit .*, {k}, Partial", plans[0])
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == before


def test_risk_does_not_go_negative():
    rows, columns = np.array([0, 1, 2, 3]), np.array([0, 0, 1, 1])
    weights, _ = toxicity.nnpu(rows, columns, np.array([True, False, False, False]), 2, 0.3)
    assert weights[0] > weights[1]


# -- token files


def test_perfect_hash_sends_keys_to_slots():
    for n in (0, 1, 5, 3000):
        h = token_shards.key_hashes(np.arange(n) * 7 - 11, np.ones(n, bool), np.zeros(n, np.int64))
        d = token_shards.build_hash(h)
        if n:
            assert sorted(token_shards._slot(h, d[token_shards._bucket(h, len(d))], n)) == list(range(n))


def test_encoder_like_the_tokenizer():
    rng = np.random.default_rng(3)
    parts = ["a", "B", "'s", "'", ".", ",", " ", "é", "é", "1", "\n", "\xa0", "–", "<|endoftext|>", "<|", "İ", "Σ", "\x1c", "don't", ".,", "日本", "‍", "!!", "$$", "&", "*", "?;", "<|ENDOFTEXT|>", "\u0301"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(3000)] + [None, "", "x" * 50_000]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    encoder, got = token_shards.WordEncoder(TOKENIZER), []
    for flat, sizes in encoder.encode(pa.array(texts)):
        got += [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
    assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def plain_tokens(rows):
    tokenizer, out, start = Tokenizer.from_file(TOKENIZER), [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(documents):
    rows = [(None, "first"), *[(i, f"Text number {i}, again." * (i % 5)) for i in range(0, 90, 3)], (95, None), (96, "x" * 20_000)]
    manifest = token_shards.write_shards(documents(rows[::-1]), TOKENIZER, shards=4)
    found = token_shards.read_shards(manifest).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=lambda r: r[1]) == plain_tokens(rows)
    looked = [token_shards.look_up(r.path, 96) for r in manifest.collect()]
    assert sum(x is not None for x in looked) == 1
    assert all(token_shards.look_up(r.path, 12345) is None for r in manifest.collect())
    twice = token_shards.read_shards(token_shards.write_shards(documents([(1, "a"), (1, "a"), (1, "b c")]), TOKENIZER)).collect()
    assert [r.doc_id for r in twice] == [1, 1, 1] and len({r.start for r in twice}) == 3
    assert token_shards.read_shards(token_shards.write_shards(documents([]), TOKENIZER)).collect() == []


def test_a_key_is_found_without_probing_the_shards(documents, monkeypatch):
    rows = [(None, "nothing"), *[(7 * i - 50, f"Text {i}, again.") for i in range(300)], *[(2, f"copy {i}") for i in range(200)]]
    manifest = token_shards.write_shards(documents(rows), TOKENIZER, order=["text"], shards=6)
    paths = [r.path for r in manifest.collect()]
    folder = os.path.dirname(paths[0])
    tokenizer, opened = Tokenizer.from_file(TOKENIZER), []

    def ids(text):
        return [*tokenizer.encode(text, add_special_tokens=False).ids, 2]

    def seen(fs, path, h, kind, record=token_shards._record):
        opened.append(path)
        return record(fs, path, h, kind)

    monkeypatch.setattr(token_shards, "_record", seen)
    for doc_id, text in rows[:301]:
        opened.clear()
        assert token_shards.look_up(folder, doc_id).tolist() == ids(text)
        assert len(opened) == 2  # the key's bucket and its shard
    assert token_shards.look_up(folder, 12345) is None
    copies = [token_shards.look_up(folder, 2, c).tolist() for c in range(200)]
    assert sorted(copies) == sorted(ids(t) for d, t in rows if d == 2) and token_shards.look_up(folder, 2, 200) is None
    assert len(os.listdir(f"{folder}/keys")) <= len(paths) + 1


# -- the pipeline


def test_pipeline_like_its_stages_in_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        if name != "token_ids":
            assert docs.columns == columns
    first = sorted(i for i, t in texts.items() if any(map(str.isalpha, t or "")))
    assert sorted(kept["language_id"]) == first
    from test_texts import components_of, hits

    second = sorted(d for d, _, _, keep in components_of([(i, texts[i]) for i in first]) if keep)
    assert sorted(kept["near_duplicates"]) == second
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    third = sorted(r[0] for r in hits([(i, texts[i]) for i in second], items) if not r[-1])
    assert sorted(kept["decontamination"]) == third == sorted(kept["mixing"])
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    places = mixing.mix(spark.createDataFrame([(i, source[i]) for i in third], "doc_id long, source string")).collect()
    order = [r.doc_id for r in sorted(places, key=lambda r: r.position)]
    rows = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in docs.collect()), key=lambda r: r[1])
    assert rows == plain_tokens([(i, texts[i]) for i in order])
    assert near_duplicates.SHINGLE == 4 and winnowing.WINDOW == 10
