"""Near duplicates, repeated passages, benchmark passages and personal data beside plain Python."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm import near_duplicates, private_data, substrings, winnowing

WORDS = [f"w{i}" for i in range(40)]
SPACE = re.compile("[ \t-\r]+")
ODD = [(None, "no id here at all"), (900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "one"), (905, "x" * 300_000), (906, "Ä ß 日本 é́"), (907, "a\x00b c")]


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def random_texts(seed, n, long=120):
    rng = np.random.default_rng(seed)
    base = [list(rng.choice(WORDS, rng.integers(1, long))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        words = list(base[rng.integers(len(base))])
        for _ in range(int(rng.integers(0, 4))):
            words[rng.integers(len(words))] = f"n{rng.integers(1000)}"
        if rng.random() < 0.3:
            words += list(base[rng.integers(len(base))])
        out.append((i, " ".join(words)))
    return out


def components_of(rows, percent=80):
    sets = []
    for _, text in rows:
        words = split(lower(text))
        sets.append({tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(doc_id, smallest.get(root(i), doc_id))
    return sorted(((d, len(sets[i]), smallest.get(root(i)), d == smallest.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [4000, 3])
def test_near_duplicates_like_brute_force(documents, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "POSTING_BLOCK", block)
    monkeypatch.setattr(near_duplicates, "GROUP_BLOCK", 2_000_000 if block > 3 else 400)
    rows = random_texts(1, 90) + ODD + [(7, "w1 w2"), (7, "w1 w2"), (8, "W1 w2")]
    found = near_duplicates.near_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str) == components_of(rows)


def test_near_duplicates_of_nothing(documents):
    assert near_duplicates.near_duplicates(documents([])).collect() == []
    assert near_duplicates.near_duplicates(documents([(1, None)])).collect()[0].kept


def test_one_document_of_each_group_stays(documents):
    rows = [(3, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (5, "other words here too"), (6, None)]
    assert sorted(r.doc_id for r in near_duplicates.keep_first(documents(rows)).collect()) == [2, 5, 6]


def removed(rows, length=20):
    """Contract in plain Python; rows must have different identifiers."""
    seen, out = {}, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = split(text)
        gone = set()
        for i in range(len(words) - length + 1):
            passage = tuple(words[i : i + length])
            if passage in seen:
                gone.update(range(i, i + length))
            else:
                seen[passage] = True
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretches", [20_000, 1])
def test_repeated_passages_like_brute_force(documents, monkeypatch, stretches):
    monkeypatch.setattr(substrings, "ANCHOR_STRETCHES", stretches)
    monkeypatch.setattr(substrings, "SHARD_STRETCHES", 50)
    rows = random_texts(2, 60, 200) + ODD + [(500, " ".join(["w1"] * 90)), (501, "\n".join(["w1"] * 50)), (502, " ".join(WORDS[:20]) + "\t" + " ".join(WORDS[:20]))]
    found = substrings.remove_repeats(documents(rows), with_text=True).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in found), key=str) == removed(rows)


def test_equal_rows_are_one_document(documents):
    text = " ".join(WORDS[:25])
    found = substrings.remove_repeats(documents([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 25)]
    assert substrings.remove_repeats(documents([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 4))
def test_automaton_gives_longest_matches_and_first_places(sequences, cap):
    automaton = substrings.SuffixAutomaton()
    for i, words in enumerate(sequences[:-1]):
        automaton.add(words, i)
    query = sequences[-1]
    for end, (n, first) in enumerate(automaton.statistics(query, cap), 1):
        best = max((k for k in range(min(cap, end) + 1) if any(query[end - k : end] == s[j : j + k] for s in sequences[:-1] for j in range(len(s) - k + 1))), default=0)
        assert n == best
        if n == cap:
            places = [(i, j + n) for i, s in enumerate(sequences[:-1]) for j in range(len(s) - n + 1) if s[j : j + n] == query[end - n : end]]
            assert first == min(places)


def hits(rows, items, window=10):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = []
    for item_id, text in items:
        words = pattern.findall(lower(text))
        if words:
            n = min(window, len(words))
            windows += [("" if item_id is None else str(item_id), words[i : i + n]) for i in range(len(words) - n + 1)]
    out = []
    for doc_id, text in rows:
        words = pattern.findall(lower(text))
        hit, names = set(), set()
        for name, w in windows:
            for i in range(len(words) - len(w) + 1):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    names.add(name)
        out.append((doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_contamination_like_brute_force(spark, documents, monkeypatch, broadcast):
    monkeypatch.setattr(winnowing, "BROADCAST_PRINTS", broadcast)
    rows = random_texts(3, 60) + ODD + [(1, "W1, w2 -- w3!")]
    items = [(i, t.upper() if i % 2 else t) for i, (_, t) in enumerate(random_texts(3, 12, 30))] + [(50, "w1 w2 w3"), (None, "w5"), (51, None), (52, ""), (50, "w9 w8"), (53, rows[4][1])]
    found = winnowing.contamination(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found), key=str) == hits(rows, items)
    for r in found:
        assert sum(s.hi - s.lo for s in r.spans or []) == r.n_hit


def test_no_items_no_hits(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in winnowing.contamination(documents([(1, "a b"), (2, None)]), none).collect()] == [False, False]
    assert winnowing.contamination(documents([]), none).collect() == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and private_data.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], private_data.ORDER[s[0]]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ ()25%_é0\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert private_data.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 50_000, "1." * 50_000, "+1(" * 50_000):
        private_data.base_spans(text)


def test_distant_mentions_are_labelled_alike():
    text = "Mail jo.smith99@mail.example.com or +1 (555) 555-2485 now. " + "filler words go here " * 30 + "Ask jo.smith99, on 15555552485 please. The 12 others."
    base, spans = private_data.all_spans(text)
    assert [k for k, _, _ in base] == ["email", "phone"]
    assert [s for s in spans if s in base] == base
    assert {(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base} == {("email_like", "jo.smith99"), ("phone_like", "15555552485")}
    assert private_data.all_spans("Ask jo.smith99, the 12 others.") == ([], [])
    assert "jo.smith99" not in private_data.redact(text, spans)


@pytest.mark.parametrize("repeats", [1, 2, 3, 10, 50])
@pytest.mark.parametrize("full", [1, 2])
def test_every_mention_is_labelled_however_often_it_recurs(repeats, full):
    gap = " a few words of other things stand in between here "
    for whole, bare, kind in [("jo.smith99@mail.example.com", "jo.smith99", "email_like"), ("+1 (555) 555-2485", "15555552485", "phone_like")]:
        for text in (gap.join([whole] * full + [bare] * repeats), gap.join([bare] * repeats + [whole] * full)):
            base, spans = private_data.all_spans(text)
            assert len(base) == full
            assert [(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base] == [(kind, bare)] * repeats


def test_short_parts_of_a_number_are_no_mentions():
    text = "Call +44 20 7946 0958 now. " + "There are 20 of them and +1 more at 7946. " * 5
    base, spans = private_data.all_spans(text)
    assert {text[a:b] for k, a, b in spans if (k, a, b) not in base} == {"7946"}


def test_links_lead_away_from_fixed_tokens():
    fixed = np.array([False, True, False, False, True, False, False])
    names = {"a": [0, 1, 2, 4, 5], "b": [5, 6], "c": [3]}
    assert sorted(private_data.skip_links(names, fixed)) == [(1, 0), (1, 2), (4, 5), (5, 6)]


def test_beliefs_are_exact_without_loops():
    rng = np.random.default_rng(0)
    unary = rng.normal(size=(4, 3))
    pairs, weights = np.array([(0, 1), (1, 2), (1, 3)]), np.array([0.5, 1.5, 2.0])
    total = np.zeros((4, 3))
    for states in np.ndindex(3, 3, 3, 3):
        p = np.exp(sum(unary[i, s] for i, s in enumerate(states)) + sum(w for (a, b), w in zip(pairs, weights) if states[a] == states[b]))
        for i, s in enumerate(states):
            total[i, s] += p
    wanted = np.log(total / total.sum(axis=1, keepdims=True))
    assert np.allclose(private_data.beliefs(unary, pairs, weights, 200, 0.0), wanted, atol=1e-6)


def test_personal_data_rows(documents):
    rows = [(1, None), (2, ""), (3, "é a.b@c.de 1.2.3.4"), (3, "é a.b@c.de 1.2.3.4"), (None, "x")]
    found = private_data.digests(private_data.personal_data(documents(rows))).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.spans, r.base_sha256 == nothing) for r in found), key=str) == sorted(
        [(1, 0, 0, "", True), (2, 0, 0, "", True), (3, 1, 1, "email:2:10,ip:11:18", False), (3, 1, 1, "email:2:10,ip:11:18", False), (None, 0, 0, "", True)], key=str
    )
    assert private_data.personal_data(documents([])).collect() == []
