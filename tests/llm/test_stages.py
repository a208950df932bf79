"""Rows that a stage must neither lose nor mix up: nulls, shared identifiers, names of its own, texts alone in their partition."""

import time

import pytest
from pyspark.sql import functions as F

from riskweave.llm import filter_audit, impact_index, language, mixing, near_duplicates, periodic_runs, private_data, substrings, token_shards, winnowing
from riskweave.llm.queries import TOKENIZER

ODD_TEXTS = [None, "", " \t\n", "123", "#!?", "a", "x" * 300_000, "Ä ß 日本 é́", "a\x00b c"]
OWN_NAMES = ["_id", "id", "_ID", "_position", "position", "_hit_id", "_gone_id", "digest_", "own_digest", "node", "label", "n", "stays", "mask", "first"]
APART = [
    "the first text speaks of rivers and of the long roads beside them in spring",
    "another one tells how bread is made from flour water salt and a little time",
    "a third describes the engine of an old lorry that would not start in winter",
    "this fourth is about stars that sailors used to find their way home at night",
    "and the fifth counts the trees of a park from the gate up to the small lake",
]


@pytest.fixture
def shared_ids(spark, documents):
    rows = [(None, APART[0], "en"), (None, APART[1], "en"), (None, APART[2], "en"), (5, APART[3], "en"), (5, APART[4], "en"), (5, APART[4], "en"), (6, APART[4] + " ", "en"), (7, "", "en"), (7, "", "en"), (None, None, "en")]
    docs = documents(rows, False)
    return docs.withColumns({c: F.lit(c) for c in OWN_NAMES if c != "_ID"})


def test_near_duplicates_keep_unrelated_rows_of_one_identifier(shared_ids):
    kept = near_duplicates.keep_first(shared_ids)
    assert kept.columns == shared_ids.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(None, APART[0]), (None, APART[1]), (None, APART[2]), (5, APART[3]), (5, APART[4]), (7, ""), (7, ""), (None, None)], key=str)


def test_near_duplicates_without_equal_rows(documents):
    rows = [(3, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f "), (9, "x y z"), (None, "x y z")]
    assert sorted(r.doc_id for r in near_duplicates.keep_first(documents(rows)).collect()) == [2, 9]
    assert near_duplicates.keep_first(documents([(None, "q r s t"), (None, "q  r s t")])).count() == 1
    assert near_duplicates.keep_first(documents([])).count() == 0


def test_a_hit_takes_its_own_row_only(spark, shared_ids):
    items = spark.createDataFrame([("i", APART[1])], "item_id string, text string")
    kept = winnowing.drop_contaminated(shared_ids, items)
    assert kept.columns == shared_ids.columns
    assert kept.count() == shared_ids.count() - 1 and kept.filter(F.col("text") == APART[1]).count() == 0


def test_unknown_language_takes_its_own_row_only(shared_ids):
    kept = language.keep_identified(shared_ids)
    assert kept.columns == shared_ids.columns
    assert sorted(r.text for r in kept.collect()) == sorted(r.text for r in shared_ids.collect() if r.text)


def test_mixture_keeps_all_rows(shared_ids):
    mixed = mixing.in_mixed_order(shared_ids)
    assert mixed.columns == shared_ids.columns
    assert sorted(map(str, mixed.collect())) == sorted(map(str, shared_ids.collect()))


@pytest.mark.parametrize("text", ODD_TEXTS, ids=lambda t: repr(t)[:12])
def test_every_kernel_with_a_text_alone_in_its_partition(spark, documents, text):
    model = language.fit(documents([(i, t, "en") for i, t in enumerate(APART)] + [(9, "и это по-русски сказано", "ru")]))
    docs = documents([(1, text)])
    assert language.identify(docs, model).count() == 1
    assert near_duplicates.near_duplicates(docs).first().kept
    assert substrings.remove_repeats(docs).first().n_removed == 0
    assert private_data.personal_data(docs).count() == 1
    assert not winnowing.contamination(docs, spark.createDataFrame([("i", APART[0])], "item_id string, text string")).first().contaminated
    assert periodic_runs.periodic_runs(docs).first().n_runs == 0
    assert filter_audit.failure_masks(docs).first().n == 1
    assert token_shards.read_shards(token_shards.write_shards(docs, TOKENIZER, shards=1)).count() == 1


@pytest.mark.parametrize("vector", [None, [], [0], [-(2**62), 2**62], [0] * 3000])
def test_an_index_of_one_vector(spark, vector):
    index = impact_index.build_index(spark.createDataFrame([(1, vector)], "vec_id long, vector array<long>"))
    assert index.rows == (vector is not None)
    assert impact_index.search(index, spark.createDataFrame([(2, [1, 1])], "query_id long, vector array<long>"), 3).count() == index.rows


def test_many_equal_rows_take_no_longer_than_others(spark, documents):
    text = " ".join(f"w{i}" for i in range(200))
    started = time.time()
    found = substrings.remove_repeats(documents([(1, text)] * 2000 + [(2, text)])).groupBy("doc_id", "n_removed").count().collect()
    assert sorted(map(tuple, found)) == [(1, 0, 2000), (2, 200, 1)]
    assert time.time() - started < 60
