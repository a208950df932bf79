"""Feature matrix and scaler beside numpy, ranks of rows that share a value, phrase counts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.functions import order_stats
from riskweave.operators import text
from riskweave.plans import features

RATIO = next(c for c in K.FEATURES if c not in K.COUNT_FEATURES)
COUNT = next(c for c in K.FEATURES if c in K.COUNT_FEATURES)


def wanted(values, counts):
    x = pd.Series(values, dtype=float)
    x = x.fillna(x.median())
    low, high = x.quantile(0.01), x.quantile(0.99)
    x = x.clip(low, high)
    out = {}
    for name, column in ((RATIO, x), (COUNT, pd.Series(counts, dtype=float).fillna(0))):
        out[name] = column.median(), (column.quantile(0.75) - column.quantile(0.25)) or 1.0
    return x, out


@pytest.mark.parametrize("n, nulls, same", [(1, 0, 0), (2, 0, 0), (3, 1, 0), (7, 3, 2), (50, 30, 5), (51, 10, 0), (400, 150, 120), (400, 0, 0), (401, 399, 0)])
def test_fit_like_numpy(spark, n, nulls, same):
    rng = np.random.default_rng(n + nulls)
    values = rng.normal(0, 100, n)
    values[:same] = 7.0
    rng.shuffle(values)
    values = [None] * nulls + values[nulls:].tolist()
    counts = [None if i % 5 == 0 else float(i % 3) for i in range(n)]
    docs = spark.createDataFrame([(str(i), v, c) for i, (v, c) in enumerate(zip(values, counts))], f"cik string, {RATIO} double, {COUNT} double")
    built, fitted = features.fit(docs)
    x, scaler = wanted(values, counts)
    got = built.toPandas().set_index("cik")
    assert [got[RATIO][str(i)] for i in range(n)] == pytest.approx(x.tolist(), rel=1e-12)
    assert set(fitted) == {RATIO, COUNT}
    for c in fitted:
        assert fitted[c] == pytest.approx(scaler[c], rel=1e-12)
        assert features.scaler(built, [c])[c] == pytest.approx(fitted[c], rel=1e-12)


def test_fit_without_known_values_or_rows(spark):
    docs = spark.createDataFrame([("a", None, None), ("b", float("nan"), 2.0)], f"cik string, {RATIO} double, {COUNT} double")
    built, fitted = features.fit(docs)
    assert sorted(map(tuple, built.select("cik", RATIO, COUNT).collect())) == [("a", None, 0.0), ("b", None, 2.0)]
    assert set(fitted) == {COUNT}
    built, fitted = features.fit(docs.limit(0))
    assert built.collect() == [] and fitted == {}


def test_ranks_where_one_value_holds_most_rows(spark):
    values = [0.0, -0.0] * 2000 + [None] * 50 + [float(i) for i in range(1, 3000)] + [5.0] * 900
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double")
    got = order_stats.mean_rank(df, "x")
    assert got.columns == ["id", "x", "mean_rank", "n_rows"]
    got = got.toPandas().sort_values("id")
    assert len(got) == len(values)
    want = pd.Series(values, dtype=float).rank()
    assert np.allclose(got["mean_rank"], want, equal_nan=True)
    assert set(got["n_rows"].dropna()) == {len(values) - 50}


def test_phrases_are_counted_as_often_as_they_occur(spark):
    texts = ["Restatement, restate and RESTATED. Going concern going concern", "", None, "record revenue" * 3]
    rows = text.lexicon_scan(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).orderBy("id").collect()
    assert [r.restatement_mentions for r in rows] == [4, 0, 0, 0]
    assert [r.going_concern_mentions for r in rows] == [2, 0, 0, 0]
    assert [r.positive_mentions for r in rows] == [0, 0, 0, 3]
    assert rows[0].restatement_phrases == 2
