import itertools
import math

import numpy as np
import pandas as pd
import pytest

from riskweave.operators import forest as W
from riskweave.plans import scoring
from riskweave.functions import constants as K


def matrix(spark, n=120, width=4, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    x[:4] += 9
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(width)])
    pdf.insert(0, "cik", [f"{i:04d}" for i in range(n)])
    return pdf, spark.createDataFrame(pdf)


COLS = [f"f{i}" for i in range(4)]


def test_scores_find_the_outliers(spark):
    _, df = matrix(spark)
    model = W.fit(df, COLS, trees=60)
    raw = W.raw_scores(df, model)
    model = W.with_offset(raw, model, 0.10)
    got = W.decisions(raw, model).toPandas()
    assert ((got["score"] > -1) & (got["score"] < 0)).all()
    assert (got["decision"] < 0).sum() == 12
    assert set(got.nsmallest(4, "decision")["cik"]) == {"0000", "0001", "0002", "0003"}


def test_forest_does_not_depend_on_partitions(spark):
    _, df = matrix(spark)
    a = W.raw_scores(df, W.fit(df.repartition(1), COLS, trees=20)).toPandas().set_index("cik")["score"]
    b = W.raw_scores(df, W.fit(df.repartition(7, "f1"), COLS, trees=20)).toPandas().set_index("cik")["score"]
    assert a.sort_index().tolist() == b.sort_index().tolist()


def test_each_tree_holds_the_sample(spark):
    _, df = matrix(spark, n=900)
    nodes = W.fit(df, COLS, trees=10, sample=64).nodes.toPandas()
    roots = nodes[nodes["node"] == 0]
    assert len(roots) == 10 and (roots["size"] == 64).all() and nodes["depth"].max() <= 6


def expected(model, row, known):
    """Mean path with the features outside `known` averaged by training share, tree by tree."""
    total = 0.0
    for t in range(model["feature"].shape[0]):
        def walk(node):
            f = model["feature"][t, node]
            if f < 0:
                return model["depth"][t, node] + W.mean_path([model["size"][t, node]])[0]
            l, r = model["left"][t, node], model["right"][t, node]
            if f in known:
                return walk(l if row[f] <= model["threshold"][t, node] else r)
            n = model["size"][t, node]
            return (walk(l) * model["size"][t, l] + walk(r) * model["size"][t, r]) / n
        total += walk(0)
    return total / model["feature"].shape[0]


def test_attributions_are_shapley_values(spark):
    pdf, df = matrix(spark, n=60)
    fitted = W.fit(df, COLS, trees=8, sample=32)
    model = W.node_arrays(fitted)
    out = W.attributions(df, fitted).toPandas().set_index("cik")
    lengths = W.path_lengths(pdf[COLS].to_numpy(), model)
    for i in (0, 17, 40):
        row, phi = pdf[COLS].to_numpy()[i], out.loc[pdf["cik"][i], "phi"]
        assert sum(phi) + out["base"].iloc[0] == pytest.approx(lengths[i])
        for f in range(4):
            others = [g for g in range(4) if g != f]
            want = 0.0
            for k in range(4):
                for s in itertools.combinations(others, k):
                    w = math.factorial(k) * math.factorial(3 - k) / math.factorial(4)
                    want += w * (expected(model, row, {*s, f}) - expected(model, row, set(s)))
            assert phi[f] == pytest.approx(want, abs=1e-9)


def candidates(spark, n=30):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({f: rng.integers(0, 2, n).astype(float) if f in K.COUNT_FEATURES else rng.normal(size=n) for f in K.FEATURES})
    pdf.loc[3, "gross_margin"] = None
    pdf.loc[4, "flag_high_leverage"] = None
    pdf["cik"] = [f"{i:010d}" for i in range(n)]
    pdf["ticker"] = pdf["company_name"] = pdf["cik"]
    pdf["industry_group"], pdf["risk_tier"], pdf["pre_ml_risk_score"] = "X", "LOW", rng.uniform(0, 60, n)
    return spark.createDataFrame(pdf)


def test_scoring_job(spark, tmp_path):
    df = candidates(spark)
    run = scoring.train(df, trees=40)
    got = scoring.anomaly_scores(run, df.select("cik", "ticker", "company_name", "industry_group")).toPandas()
    assert len(got) == 30 and got["ml_risk_score"].between(0, 100).all() and 1 <= got["is_anomaly"].sum() <= 10
    assert not run.features.toPandas()[K.FEATURES].isna().any().any()
    rows = scoring.attribution_rows(run).toPandas()
    assert len(rows) == 30 * len(K.FEATURES) and (rows.groupby("cik")["rank_in_company"].max() == len(K.FEATURES)).all()
    assert ((rows["direction"] == "increases") == (rows["shap_value"] > 0))[rows["abs_shap_value"] > 0].all()
    W.save(run.model, run.fitted, str(tmp_path / "m"))
    model, fitted = W.load(spark, str(tmp_path / "m"))
    assert model.columns == run.model.columns and model.offset == run.model.offset and fitted == run.fitted


def test_empty_input(spark):
    assert scoring.train(candidates(spark).limit(0)) is None
