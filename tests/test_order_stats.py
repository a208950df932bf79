import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions import order_stats as O


def frame(spark, seed=1, n=3000):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "g": rng.choice(["a", "b", "c"], n, p=[0.8, 0.15, 0.05]),
        "x": np.where(rng.random(n) < 0.35, 7.0, rng.normal(0, 1e3, n)),  # one value holds a third of the rows
        "y": np.exp(rng.normal(0, 8, n)),
    })
    pdf.loc[::17, "y"] = None
    return pdf, spark.createDataFrame(pdf)


def test_percentiles_match_linear_interpolation(spark):
    pdf, df = frame(spark)
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r["metric"]: r for r in O.percentiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        want = pdf[c].dropna().quantile(probs).tolist()
        assert [got[c][f"p{i}"] for i in range(len(probs))] == pytest.approx(want, rel=1e-12)


def test_percentiles_per_group(spark):
    pdf, df = frame(spark, 2)
    got = {r["g"]: r["p0"] for r in O.percentiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == pytest.approx(pdf.groupby("g")["x"].median().to_dict(), rel=1e-12)


def test_mean_rank_shares_ties(spark):
    pdf, df = frame(spark, 3)
    got = O.mean_rank(df.withColumn("id", F.monotonically_increasing_id()), "x").toPandas()
    assert (got["n_rows"] == len(pdf)).all()
    assert got["mean_rank"].tolist() == pytest.approx(got["x"].rank().tolist())


def test_row_numbers_are_global_and_per_group(spark):
    pdf, df = frame(spark, 4)
    df = df.withColumn("id", F.monotonically_increasing_id())
    order = [F.desc("x"), F.col("id")]
    got = O.row_numbers(O.row_numbers(df, order, "rn"), order, "rg", ["g"]).toPandas().sort_values(["x", "id"], ascending=[False, True])
    assert got["rn"].tolist() == list(range(1, len(pdf) + 1))
    assert (got["rg"] == got.groupby("g").cumcount() + 1).all()
