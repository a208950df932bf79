"""Isolation forest: grown per tree, scored and explained per batch of rows.

All chance comes from hashes of (seed, tree, row id), so the forest does not depend on how rows
are partitioned. The model is bounded by its parameters: trees x at most 2 * sample - 1 nodes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.exprs import unit_noise
from riskweave.functions.order_stats import percentiles
from riskweave.session import cut_lineage

NODE_SCHEMA = "tree int, node int, feature int, threshold double, `left` int, `right` int, size int, depth int"
EULER = 0.5772156649015329


def mean_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


@dataclass(frozen=True)
class Forest:
    """Nodes as a table plus what scoring needs to know."""

    nodes: DataFrame
    columns: list[str]
    sample: int
    offset: float | None = None


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    rows: list[list] = []
    todo = [(np.arange(len(x)), 0, None, None)]
    while todo:
        members, depth, parent, side = todo.pop()
        node = len(rows)
        rows.append([node, -1, 0.0, -1, -1, len(members), depth])
        if parent is not None:
            rows[parent][side] = node
        if depth >= max_depth or len(members) <= 1:
            continue
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        open_features = np.flatnonzero(high > low)
        if len(open_features) == 0:
            continue
        f = int(rng.choice(open_features))
        cut = float(rng.uniform(low[f], high[f]))
        if cut >= high[f]:
            cut = float(low[f])
        goes_left = x[members, f] <= cut
        rows[node][1:3] = [f, cut]
        todo.append((members[~goes_left], depth + 1, node, 4))
        todo.append((members[goes_left], depth + 1, node, 3))
    return [tuple(r) for r in rows]


def fit(features: DataFrame, columns: Sequence[str], key: str = "cik", trees: int = 200, sample: int = 256, seed: int = 42) -> Forest:
    """Each tree gets the `sample` rows of lowest hash.

    A row joins a tree only below a hash bound that leaves about twice the sample, so the shuffle
    carries trees x 2 x sample rows however many rows there are.
    """
    total = features.count()
    size = min(sample, total)
    depth = int(np.ceil(np.log2(max(size, 2))))
    bound = min(1.0, 2.0 * sample / max(total, 1))
    draw = lambda t: unit_noise(F.lit(seed), t, key)
    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < bound)
    held = features.select(F.col(key).cast("string").alias("_key"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), F.explode(chosen).alias("tree"))
    held = held.withColumn("draw", unit_noise(F.lit(seed), F.col("tree"), F.col("_key")))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["draw", "_key"]).head(size)
        nodes = grow_tree(np.stack(pdf["x"].to_numpy()), np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out

    nodes = cut_lineage(held.groupBy("tree").applyInPandas(grow, NODE_SCHEMA))
    return Forest(nodes, list(columns), size)


def node_arrays(forest: Forest) -> dict[str, np.ndarray]:
    """The model as arrays (trees x nodes); its size is bounded by the fit parameters."""
    pdf = forest.nodes.toPandas()
    t, m = int(pdf["tree"].max()) + 1, int(pdf["node"].max()) + 1
    out = {
        "feature": np.full((t, m), -1, np.int32), "threshold": np.zeros((t, m)), "left": np.full((t, m), -1, np.int32),
        "right": np.full((t, m), -1, np.int32), "size": np.zeros((t, m), np.int32), "depth": np.zeros((t, m), np.int32),
    }
    at = (pdf["tree"].to_numpy(), pdf["node"].to_numpy())
    for name, arr in out.items():
        arr[at] = pdf[name].to_numpy()
    return out


def path_lengths(x: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Mean path length of each row over the trees."""
    trees = np.arange(model["feature"].shape[0])[None, :]
    leaf_value = model["depth"] + mean_path(model["size"])
    at = np.zeros((len(x), trees.shape[1]), np.int32)
    rows = np.arange(len(x))[:, None]
    for _ in range(int(model["depth"].max())):
        f = model["feature"][trees, at]
        inner = f >= 0
        goes_left = x[rows, np.maximum(f, 0)] <= model["threshold"][trees, at]
        nxt = np.where(goes_left, model["left"][trees, at], model["right"][trees, at])
        at = np.where(inner, nxt, at)
    return leaf_value[trees, at].mean(axis=1)


def raw_scores(features: DataFrame, forest: Forest, key: str = "cik") -> DataFrame:
    """key, score in (-1, 0); lower is more unusual."""
    model = features.sparkSession.sparkContext.broadcast(node_arrays(forest))
    norm = float(mean_path([forest.sample])[0]) or 1.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, 1))
            parts = [path_lengths(x[i:i + 2000], model.value) for i in range(0, len(x), 2000)]
            lengths = np.concatenate(parts) if parts else np.zeros(0)
            yield pd.DataFrame({key: pdf[key], "score": -np.power(2.0, -lengths / norm)})

    rows = features.select(F.col(key).cast("string").alias(key), F.array(*[F.col(c).cast("double") for c in forest.columns]).alias("x"))
    return rows.mapInPandas(run, f"{key} string, score double")


def with_offset(scores: DataFrame, forest: Forest, contamination: float = 0.10) -> Forest:
    """Offset: the score below which the given share of the training rows lies."""
    row = percentiles(scores, ["score"], [contamination]).first()
    return Forest(forest.nodes, forest.columns, forest.sample, row["p0"])


def decisions(scores: DataFrame, forest: Forest) -> DataFrame:
    return scores.withColumn("decision", F.col("score") - F.lit(forest.offset))


def save(forest: Forest, fitted: dict[str, tuple[float, float]], path: str) -> None:
    """Model as Parquet: nodes, scaling row and settings."""
    spark = forest.nodes.sparkSession
    forest.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    scale = [(i, c, *map(float, fitted.get(c, (0.0, 1.0)))) for i, c in enumerate(forest.columns)]
    spark.createDataFrame(scale, "place int, feature string, mid double, width double").coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    spark.createDataFrame([(forest.sample, forest.offset)], "sample int, offset double").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")


def load(spark: SparkSession, path: str) -> tuple[Forest, dict[str, tuple[float, float]]]:
    scale = spark.read.parquet(f"{path}/scaler").orderBy("place").collect()
    row = spark.read.parquet(f"{path}/settings").first()
    forest = Forest(spark.read.parquet(f"{path}/nodes"), [r["feature"] for r in scale], row["sample"], row["offset"])
    return forest, {r["feature"]: (r["mid"], r["width"]) for r in scale}


# --- attribution --------------------------------------------------------------------------------------


def leaf_boxes(model: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Every leaf as a box: per feature on its path an interval and the share of training rows inside it."""
    feats, lows, highs, shares, values, covers = [], [], [], [], [], []
    width = max(int(model["depth"].max()), 1)
    for t in range(model["feature"].shape[0]):
        root = model["size"][t, 0]
        todo = [(0, {})]
        while todo:
            node, box = todo.pop()
            f, size = int(model["feature"][t, node]), int(model["size"][t, node])
            if f < 0:
                pad = width - len(box)
                feats.append(list(box) + [0] * pad)
                lows.append([b[0] for b in box.values()] + [-np.inf] * pad)
                highs.append([b[1] for b in box.values()] + [np.inf] * pad)
                shares.append([b[2] for b in box.values()] + [1.0] * pad)
                values.append(model["depth"][t, node] + mean_path([size])[0])
                covers.append(size / root)
                continue
            cut = model["threshold"][t, node]
            lo, hi, share = box.get(f, (-np.inf, np.inf, 1.0))
            left, right = int(model["left"][t, node]), int(model["right"][t, node])
            todo.append((left, {**box, f: (lo, min(hi, cut), share * model["size"][t, left] / size)}))
            todo.append((right, {**box, f: (max(lo, cut), hi, share * model["size"][t, right] / size)}))
    return {
        "feature": np.array(feats), "low": np.array(lows), "high": np.array(highs), "share": np.array(shares),
        "value": np.array(values), "cover": np.array(covers), "trees": np.array(model["feature"].shape[0]),
    }


def shapley(x: np.ndarray, boxes: dict[str, np.ndarray], n_features: int) -> np.ndarray:
    """Exact path-dependent Shapley values of the mean path length.

    A leaf adds value * prod_j(in_j or share_j). Its Shapley value is the integral over t of the
    product of t * in_j + (1 - t) * share_j without the own factor, a polynomial that
    Gauss-Legendre points integrate exactly.
    """
    points = (boxes["feature"].shape[1] + 1) // 2
    at, weight = np.polynomial.legendre.leggauss(max(points, 1))
    at, weight = (at + 1) / 2, weight / 2
    flat = boxes["feature"].ravel()
    spread = np.zeros((len(flat), n_features))
    spread[np.arange(len(flat)), flat] = 1.0
    out = np.zeros((len(x), n_features))
    for i in range(0, len(x), 16):
        v = x[i:i + 16][:, boxes["feature"]]
        inside = ((v > boxes["low"]) & (v <= boxes["high"])).astype(float)
        gap = (inside - boxes["share"]) * boxes["value"][:, None]
        total = np.zeros_like(inside)
        for t, w in zip(at, weight):
            factor = t * inside + (1 - t) * boxes["share"]
            total += w * factor.prod(axis=2, keepdims=True) / factor
        out[i:i + 16] = (total * gap).reshape(len(v), -1) @ spread
    return out / int(boxes["trees"])


def attributions(features: DataFrame, forest: Forest, key: str = "cik") -> DataFrame:
    """key, values (one per feature) and base; values sum with base to the mean path length."""
    boxes = leaf_boxes(node_arrays(forest))
    base = float((boxes["cover"] * boxes["value"]).sum() / boxes["trees"])
    held = features.sparkSession.sparkContext.broadcast(boxes)
    n = len(forest.columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, n))
            yield pd.DataFrame({key: pdf[key], "phi": list(shapley(x, held.value, n))})

    rows = features.select(F.col(key).cast("string").alias(key), F.array(*[F.col(c).cast("double") for c in forest.columns]).alias("x"))
    return rows.mapInPandas(run, f"{key} string, phi array<double>").withColumn("base", F.lit(base))


# tasks get these helpers with the job, so workers need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
