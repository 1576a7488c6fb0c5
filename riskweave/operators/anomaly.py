"""Anomaly detection and score ensembling.

Isolation forest on Spark:

* **Subsample** (ψ = min(256, n) rows per tree, without replacement): a
  seeded row hash gates rows into a pool of about trees × (2ψ + 64) rows,
  whatever the input size; each pooled row gets a seeded hash per tree,
  rows below a cut-off that keeps about 2ψ + 64 candidates per tree are
  emitted as (tree, row) pairs and the ψ smallest hashes per tree are kept
  (``row_number`` over a few hundred rows per tree). If a tree gets fewer
  than ψ candidates, pool and cut-off widen fourfold and the draw repeats,
  so every tree gets exactly ψ rows.
* **Fit**: ``groupBy(tree).applyInPandas`` grows each tree on its ψ rows
  (random feature among non-constant ones, uniform split, depth limit
  ceil(log2 ψ)); the forest is a table of at most trees × (2ψ − 1) nodes.
* **Score**: the forest is broadcast once and evaluated with NumPy on
  Arrow batches (``mapInPandas``), one depth level at a time for all trees
  and all rows of a batch together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.ordered import exact_quantiles

N_TREES = 200
MAX_SAMPLES = 256
SEED = 42
EULER_GAMMA = 0.5772156649015329
FOREST_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double"


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): expected path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """One isolation tree as node rows (feature −1 marks a leaf whose value
    is depth + c(size))."""
    nodes: list[list] = []
    stack = [(np.arange(len(X)), 0, -1, False)]
    while stack:
        idx, depth, parent, is_right = stack.pop()
        nid = len(nodes)
        if parent >= 0:
            nodes[parent][3 if is_right else 2] = nid
        sub = X[idx]
        feat = -1
        if depth < max_depth and len(idx) > 1:
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if len(usable):
                feat = int(rng.choice(usable))
        if feat < 0:
            nodes.append([-1, 0.0, -1, -1, depth + float(average_path_length(len(idx)))])
            continue
        thr = float(rng.uniform(sub[:, feat].min(), sub[:, feat].max()))
        nodes.append([feat, thr, -1, -1, 0.0])
        go_left = sub[:, feat] < thr
        stack.append((idx[~go_left], depth + 1, nid, True))
        stack.append((idx[go_left], depth + 1, nid, False))
    return [tuple(n) for n in nodes]


def _tree_builder(features: list[str], psi: int, seed: int):
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["__tree"].iloc[0])
        X = pdf[features].to_numpy(dtype="float64")
        rng = np.random.default_rng([seed, tree])
        rows = _grow(X, rng, max_depth)
        out = pd.DataFrame(rows, columns=["feature", "threshold", "left", "right", "value"])
        out.insert(0, "node", np.arange(len(out), dtype="int32"))
        out.insert(0, "tree", np.int32(tree))
        return out.astype({"feature": "int32", "left": "int32", "right": "int32"})

    return build


@dataclass
class IsolationForestModel:
    features: list[str]
    forest: pd.DataFrame
    psi: int

    def arrays(self):
        f = self.forest.sort_values(["tree", "node"])
        trees = int(f["tree"].max()) + 1
        width = int(f.groupby("tree")["node"].max().max()) + 1
        shape = (trees, width)
        feat = np.full(shape, -1, dtype="int64")
        thr = np.zeros(shape)
        left = np.zeros(shape, dtype="int64")
        right = np.zeros(shape, dtype="int64")
        val = np.zeros(shape)
        t, n = f["tree"].to_numpy(), f["node"].to_numpy()
        feat[t, n] = f["feature"].to_numpy()
        thr[t, n] = f["threshold"].to_numpy()
        left[t, n] = f["left"].to_numpy()
        right[t, n] = f["right"].to_numpy()
        val[t, n] = f["value"].to_numpy()
        return feat, thr, left, right, val


def _subsample(df: DataFrame, key: str, n: int, psi: int, trees: int, seed: int, widen: float = 1.0) -> DataFrame:
    """ψ rows per tree, uniform without replacement, in two seeded steps.

    A row-level hash first gates rows into a pool of about
    trees × (2ψ + 64) rows (one hash per input row; the pool size does not
    grow with the input). Only pooled rows are copied per tree; a tree takes
    the pooled rows whose per-tree hash is below a cut-off that keeps about
    2ψ + 64 candidates, and the ψ smallest of those. A uniform subset of a
    uniform pool is a uniform subset of the input. If a tree gets fewer
    than ψ candidates, pool and cut-off widen fourfold and the draw repeats
    (up to the whole input), so every tree gets exactly ψ rows.
    """
    want = (2 * psi + 64) * widen
    pool_p = 1.0 if n == 0 else min(1.0, trees * want / n)
    pool_n = max(1.0, pool_p * n)
    frac = min(1.0, want / pool_n)
    kstr = F.col(key).cast("string")
    gate = F.pmod(F.xxhash64(kstr, F.lit(seed), F.lit(-1)), F.lit(2**62)) / float(2**62)
    pooled = df.where(gate < F.lit(pool_p)) if pool_p < 1.0 else df
    u = F.pmod(F.xxhash64(kstr, F.col("__t"), F.lit(seed)), F.lit(2**62)) / float(2**62)
    with_t = pooled.withColumn("__t", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("__u", u)
    cand = with_t.where(F.col("__u") < F.lit(frac)) if frac < 1.0 else with_t
    w = Window.partitionBy("__t").orderBy("__u", F.col(key))
    picked = cand.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= psi)
    if pool_p < 1.0 or frac < 1.0:
        short = picked.groupBy("__t").count().where(F.col("count") < psi).limit(1).count()
        missing = picked.select("__t").distinct().count() < trees
        if short or missing:
            return _subsample(df, key, n, psi, trees, seed, widen * 4)
    return picked.withColumnRenamed("__t", "__tree")


def fit_isolation_forest(
    df: DataFrame,
    features: list[str],
    key: str,
    target: str | None = None,
    trees: int = N_TREES,
    max_samples: int = MAX_SAMPLES,
    seed: int = SEED,
) -> IsolationForestModel:
    """Y1+Y2: train on benign rows when both classes are present, else on all."""
    data = df
    if target is not None:
        k = df.agg(F.count_distinct(F.col(target)).alias("k"), F.count_if(F.col(target) == 0).alias("z")).first()
        if k["k"] > 1 and k["z"] > 0:
            data = df.where(F.col(target) == 0)
    data = data.select(F.col(key), *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)).alias(f) for f in features])
    n = data.count()
    psi = min(max_samples, n)
    sample = _subsample(data, key, n, psi, trees, seed)
    forest = (
        sample.select("__tree", *features)
        .groupBy("__tree")
        .applyInPandas(_tree_builder(features, psi, seed), FOREST_SCHEMA)
    )
    # bounded by trees × (2ψ − 1) rows (≤ 102,200 for the defaults)
    return IsolationForestModel(list(features), forest.toPandas(), psi)


def raw_scores(model: IsolationForestModel, df: DataFrame, keep: list[str], out: str = "anomaly_raw") -> DataFrame:
    """2^(−E[path] / c(ψ)) per row (higher = more anomalous)."""
    spark = df.sparkSession
    arrays = spark.sparkContext.broadcast(model.arrays())
    feats = model.features
    c_psi = float(average_path_length(model.psi))
    data = df.select(*[F.col(f"`{c}`") for c in keep], *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)).alias(f"__f{i}") for i, f in enumerate(feats)])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields if f.name in keep] + [f"`{out}` double"])

    def run(batches):
        feat, thr, left, right, val = arrays.value
        n_trees = feat.shape[0]
        tree_ix = np.arange(n_trees)[:, None]
        for pdf in batches:
            X = pdf[[f"__f{i}" for i in range(len(feats))]].to_numpy(dtype="float64")
            m = len(X)
            cols = np.arange(m)[None, :]
            # all trees at once: node[t, i] is row i's current node in tree t
            node = np.zeros((n_trees, m), dtype="int64")
            while True:
                f = feat[tree_ix, node]
                inner = f >= 0
                if not inner.any():
                    break
                xv = X[cols, np.where(inner, f, 0)]
                nxt = np.where(xv < thr[tree_ix, node], left[tree_ix, node], right[tree_ix, node])
                node = np.where(inner, nxt, node)
            total = val[tree_ix, node].sum(axis=0)
            score = np.power(2.0, -(total / n_trees) / c_psi) if c_psi > 0 else np.full(m, 0.5)
            res = pdf[keep].copy()
            res[out] = score
            yield res

    return data.mapInPandas(run, schema)


def minmax(df: DataFrame, score: str, out: str = "anomaly_score", bounds: tuple[float, float] | None = None) -> DataFrame:
    """(s − min) / (max − min); all equal → 0.5. With ``bounds`` (the
    train min/max) the result is clipped to [0, 1] instead of re-fitted."""
    if bounds is None:
        mm = df.agg(F.min(score).alias("__lo"), F.max(score).alias("__hi"), F.lit(1).alias("__k"))
        j = df.withColumn("__k", F.lit(1)).join(F.broadcast(mm), "__k")  # one-row table
        lo, hi = F.col("__lo"), F.col("__hi")
    else:
        j, lo, hi = df, F.lit(bounds[0]), F.lit(bounds[1])
    span = hi - lo
    val = F.when(F.abs(span) <= 1e-8 + 1e-5 * F.abs(lo), F.lit(0.5)).otherwise((F.col(score) - lo) / span)
    if bounds is not None:
        val = F.least(F.greatest(val, F.lit(0.0)), F.lit(1.0))
    return j.withColumn(out, val).drop("__lo", "__hi", "__k")


def quantile_threshold(df: DataFrame, score: str, q: float) -> DataFrame:
    """Y5 (q = 0.95 of train scores) and Y8 (q = 0.75 of ensemble scores)."""
    return exact_quantiles(df, score, [q], names=["threshold"]).select("threshold")


def ensemble(sup: Column, anom: Column, alpha: float = 0.7) -> Column:
    """α · supervised + (1 − α) · anomaly."""
    return F.lit(alpha) * sup + F.lit(1.0 - alpha) * anom


def evaluate_at(df: DataFrame, y: str, score: str, threshold: float) -> DataFrame:
    """The V12 row at ``threshold`` plus ``decision_threshold``."""
    from riskweave.operators.metrics import evaluate

    return evaluate(df, y, score, threshold).withColumn("decision_threshold", F.lit(float(threshold)))


def study(
    scored: DataFrame, y: str, score: str, raw: str, split: str = "split", alpha: float = 0.7, anomaly_q: float = 0.95, ensemble_q: float = 0.75
) -> dict[str, DataFrame]:
    """Y10+Y11: one metric row per detector from rows with a supervised score and a raw anomaly score.

    The anomaly score is scaled by the train bounds and clipped; its threshold is the ``anomaly_q``
    quantile of the train rows, the ensemble's the ``ensemble_q`` quantile of all rows. The forest is judged on the holdout
    (valid ∪ test) and on all rows, the supervised score at 0.5 and the ensemble on all rows.
    ``scored`` is read several times: pass a written table. No scored train row is an error.
    """
    train = F.col(split) == "train"
    low, high = scored.where(train).agg(F.min(raw), F.max(raw)).first()
    if low is None:
        raise ValueError("The anomaly study needs scored train rows.")
    both = minmax(scored, raw, "anomaly_score", bounds=(low, high))
    both = both.withColumn("ensemble_score", ensemble(F.col(score), F.col("anomaly_score"), alpha))
    t_anomaly = quantile_threshold(both.where(train), "anomaly_score", anomaly_q).first()[0]
    t_ensemble = quantile_threshold(both, "ensemble_score", ensemble_q).first()[0]
    holdout = both.where(F.col(split).isin("valid", "test"))
    return {
        "supervised_full": evaluate_at(both, y, score, 0.5),
        "isolation_forest_holdout": evaluate_at(holdout, y, "anomaly_score", t_anomaly),
        "isolation_forest_full": evaluate_at(both, y, "anomaly_score", t_anomaly),
        "ensemble_full": evaluate_at(both, y, "ensemble_score", t_ensemble),
    }


def score_histograms(df: DataFrame, y: str, score: str) -> DataFrame:
    """Per class, equal-width histogram with min(10, max(3, n)) bins."""
    from riskweave.operators.eda import histogram_by_count

    return histogram_by_count(df, F.col(score), F.col(y).cast("int"), 10, 3)
