"""Histogram boosting against naive trees on the raw values, and its edge cases."""

import gc

import numpy as np
import pandas as pd
import pytest

from riskweave.operators import boosting as bo
from riskweave.operators import explain as ex
from riskweave.operators import models as md
from riskweave.session import path_exists

NAMES = ["a", "b.d", "c"]
PARAMS = {"learning_rate": 0.2, "max_depth": 3, "max_iter": 6, "min_samples_leaf": 7, "l2_regularization": 0.7}


def _table(n=500, seed=5):
    rng = np.random.default_rng(seed)
    a, c = rng.normal(size=n).round(2), rng.integers(0, 3, n).astype(float)
    b = rng.normal(size=n).round(1)
    y = ((a + 0.5 * c * (b > 0) + 0.4 * rng.normal(size=n)) > 0.8).astype(int)
    return pd.DataFrame({"a": a, "bcd": b, "c": c, "y": y})


def _frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.withColumnRenamed("bcd", "b.d")


def _naive(x, y, p):
    """Boosted trees grown row by row over all values: (trees of nested tuples, margins)."""
    n, n1 = len(y), int(y.sum())
    w = np.where(y == 1, n / (2 * n1), n / (2 * (n - n1)))
    lam, least, margin, trees = p["l2_regularization"], p["min_samples_leaf"], np.zeros(n), []
    middles = [np.unique(x[:, f]) for f in range(x.shape[1])]
    middles = [(v[1:] + v[:-1]) / 2 for v in middles]

    def node(rows, g, h, depth):
        gain, cut = 0.0, None
        G, H = g[rows].sum(), h[rows].sum()
        if depth < p["max_depth"] and len(rows) >= 2 * least:
            for f in range(x.shape[1]):
                for t in middles[f]:
                    left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                    if min(len(left), len(right)) < least or min(h[left].sum(), h[right].sum()) < 1e-3:
                        continue
                    v = sum(g[s].sum() ** 2 / (h[s].sum() + lam) for s in (left, right)) - G**2 / (H + lam)
                    if v > gain + 1e-9:
                        gain, cut = v, (f, t, left, right)
        if cut is None:
            value = -p["learning_rate"] * G / (H + lam)
            margin[rows] += value
            return value
        f, t, left, right = cut
        return (f, t, node(left, g, h, depth + 1), node(right, g, h, depth + 1))

    for _ in range(p["max_iter"]):
        q = 1 / (1 + np.exp(-margin))
        trees.append(node(np.arange(n), w * (q - y), w * q * (1 - q), 0))
    return trees, margin


def _nested(t, node=0):
    f = t["feature"][node]
    if f < 0:
        return t["value"][node]
    return (f, t["threshold"][node], _nested(t, t["left"][node]), _nested(t, t["left"][node] + 1))


def _same(a, b):
    if isinstance(a, tuple) or isinstance(b, tuple):
        return isinstance(a, tuple) and isinstance(b, tuple) and a[0] == b[0] and np.isclose(a[1], b[1]) and _same(a[2], b[2]) and _same(a[3], b[3])
    return np.isclose(a, b, atol=1e-7)


def test_equals_naive_trees(spark):
    """At most 255 distinct values a feature: every middle between two of them is a candidate cut."""
    pdf = _table()
    pdf["a"] = pdf["a"].round(1)
    x, y = pdf[["a", "bcd", "c"]].to_numpy(), pdf["y"].to_numpy()
    model = bo.fit_hist(_frame(spark, pdf), NAMES, "y", [PARAMS])[0]
    trees, margin = _naive(x, y, PARAMS)
    assert len(model.trees) == len(trees) == 6
    assert all(_same(_nested(t), u) for t, u in zip(model.trees, trees))
    got = _frame(spark, pdf.assign(i=range(len(pdf)))).select("i", model.probability().alias("p")).toPandas().sort_values("i")["p"]
    assert np.allclose(got, 1 / (1 + np.exp(-margin)), atol=1e-7)


def test_partitioning_and_company_change_nothing(spark):
    """The same trees from one part or seven, alone or beside another candidate, across settled margins."""
    df = _frame(spark, _table(1500))
    other = {**PARAMS, "learning_rate": 0.05, "max_depth": 1, "max_iter": bo.PENDING + 3, "l2_regularization": 0.0}
    alone = bo.fit_hist(df.coalesce(1), NAMES, "y", [PARAMS])[0]
    both = bo.fit_hist(df.repartition(7), NAMES, "y", [other, PARAMS])
    assert both[1].trees == alone.trees
    assert len(both[0].trees) == bo.PENDING + 3
    assert both[0].trees == bo.fit_hist(df.repartition(3), NAMES, "y", [other])[0].trees
    assert max(len(t["left"]) for t in both[0].trees) == 3


def test_many_values_are_cut_at_percentiles(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=5000), "z": np.where(rng.random(5000) < 0.9, 0.0, 1.0)}))
    x, z = bo.bin_edges(df, ["x", "z"])
    assert 200 < len(x) <= bo.BINS - 1 and list(z) == [0.5]


def test_l2_shrinks_and_is_reported(spark):
    df = _frame(spark, _table(800))
    grid = [{**PARAMS, "l2_regularization": v, "max_iter": 1} for v in (0.0, 50.0)]
    plain, shrunk = bo.fit_hist(df, NAMES, "y", grid)
    assert max(map(abs, shrunk.trees[0]["value"])) < max(map(abs, plain.trees[0]["value"]))
    found = md.tune_hist(df, df, NAMES, "y", grid)
    assert all(r["l2_supported"] for r in found.rows) and len(found.rows) == 2
    final = md.refit_hist(df, df, NAMES, "y", found.best_params)
    assert len(final.trees) == 1
    imp = ex.native_importance(spark, final, NAMES).toPandas()
    assert abs(imp["importance"].sum() - 1) < 1e-9


def test_saved_model_scores_alike(spark, tmp_path):
    df = _frame(spark, _table(600))
    model = bo.fit_hist(df, NAMES, "y", [PARAMS])[0]
    model.save(spark, str(tmp_path / "m"))
    again = bo.HistModel.load(spark, str(tmp_path / "m"))
    assert again == model
    p, q = (md.score(m, df, NAMES, ["y"]).toPandas()["score"].sort_values().to_numpy() for m in (model, again))
    assert (p == q).all() and 0 < p.min() and p.max() < 1


def test_odd_rows(spark):
    """NULL and NaN features are 0, rows without a label are left out, one class gives leaves, none an error."""
    pdf = _table(300)
    df = _frame(spark, pdf).selectExpr("CASE WHEN c = 1 THEN NULL WHEN c = 2 THEN double('NaN') ELSE a END AS a", "`b.d`", "c", "y", "y AS bins", "'t' AS margins")
    zero = df.selectExpr("CASE WHEN c > 0 THEN 0D ELSE a END AS a", "`b.d`", "c", "y")
    unlabelled = df.selectExpr("100D AS a", "`b.d`", "c", "CAST(NULL AS INT) AS y", "bins", "margins")
    model = bo.fit_hist(df.unionByName(unlabelled), NAMES, "y", [PARAMS])[0]
    plain = bo.fit_hist(zero, NAMES, "y", [PARAMS])[0]
    x = zero.select(plain.probability().alias("p")).toPandas()["p"].sort_values()
    assert np.allclose(df.select(model.probability().alias("p")).toPandas()["p"].sort_values(), x)
    one = bo.fit_hist(zero.where("y = 1"), NAMES, "y", [{**PARAMS, "max_iter": 2}])[0]
    assert all(t["feature"][0] == -1 for t in one.trees)
    assert one.importances() == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        bo.fit_hist(zero.where("y > 5"), NAMES, "y", [PARAMS])
    with pytest.raises(ValueError):
        bo.fit_hist(zero.withColumn("y", zero["y"] + 1), NAMES, "y", [PARAMS])
    assert zero.limit(0).select(model.probability().alias("p")).count() == 0


def test_rows_are_kept_in_blocks_of_columns(spark):
    """A pass reads a few large values, not a row each; dense, sparse and constant features add up to the same histograms."""
    pdf = _table(1000)
    df = _frame(spark, pdf).repartition(3)
    edges = [np.array([-0.5, 0.5]), np.array([0.0]), np.array([])]
    blocks = bo.binned(df, NAMES, "y", edges, block=64).collect()
    assert len(blocks) <= 1000 // 64 + 3
    bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(3, -1) for r in blocks], axis=1)
    y = np.concatenate([np.frombuffer(r["y"], np.uint8) for r in blocks])
    want = [np.searchsorted(e, pdf[c].to_numpy()) for c, e in zip(("a", "bcd", "c"), edges)] + [pdf["y"]]
    assert sorted(zip(*bins.tolist(), y.tolist())) == sorted(zip(*map(list, want)))
    slot = np.arange(len(y)) % 4 - 1
    g, h = np.arange(len(y)) - 300.0, np.arange(len(y)) + 1.0
    acc = np.zeros((3, 3, 3, bo.BINS), np.int64)
    bo._add_histograms(acc, bins, [None, *[np.flatnonzero(b) for b in bins[1:]]], slot, g, h)
    for s in range(3):
        for f in range(3):
            for i, w in enumerate((g, h, np.ones(len(y)))):
                assert acc[s, f, i, :3].tolist() == [w[(slot == s) & (bins[f] == b)].sum() for b in range(3)]


def _spark_ml(df, names, params):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    data = md.with_weights(md.split_xy(df, "y"), "y")
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol=md.FEATURES, handleInvalid="keep"), md.gbt_estimator(params)]).fit(data)


def _scores(model, df, names):
    return md.score(model, df, names, ["i"]).toPandas().sort_values("i")["score"].to_numpy()


def test_first_order_equals_spark_ml(spark):
    """Scores and importances of GBTClassifier, from few or many values, zeros, a constant and 255 bins, one part or five."""
    rng = np.random.default_rng(3)
    n = 1200
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)).round(2), "c": rng.integers(0, 3, n) * 1.0, "d": 7.0})
    pdf["y"] = ((pdf["a"] + pdf["b"] * pdf["c"] + rng.normal(size=n)) > 1.2).astype(int)
    pdf["i"] = range(n)
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame(pdf).coalesce(1).checkpoint()
    base = {"min_samples_leaf": 9, "l2_regularization": 0.5}
    grid = [base | {"learning_rate": 0.1, "max_depth": 3, "max_iter": bo.PENDING + 2}, base | {"learning_rate": 0.3, "max_depth": 2, "max_iter": 3}]
    models = bo.fit_boosted(df, names, "y", grid)
    for model, params in zip(models, grid):
        old = _spark_ml(df, names, params)
        assert len(model.trees) == params["max_iter"]
        assert np.allclose(_scores(model, df, names), _scores(old, df, names), atol=1e-9, rtol=0)
        assert np.allclose(model.importances(), old.stages[-1].featureImportances.toArray(), atol=1e-8)
    assert bo.fit_boosted(df.repartition(5), names, "y", grid[:1]) == models[:1]
    assert md.fit_gbt(df, names, "y", grid[1]) == models[1]


def test_first_order_draws_the_rows_of_spark_ml_for_its_cuts(spark):
    df = spark.range(0, 70_000, 1, 3).selectExpr("id AS i", "(id * 7919 % 70001) / 10D - 900 AS a", "CAST(id * 31 % 1009 AS DOUBLE) AS b", "CAST((id * 7919 % 70001 > 40000) != (id % 11 = 0) AS INT) AS y")
    params = {"min_samples_leaf": 20, "l2_regularization": 0.0, "learning_rate": 0.3, "max_depth": 3, "max_iter": 2}
    new, old = md.fit_gbt(df, ["a", "b"], "y", params), _spark_ml(df, ["a", "b"], params)
    assert np.allclose(_scores(new, df, ["a", "b"]), _scores(old, df, ["a", "b"]), atol=1e-9, rtol=0)


def test_bins_beyond_a_byte(spark):
    """Cuts from drawn rows can be more than 255: no bin wraps around."""
    df = spark.range(2000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id >= 1700 AS INT) AS y").coalesce(1)
    edges = [np.arange(300) * 6.5]
    blocks = bo.binned(df, ["a"], "y", edges).collect()
    assert np.frombuffer(blocks[0]["bins"], bo.bin_type(edges)).tolist() == np.searchsorted(edges[0], np.arange(2000)).tolist()
    model = bo._grown(df, ["a"], "y", edges, [PARAMS | {"max_iter": 1}], {0: 1.0, 1: 1.0}, 2000, 0.0, False)[0]
    assert model.trees[0]["threshold"][0] == 261 * 6.5 and bo.bin_type([np.arange(255)]) is np.uint8
    skewed = bo.cut_points(np.arange(1000.0) + 1, np.ones(1000), 900.0, 254)
    assert len(skewed) > 254


def test_first_order_odd_rows(spark, tmp_path):
    """Rows that GBTClassifier refuses are refused; NaN is above every threshold when scored; a grid takes the passes of its longest candidate."""
    df = _frame(spark, _table(300)).withColumnRenamed("b.d", "b")
    names, params = ["a", "b", "c"], PARAMS | {"max_iter": 4}
    for odd in ("CAST(NULL AS DOUBLE)", "double('NaN')", "double('Infinity')"):
        with pytest.raises(ValueError):
            bo.fit_boosted(df.unionByName(df.limit(1).selectExpr(f"{odd} AS a", "b", "c", "y")), names, "y", [params])
    for rows in (df.selectExpr("a", "b", "c", "CAST(NULL AS INT) AS y"), df.selectExpr("a", "b", "c", "y + 1 AS y"), df.limit(0)):
        with pytest.raises(ValueError):
            bo.fit_boosted(rows, names, "y", [params])
    one = bo.fit_boosted(df.where("y = 0"), names, "y", [params])[0]
    assert all(t["feature"][0] == -1 for t in one.trees) and one.trees[0]["value"] == [-1.0]
    sc = spark.sparkContext
    jobs = []
    for grid in ([params], [params, params | {"max_depth": 2}, params | {"max_iter": 3}]):
        sc.setJobGroup(f"boost-{len(grid)}", "")
        model = bo.fit_boosted(df, names, "y", grid)[0]
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boost-{len(grid)}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 12
    model.save(spark, str(tmp_path / "m"))
    assert bo.HistModel.load(spark, str(tmp_path / "m")) == model
    odd = spark.createDataFrame([(0, float("nan"), None, 1.0), (1, 1e9, 0.0, 1.0)], "i int, a double, b double, c double")
    assert len(set(_scores(model, odd, names))) == 1


def test_margins_do_not_pile_up(spark, monkeypatch):
    """Tasks of late passes carry no more trees than those of early ones, and written margins go with the fit."""
    monkeypatch.setattr(bo, "PENDING", 1)
    depths, files, settle = [], [], bo._settle

    def settled(*args):
        rows = settle(*args)
        depths.append(rows.toDebugString().count(b"\n"))
        files.extend([rows.getCheckpointFile()] if rows.isCheckpointed() else [])
        return rows

    monkeypatch.setattr(bo, "_settle", settled)
    p = {"learning_rate": 0.3, "max_depth": 1, "max_iter": 13, "min_samples_leaf": 1, "l2_regularization": 0.0}
    df = spark.range(0, 64, 1, 2).selectExpr("id * 1.0 AS x", "CAST(id % 7 > 3 AS int) AS y")
    (model,) = bo.fit_boosted(df, ["x"], "y", [p])
    assert len(model.trees) == len(depths) == 13
    assert max(depths[4:]) <= max(depths[:4])
    assert len(files) == 3 and not any(path_exists(spark, f) for f in files)

    def frozen(_):
        bo.lean_worker()
        return gc.get_freeze_count()

    assert spark.sparkContext.parallelize([0], 1).map(frozen).first() > 0


def test_passes_are_short(spark, monkeypatch):
    """Few-valued features are counted together, a pass adds few trees anew, keeping margins takes no job of its own, and no
    pass has a few parts more than cores."""
    rng = np.random.default_rng(8)
    n_bins = [2, 40, 7, 1, 2, 300, 24, 2]
    bins = np.stack([rng.integers(0, b, 500) for b in n_bins]).astype(np.uint16)
    groups = bo.joint_groups(n_bins)
    assert sorted(sum(groups, [])) == list(range(8)) and len(groups) == 4 and [5] in groups
    joint = iter(bo.joint_lines(bins, groups, n_bins))
    lines = [next(joint) if len(g) > 1 else bins[g[0]] for g in groups]
    acc = np.zeros((2, len(groups), 3, 300), np.int64)
    slot, g, h = rng.integers(-1, 2, 500), rng.integers(-9, 9, 500) * 1.0, rng.integers(0, 2, 500).astype(np.uint8)
    bo._add_histograms(acc, lines, [None] * len(lines), slot, g, h)
    for i, group in enumerate(groups):
        for f, one in bo.of_each(acc[:, i], group, n_bins):
            for s in (0, 1):
                for k, w in enumerate((g, h, np.ones(500))):
                    wanted = np.bincount(bins[f][slot == s], weights=w[slot == s], minlength=max(2, n_bins[f]))
                    assert one[s, k].tolist() == wanted.tolist()

    seen, splits = [], bo.level_splits

    def watched(rows, n_bins, steps, state):
        seen.append((rows.getNumPartitions(), max(len(s["pending"]) for s in state)))
        return splits(rows, n_bins, steps, state)

    monkeypatch.setattr(bo, "level_splits", watched)
    sc = spark.sparkContext
    cores = sc.defaultParallelism
    df = spark.range(0, 4000, 1, 3 * cores + 1).selectExpr("CAST(id % 50 AS double) AS x", "CAST(id % 7 > 3 AS int) AS y")
    p = {"learning_rate": 0.3, "max_depth": 1, "min_samples_leaf": 1, "l2_regularization": 0.0}
    bo.fit_boosted(df, ["x"], "y", [p | {"max_iter": 6}])
    assert max(pending for _, pending in seen) < 2
    assert all(parts <= cores or parts % cores == 0 for parts, _ in seen)
    jobs, found = [], []
    for pending in (1, 100):
        monkeypatch.setattr(bo, "PENDING", pending)
        sc.setJobGroup(f"short-{pending}", "")
        found.append(bo.fit_boosted(df.coalesce(2), ["x"], "y", [p | {"max_iter": 3}]))
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"short-{pending}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and found[0] == found[1]


def test_long_fits_take_few_jobs_and_give_the_same_trees(spark, monkeypatch):
    """A fit of many passes grows in tasks that keep the rows: the trees of the passes, in first and second order, over
    several blocks and jobs, with bins of two bytes and with one class."""
    grid = [
        PARAMS | {"learning_rate": 0.2, "max_depth": 4, "max_iter": 16, "min_samples_leaf": 30, "l2_regularization": 0.5},
        PARAMS | {"learning_rate": 0.1, "max_depth": 2, "max_iter": 9, "min_samples_leaf": 1, "l2_regularization": 0.0},
    ]
    df = spark.range(0, 70_000, 1, 3).selectExpr(
        "pmod(hash(id), 997) / 7.0 AS a", "pmod(hash(id, 1), 12) * 1.0 AS b", "pmod(id, 2) * 1.0 AS c", "1.0 AS d",
        "CAST(pmod(hash(id, 2), 100) < 3 + pmod(hash(id), 997) / 30 + pmod(hash(id, 1), 12) AS int) AS y",
    ).cache()
    names, sc = ["a", "b", "c", "d"], spark.sparkContext

    def fits():
        return [bo.fit_boosted(df, names, "y", grid), bo.fit_hist(df, names, "y", grid), bo.fit_boosted(df.where("y = 0").limit(500), names, "y", grid)]

    sc.setJobGroup("long-fits", "")
    monkeypatch.setattr(bo, "TREES_A_JOB", 7)
    in_place = fits()
    jobs = len(sc.statusTracker().getJobIdsForGroup("long-fits"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    monkeypatch.setattr(bo, "MOST_IN_PLACE", 0)
    assert in_place == fits()
    assert jobs < 64 and any(f >= 0 for f in in_place[0][0].trees[-1]["feature"])
    df.unpersist()

    edges = [np.sort(np.unique(np.arange(400) / 3.0)), np.array([0.5])]
    wide = spark.range(2000).selectExpr("pmod(id * 7, 401) / 3.0 AS a", "id % 2 * 1.0 AS b", "CAST(pmod(id * 7, 401) > 300 AS int) AS y")
    args = (wide, ["a", "b"], "y", edges, [grid[0]], {0: 1.0, 1: 1.0}, 2000, 0.0, False)
    by_pass = bo._grown(*args)
    monkeypatch.setattr(bo, "MOST_IN_PLACE", 1 << 23)
    assert bo._grown(*args) == by_pass
