"""Planted-signal model checks, isolation forest ranking, stream = batch,
and plan shape checks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import anomaly as an
from riskweave.operators import features as fe
from riskweave.operators import metrics as mt
from riskweave.operators import models as md
from riskweave.sources import testdata as td

from conftest import SF001


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    n = 4000
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    noise = rng.normal(size=n)
    y = ((2.5 * x1 + 0.3 * noise) > 1.5).astype(int)
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "y": y})
    return spark.createDataFrame(pdf)


def test_baseline_learns_planted_signal(spark, planted):
    model = md.fit_baseline(planted, ["x1", "x2"], "y", max_iter=200)
    s = md.score(model, planted, ["x1", "x2"], ["y"])
    auc = mt.ranking_metrics(mt.score_table(s, "y", "score")).first()["roc_auc"]
    assert auc > 0.8
    coef = model.stages[-1].coefficients.toArray()
    assert abs(coef[0]) > abs(coef[1])


def test_isolation_forest_ranks_outliers(spark):
    rng = np.random.default_rng(3)
    normal = rng.normal(size=(2000, 3))
    outliers = rng.normal(loc=7.0, size=(10, 3))
    X = np.vstack([normal, outliers])
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(id=np.arange(len(X)), y=[0] * 2000 + [1] * 10)
    df = spark.createDataFrame(pdf)
    model = an.fit_isolation_forest(df, ["a", "b", "c"], "id", trees=50)
    scores = an.raw_scores(model, df, ["id", "y"]).toPandas().sort_values("anomaly_raw", ascending=False)
    assert scores.head(10)["y"].sum() >= 9
    assert len(model.forest.groupby("tree")) == 50


def test_anomaly_study_equals_numpy(spark):
    rng = np.random.default_rng(11)
    n = 900
    pdf = pd.DataFrame({"y": (rng.random(n) < 0.1).astype(int), "score": rng.random(n).round(3), "raw": rng.normal(size=n).round(2)})
    pdf["split"] = np.where(np.arange(n) < 600, "train", np.where(np.arange(n) < 750, "valid", "test"))
    pdf.loc[700, "raw"], pdf.loc[701, "raw"] = 90.0, -90.0  # beyond the train bounds: clipped
    rows = {k: v.first() for k, v in an.study(spark.createDataFrame(pdf), "y", "score", "raw").items()}
    train = pdf["split"] == "train"
    low, high = pdf.loc[train, "raw"].min(), pdf.loc[train, "raw"].max()
    anomaly = ((pdf["raw"] - low) / (high - low)).clip(0, 1)
    both = 0.7 * pdf["score"] + 0.3 * anomaly
    expected = {
        "supervised_full": (pdf["score"], 0.5, train | True),
        "isolation_forest_holdout": (anomaly, anomaly[train].quantile(0.95), ~train),
        "isolation_forest_full": (anomaly, anomaly[train].quantile(0.95), train | True),
        "ensemble_full": (both, both.quantile(0.75), train | True),
    }
    assert set(rows) == set(expected)
    for name, (s, t, where) in expected.items():
        hit, y = (s >= t)[where], pdf["y"][where] == 1
        got = rows[name]
        assert got["decision_threshold"] == pytest.approx(t)
        assert [got[c] for c in ("tp", "fp", "fn", "tn")] == [(hit & y).sum(), (hit & ~y).sum(), (~hit & y).sum(), (~hit & ~y).sum()], name
    with pytest.raises(ValueError):
        an.study(spark.createDataFrame(pdf[~train]), "y", "score", "raw")


def test_stream_equals_batch(spark):
    from riskweave.plans.registry import load_all

    stream = load_all()["stream_behavioral_features"].run(spark, SF001).toPandas().set_index("transaction_id").sort_index()
    df = td.events_txn(spark, SF001)
    batch, _, _ = fe.add_behavioral_features(df, "amount", "transaction_time", "user_id", "transaction_id")
    from riskweave.functions.columns import round_doubles

    batch = round_doubles(batch.select("transaction_id", *fe.BEHAVIORAL_FEATURES)).toPandas().set_index("transaction_id").sort_index()
    assert len(stream) == len(batch)
    for c in fe.BEHAVIORAL_FEATURES:
        assert np.allclose(stream[c].astype(float), batch[c].astype(float), equal_nan=True, atol=1e-4), c


def test_late_rows_have_a_sink_of_their_own(spark):
    """On-time and late rows add up to the input; late are those older than the watermark of their micro-batch."""
    from riskweave.streaming import behavioral as bh
    from riskweave.streaming import source as src

    df = td.events_txn(spark, SF001)
    data, root = src.replay_as_files(df, "transaction_time", late_share=0.1)
    stream = src.read_stream(spark, data, src.replay_schema(df))
    op = bh.behavioral_stream(stream, "user_id", "transaction_time", "amount", "transaction_id", watermark="1 hour", end_marker=src.END_MARKER)
    on_time, late = (spark.read.parquet(p).toPandas() for p in bh.write_split(op, root))
    assert sorted([*on_time["transaction_id"], *late["transaction_id"]]) == sorted(r[0] for r in df.select("transaction_id").collect())
    assert late[fe.BEHAVIORAL_FEATURES].isna().all().all()
    written = spark.read.parquet(data.split("/__slice")[0]).toPandas().sort_values("__slice")
    expected, newest = set(), None
    for _, part in written.groupby("__slice"):
        if newest is not None:
            mark = newest.floor("ms") - pd.Timedelta(hours=1)
            expected |= set(part[part["user_id"].notna() & (part["transaction_time"] < mark)]["transaction_id"])
        newest = max(filter(pd.notna, [newest, part["transaction_time"].max()]))
    assert expected and set(late["transaction_id"]) == expected


def test_untimed_rows_may_come_first(spark):
    """Rows without a time, in every slice, follow all timed rows of their user, as in batch."""
    from riskweave.streaming import source as src

    df = td.events_txn(spark, SF001)
    data, _ = src.replay_as_files(df, "transaction_time", rows_per_file=400)
    written = spark.read.parquet(data.split("/__slice")[0])
    untimed = written.where("transaction_time IS NULL")
    assert untimed.select("__slice").distinct().count() > 8
    assert written.inputFiles() and len(written.inputFiles()) >= 25
    assert written.where(f"NOT {src.END_MARKER}").count() == df.count()


def test_sliding_counts_copy_hours_not_rows(spark):
    from riskweave.streaming import velocity as vel

    df = td.events_txn(spark, SF001)
    plan = _plan(vel.daily_sliding_counts(df, "user_id", "transaction_time"))
    # The only copies (Expand) are above the hourly aggregate.
    assert 0 < plan.index("Expand") < plan.index("HashAggregate", plan.index("Expand"))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_plan_has_no_single_partition(spark):
    ff = fe.build_feature_frame(td.events_txn(spark, SF001), td.EVENTS_TXN_ROLES, prune=False)
    plan = _plan(ff.df)
    assert "SinglePartition" not in plan
    assert "Window" in plan


def test_scan_prunes_columns(spark):
    df = td.events_txn(spark, SF001).select("transaction_id", "amount")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_forest_subsample_pool_gives_psi_distinct_rows_per_tree(spark):
    """Pooled draw: every tree gets exactly ψ distinct rows; a pool that is
    too small (n overstated) widens until every tree is full."""
    from pyspark.sql import functions as F

    df = spark.range(40_000).withColumnRenamed("id", "k")
    for n in (40_000, 10**9):  # the second forces repeated widening
        s = an._subsample(df, "k", n, 256, 10, 42)
        per = {r["__tree"]: (r["n"], r["d"]) for r in s.groupBy("__tree").agg(F.count("*").alias("n"), F.count_distinct("k").alias("d")).collect()}
        assert sorted(per) == list(range(10))
        assert all(v == (256, 256) for v in per.values()), per


def test_boosting_and_permutation_find_the_planted_signal(spark, planted):
    from riskweave.operators import explain as ex

    base = {"min_samples_leaf": 5, "l2_regularization": 0.0}
    grid = [base | {"learning_rate": 1e-6, "max_depth": 1, "max_iter": 1}, base | {"learning_rate": 0.3, "max_depth": 3, "max_iter": 8}]
    train, valid = planted.where("id < 3000"), planted.where("id >= 3000")
    res = md.tune_gbt(train, valid, ["x1", "x2"], "y", grid)
    assert res.best_params == grid[1] and [r["candidate"] for r in res.rows] == [0, 1]
    s = md.score(res.model, valid, ["x1", "x2"], ["id", "y"])
    assert mt.evaluate(s, "y", "score", 0.5).first()["roc_auc"] > 0.9
    imp = {r["feature"]: r["importance"] for r in ex.permutation_importance(res.model, valid, ["x1", "x2"], "y", "id", repeats=3).collect()}
    assert imp["x1"] > 0.2 > abs(imp["x2"])
    again = ex.permutation_importance(res.model, valid, ["x1", "x2"], "y", "id", repeats=3)
    assert {r["feature"]: r["importance"] for r in again.collect()} == imp
    # Blocks of one row have no other donor; each row is in the shuffle once.
    alone = ex.permutation_importance(res.model, valid.limit(1), ["x1", "x2"], "y", "id", repeats=2)
    assert [r["importance"] for r in alone.collect()] == [0.0, 0.0]
    spread = ex.permutation_importance(res.model, valid, ["x1", "x2"], "y", "id", repeats=3, block_rows=50).collect()
    assert {r["feature"]: r["importance"] for r in spread}["x1"] > 0.2


def test_artifacts_are_found_again_by_all_that_shapes_them(spark):
    from riskweave.plans import workflows as wf
    from riskweave.session import artifact_path, path_exists

    small = SF001.replace("0.01", "0.001")
    first = wf.prepare_model_data(spark, small)
    again = wf.prepare_model_data(spark, small)
    assert again.features == first.features and again.built == first.built
    assert sorted(again.df.inputFiles()) == sorted(first.df.inputFiles())
    other = wf.prepare_model_data(spark, small, params={"train_ratio": 0.6})
    assert set(other.df.inputFiles()).isdisjoint(first.df.inputFiles())
    assert other.df.where("split = 'train'").count() < first.df.where("split = 'train'").count()
    assert path_exists(spark, artifact_path(spark, "")) and not path_exists(spark, artifact_path(spark, "absent"))


def _user():
    """A user's processor over states that are dicts, and timer values by watermark."""
    from types import SimpleNamespace

    from riskweave.streaming import behavioral as bh

    class State:
        def __init__(self):
            self.kept = {}

        exists = lambda self: bool(self.kept)
        get = lambda self: self.kept.get(())
        update = lambda self, v: self.kept.update({(): v})
        containsKey = lambda self, k: k in self.kept
        getValue = lambda self, k: self.kept[k]
        updateValue = lambda self, k, v: self.kept.update({k: v})
        removeKey = lambda self, k: self.kept.pop(k)
        keys = lambda self: iter(list(self.kept))

    new = lambda *_: State()
    user = bh.UserHistory(0)
    user.init(SimpleNamespace(getValueState=new, getMapState=new, getListState=new, registerTimer=lambda _: None, deleteTimer=lambda _: None))
    return user, lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


def test_final_hours_of_a_user_come_out_as_one_frame():
    user, at = _user()
    us = [h * fe.HOUR_US + 5 for h in range(30, 60)]
    rows = pd.DataFrame({"us": us, "transaction_id": range(30), "amount": [float(i) for i in range(30)]})
    assert list(user.handleInputRows(("u",), iter([rows]), at(0))) == []
    frames = list(user.handleExpiredTimer(("u",), at(59 * fe.HOUR_US // 1000), None))
    assert [len(f) for f in frames] == [29]
    assert frames[0]["user_prior_transaction_count"].tolist() == list(range(29))
    assert frames[0]["user_txn_count_last_24h"].tolist() == [float(min(i, 24)) for i in range(29)]
    assert frames[0]["user_amount_mean_prior"].tolist()[1:] == pytest.approx([(i - 1) / 2 for i in range(1, 29)])
    assert [len(f) for f in user.handleExpiredTimer(("u",), at(61 * fe.HOUR_US // 1000), None)] == [1]


def test_many_waiting_rows_of_a_user_move_to_the_hours(spark, monkeypatch):
    """The same features whether a user's rows are kept in one value, by hour, or move in between."""
    from riskweave.streaming import behavioral as bh

    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 80 * fe.HOUR_US, 300)) // fe.HOUR_US * fe.HOUR_US + rng.integers(0, 4, 300) * 60_000_000
    pdf = pd.DataFrame({"us": us, "transaction_id": rng.permutation(300), "amount": np.where(rng.random(300) < 0.1, np.nan, rng.random(300))})

    def run(small):
        monkeypatch.setattr(bh, "SMALL", small)
        user, n = _user()
        out = []
        for k, ms in enumerate([20, 45, 46, 90]):
            part = pdf[(pdf["us"] // (20 * fe.HOUR_US)) == k]
            out += list(user.handleInputRows(("u",), iter([part]), n(0)))
            out += list(user.handleExpiredTimer(("u",), n(ms * fe.HOUR_US // 1000), None))
        return pd.concat(out).sort_values("transaction_id").reset_index(drop=True)

    by_hour = run(0)
    assert len(by_hour) == 300
    for small in (60, 10_000):
        pd.testing.assert_frame_equal(run(small), by_hour, check_exact=True)


def test_split_sinks_run_a_batch_once(spark, tmp_path):
    from riskweave.streaming import behavioral as bh
    from riskweave.streaming import source as src

    df = td.events_txn(spark, SF001)
    data, root = src.replay_as_files(df, "transaction_time", slices=2)
    seen = str(tmp_path)

    def count(batches):
        import uuid

        for b in batches:
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(b)))
            yield pd.DataFrame({"transaction_id": b["transaction_id"].fillna(-1).astype("int64"), "late": b["transaction_id"].fillna(-1) % 2 == 0})

    stream = src.read_stream(spark, data, src.replay_schema(df)).mapInPandas(count, "transaction_id long, late boolean")
    on_time, late = (spark.read.parquet(p).count() for p in bh.write_split(stream, root))
    assert on_time + late == df.count() + 2
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == df.count() + 2


def test_state_partitions_follow_the_replay(spark):
    from riskweave.streaming import source as src

    _, root = src.replay_as_files(td.events_txn(spark, SF001), "transaction_time", slices=2)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "5000")
    try:
        with src.state_tasks(spark, root):
            assert int(spark.conf.get(key)) == spark.sparkContext.defaultParallelism
        assert spark.conf.get(key) == "5000"
    finally:
        spark.conf.set(key, before)


def test_permuted_copies_are_scored_block_wise_with_the_same_counts(spark, monkeypatch):
    """Only the trees of the replaced feature are walked anew: importances are those of scoring every copy as a row, also with
    null and repeated keys, null features and labels, blocks of one row and more than a slice."""
    from riskweave.operators import boosting as bo
    from riskweave.operators import explain as ex

    df = spark.range(0, 900, 1, 3).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE id div 2 END AS id", "pmod(hash(id), 97) / 9.0 AS a", "pmod(hash(id, 1), 5) * 1.0 AS b", "1.0 AS c",
        "CAST(pmod(hash(id), 97) + 9 * pmod(hash(id, 1), 5) + pmod(hash(id, 2), 30) > 80 AS int) AS y",
    ).cache()
    names = ["a", "b", "c"]
    params = {"learning_rate": 0.3, "max_depth": 2, "max_iter": 5, "min_samples_leaf": 3, "l2_regularization": 0.1}
    odd = df.withColumns({"a": F.expr("CASE WHEN a > 9 THEN NULL WHEN a < 0.5 THEN double('NaN') ELSE a END"), "y": F.expr("CASE WHEN b = 2 AND a < 3 THEN NULL ELSE y END")})
    for model in (bo.fit_boosted(df, names, "y", [params])[0], bo.fit_hist(df, names, "y", [params])[0]):
        found = []
        for kind in (ex.HistModel, ()):
            monkeypatch.setattr(ex, "SLICE", 64)
            with monkeypatch.context() as m:
                m.setattr(ex, "HistModel", kind)
                asked = [(odd, 100), (odd, 1), (df.limit(2), 10)]
                found.append([ex.permutation_importance(model, d, names, "y", "id", repeats=3, block_rows=n) for d, n in asked])
                found[-1] = [sorted((r["feature"], round(r["importance"], 12), round(r["importance_std"], 12)) for r in f.collect()) for f in found[-1]]
        assert found[0] == found[1] and found[0][0][0][1] > 0.02
    plan = ex.permutation_importance(model, odd, names, "y", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    df.unpersist()
