"""Split sizes, metric edge cases and the reference's published sanity values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import metrics as mt
from riskweave.operators import split as sp
from riskweave.operators import thresholds as th
from riskweave.sources import testdata as td

from conftest import SF001


def test_tiny_split_sizes():
    with pytest.raises(ValueError):
        sp.resolve_split_sizes(2)
    assert sp.resolve_split_sizes(3)[:2] == (1, 2)
    assert sp.resolve_split_sizes(4) == (2, 3, 1)
    assert sp.resolve_split_sizes(10) == (7, 8, 2)


def test_time_split_sizes_match_p1(spark):
    res = sp.time_split(td.orders_txn(spark, SF001), "transaction_time", "transaction_id")
    got = {r["split"]: r["rows"] for r in sp.split_sizes(res.df).collect()}
    assert got == res.sizes


def test_stratified_split_keeps_class_shares(spark):
    res = sp.split_feature_frame(td.docs_labeled(spark, SF001), None, "transaction_id", "is_fraud")
    assert res.method == "stratified"
    counts = res.df.groupBy("split", "is_fraud").count().toPandas()
    assert counts["count"].sum() == td.docs_labeled(spark, SF001).count()
    share = counts.groupby("split").apply(lambda g: g.loc[g.is_fraud == 1, "count"].sum() / g["count"].sum(), include_groups=False)
    assert share.max() - share.min() < 0.05


def test_scored_reference_values(spark):
    """AP and ROC-AUC of the `scored` view at sf0.01 (values from SURVEY §5)."""
    r = mt.ranking_metrics(mt.score_table(td.scored(spark, SF001), "y_true", "score")).first()
    assert r["pr_auc"] == pytest.approx(0.2020378, abs=1e-7)
    assert r["roc_auc"] == pytest.approx(0.4981682, abs=1e-7)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "y int, s double")


def test_one_class(spark):
    df = _frame(spark, [(0, 0.1), (0, 0.7), (0, 0.4)])
    row = mt.evaluate(df, "y", "s").first()
    assert row["roc_auc"] is None and row["pr_auc"] is None and row["recall_at_precision_90"] is None
    assert th.no_positive_flag(th.threshold_sweep(df, "y", "s"), df, "y").first()["no_positives"]


def test_constant_score(spark):
    df = _frame(spark, [(1, 0.4), (0, 0.4), (0, 0.4), (1, 0.4), (0, 0.4)])
    r = mt.ranking_metrics(mt.score_table(df, "y", "s")).first()
    assert r["roc_auc"] == pytest.approx(0.5)
    assert r["pr_auc"] == pytest.approx(0.4)


def test_zero_predicted_modes(spark):
    df = _frame(spark, [(1, 0.01), (0, 0.02), (0, 0.03)])
    modes = {r["mode"]: r["threshold"] for r in th.select_modes(th.threshold_sweep(df, "y", "s")).collect()}
    assert modes["conservative"] == pytest.approx(0.8)
    assert modes["aggressive"] == pytest.approx(0.2)


def test_sweep_confusion_sums(spark):
    t = th.threshold_sweep(td.scored(spark, SF001), "y_true", "score")
    n = td.scored(spark, SF001).where(F.col("score").isNotNull()).count()
    assert t.count() == 19
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == n for r in t.collect())


def test_auc_symmetry(spark):
    df = td.scored(spark, SF001)
    a = mt.ranking_metrics(mt.score_table(df, "y_true", "score")).first()["roc_auc"]
    b = mt.ranking_metrics(mt.score_table(df.withColumn("score", 1 - F.col("score")), "y_true", "score")).first()["roc_auc"]
    assert a + b == pytest.approx(1.0)


def test_kth_by_range_matches_sort(spark):
    """Text keys (with a hot duplicate and NULLs) ranked without one task."""
    from riskweave.operators.split import kth_by_range

    keys = [f"id{i:04d}" for i in range(0, 500, 3)] + ["id0100"] * 40 + [None] * 5
    df = spark.createDataFrame([(k,) for k in keys], "tie string")
    ordered = sorted([k for k in keys if k is not None]) + [None] * 5
    for k in (1, 7, 40, 100, len(keys) - 6, len(keys) - 5, len(keys)):
        assert kth_by_range(df, "tie", k, partitions=4) == ordered[k - 1], k


def test_time_split_text_ids_with_tied_times(spark):
    """Time ties broken by text ids: sizes follow P1 and train precedes valid."""
    import datetime as dt

    from riskweave.operators.split import resolve_split_sizes, time_split

    t0 = dt.datetime(2024, 1, 1)
    rows = [(f"t{i:03d}", t0 + dt.timedelta(hours=i // 25)) for i in range(100)]
    df = spark.createDataFrame(rows, "tid string, ts timestamp")
    res = time_split(df, "ts", "tid")
    got = {r["split"]: r["n"] for r in res.df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    tr, va, te = resolve_split_sizes(100)
    assert got == {"train": tr, "valid": va - tr, "test": te}
    last_train = res.df.where("split = 'train'").agg(F.max("tid")).first()[0]
    first_valid = res.df.where("split = 'valid'").agg(F.min("tid")).first()[0]
    assert last_train < first_valid


def test_prefix_buckets_keep_resolution_for_epoch_micros(spark):
    """Bucket keys of large values (epoch µs) stay distinct, so the ordered
    prefix spreads a time column over many buckets instead of one task."""
    from riskweave.functions import ordered as od
    from riskweave.functions.columns import epoch_micros

    df = td.events_txn(spark, SF001).select(epoch_micros(F.col("transaction_time"), None).alias("us"))
    bounds, lo, hi, _ = od._bounds_by_group(df.where("us IS NOT NULL"), "us", [], 256)[()]
    keys = {od._unit_key(float(b), 0, lo, hi) for b in bounds}
    assert len(keys) == len(set(bounds)) > 200
    assert all(0.1 <= k <= 0.9 for k in keys)
    assert sorted(keys) == [od._unit_key(float(b), 0, lo, hi) for b in sorted(set(bounds))]


@pytest.mark.parametrize("rows_per_bucket,buckets", [(7, 1024), (10**9, 1024), (5, 4)])
def test_ordered_prefix_and_quantiles_match_brute_force(spark, rows_per_bucket, buckets, monkeypatch):
    """Many buckets (7 rows each), a single bucket, and a capped first level
    that needs the second (per-bucket) level give the same exact running
    sums and quantiles as pandas, per group, with ties and NULLs."""
    import numpy as np
    import pandas as pd

    from riskweave.functions import ordered as od
    from riskweave.functions.ordered import exact_quantiles, ordered_prefix

    calls = []
    real = od._refine_buckets
    monkeypatch.setattr(od, "_refine_buckets", lambda *a: calls.append(1) or real(*a))
    rng = np.random.default_rng(5)
    g = rng.integers(0, 3, 600)
    v = np.round(rng.normal(1e15, 1e9, 600) / 1e6) * 1e6  # large values with ties
    v[::50] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None)))
    got = ordered_prefix(df, "v", {"c": F.lit(1)}, ["g"], buckets=buckets, rows_per_bucket=rows_per_bucket).toPandas()
    exp = pdf.dropna().groupby(["g", "v"]).size().rename("c").reset_index().sort_values(["g", "v"])
    exp["cum_c"] = exp.groupby("g")["c"].cumsum()
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    assert got["cum_c"].tolist() == exp["cum_c"].tolist()
    q = exact_quantiles(df, "v", [0.25, 0.5, 0.95], ["g"])
    q = q.toPandas().set_index("g")
    for key, part in pdf.dropna().groupby("g"):
        for p, name in ((0.25, "q25"), (0.5, "q50"), (0.95, "q95")):
            assert q.loc[key, name] == pytest.approx(part["v"].quantile(p), rel=1e-12)
    assert bool(calls) == (buckets == 4)  # only the capped case needs the second level


@pytest.mark.parametrize("grid,sketch,few", [(1000, 10_000, 10_000), (20, 100, 10_000), (20, 100, 0)])
def test_ranks_in_brackets_match_sorting(spark, monkeypatch, grid, sketch, few):
    from riskweave.functions import ordered

    monkeypatch.setattr(ordered, "GRID", grid)
    monkeypatch.setattr(ordered, "SKETCH", sketch)
    monkeypatch.setattr(ordered, "BROADCAST_GROUPS", few)
    rng = np.random.default_rng(11)
    parts = {"a": rng.normal(size=4000), "b": np.repeat([3.0, 1.0, 2.0], [3000, 5, 400]), "c": np.array([7.0]), None: rng.integers(0, 50, 900) * 1.0}
    pdf = pd.DataFrame([(g, float(v)) for g, vs in parts.items() for v in vs] + [("a", None), ("d", None)], columns=["g", "v"])
    df = spark.createDataFrame([(g, None if pd.isna(v) else v) for g, v in pdf.itertuples(index=False)], "g string, v double").repartition(7)
    ranks = {"first": F.lit(0), "third": F.floor(F.col("n") / 3), "last": F.col("n") - 1}
    got = {(r["g"], r["rank_name"]): r for r in ordered.at_ranks(df, "v", ranks, ["g"]).collect()}
    assert len(got) == 3 * len(parts)
    for g, values in parts.items():
        s = np.sort(values)
        for name, k in (("first", 0), ("third", len(s) // 3), ("last", len(s) - 1)):
            r = got[g, name]
            assert (r["value"], r["before"], r["count"], r["n"]) == (s[k], (s < s[k]).sum(), (s == s[k]).sum(), len(s))
    assert ordered.at_ranks(df.where("g = 'd'"), "v", ranks).count() == 0


@pytest.mark.parametrize("ordered_at_most,parts,few", [(50, 4, 10_000), (7, 3, 0)])
def test_large_brackets_are_narrowed_in_rounds(spark, monkeypatch, ordered_at_most, parts, few):
    from riskweave.functions import ordered

    monkeypatch.setattr(ordered, "ORDERED", ordered_at_most)
    monkeypatch.setattr(ordered, "PARTS", parts)
    monkeypatch.setattr(ordered, "GRID", 20)
    monkeypatch.setattr(ordered, "SKETCH", 100)
    monkeypatch.setattr(ordered, "BROADCAST_GROUPS", few)
    left = []
    narrow = ordered._narrowed

    def counted(counts, *args):
        out = narrow(counts, *args)
        left.extend(r["n"] for r in out.where("__v IS NOT NULL").groupBy("g", "__i").agg(F.count(F.lit(1)).alias("n")).collect())
        assert counts.where("__v IS NOT NULL").groupBy("g", "__i").count().agg(F.max("count")).first()[0] > 3 * ordered_at_most
        return out

    monkeypatch.setattr(ordered, "_narrowed", counted)
    rng = np.random.default_rng(12)
    groups = {"a": rng.normal(size=3000), None: np.repeat(rng.normal(size=700), rng.integers(1, 9, 700)), "c": np.array([1.0, 1.0, 2.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double").repartition(5)
    ranks = {"first": F.lit(0), "third": F.floor(F.col("n") / 3), "last": F.col("n") - 1}
    for r in ordered.at_ranks(df, "v", ranks, ["g"]).collect():
        s = np.sort(groups[r["g"]])
        v = s[{"first": 0, "third": len(s) // 3, "last": len(s) - 1}[r["rank_name"]]]
        assert (r["value"], r["before"], r["count"], r["n"]) == (v, (s < v).sum(), (s == v).sum(), len(s))
    assert left and max(left) <= ordered_at_most


def test_quantiles_do_not_order_all_values(spark):
    from riskweave.functions.ordered import exact_quantiles

    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    q = exact_quantiles(df, "v", [0.5, 0.95])
    assert q.first()["q50"] == pytest.approx(df.approxQuantile("v", [0.5], 0.0)[0], rel=1e-2)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Bucketizer" not in plan and plan.count("Window") <= 2


def test_many_groups_have_quantiles(spark):
    from riskweave.functions.ordered import exact_quantiles

    df = spark.range(60_000).select((F.col("id") % 20_000).alias("g"), F.col("id").cast("double").alias("v"))
    q = exact_quantiles(df, "v", [0.5], ["g"])
    assert q.count() == 20_000 and q.where(F.col("q50") != F.col("g") + 20_000).count() == 0
