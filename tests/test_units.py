"""Small operator contracts: selection metric, importance data choice,
threshold loading, path resolution, encoder behaviour, request parsing."""

import os

import pytest
from pyspark.sql import functions as F

from riskweave.operators import encode as en
from riskweave.operators import explain as ex
from riskweave.operators import models as md
from riskweave.operators import scoring as sc
from riskweave.operators import thresholds as th
from riskweave.session import shared_path
from riskweave.sources import io
from riskweave.sources import testdata as td

from conftest import SF001


def test_choose_selection_metric():
    assert md.choose_selection_metric({"pr_auc": 0.3, "roc_auc": 0.6, "log_loss": 0.5}) == ("pr_auc", 0.3, "max")
    assert md.choose_selection_metric({"pr_auc": None, "roc_auc": 0.6, "log_loss": 0.5}) == ("roc_auc", 0.6, "max")
    assert md.choose_selection_metric({"pr_auc": None, "roc_auc": None, "log_loss": 0.5}) == ("log_loss", 0.5, "min")


def test_choose_importance_dataset(spark):
    df = spark.createDataFrame([(i, "test" if i < 5 else "train", i % 2) for i in range(30)], "id int, split string, y int")
    assert ex.choose_importance_dataset(df, "split", "test", "y").count() == 30  # 5 rows < 10 → all splits
    assert ex.choose_importance_dataset(df, "split", "train", "y").count() == 25


def test_load_threshold(spark):
    assert th.load_threshold(spark, None) == 0.5
    assert th.load_threshold(spark, "/nonexistent/threshold.csv") == 0.5
    table = th.threshold_sweep(td.scored(spark, SF001), "y_true", "score")
    path = shared_path(spark, "threshold-table-test")
    io.write_csv(table, path)
    best = table.orderBy(F.asc("business_cost"), F.desc("f1"), F.desc("threshold")).first()["threshold"]
    assert th.load_threshold(spark, path) == pytest.approx(best)


def test_resolve_data_path(tmp_path):
    with pytest.raises(FileNotFoundError):
        io.resolve_data_path(None, str(tmp_path))
    (tmp_path / "b.parquet").write_bytes(b"")
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "c.txt").write_text("")
    assert io.resolve_data_path(None, str(tmp_path)).endswith("a.csv")
    with pytest.raises(FileNotFoundError):
        io.resolve_data_path("missing.csv", str(tmp_path))
    with pytest.raises(ValueError):
        io.load_dataset(None, str(tmp_path / "c.txt"))


def test_unseen_and_pooled_categories(spark):
    train = spark.createDataFrame([("a",)] * 50 + [("b",)] * 49 + [("c",)] + [(None,)] * 2, "m string")
    enc = en.fit_encoder(train, [], ["m"], min_frequency=0.05)
    assert enc.categorical[0].mode == "a"
    assert enc.output_features == ["m_a", "m_b", "m_infrequent_sklearn"]
    test = spark.createDataFrame([("a",), ("c",), ("zzz",), (None,)], "m string")
    rows = [tuple(r) for r in enc.transform(test).collect()]
    assert rows == [(1.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, 0.0, 1.0), (1.0, 0.0, 0.0)]
    enc2 = en.fit_encoder(train, [], ["m"], min_frequency=0.0)  # nothing pooled: unseen → zeros
    assert [tuple(r) for r in enc2.transform(test.where("m = 'zzz'")).collect()] == [(0.0, 0.0, 0.0)]


def test_parse_request_aliases_and_extras(spark):
    df = spark.createDataFrame(
        [('{"tx_id": "t1", "customer_id": "u9", "event_time": "2026-03-01T10:15:00", "amount": 125.5, "channel": "web"}',),
         ('{"transaction_id": "t2", "user_id": "u1", "amount": "abc"}',)],
        "body string",
    )
    rows = {r["transaction_id"]: r for r in sc.parse_requests(df, "body").collect()}
    assert rows["t1"]["user_id"] == "u9" and rows["t1"]["amount"] == 125.5
    assert rows["t1"]["transaction_time"] is not None and rows["t1"]["extras"] == {"channel": "web"}
    assert rows["t2"]["amount"] is None
    coerced = df.select(sc.coerce_numeric(F.lit("abc")).alias("x")).first()["x"]
    assert coerced == 0.0


def test_csv_keeps_microseconds_and_empty_text(spark):
    import datetime as dt

    rows = [(1, dt.datetime(2024, 1, 1, 1, 2, 3, 575), "a"), (2, None, None), (3, dt.datetime(2024, 1, 1), ""), (4, None, 'x,"y"')]
    df = spark.createDataFrame(rows, "i long, t timestamp_ntz, s string")
    path = shared_path(spark, "csv-round-trip.csv")
    io.write_csv(df, path)
    assert sorted(map(tuple, io.load_dataset(spark, path, df.schema).collect())) == rows


def test_every_scored_row_stays(spark):
    rows = [(1, 0.7), (2, float("nan")), (3, None), (4, 0.1), (5, 1.5)]
    out = sc.label_scores(spark.createDataFrame(rows, "id long, score double"), "id", 0.5).collect()
    assert {r["id"]: (r["fraud_label"], r["contract_ok"]) for r in out} == {
        1: (1, True), 2: (None, False), 3: (None, False), 4: (0, True), 5: (None, False)
    }


def test_group_candidates_above_the_limit_have_no_count(spark):
    from riskweave.operators import eda

    df = spark.range(5000).select(
        F.concat(F.lit("v"), F.col("id") % 95).alias("many"), F.concat(F.lit("v"), F.col("id")).alias("each"),
        F.concat(F.lit("v"), F.col("id") % 20).alias("some"),
    )
    got = {r["column_name"]: tuple(r)[1:] for r in eda.group_candidates(df, None).collect()}
    assert got == {"many": (None, True, False), "each": (None, True, False), "some": (20, False, True)}


def test_a_time_column_without_times_counts_as_absent(spark):
    from riskweave.operators import eda
    from riskweave.operators import features as fe

    df = td.events_txn(spark, SF001).limit(50).withColumn("transaction_time", F.lit("soon"))
    ff = fe.build_feature_frame(df, td.EVENTS_TXN_ROLES)
    assert ff.built_features == ["amount_log1p"] and len(ff.unavailable_features) == 2
    assert "event_hour" not in ff.df.columns and any("transaction_time" in n for n in ff.notes)
    report = eda.run_full_eda(df, td.EVENTS_TXN_ROLES)
    assert "rate_by_hour" not in report.tables and "top_values" in report.tables


def test_wide_tables_of_small_vocabularies_encode(spark):
    df = spark.range(200).select("id", F.lit("train").alias("split"), (F.col("id") % 2).cast("int").alias("y"),
                                 (F.col("id") % 3 == 0).alias("flag"), *[(F.col("id") % 50 + i).cast("string").alias(f"c{i}") for i in range(40)])
    out, enc = en.build_processed_splits(df, [], ["flag", *[f"c{i}" for i in range(40)]], "y")
    assert enc.categorical[0].output_columns == ["flag_False", "flag_True"] and len(out.columns) == 2 + 2 + 40 * 50
    with pytest.raises(ValueError, match="c0"):
        en.fit_encoder(spark.range(200).select(F.col("id").cast("string").alias("c0")), [], ["c0"])


def test_split_sizes_and_non_binary_targets(spark):
    from riskweave.operators import split as sp

    df = spark.range(399).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"), (F.col("id") * 7 % 399).alias("wide"))
    res = sp.hash_split(df, "k", "y")
    assert res.method == "stratified" and res.sizes == {"train": 279, "valid": 60, "test": 60}
    got = {r["split"]: r["n"] for r in res.df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == res.sizes
    ones = res.df.where("y = 1").groupBy("split").count().collect()
    assert sorted(r["count"] for r in ones) == [6, 6, 28]
    assert sp.hash_split(df, "k", "wide").method == "random"
    assert sp.hash_split(df.withColumn("y", F.when(F.col("k") > 5, F.col("y"))), "k", "y").method == "stratified"
    assert sp.hash_split(df.limit(0), "k", "y").sizes == {"train": 0, "valid": 0, "test": 0}


def test_files_are_found_on_any_file_system(spark, tmp_path):
    for name in ("b.parquet", "a.parquet"):
        spark.range(3).write.parquet(f"file://{tmp_path}/{name}")
    spark.range(2).write.option("header", True).csv(f"file://{tmp_path}/c.csv")
    (tmp_path / "0.txt").write_text("x")
    root = f"file://{tmp_path}"
    found = io.resolve_data_path(None, root, spark)
    assert found == f"{root}/a.parquet" and io.load_dataset(spark, found).count() == 3
    assert io.resolve_data_path("c.csv", root, spark) == f"{root}/c.csv"
    assert io.resolve_data_path(f"{root}/b.parquet", "/nowhere", spark) == f"{root}/b.parquet"
    for missing in (lambda: io.resolve_data_path("d.csv", root, spark), lambda: io.resolve_data_path(None, f"{root}/none", spark)):
        with pytest.raises(FileNotFoundError):
            missing()
    # A bare folder of part files takes the format of its files; a mixed one must be told.
    bare = tmp_path / "bare"
    spark.range(4).write.parquet(f"file://{bare}")
    assert io.load_dataset(spark, f"file://{bare}").count() == 4
    with pytest.raises(ValueError):
        io.load_dataset(spark, root)


def test_json_sink_and_detected_roles(spark, tmp_path):
    from riskweave.roles import Roles, candidates

    df = spark.createDataFrame([(1, 2, 3, 4, 5.0, None)], "`Trans Num` long, order_id long, cc_num long, class int, amt double, date string")
    path = f"file://{tmp_path}/t.json"
    io.write_json(df, path)
    assert spark.read.schema(df.schema).json(path).collect() == df.collect()
    assert Roles.detect(df) == Roles("class", "date", "cc_num", "Trans Num", "amt")
    assert Roles.detect(df, timestamp=None).timestamp is None
    assert candidates(df, "transaction_id") == ["Trans Num", "order_id"]
    with pytest.raises(ValueError):
        candidates(df, "colour")


def test_distinct_shares_of_id_candidates(spark, monkeypatch):
    from riskweave import roles

    df = spark.range(3000).selectExpr("id AS order_id", "id % 70 AS user_id", "if(id % 3 = 0, NULL, id % 900) AS client_id", "CAST(NULL AS STRING) AS tx_id")
    rows = {r["column_name"]: r for r in roles.role_profile(df).collect()}
    assert (rows["order_id"]["distinct_share"], rows["order_id"]["distinct_exact"]) == (1.0, True)
    assert rows["user_id"]["distinct_share"] == pytest.approx(70 / 3000)
    assert rows["client_id"]["distinct_share"] == pytest.approx(600 / 2000)
    assert rows["tx_id"]["distinct_share"] is None
    monkeypatch.setattr(roles, "FEW_VALUES", 10)
    rows = {r["column_name"]: r for r in roles.role_profile(df).collect()}
    assert not rows["client_id"]["distinct_exact"] and rows["client_id"]["distinct_share"] == pytest.approx(0.3, rel=0.1)
    assert rows["order_id"]["distinct_exact"]


def test_duplicate_rows_by_key(spark, monkeypatch):
    from riskweave.operators import audit

    nan, nan2 = float("nan"), -float("nan")
    rows = [("a", None, 0.0), ("a", None, -0.0), (None, "a", 0.0), ("b", "x", nan), ("b", "x", nan2), ("c", "y", None), ("c", "y", 1.0), ("c", "y", 1.0)]
    df = spark.createDataFrame(rows, "s string, t string, v double")
    assert tuple(audit.duplicate_rows(df).first()) == (8, 5, 3)
    assert tuple(audit.duplicate_rows(df.limit(0)).first()) == (0, 0, 0)
    # Rows that differ are told apart under one key.
    monkeypatch.setattr(audit, "_row_key", lambda df: [F.lit(1), F.length("s")])
    assert tuple(audit.duplicate_rows(df).first()) == (8, 5, 3)


def test_whole_report_has_the_blocks_of_its_operators(spark):
    import json

    from riskweave.operators import eda
    from riskweave.sources import testdata as td

    df = td.events_txn(spark, "/root/testdata/sf0.001")
    rep = eda.run_full_eda(df, td.EVENTS_TXN_ROLES, shared=True)
    rows = eda.report_rows(rep).collect()
    by_block = {}
    for r in rows:
        by_block.setdefault(r["block"], []).append(r["row"])
    plain = eda.run_full_eda(df, td.EVENTS_TXN_ROLES).tables
    assert set(by_block) - {"note"} == set(plain) and len(plain) >= 9
    for name in ("rate_by_hour", "dataset_summary", "target_distribution"):
        whole = plain[name].selectExpr("to_json(struct(*), map('ignoreNullFields', 'false')) AS j")
        assert sorted(by_block[name]) == sorted(r["j"] for r in whole.collect())
    assert all(json.loads(r) for n, rs in by_block.items() if n != "note" for r in rs)
