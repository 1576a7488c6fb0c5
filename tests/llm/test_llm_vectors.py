"""Embedding dedup and nearest neighbours against brute force."""

import numpy as np
import pandas as pd
from llm_fixtures import SF001
from pyspark.sql import functions as F

from riskweave.llm import embedding_dedup, neighbours, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def near_vectors(rng, n=240, dim=24):
    x = rng.normal(size=(n, dim)).astype(np.float32)
    for i in range(0, n, 3):  # near copies of a few, at all distances
        x[i] = x[i % 5] + rng.normal(size=dim) * rng.uniform(0.2, 0.8)
    x[50] = x[51]
    return x


def brute_links(ids, x, threshold):
    x = x.astype(float)
    norm = np.sqrt((x * x).sum(axis=1))
    close = (x @ x.T) / norm[:, None] / norm[None, :] >= threshold
    np.fill_diagonal(close, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(close, root[None, :], len(x)).min(axis=1))
        if (new == root).all():
            return close.sum(axis=1), ids[root]
        root = new


def test_links_whole_table_and_near_copies(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = near_vectors(rng)
    ids = np.arange(len(x)) * 3
    frame = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], SCHEMA).repartition(4)
    links, groups = brute_links(ids, x, 0.9)
    assert links.sum() > 100
    # One tile; tiles that meet one by one; 24 tiles in 4 groups and in 1.
    for tile, meetings in ((4096, 4), (60, 4), (10, 1), (10, 0)):
        monkeypatch.setattr(embedding_dedup, "TILE", tile)
        monkeypatch.setattr(embedding_dedup, "MEETINGS", meetings)
        rows = embedding_dedup.link_vectors(frame).toPandas().sort_values("vec_id")
        assert (rows["n_links"].to_numpy() == links).all() and (rows["component_id"].to_numpy() == groups).all()
        assert (rows["kept"].to_numpy() == (groups == ids)).all()
    table = pd.read_parquet(f"{SF001}/embeddings.parquet").sort_values("vec_id")
    links, groups = brute_links(table["vec_id"].to_numpy(), np.stack(table["embedding"]), 0.9)
    rows = queries.QUERIES["op2_embedding_dedup"](spark, SF001).toPandas().sort_values("vec_id")
    assert (rows["n_links"].to_numpy() == links).all() and (rows["component_id"].to_numpy() == groups).all()


def test_groups_of_tiles_and_lengths_meet_once(spark, monkeypatch):
    """Vectors of two lengths in many tiles: links within a length only, each counted once; a vector is sent once a group."""
    rng = np.random.default_rng(12)
    short, long_ = near_vectors(rng, 90, 8), near_vectors(rng, 150, 24)
    rows = [(i, v.tolist(), 0) for i, v in enumerate([*short, *long_])]
    monkeypatch.setattr(embedding_dedup, "TILE", 12)
    monkeypatch.setattr(embedding_dedup, "MEETINGS", 0)
    n_links, _ = zip(brute_links(np.arange(90), short, 0.9), brute_links(np.arange(150), long_, 0.9), strict=True)
    for held in (128 << 20, 5_000):  # one group, or seven of them by their bytes
        monkeypatch.setattr(embedding_dedup, "HELD_BYTES", held)
        got = embedding_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).toPandas().sort_values("vec_id")
        assert (got["n_links"].to_numpy() == np.concatenate(n_links)).all()
    schema = "tile int, size int, reps binary, counts binary, vectors binary, low array<double>, high array<double>"
    plan = embedding_dedup.met(spark.createDataFrame([], schema), 5, 0.9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_rounding_bounds_hold():
    rng = np.random.default_rng(8)
    for dim in (2, 64, 1500):
        unit = rng.normal(size=(200, dim)) * rng.exponential(size=(200, dim))
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        q, scale, error = embedding_dedup.quantised(unit)
        rounded = (q.astype(float) @ q.astype(float).T) * scale[:, None] * scale[None, :]
        bound = error[:, None] + error[None, :] + error[:, None] * error[None, :]
        assert (np.abs(unit @ unit.T - rounded) <= bound).all()


ODD = [
    (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 1), (3, None, 0), (4, [0.0, 0.0], 0), (5, [None, 1.0], 0), (6, [float("nan"), 1.0], None),
    (7, [float("inf"), 1.0], 0), (8, [2.0, -0.0], 0), (9, [], 0), (10, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0),
]


def odd_vectors(spark):
    frame = spark.createDataFrame(ODD, SCHEMA)
    for name in ("vector", "size", "tile", "key", "rank", "score", "row"):
        frame = frame.withColumn(name, frame["label"])
    return frame


def test_links_of_odd_rows(spark):
    rows = embedding_dedup.link_vectors(odd_vectors(spark)).collect()
    assert len(rows) == len(ODD)
    of = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows}
    assert of[1] == (4, 1, True) and of[2] == (4, 1, False) and of[8] == (4, 1, False)
    assert all(of[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 9, 10)) and of[None] == (4, None, False)
    assert embedding_dedup.link_vectors(odd_vectors(spark).limit(0)).count() == 0


def recall(rows, table, k=20):
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    hit = 0
    asked = np.flatnonzero(ids % 20 == 0)
    for i in asked:
        score = (x * x[i]).sum(axis=1)
        score[i] = -np.inf
        got = rows[rows["query_id"] == ids[i]].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, min(k, len(x) - 1) + 1))
        place = np.searchsorted(ids, got["vec_id"])
        np.testing.assert_allclose(got["score"], score[place], rtol=0, atol=1e-12)
        assert list(zip(-got["score"], got["vec_id"], strict=True)) == sorted(zip(-got["score"], got["vec_id"], strict=True))
        hit += len(set(ids[np.lexsort((ids, -score))[:k]]) & set(got["vec_id"]))
    return hit / (len(asked) * min(k, len(x) - 1))


def test_recall_over_whole_tables(spark):
    for sf in (SF001, "/root/testdata/sf0.1"):
        table = pd.read_parquet(f"{sf}/embeddings.parquet").sort_values("vec_id")
        assert recall(queries.QUERIES["op7_neighbours"](spark, sf).toPandas(), table) >= 0.9


def test_neighbours_by_inner_product_of_unequal_lengths(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 8)
    x = near_vectors(np.random.default_rng(9)) * np.random.default_rng(10).uniform(0.5, 2, (240, 1)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    table = pd.DataFrame({"vec_id": range(len(x)), "embedding": list(x)})
    assert recall(neighbours.nearest(frame).toPandas(), table) >= 0.9


def test_neighbours_of_odd_rows(spark):
    frame = odd_vectors(spark).replace({2: 20, 8: 40}, subset=["vec_id"])
    rows = [tuple(r)[:4] for r in neighbours.nearest(frame, k=3).orderBy("query_id", "rank").collect()]
    assert rows == [(20, 1, 40, 2.0), (20, 2, 1, 1.0), (20, 3, 1, 1.0), (40, 1, 1, 2.0), (40, 2, 1, 2.0), (40, 3, 20, 2.0)]
    assert neighbours.nearest(frame.limit(0)).count() == 0


def grouped_vectors(rng, n=3000, dim=64, groups=30, noise=0.01):
    """Seven in ten rows lie in dense groups of 70, the others anywhere; unit vectors."""
    x = rng.normal(size=(n, dim))
    for g in range(groups):
        x[g * 70 : (g + 1) * 70] = x[g * 70] + noise * rng.normal(size=(70, dim))
    x = rng.permutation(x)
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def test_neighbours_where_most_rows_lie_in_copy_groups(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE", 1000)
    for noise in (0.0, 0.01):
        x = grouped_vectors(np.random.default_rng(11), noise=noise)
        frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
        rows = neighbours.nearest(frame).toPandas()
        for q in range(0, len(x), 20):
            assert rows.loc[rows["query_id"] == q, "rank"].sort_values().tolist() == list(range(1, 21))
        score = x[::20].astype(float) @ x.astype(float).T
        score[np.arange(len(score)), np.arange(0, len(x), 20)] = -np.inf
        kth = np.sort(score, axis=1)[:, -20]  # copies tie, so hits are counted by score
        hits = rows["score"].to_numpy() >= kth[rows["query_id"].to_numpy() // 20] - 1e-9
        assert hits.mean() >= 0.95


def test_queries_left_short_meet_every_vector(spark, monkeypatch):
    x = grouped_vectors(np.random.default_rng(12))
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    monkeypatch.setattr(neighbours, "SLICE", 1000)
    monkeypatch.setattr(neighbours, "QUERIES", 20)
    near_nothing = lambda tables, queries, *rest: np.full(len(queries), 1e-6)
    monkeypatch.setattr(neighbours, "reaches", near_nothing)
    rows = neighbours.nearest(frame).toPandas()
    assert rows.groupby("query_id")["rank"].apply(sorted).tolist() == [list(range(1, 21))] * 150


def test_only_candidates_are_ranked_and_each_once(spark, monkeypatch):
    """n_reranked is the number of other vectors in the visited buckets of any table, however buckets are cut into parts."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(600, 3))  # few dimensions and one length: most buckets are far away
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[100:260] = x[100]  # one bucket with many rows
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    monkeypatch.setattr(neighbours, "SLICE", 50)
    options = dict(tables=2, dims=2, width=0.4, success=0.9, sample=600)
    rows = neighbours.nearest(frame, k=5, **options).toPandas()
    x = x.astype(np.float32).astype(float)
    ids, asked = np.arange(len(x)), np.arange(0, len(x), 20)
    longest = np.sqrt((x * x).sum(axis=1)).max()
    probe = neighbours.Tables(3, longest, 1.0, tables=1, dims=1, width=1.0, success=0.5, seed=3)
    seen = np.zeros((len(asked), len(x)), dtype=bool)
    reach = neighbours.reaches(probe, x[asked], asked, x, ids, 5)
    # The fitted distance is a quantile over distinct sampled vectors, in the order of their id hashes.
    taken = [r[0] for r in frame.orderBy(F.xxhash64("vec_id")).select("vec_id").collect()]
    first = np.sort(np.unique(x[taken], axis=0, return_index=True)[1])[: neighbours.FITTED]
    far = neighbours.reaches(probe, x[taken][first], np.array(taken)[first], x[taken], np.array(taken), 5)
    tables = neighbours.Tables(3, longest, float(np.quantile(far, neighbours.HIGH)), tables=2, dims=2, width=0.4, success=0.9, seed=3)
    own = tables.own_keys(x)
    whole = np.zeros(len(asked), dtype=bool)
    for t in range(2):
        for i, found in enumerate(tables.probes(tables.lifted(x[asked], True), reach, t)):
            whole[i] |= found is None
            seen[i] |= [found is None or key in set(found.tolist()) for key in own[:, t].tolist()]
    seen[whole] = True
    seen[np.arange(len(asked)), asked] = False
    counted = rows.groupby("query_id")["n_reranked"].first().reindex(asked).to_numpy()
    full = seen.sum(axis=1) >= 5  # a query with fewer candidates meets every vector
    assert full.sum() > 20 and (counted[full] == seen.sum(axis=1)[full]).all() and (counted[~full] == len(x) - 1).all()
    assert seen[full & ~whole].mean() < 0.7
