"""Each pipeline stage against brute force, on its own input."""

import corpus_pipeline
import numpy as np
import pandas as pd
import pyarrow as pa
from llm_fixtures import SF0001, duck, odd_docs
from test_llm_texts import check_packing, groups_of, sets_of

from riskweave.llm import ngram_join, tables
from riskweave.llm.line_dedup import LINES_SQL
from riskweave.llm.mixing import MIX_SELECT, MIX_SQL
from riskweave.llm.tables import BATCH_BYTES, Scratch

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    scratch = Scratch(spark, "pipeline-test")
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF0001), name)
        kept[name] = docs.toPandas()
        assert name == "packing" or docs.columns == NAMES
    whole = pd.read_parquet(f"{SF0001}/documents.parquet")
    labels = pd.read_parquet(f"{SF0001}/labels.parquet").merge(whole, on="doc_id")
    gone = set(labels["doc_id"]) - set(kept["quality"]["doc_id"])
    assert (labels["doc_id"].isin(gone) == (labels["quality"] == 0)).mean() > 0.95

    con = duck(SF0001)
    con.register("docs_in", kept["quality"])
    lines = con.sql(LINES_SQL.format(docs="docs_in") + "select doc_id, case when len(kept) < len(lines) then array_to_string(kept, chr(10)) else text end as text from cl")
    assert sorted(lines.fetchall()) == sorted(zip(kept["line_dedup"]["doc_id"], kept["line_dedup"]["text"], strict=True))

    before = kept["line_dedup"]
    groups = groups_of(sets_of(zip(before["doc_id"], before["text"], strict=True), 5), 80, 100)
    assert sorted(kept["near_duplicates"]["doc_id"]) == sorted({g for g in groups.values()})

    con.register("mix_in", kept["near_duplicates"])
    taken = con.sql(MIX_SQL.format(docs="mix_in") + MIX_SELECT).df().set_index("doc_id")["taken"]
    words = kept["mixing"].assign(n=[len(t.encode().split()) for t in kept["mixing"]["text"]]).groupby("doc_id")["n"].sum()
    assert words.to_dict() == taken[taken > 0].to_dict()
    assert (kept["mixing"]["n_chars"] == kept["mixing"]["text"].str.len()).mean() > 0.9

    check_packing(kept["packing"], zip(kept["mixing"]["doc_id"], kept["mixing"]["text"], strict=True))
    assert np.isin(kept["packing"]["doc_id"], kept["mixing"]["doc_id"]).all()


def test_a_cut_copy_keeps_its_lines(spark):
    text = " a  first\tline\r\n\n  second É\u00a0line \nthird line " * 3
    rows = [(i, text, "en", s, len(text)) for i, s in enumerate("abbccc" * 3 + "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mix_sources(spark, docs, SF0001).collect()
    short = [r["text"] for r in out if r["text"] != text]
    assert short
    for t in short:
        assert text.startswith(t) and t[-1:].strip() and text[len(t)].isspace()
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_stages_take_odd_rows(spark):
    """Every row has a defined place in each stage, and columns that steps name themselves keep their values."""
    docs = odd_docs(spark)
    for name in ("source_size", "n_lines", "n_dropped"):
        docs = docs.withColumn(name, docs["lang"])
    rows = docs.toPandas()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF0001).count() == 0
        out = stage(spark, docs, SF0001)
        kept[name] = out.toPandas()
        if name == "packing":
            continue
        assert out.columns == docs.columns
        for column in set(docs.columns) - {*NAMES, "source"}:  # copies of lang, so they must follow it
            same = kept[name][column].fillna("") == kept[name]["lang"].fillna("")
            assert same.all(), (name, column)
    assert len(kept["line_dedup"]) == len(rows)
    with_words = rows["text"].fillna("").str.encode("utf-8").map(lambda t: len(t.split()) > 0)
    assert kept["near_duplicates"]["doc_id"].isna().sum() == 1
    # 2 is a copy of 1; both rows of 7 share one id; the others are alike to nothing.
    assert sorted(kept["near_duplicates"]["doc_id"].dropna().astype(int)) == [1, 3, 4, 5, 6, 7, 7, 8]
    assert set(kept["mixing"]["doc_id"].fillna(-1)) <= set(rows["doc_id"][with_words].fillna(-1))
    ids = kept["packing"].groupby("doc_id", dropna=False)["length"].sum()
    assert len(kept["packing"]["doc_id"].isna().to_numpy().nonzero()[0]) == 1 and ids[3] == ids[4] == ids[5] == 1


def test_texts_reach_workers_in_bounded_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 400, 1, 1).selectExpr("id AS doc_id", "repeat('abcd ', 10000) AS text", "'a' AS lang", "'b' AS source", "50000L AS n_chars")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    try:
        for stage in (corpus_pipeline.drop_low_quality, corpus_pipeline.drop_near_duplicates, corpus_pipeline.pack_windows):
            spark.conf.set(key, "64m")
            stage(spark, docs, SF0001)
            assert docs.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0] < BATCH_BYTES + 100_000
        spark.conf.set(key, "1m")
        stage(spark, docs, SF0001)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_copies_and_common_shingles_are_told_across_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 30, 1, 1).selectExpr("id AS doc_id", "'one two three four five six seven' AS text")
    common = spark.sparkContext.broadcast(np.zeros(0, dtype=np.uint64))
    try:
        spark.conf.set(key, 4)
        rows = ngram_join.signed(docs, common, k=3, num=90, den=100).toPandas()
        links = rows[rows["code"] == ngram_join.LINK]
        assert set(rows["a"][rows["code"] != ngram_join.LINK]) == {0}
        assert set(zip(links["a"], links["b"])) == {(i, 0) for i in range(1, 30)}
        told = ngram_join.described(docs, k=3).toPandas()
        assert told["n"].tolist() == [5] * 30 and [set(t) for t in told["times"] if len(t)] == [{30}]
        none = ngram_join.described(docs.where("doc_id < 0"), k=3)
        assert none.count() == 0
    finally:
        spark.conf.set(key, before)


def test_only_the_first_of_all_copies_signs(spark):
    """Copies far apart add no signatures, so no pairs of copies are shuffled."""
    words = [" ".join(f"w{(7 * i + j) % 97}x{i}" for j in range(60)) for i in range(20)]
    docs = spark.createDataFrame([(100 * c + i, t) for c in range(6) for i, t in enumerate(words)], "doc_id long, text string").repartition(6)
    firsts = tables.id_bits(docs.where("doc_id < 100"), "doc_id")
    common = spark.sparkContext.broadcast(np.zeros(0, dtype=np.uint64))
    rows = ngram_join.signed(docs, common, firsts, k=3, num=90, den=100).toPandas()
    assert set(rows["a"]) == set(range(20))
    kept = ngram_join.one_of_each_group(docs, k=3, num=90, den=100)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(20))


def test_id_bits_find_every_id_again_and_leave_out_most_others(spark):
    ids = spark.createDataFrame([(-5,), (0,), (None,), (2**62,), *[(7 * i,) for i in range(5000)]], "i long")
    table = tables.id_bits(ids, "i")
    assert ids.where(tables.has_bit("i", table)).count() == 5003
    others = spark.range(10**6, 10**6 + 20_000).selectExpr("id as i")
    assert others.where(tables.has_bit("i", table)).count() < 4000
    assert ids.where(tables.has_bit("i", tables.id_bits(ids.limit(0), "i"))).count() == 0


def test_near_duplicates_shuffle_only_the_texts_that_may_go(spark):
    """No join of the result moves the rows that surely stay."""
    docs = odd_docs(spark)
    plan = ngram_join.one_of_each_group(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "found(" in plan
