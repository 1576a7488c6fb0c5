"""Mixing, line dedup and URL rules: SQL on whole tables, odd rows by hand."""

import math
import random
import time
from collections import Counter
from itertools import combinations, product

import pytest
from llm_fixtures import SF001, duck, no_docs, odd_docs, same_rows
from pyspark.sql import functions as F

from riskweave.llm import queries, url_filter
from riskweave.llm.line_dedup import drop_frequent_lines
from riskweave.llm.mixing import mix
from riskweave.llm.tables import Scratch


@pytest.mark.parametrize("name", ["op9_mixing", "op10_line_dedup"])
def test_same_as_sql(spark, name):
    found, wanted = queries.QUERIES[name](spark, SF001).toPandas(), duck().sql(queries.ORACLE_SQL[name]).df()
    for frame in (found, wanted):
        if "target" in frame:
            frame["target"] = frame["target"].round(6)
    same_rows(found, wanted)


def test_mix_odd_rows(spark):
    rows = mix(odd_docs(spark)).toPandas()
    assert len(rows) == 10
    for source, part in rows.groupby("source", dropna=False):
        size = part["size"].sum()
        assert (part["source_size"] == size).all()
        target = part["target"].iloc[0]
        assert part["taken"].sum() == int(target) and target <= 3 * size + 1e-9
        assert (part["taken"] <= 3 * part["size"]).all()
    assert rows["target"].groupby(rows["source"].fillna("")).first().sum() == pytest.approx(rows["size"].sum())
    again = mix(odd_docs(spark)).toPandas()
    same_rows(rows, again)
    assert mix(no_docs(spark)).count() == 0


def test_mix_many_rows_of_one_source(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', int(id % 7))").alias("text"),
        F.expr("if(id % 3 = 0, 'x', concat('s', id % 50))").alias("source"),
    )
    rows = mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.expr("taken > 3 * size")).alias("over")).collect()
    assert all(r["taken"] == int(r["target"]) and not r["over"] for r in rows)


def test_line_dedup_odd_rows(spark):
    rows = {(r["doc_id"], r["text"]): r for r in drop_frequent_lines(odd_docs(spark), min_pages=1, ratio=0.99).collect()}
    assert len(rows) == 9  # row 7 twice
    # Copies are one page of their host: with a floor of one page all their lines are frequent.
    assert rows[(1, "")]["n_dropped"] == 3
    assert rows[(3, None)]["n_lines"] == 0
    assert rows[(4, "")]["n_lines"] == 1 and rows[(4, "")]["n_dropped"] == 0
    assert (5, " \n\t ") in rows
    assert drop_frequent_lines(no_docs(spark)).count() == 0


def test_line_dedup_counts_distinct_pages(spark):
    pages = [(i, f"menu\npage {i}\n\n") for i in range(10)] + [(100 + i, "a copied page\nof two lines") for i in range(30)]
    docs = spark.createDataFrame([(i, t, "h") for i, t in pages], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in drop_frequent_lines(docs, ratio=0.5, min_pages=5).collect()}
    assert rows[3]["text"] == "page 3\n\n" and rows[3]["n_dropped"] == 1
    assert rows[100]["n_dropped"] == 0


def test_url_parts_and_listed_rules(spark):
    cases = [
        (0, "https://A.Net/x", "a.net", "/x", "net/", "block"),
        (1, "http://m.example.net/en/5?q", "m.example.net", "/en/5", "example.net/en/", "allow"),
        (2, "http://example.com/de/#a", "example.com", "/de/", "example.com/de/", "block"),
        (3, "x://b.org/fr/1", "b.org", "/fr/1", "org/fr/", "allow"),
        (4, "https://a.net", "a.net", "", None, "allow"),
        (5, "https://xnet/", "xnet", "/", None, "allow"),
        (6, "no scheme", "", "", None, "allow"),
        (7, None, "", "", None, "allow"),
        (8, "", "", "", None, "allow"),
        (9, "https://ÀB.ORG/fr/a/b?x://y", "Àb.org", "/fr/a/b", "org/fr/", "allow"),
        (9, "https://ÀB.ORG/fr/a/b?x://y", "Àb.org", "/fr/a/b", "org/fr/", "allow"),
    ]
    pages = spark.createDataFrame([(c[0], c[1], "t") for c in cases], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_filter.judge(pages, labels).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr((c[0], *c[2:])) for c in cases)
    assert url_filter.judge(pages.limit(0), labels).count() == 0


def test_mined_rules_find_planted_combination(spark):
    # spam only where both tokens meet
    pages = [(i, f"https://h{i % 4}.org/{'shop' if i % 2 else 'news'}/{i}?{'ref' if i % 3 == 0 else 'id'}=1") for i in range(600)]
    labels = [(i, 0 if i % 2 and i % 3 == 0 else 1, None) for i in range(0, 600) if i % 5]
    table = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = url_filter.judge(table, marks, min_support=0.02, min_confidence=0.9).collect()
    assert all((r["verdict"] == "block") == (r["page_id"] % 6 == 3) for r in rows)


def rules_by_hand(labelled, min_support, min_confidence):
    """All token sets of bad rows with enough support and confidence, each counted over all rows."""
    least = math.ceil(min_support * len(labelled))
    sets = Counter(frozenset(c) for tokens, bad in labelled if bad for n in range(1, len(tokens) + 1) for c in combinations(sorted(tokens), n))
    strong = {s: n / sum(1 for tokens, _ in labelled if s <= tokens) for s, n in sets.items() if n >= least}
    return {s: c for s, c in strong.items() if c >= min_confidence}


@pytest.mark.parametrize("seed,support,confidence", [(1, 0.05, 0.5), (2, 0.1, 0.7), (3, 0.02, 0.9)])
def test_rules_are_those_of_a_brute_force_miner(spark, seed, support, confidence):
    draw = random.Random(seed)
    labelled = []
    for _ in range(200):
        tokens = {f"t{draw.randint(0, 6)}" for _ in range(draw.randint(0, 4))}
        if "t1" in tokens:
            tokens |= {"with t1", "too with t1"}  # always together
        labelled.append((frozenset(tokens), draw.random() < (0.8 if {"t1", "t2"} <= tokens or "t5" in tokens else 0.2)))
    frame = spark.createDataFrame([(i, sorted(t), b) for i, (t, b) in enumerate(labelled)], "row long, tokens array<string>, bad boolean")
    found = url_filter.mine_rules(frame, Scratch(spark, "test"), min_support=support, min_confidence=confidence).collect()
    wanted = rules_by_hand(labelled, support, confidence)
    # Any choice of at least one token of each item is a rule of the miner, and nothing else is.
    spelled = {}
    for r in found:
        choices = [[frozenset(c) for n in range(1, len(i) + 1) for c in combinations(i, n)] for i in r["items"]]
        for choice in product(*choices):
            spelled[frozenset().union(*choice)] = r["confidence"]
    assert spelled.keys() == wanted.keys() and wanted
    assert all(spelled[s] == pytest.approx(c) for s, c in wanted.items())


def test_deep_paths_are_mined_in_seconds(spark):
    deep = "/".join(f"part{'abcdefghij'[i // 10]}x{'abcdefghij'[i % 10]}" for i in range(30))
    pages = [(i, f"https://h.org/{deep}" if i % 4 == 1 else f"https://h.org/{'a' if i % 3 else 'b'}") for i in range(400)]
    table = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame([(i, int(i % 4 != 1), None) for i in range(400)], "doc_id long, quality int, toxic int")
    start = time.time()
    rows = url_filter.judge(table, marks).collect()
    assert time.time() - start < 60 and len(rows) == 400
    assert all((r["verdict"] == "block") == (r["page_id"] % 4 == 1) for r in rows)
    # A page with one of the segments that always came together holds a rule as well.
    one = spark.createDataFrame([(0, "https://other.com/partaxc")], "page_id long, url string")
    assert url_filter.judge(table.unionByName(one.withColumn("page_id", F.lit(999).cast("long"))), marks).where("page_id = 999").first()["verdict"] == "block"


def test_toxic_labels_without_quality_teach(spark):
    pages = [(i, f"https://h{i % 4}.org/{'shop' if i % 2 else 'news'}/{i}") for i in range(400)]
    labels = [(i, None, i % 2) for i in range(300)] + [(i, None, None) for i in range(300, 400)]
    table = spark.createDataFrame(pages, "page_id long, url string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = url_filter.judge(table, marks, min_support=0.02, min_confidence=0.9).collect()
    assert all((r["verdict"] == "block") == (r["page_id"] % 2 == 1) for r in rows)


def test_url_query_against_its_rules(spark):
    rows = queries.QUERIES["op4_url_rules"](spark, SF001).toPandas()
    con = duck()
    con.register("got", rows)
    assert len(rows) == con.sql("select count(*) from pages").fetchall()[0][0]
    host = r"lower(regexp_extract(split_part(url, '://', 2), '^[^/?#]*'))"
    bad = con.sql(
        f"""select count(*) from got join pages using (page_id) where url like '%://%' and (host <> {host} or
        (rule = 'net/') <> (host like '%.net' and not (host like '%example.net' and path like '/en/%')) or
        (rule is not null and verdict <> case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end))"""
    ).fetchall()
    assert bad == [(0,)]
