"""Rows that every operator must take: nulls, empty and long texts, ties, copies, clashing column names."""

import os

import duckdb

# Python workers import the package too; they take the driver's environment when Spark starts.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor " * 4000
ODD_DOCS = [
    (1, "the quick brown fox jumps over the lazy dog\nsame line\nlast", "en", "b", 58),
    (2, "the quick brown fox jumps over the lazy dog\nsame line\nlast", "en", "b", 58),
    (3, None, None, "a", None),
    (4, "", "en", None, 0),
    (5, " \n\t ", "en", None, 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "one", "en", "c", 3),
    (7, "one", "en", "c", 3),
    (8, "É à\x00 ü <|endoftext|> ONE\u00a0two", None, "c", 20),
    (None, "text without an id", "en", "a", 18),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """The odd rows, with further columns whose names operators use themselves."""
    docs = spark.createDataFrame(ODD_DOCS, DOCS)
    for name in ("size", "taken", "target", "n", "key", "component_id", "score", "host", "length", "rank", "bucket", "lines"):
        docs = docs.withColumn(name, docs["lang"])
    return docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def duck(sf_dir=SF001):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    return con


def same_rows(left, right):
    """Both pandas frames hold the same rows, in any order."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    as_rows = lambda f: sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None)))
    assert as_rows(left) == as_rows(right)
