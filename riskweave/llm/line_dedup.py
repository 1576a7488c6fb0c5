"""Line dedup by site-relative frequency (operator 10, DataFrame functions only).

Rows are grouped by host. A line's ratio is the share of the host's pages that
contain it; lines above ``ratio`` on at least ``min_pages`` pages are dropped
from every page of the host. Copies of one page count as one page of their
host, so that a copied page does not look like boilerplate.

The frequent lines of one host number at most (mean lines of a page) / ratio,
whatever the host's size; the pages join that list and are filtered in place,
so texts are never taken apart and put together again over a shuffle.

Defined results: a null text stays null with no lines; an empty text has one
blank line; blank lines always stay; rows with a null host belong to no site
and stay as they are; repeated rows count as copies of a page. Columns of the
input named like an added column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch


def boilerplate(docs: DataFrame, *, text_col: str, host_col: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): 64-bit hashes of the lines that each host repeats."""
    page = docs.where(F.col(host_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(host_col).alias("host"),
        F.xxhash64(text_col).alias("page"),
        F.transform(F.filter(F.split(text_col, "\n", -1), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)).alias("all"),
    )
    # One row per distinct page first: partial sums keep copies of a page from the shuffle.
    page = page.groupBy("host", "page").agg(F.first("all").alias("all"))
    seen = page.select("host", "page", F.explode(F.array_distinct("all")).alias("line"))
    counts = seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    pages = docs.where(F.col(host_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(host_col).alias("host"), F.xxhash64(text_col).alias("page")
    )
    totals = pages.distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    often = counts.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("total"))
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_frequent_lines(
    docs: DataFrame,
    *,
    text_col: str = "text",
    host_col: str = "source",
    ratio: float = 0.1,
    min_pages: int = 5,
) -> DataFrame:
    """``docs`` with its frequent lines gone, plus n_lines and n_dropped."""
    scratch = Scratch(docs.sparkSession, "lines")
    often = scratch.write(boilerplate(docs, text_col=text_col, host_col=host_col, ratio=ratio, min_pages=min_pages), "often")
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    listed = often.select(F.col("host").alias("__host"), F.col("lines").alias("__often"))
    rows = docs.select(*keep).join(listed, F.col(host_col) == F.col("__host"), "left")
    rows = rows.withColumn("__lines", F.split(text_col, "\n", -1))
    kept = F.filter(
        "__lines",
        lambda x: F.col("__often").isNull() | (F.trim(x) == "") | ~F.array_contains(F.col("__often"), F.xxhash64(x)),
    )
    rows = rows.withColumn("__kept", kept)
    text = F.when(F.size("__kept") < F.size("__lines"), F.array_join("__kept", "\n")).otherwise(F.col(text_col))
    n_lines = F.coalesce(F.when(F.col("__lines").isNotNull(), F.size("__lines")), F.lit(0)).cast("long")
    dropped = F.coalesce(F.when(F.col("__lines").isNotNull(), F.size("__lines") - F.size("__kept")), F.lit(0)).cast("long")
    return rows.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in keep], n_lines.alias("n_lines"), dropped.alias("n_dropped")
    )


#: The kept lines of every row in DuckDB SQL (ratio 0.1, at least 5 pages).
LINES_SQL = """
WITH pg AS (SELECT DISTINCT source, text FROM {docs} WHERE source IS NOT NULL AND text IS NOT NULL),
tot AS (SELECT source, count(*) AS total FROM pg GROUP BY source),
ln AS (SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM pg),
oft AS (SELECT source, line FROM (SELECT source, line, count(*) AS n FROM ln WHERE trim(line) <> '' GROUP BY source, line)
        JOIN tot USING (source) WHERE n >= 5 AND n > 0.1 * total),
lst AS (SELECT source, list(line) AS often FROM oft GROUP BY source),
cl AS (SELECT d.*, string_split(d.text, chr(10)) AS lines,
              CASE WHEN l.often IS NULL THEN string_split(d.text, chr(10))
                   ELSE list_filter(string_split(d.text, chr(10)), lambda x: NOT list_contains(l.often, x)) END AS kept
       FROM {docs} d LEFT JOIN lst l ON d.source = l.source)
"""
