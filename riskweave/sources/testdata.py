"""Adapters that turn the driver's tables into transaction-shaped inputs.

Each adapter exists twice, as a Spark DataFrame and as SQL text for the
DuckDB oracle; both read the whole table. NULLs are injected by id so that
null handling is exercised on every run (values change, no row is removed).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.roles import Roles

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ----------------------------------------------------------------- events_txn
EVENTS_TXN_ROLES = Roles(
    target="is_fraud", timestamp="transaction_time", user_id="user_id", transaction_id="transaction_id", amount="amount"
)

EVENTS_TXN_SQL = """
SELECT event_id AS transaction_id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS transaction_time,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS amount,
       CASE WHEN event_id % 13 = 0 THEN NULL
            ELSE concat('m', CAST(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 12 AS VARCHAR)) END AS merchant,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
FROM events
"""


def events_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.regexp_extract("props", r"([0-9]+)", 1).try_cast("int")
    return e.select(
        eid.alias("transaction_id"),
        F.when(eid % 97 != 0, F.col("user_id")).alias("user_id"),
        F.when(eid % 101 != 0, F.col("ts")).alias("transaction_time"),
        F.when(eid % 17 != 0, F.col("value")).alias("amount"),
        F.when(eid % 13 != 0, F.concat(F.lit("m"), (k % 12).cast("string"))).alias("merchant"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_fraud"),
    )


# ----------------------------------------------------------------- orders_txn
ORDERS_TXN_ROLES = Roles(
    target="is_fraud", timestamp="transaction_time", user_id="user_id", transaction_id="transaction_id", amount="amount"
)

ORDERS_TXN_SQL = """
SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_orderdate AS transaction_time, o_totalprice AS amount,
       c_mktsegment AS segment, n_name AS nation, o_orderpriority AS priority,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_fraud
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def orders_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # nation has 25 rows by definition of the schema: a fixed-size broadcast.
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
        .select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("transaction_time"),
            F.col("o_totalprice").alias("amount"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
            F.col("o_orderpriority").alias("priority"),
            F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), 1)
            .otherwise(0)
            .alias("is_fraud"),
        )
    )


# --------------------------------------------------------------------- scored
SCORED_SQL = """
SELECT event_id AS transaction_id, ts, value AS amount, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y_true,
       value / (value + 50.0) AS score
FROM events
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("transaction_id"),
        "ts",
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y_true"),
        (F.col("value") / (F.col("value") + F.lit(50.0))).alias("score"),
    )


# --------------------------------------------------------------- docs_labeled
DOCS_LABELED_ROLES = Roles(target="is_fraud", transaction_id="transaction_id", amount="amount")

DOCS_LABELED_SQL = """
SELECT d.doc_id AS transaction_id, lang, source, n_chars AS amount, toxic AS is_fraud
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def docs_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return d.join(lab, "doc_id").select(
        F.col("doc_id").alias("transaction_id"),
        "lang",
        "source",
        F.col("n_chars").alias("amount"),
        F.col("toxic").alias("is_fraud"),
    )


VIEWS_SQL = {
    "events_txn": EVENTS_TXN_SQL,
    "orders_txn": ORDERS_TXN_SQL,
    "scored": SCORED_SQL,
    "docs_labeled": DOCS_LABELED_SQL,
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for the named adapter views; a query that
    starts with its own ``WITH`` has its CTEs appended after the views."""
    ctes = ",\n".join(f"{n} AS ({VIEWS_SQL[n].strip()})" for n in names)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
