"""Registered queries for the data audit (A1–A4) and role profile."""

from __future__ import annotations

import uuid

from riskweave.operators import audit
from riskweave.plans.registry import register
from riskweave.roles import role_profile
from riskweave.session import shared_path
from riskweave.sources import io
from riskweave.sources import testdata as td

_EVENTS_COLS = ["transaction_id", "user_id", "transaction_time", "amount", "merchant", "is_fraud"]


def _missing_sql(view: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, {i}::BIGINT AS position, count_if({c} IS NULL"
        + (f" OR isnan({c})" if c == "amount" else "")
        + f")::BIGINT AS missing FROM {view}"
        for i, c in enumerate(cols)
    ]
    return "\nUNION ALL ".join(parts)


@register("audit_missing", td.with_views(_missing_sql("events_txn", _EVENTS_COLS), "events_txn"))
def audit_missing(spark, sf_dir):
    return audit.missing_counts(td.events_txn(spark, sf_dir))


@register(
    "audit_duplicates",
    """
SELECT count(*)::BIGINT AS row_count, (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events))::BIGINT AS distinct_rows,
       (count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)))::BIGINT AS duplicate_rows
FROM events""",
)
def audit_duplicates(spark, sf_dir):
    """A2 on a projection with natural repeats: (user, event type) pairs."""
    return audit.duplicate_rows(td.table(spark, sf_dir, "events").select("user_id", "event_type"))


@register(
    "audit_duplicates_whole",
    """
SELECT count(*)::BIGINT AS row_count, (SELECT count(*) FROM (SELECT DISTINCT * FROM events))::BIGINT AS distinct_rows,
       (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)))::BIGINT AS duplicate_rows
FROM events""",
)
def audit_duplicates_whole(spark, sf_dir):
    """A2 on whole event rows."""
    return audit.duplicate_rows(td.table(spark, sf_dir, "events"))


@register(
    "audit_duplicates_repeated",
    """
WITH r AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)
SELECT count(*)::BIGINT AS row_count, (SELECT count(*) FROM (SELECT DISTINCT * FROM r))::BIGINT AS distinct_rows,
       (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r)))::BIGINT AS duplicate_rows
FROM r""",
)
def audit_duplicates_repeated(spark, sf_dir):
    """A2 on whole event rows of which a tenth is there twice."""
    events = td.table(spark, sf_dir, "events")
    return audit.duplicate_rows(events.unionByName(events.where("event_id % 10 = 0")))


_TYPES = [
    ("transaction_id", "bigint", True, False, False, False, False, True),
    ("user_id", "bigint", True, False, False, False, True, False),
    ("transaction_time", "timestamp_ntz", False, False, False, True, False, False),
    ("amount", "double", True, False, False, False, False, False),
    ("merchant", "string", False, True, False, False, False, False),
    ("is_fraud", "int", True, False, True, False, False, False),
]


def _summary_sql() -> str:
    vals = ",\n  ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else ("true" if v else "false") for v in t) + ")" for t in _TYPES
    )
    return td.with_views(
        f"""
WITH meta(column_name, data_type, is_numeric, is_categorical, is_target_candidate, is_timestamp_candidate,
          is_user_id_candidate, is_transaction_id_candidate) AS (VALUES
  {vals}),
miss AS ({_missing_sql('events_txn', _EVENTS_COLS)}),
d AS (SELECT count(*)::BIGINT AS row_count FROM events_txn),
dd AS (SELECT count(*)::BIGINT AS n_distinct FROM (SELECT DISTINCT * FROM events_txn))
SELECT meta.*, miss.position, miss.missing, d.row_count, (d.row_count - dd.n_distinct)::BIGINT AS duplicate_rows,
       6::BIGINT AS column_count
FROM meta JOIN miss USING (column_name), d, dd""",
        "events_txn",
    )


@register("audit_summary", _summary_sql())
def audit_summary(spark, sf_dir):
    """A3 on events_txn: schema classes, candidates, missing and duplicates."""
    return audit.quality_summary(td.events_txn(spark, sf_dir))


_DOCS_LEFT_SQL = """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


@register(
    "audit_high_missing",
    f"""
WITH t AS ({_DOCS_LEFT_SQL}),
m AS (
  SELECT 'doc_id' AS column_name, count_if(doc_id IS NULL) AS missing, count(*) AS n FROM t
  UNION ALL SELECT 'text', count_if(text IS NULL), count(*) FROM t
  UNION ALL SELECT 'lang', count_if(lang IS NULL), count(*) FROM t
  UNION ALL SELECT 'source', count_if(source IS NULL), count(*) FROM t
  UNION ALL SELECT 'n_chars', count_if(n_chars IS NULL), count(*) FROM t
  UNION ALL SELECT 'quality', count_if(quality IS NULL), count(*) FROM t
  UNION ALL SELECT 'toxic', count_if(toxic IS NULL), count(*) FROM t)
SELECT column_name, missing::BIGINT AS missing, round(missing / n, 6) AS missing_share FROM m WHERE missing / n > 0.2""",
)
def audit_high_missing(spark, sf_dir):
    """A4 on documents left-joined to their (partial) labels."""
    d = td.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    lab = td.table(spark, sf_dir, "labels")
    return audit.high_missing(d.join(lab, "doc_id", "left"))


@register(
    "role_profile",
    td.with_views(
        """
SELECT * FROM (
  SELECT 'transaction_id' AS column_name, 0::BIGINT AS position, 'bigint' AS data_type, true AS is_numeric, false AS is_categorical,
         false AS is_target_candidate, false AS is_timestamp_candidate, false AS is_user_id_candidate, true AS is_transaction_id_candidate,
         false AS is_amount_column, count(transaction_id)::BIGINT AS non_null, NULL::BOOLEAN AS target_binary, NULL::DOUBLE AS time_parse_rate,
         round(count(DISTINCT transaction_id) / count(transaction_id), 6) AS distinct_share, true AS distinct_exact
  FROM events_txn
  UNION ALL SELECT 'user_id', 1, 'bigint', true, false, false, false, true, false, false, count(user_id), NULL, NULL,
         round(count(DISTINCT user_id) / count(user_id), 6), true FROM events_txn
  UNION ALL SELECT 'transaction_time', 2, 'timestamp_ntz', false, false, false, true, false, false, false, count(transaction_time), NULL,
         round(count(transaction_time) / count(*), 6), NULL, NULL FROM events_txn
  UNION ALL SELECT 'amount', 3, 'double', true, false, false, false, false, false, true, count(amount), NULL, NULL, NULL, NULL FROM events_txn
  UNION ALL SELECT 'merchant', 4, 'string', false, true, false, false, false, false, false, count(merchant), NULL, NULL, NULL, NULL FROM events_txn
  UNION ALL SELECT 'is_fraud', 5, 'int', true, false, true, false, false, false, false, count(is_fraud),
         count(is_fraud) > 0 AND count_if(is_fraud NOT IN (0, 1)) = 0, NULL, NULL, NULL FROM events_txn)""",
        "events_txn",
    ),
)
def role_profile_q(spark, sf_dir):
    """R1–R10 on events_txn: type classes, name candidates, data checks."""
    return role_profile(td.events_txn(spark, sf_dir))


@register("audit_summary_json", _summary_sql())
def audit_summary_json(spark, sf_dir):
    """The audit summary written as JSON and read back with its schema."""
    summary = audit.quality_summary(td.events_txn(spark, sf_dir))
    path = shared_path(spark, f"audit-{uuid.uuid4().hex}.json")
    io.write_json(summary, path)
    return spark.read.schema(summary.schema).json(path)
