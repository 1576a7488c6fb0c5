"""Registered queries for feature engineering."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import features as fe
from riskweave.plans.registry import register
from riskweave.roles import Roles
from riskweave.sources import testdata as td

# Shared SQL: causal history over events_txn / orders_txn, with the same order
# as the Spark operator (time ascending, NULL last, ties by transaction id).
_HISTORY_SQL = """
WITH t AS (SELECT *, epoch_us(transaction_time) AS us FROM {view}),
w AS (
  SELECT transaction_id, user_id, us, amount,
         row_number() OVER (PARTITION BY user_id ORDER BY us ASC NULLS LAST, transaction_id) AS rk,
         lag(us) OVER (PARTITION BY user_id ORDER BY us ASC NULLS LAST, transaction_id) AS prev_us,
         avg(amount) OVER (PARTITION BY user_id ORDER BY us ASC NULLS LAST, transaction_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mean_prior,
         stddev_samp(amount) OVER (PARTITION BY user_id ORDER BY us ASC NULLS LAST, transaction_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS std_prior
  FROM t),
v AS (
  SELECT *,
         rk - min(rk) OVER (PARTITION BY user_id ORDER BY us ASC NULLS LAST
                            RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS c1h,
         rk - min(rk) OVER (PARTITION BY user_id ORDER BY us ASC NULLS LAST
                            RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS c24h
  FROM w),
h AS (
  SELECT transaction_id,
         CASE WHEN user_id IS NULL THEN NULL ELSE rk - 1 END::BIGINT AS user_prior_transaction_count,
         CASE WHEN user_id IS NULL THEN NULL ELSE {r}((us - prev_us) / 1e6{six}) END AS seconds_since_prev_transaction,
         CASE WHEN user_id IS NULL THEN NULL ELSE {r}(mean_prior{six}) END AS user_amount_mean_prior,
         CASE WHEN user_id IS NULL THEN NULL ELSE {r}(std_prior{four}) END AS user_amount_std_prior,
         CASE WHEN user_id IS NULL THEN NULL ELSE {r}(amount - mean_prior{six}) END AS amount_vs_user_mean,
         CASE WHEN user_id IS NULL OR us IS NULL THEN 0 ELSE c1h END::DOUBLE AS user_txn_count_last_1h,
         CASE WHEN user_id IS NULL OR us IS NULL THEN 0 ELSE c24h END::DOUBLE AS user_txn_count_last_24h
  FROM v)
"""

_STD4 = {"user_amount_std_prior": 4}


def history_ctes(view: str, rounded: bool = True) -> str:
    """CTEs up to ``h``, the history of each row of ``view``; unrounded where a query rounds its own result."""
    digits = {"r": "round", "six": ", 6", "four": ", 4"} if rounded else {"r": "", "six": "", "four": ""}
    return _HISTORY_SQL.format(view=view, **digits)


def _history(view: str, cols: list[str]) -> str:
    body = history_ctes(view) + f"SELECT transaction_id, {', '.join(cols)} FROM h"
    return td.with_views(body, view)


def _behavior(spark, sf_dir, adapter, roles: Roles, cols):
    df = adapter(spark, sf_dir)
    out, _, _ = fe.add_behavioral_features(df, roles.amount, roles.timestamp, roles.user_id, roles.transaction_id)
    return out.select("transaction_id", *cols)


def _one(name: str, column: str, overrides=None):
    @register(name, _history("events_txn", [column]), overrides=overrides)
    def q(spark, sf_dir):
        return _behavior(spark, sf_dir, td.events_txn, td.EVENTS_TXN_ROLES, [column])

    return q


_one("feat_prior_count", "user_prior_transaction_count")
_one("feat_seconds_since_prev", "seconds_since_prev_transaction")
_one("feat_amount_mean_prior", "user_amount_mean_prior")
_one("feat_amount_std_prior", "user_amount_std_prior", _STD4)
_one("feat_amount_vs_mean", "amount_vs_user_mean")
_one("feat_velocity_1h", "user_txn_count_last_1h")
_one("feat_velocity_24h", "user_txn_count_last_24h")


@register("feat_history_orders", _history("orders_txn", fe.BEHAVIORAL_FEATURES), overrides=_STD4)
def feat_history_orders(spark, sf_dir):
    """All of F3–F9 on orders (date-level timestamps: many ties)."""
    return _behavior(spark, sf_dir, td.orders_txn, td.ORDERS_TXN_ROLES, fe.BEHAVIORAL_FEATURES)


@register(
    "feat_calendar",
    td.with_views(
        """
SELECT transaction_id, hour(transaction_time)::BIGINT AS event_hour,
       (isodow(transaction_time) - 1)::BIGINT AS event_day_of_week,
       CASE WHEN isodow(transaction_time) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend
FROM events_txn""",
        "events_txn",
    ),
)
def feat_calendar(spark, sf_dir):
    df, _, _ = fe.add_time_features(td.events_txn(spark, sf_dir), "transaction_time")
    return df.select("transaction_id", *fe.TIME_FEATURES)


@register(
    "feat_amount_log",
    td.with_views(
        """
SELECT transaction_id, round(CASE WHEN amount IS NULL THEN NULL ELSE ln(1 + greatest(amount, 0.0)) END, 6) AS amount_log1p
FROM events_txn""",
        "events_txn",
    ),
)
def feat_amount_log(spark, sf_dir):
    df, _, _ = fe.add_amount_features(td.events_txn(spark, sf_dir), "amount")
    return df.select("transaction_id", "amount_log1p")


def _pruning_rows(spark, decisions, columns):
    reasons = {d.column: d.reason for d in decisions}
    rows = [(c, c in reasons, reasons.get(c)) for c in columns]
    return spark.createDataFrame(rows, "column_name string, dropped boolean, reason string")


@register(
    "feat_column_pruning",
    td.with_views(
        """
WITH nd AS (SELECT count(*) AS n, count(DISTINCT segment) AS d_segment, count(DISTINCT nation) AS d_nation,
                   count(DISTINCT priority) AS d_priority FROM orders_txn)
SELECT * FROM (VALUES ('user_id', false, NULL), ('amount', false, NULL)) v(column_name, dropped, reason)
UNION ALL SELECT 'segment', d_segment > 50 OR d_segment / n > 0.01, CASE WHEN d_segment > 50 OR d_segment / n > 0.01 THEN 'cardinality' END FROM nd
UNION ALL SELECT 'nation', d_nation > 50 OR d_nation / n > 0.01, CASE WHEN d_nation > 50 OR d_nation / n > 0.01 THEN 'cardinality' END FROM nd
UNION ALL SELECT 'priority', d_priority > 50 OR d_priority / n > 0.01, CASE WHEN d_priority > 50 OR d_priority / n > 0.01 THEN 'cardinality' END FROM nd
UNION ALL SELECT 'first_name', true, 'name_pattern'
""",
        "orders_txn",
    ),
)
def feat_column_pruning(spark, sf_dir):
    """F10 on orders_txn (target/time/id removed first) plus a PII-named column.

    The decision table is one row per candidate column; the data rule runs
    as one approximate-distinct pass plus an exact pass on low-cardinality
    columns.
    """
    df = td.orders_txn(spark, sf_dir).drop("transaction_time", "transaction_id", "is_fraud")
    df = df.withColumn("first_name", F.concat(F.lit("n"), F.col("user_id").cast("string")))
    return _pruning_rows(spark, fe.column_pruning(df, "user_id"), df.columns)


def full_features_events(spark, sf_dir) -> fe.FeatureFrame:
    return fe.build_feature_frame(td.events_txn(spark, sf_dir), td.EVENTS_TXN_ROLES)


_FULL_COLS = ["user_id", "amount", "merchant"] + fe.ENGINEERED_FEATURES


@register(
    "feat_full",
    td.with_views(
        history_ctes("events_txn")
        + """
SELECT e.transaction_id, e.user_id, round(e.amount, 6) AS amount, e.merchant,
       hour(e.transaction_time)::BIGINT AS event_hour,
       (isodow(e.transaction_time) - 1)::BIGINT AS event_day_of_week,
       CASE WHEN isodow(e.transaction_time) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend,
       round(CASE WHEN e.amount IS NULL THEN NULL ELSE ln(1 + greatest(e.amount, 0.0)) END, 6) AS amount_log1p,
       h.* EXCLUDE (transaction_id)
FROM events_txn e JOIN h ON e.transaction_id = h.transaction_id""",
        "events_txn",
    ),
    overrides=_STD4,
)
def feat_full(spark, sf_dir):
    """F11 flagship: the whole feature frame of events_txn keyed by id."""
    ff = full_features_events(spark, sf_dir)
    return ff.df.select("transaction_id", *ff.feature_columns)


@register(
    "feat_model_columns",
    td.with_views(
        """
WITH nd AS (SELECT count(DISTINCT segment) AS d_segment, count(DISTINCT nation) AS d_nation,
                   count(DISTINCT priority) AS d_priority FROM orders_txn)
SELECT 'amount' AS column_name, 'numeric' AS kind
UNION ALL SELECT 'segment', 'categorical' FROM nd WHERE d_segment <= 50
UNION ALL SELECT 'nation', 'categorical' FROM nd WHERE d_nation <= 50
UNION ALL SELECT 'priority', 'categorical' FROM nd WHERE d_priority <= 50
""",
        "orders_txn",
    ),
)
def feat_model_columns(spark, sf_dir):
    """F12 on orders_txn: numeric and low-cardinality text columns (user id,
    target and parsed time excluded)."""
    df = td.orders_txn(spark, sf_dir)
    feats = [c for c in df.columns if c not in ("transaction_id", "transaction_time", "is_fraud")]
    num, cat = fe.select_model_columns(df, feats, "is_fraud", "user_id")
    rows = [(c, "numeric") for c in num] + [(c, "categorical") for c in cat]
    return spark.createDataFrame(rows, "column_name string, kind string")
