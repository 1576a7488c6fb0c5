"""Registered queries for exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import eda
from riskweave.plans.registry import register
from riskweave.sources import testdata as td

_NUM = ["transaction_id", "user_id", "amount", "is_fraud"]
_CAT_ORDERS = ["segment", "nation", "priority"]


def _ev(spark, sf_dir):
    return td.events_txn(spark, sf_dir)


@register(
    "target_prepare",
    td.with_views(
        """
SELECT 'is_fraud' AS column_name, count(is_fraud)::BIGINT AS non_null, count_if(is_fraud NOT IN (0, 1))::BIGINT AS invalid,
       count(is_fraud) > 0 AND count_if(is_fraud NOT IN (0, 1)) = 0 AS is_binary FROM events_txn
UNION ALL SELECT 'amount', count(amount), count_if(amount NOT IN (0, 1)), count(amount) > 0 AND count_if(amount NOT IN (0, 1)) = 0 FROM events_txn
UNION ALL SELECT 'merchant', count(TRY_CAST(merchant AS DOUBLE)), coalesce(count_if(TRY_CAST(merchant AS DOUBLE) NOT IN (0, 1)), 0),
       count(TRY_CAST(merchant AS DOUBLE)) > 0 AND coalesce(count_if(TRY_CAST(merchant AS DOUBLE) NOT IN (0, 1)), 0) = 0 FROM events_txn""",
        "events_txn",
    ),
)
def target_prepare(spark, sf_dir):
    """E1 on three candidate columns of events_txn."""
    return eda.target_check(_ev(spark, sf_dir), ["is_fraud", "amount", "merchant"])


@register(
    "eda_target_distribution",
    td.with_views(
        """
SELECT is_fraud::BIGINT AS target_value, count(*)::BIGINT AS count, round(round(count(*) / sum(count(*)) OVER (), 4), 6) AS share,
       round(sum(sum(is_fraud)) OVER () / sum(count(is_fraud)) OVER (), 6) AS positive_rate
FROM events_txn GROUP BY is_fraud""",
        "events_txn",
    ),
)
def eda_target_distribution(spark, sf_dir):
    return eda.target_distribution(_ev(spark, sf_dir), "is_fraud")


def _describe_sql() -> str:
    parts = []
    for c in _NUM:
        parts.append(
            f"SELECT '{c}' AS column_name, count({c})::BIGINT AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
            f"round(quantile_cont({c}, 0.75), 6) AS p75, round(quantile_cont({c}, 0.95), 6) AS p95, round(max({c})::DOUBLE, 6) AS max FROM events_txn"
        )
    return td.with_views("\nUNION ALL ".join(parts), "events_txn")


@register("eda_describe", _describe_sql(), overrides={"std": 4})
def eda_describe(spark, sf_dir):
    """E4 on the numeric columns of events_txn (exact quantiles)."""
    return eda.describe(_ev(spark, sf_dir), _NUM)


def _corr_sql() -> str:
    parts = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 4) AS corr FROM events_txn"
        for a in _NUM
        for b in _NUM
    ]
    return td.with_views("\nUNION ALL ".join(parts), "events_txn")


@register("eda_correlation", _corr_sql(), digits=4)
def eda_correlation(spark, sf_dir):
    return eda.correlation(_ev(spark, sf_dir), _NUM)


@register(
    "eda_amount_summary",
    td.with_views(
        """
SELECT round(min(amount), 6) AS min, round(quantile_cont(amount, 0.5), 6) AS median, round(avg(amount), 6) AS mean,
       round(quantile_cont(amount, 0.95), 6) AS p95, round(max(amount), 6) AS max FROM events_txn""",
        "events_txn",
    ),
)
def eda_amount_summary(spark, sf_dir):
    return eda.amount_summary(_ev(spark, sf_dir), "amount")


@register(
    "eda_amount_histogram",
    td.with_views(
        """
WITH s AS (SELECT min(amount) AS lo0, max(amount) AS hi0, count(DISTINCT amount) AS ndv FROM events_txn WHERE amount IS NOT NULL),
p AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi,
             least(30, greatest(5, ndv)) AS bins FROM s),
c AS (SELECT least(floor((amount - lo) / ((hi - lo) / bins)), bins - 1)::BIGINT AS bin, count(*) AS n
      FROM events_txn, p WHERE amount IS NOT NULL GROUP BY 1),
sp AS (SELECT unnest(range(bins::BIGINT)) AS bin, lo, hi, bins FROM p)
SELECT sp.bin::BIGINT AS bin, round(lo + sp.bin * (hi - lo) / bins, 6) AS lower, round(lo + (sp.bin + 1) * (hi - lo) / bins, 6) AS upper,
       coalesce(c.n, 0)::BIGINT AS count
FROM sp LEFT JOIN c ON sp.bin = c.bin""",
        "events_txn",
    ),
)
def eda_amount_histogram(spark, sf_dir):
    """Equal-width amount histogram."""
    df = _ev(spark, sf_dir)
    return eda.histogram(df, F.col("amount"))


def _top_sql(cols: list[str], view: str, n: int = 10) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, coalesce({c}::VARCHAR, '<missing>') AS value, count(*) AS count FROM {view} GROUP BY 2"
        for c in cols
    ]
    return td.with_views(
        f"""
WITH g AS ({' UNION ALL '.join(parts)}),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value ASC) AS rank FROM g)
SELECT column_name, rank::BIGINT AS rank, value, count::BIGINT AS count FROM r WHERE rank <= {n}""",
        view,
    )


@register("eda_top_values", _top_sql(_CAT_ORDERS, "orders_txn"))
def eda_top_values(spark, sf_dir):
    """E8 on the text columns of orders_txn."""
    return eda.top_values(td.orders_txn(spark, sf_dir), _CAT_ORDERS)


@register(
    "eda_group_candidates",
    td.with_views(
        """
WITH n AS (SELECT count(*) AS n, count(DISTINCT segment) AS s, count(DISTINCT nation) AS na, count(DISTINCT priority) AS p FROM orders_txn)
SELECT column_name, CASE WHEN d <= 20 THEN d END::BIGINT AS n_distinct, d > 20 AS over_limit, d <= 20 AND d / n <= 0.5 AS eligible
FROM (SELECT 'segment' AS column_name, s AS d, n FROM n UNION ALL SELECT 'nation', na, n FROM n UNION ALL SELECT 'priority', p, n FROM n)""",
        "orders_txn",
    ),
)
def eda_group_candidates(spark, sf_dir):
    """E9 on orders_txn (user and transaction ids excluded by name)."""
    return eda.group_candidates(td.orders_txn(spark, sf_dir), "is_fraud")


def _eligible(spark, sf_dir):
    df = td.orders_txn(spark, sf_dir)
    cand = eda.group_candidates(df, "is_fraud")
    return df, [r["column_name"] for r in cand.where("eligible").orderBy("column_name").collect()]


_RATE_SQL = """
WITH g AS (
  SELECT 'segment' AS column_name, coalesce(segment, '<missing>') AS value, avg(is_fraud) AS positive_rate, count(is_fraud) AS count
  FROM orders_txn GROUP BY 2
  UNION ALL
  SELECT 'priority', coalesce(priority, '<missing>'), avg(is_fraud), count(is_fraud) FROM orders_txn GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY positive_rate DESC NULLS LAST, count DESC, value) AS rank FROM g
      QUALIFY rank <= 10)
"""


@register(
    "eda_rate_by_group",
    td.with_views(
        _RATE_SQL + "SELECT column_name, rank::BIGINT AS rank, value, round(positive_rate, 6) AS positive_rate, count::BIGINT AS count FROM r",
        "orders_txn",
    ),
)
def eda_rate_by_group(spark, sf_dir):
    """E10 over the eligible columns (E9) of orders_txn."""
    df, cols = _eligible(spark, sf_dir)
    return eda.rate_by_group(df, "is_fraud", cols)


@register(
    "eda_best_group",
    td.with_views(
        _RATE_SQL
        + """
SELECT column_name, round(max(positive_rate) - min(positive_rate), 6) AS gap FROM r GROUP BY column_name
ORDER BY gap DESC, CASE column_name WHEN 'segment' THEN 0 ELSE 1 END LIMIT 1""",
        "orders_txn",
    ),
)
def eda_best_group(spark, sf_dir):
    """The eligible column with the widest rate gap."""
    df, cols = _eligible(spark, sf_dir)
    order = [c for c in df.columns if c in cols]
    return eda.best_group(eda.rate_by_group(df, "is_fraud", cols), order)


@register(
    "eda_amount_by_target",
    td.with_views(
        """
SELECT is_fraud::BIGINT AS target_value, round(quantile_cont(amount, 0.25), 6) AS p25, round(quantile_cont(amount, 0.5), 6) AS p50,
       round(quantile_cont(amount, 0.75), 6) AS p75, round(quantile_cont(amount, 0.95), 6) AS p95
FROM events_txn WHERE amount IS NOT NULL AND is_fraud IS NOT NULL GROUP BY is_fraud""",
        "events_txn",
    ),
)
def eda_amount_by_target(spark, sf_dir):
    return eda.amount_by_target(_ev(spark, sf_dir), "is_fraud", "amount")


@register(
    "eda_rate_by_hour",
    td.with_views(
        """
WITH g AS (SELECT hour(transaction_time) AS hour, avg(is_fraud) AS r, count(*) AS n FROM events_txn
           WHERE transaction_time IS NOT NULL AND is_fraud IS NOT NULL GROUP BY 1)
SELECT s.hour::BIGINT AS hour, round(g.r, 6) AS positive_rate, coalesce(g.n, 0)::BIGINT AS count
FROM (SELECT unnest(range(24)) AS hour) s LEFT JOIN g ON s.hour = g.hour""",
        "events_txn",
    ),
)
def eda_rate_by_hour(spark, sf_dir):
    return eda.rate_by_hour(_ev(spark, sf_dir), "transaction_time", "is_fraud")


@register(
    "eda_rate_by_weekday",
    td.with_views(
        """
WITH g AS (SELECT isodow(transaction_time) - 1 AS day_index, avg(is_fraud) AS r, count(*) AS n FROM events_txn
           WHERE transaction_time IS NOT NULL AND is_fraud IS NOT NULL GROUP BY 1),
s AS (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
                            (5, 'Saturday'), (6, 'Sunday')) v(day_index, day_name))
SELECT s.day_index::BIGINT AS day_index, s.day_name, round(g.r, 6) AS positive_rate, coalesce(g.n, 0)::BIGINT AS count
FROM s LEFT JOIN g ON s.day_index = g.day_index""",
        "events_txn",
    ),
)
def eda_rate_by_weekday(spark, sf_dir):
    return eda.rate_by_weekday(_ev(spark, sf_dir), "transaction_time", "is_fraud")


@register(
    "eda_dataset_summary",
    td.with_views(
        """
SELECT count(*)::BIGINT AS row_count, 6::BIGINT AS column_count,
       (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM events_txn)))::BIGINT AS duplicate_rows,
       'is_fraud' AS target_column, 'transaction_time' AS timestamp_column, 'user_id' AS user_id_column,
       'transaction_id' AS transaction_id_column
FROM events_txn""",
        "events_txn",
    ),
)
def eda_dataset_summary(spark, sf_dir):
    """E15 head block on events_txn."""
    return eda.dataset_summary(_ev(spark, sf_dir), td.EVENTS_TXN_ROLES)


@register("eda_full")
def eda_full(spark, sf_dir):
    """Every block of the report on events_txn, the source read once; one row per row of a block."""
    rep = eda.run_full_eda(td.events_txn(spark, sf_dir), td.EVENTS_TXN_ROLES, shared=True)
    return eda.report_rows(rep)
