"""Registered queries for splitting (P1–P6), sources S3/S4 and encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskweave.operators import encode as en
from riskweave.operators import split as sp
from riskweave.plans.registry import register
from riskweave.session import shared_path
from riskweave.sources import io
from riskweave.sources import testdata as td


def _time_split_sql(view: str) -> str:
    return f"""
ranked AS (SELECT transaction_id, row_number() OVER (ORDER BY epoch_us(transaction_time) ASC NULLS LAST, transaction_id) AS rk,
                  count(*) OVER () AS n FROM {view}),
b1 AS (SELECT *, greatest(1, floor(n * 0.7::DOUBLE)) AS te0 FROM ranked),
b2 AS (SELECT *, least(greatest(te0 + 1, floor(n * (0.7::DOUBLE + 0.15::DOUBLE))), n - 1) AS ve FROM b1),
splits AS (SELECT transaction_id, CASE WHEN rk <= least(te0, ve - 1) THEN 'train' WHEN rk <= ve THEN 'valid' ELSE 'test' END AS split
           FROM b2)"""


def _events_split(spark, sf_dir):
    df = td.events_txn(spark, sf_dir)
    return sp.time_split(df, "transaction_time", "transaction_id")


@register(
    "split_time_based",
    td.with_views("WITH " + _time_split_sql("events_txn") + "\nSELECT transaction_id, split FROM splits", "events_txn"),
)
def split_time_based(spark, sf_dir):
    """P2 on events_txn (1% NULL times, which sort last)."""
    return _events_split(spark, sf_dir).df.select("transaction_id", "split")


@register(
    "split_time_based_orders",
    td.with_views("WITH " + _time_split_sql("orders_txn") + "\nSELECT transaction_id, split FROM splits", "orders_txn"),
)
def split_time_based_orders(spark, sf_dir):
    """P2 on orders_txn: date-level times, so the cuts fall inside tie groups."""
    df = td.orders_txn(spark, sf_dir)
    return sp.time_split(df, "transaction_time", "transaction_id").df.select("transaction_id", "split")


_SIZES_SQL = td.with_views(
    "WITH " + _time_split_sql("events_txn") + "\nSELECT split, count(*)::BIGINT AS rows FROM splits GROUP BY split", "events_txn"
)


@register("split_sizes", _SIZES_SQL)
def split_sizes(spark, sf_dir):
    """P5: rows per split of the events_txn time split."""
    return sp.split_sizes(_events_split(spark, sf_dir).df)


@register("split_roundtrip", _SIZES_SQL)
def split_roundtrip(spark, sf_dir):
    """Write the split partitioned by ``split`` into the shared
    checkpoint folder, read each split back with partition pruning."""
    path = shared_path(spark, f"splits-{uuid.uuid4().hex}")
    io.write_splits(_events_split(spark, sf_dir).df, path)
    parts = [io.read_split(spark, path, name).select(F.lit(name).alias("split")) for name in io.SPLITS]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return sp.split_sizes(out)


_HASH_SPLIT_SQL = """
WITH h AS (SELECT *, CAST('0x' || substr(md5(concat_ws(':', CAST(transaction_id AS VARCHAR), '42')), 1, 15) AS BIGINT) AS h, {cls} AS cls
           FROM docs_labeled),
c AS (SELECT cls, count(*) AS n, CAST(ceil(round(sum(count(*)) OVER () * 0.3, 9)) AS BIGINT) AS held, sum(count(*)) OVER () AS total
      FROM h GROUP BY cls),
a AS (SELECT *, CAST(held * n // total AS BIGINT) AS whole, held * n % total AS rest FROM c),
t AS (SELECT *, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, cls) <= held - sum(whole) OVER () THEN 1 ELSE 0 END AS temp FROM a),
u AS (SELECT *, CAST(ceil(round(sum(temp) OVER () * 0.5, 9)) AS BIGINT) AS tests, sum(temp) OVER () AS temps FROM t),
v AS (SELECT *, CAST(tests * temp // temps AS BIGINT) AS whole2, tests * temp % temps AS rest2 FROM u),
w AS (SELECT *, whole2 + CASE WHEN row_number() OVER (ORDER BY rest2 DESC, cls) <= tests - sum(whole2) OVER () THEN 1 ELSE 0 END AS test FROM v),
r AS (SELECT h.*, row_number() OVER (PARTITION BY h.cls ORDER BY h) AS rk, n, temp, test FROM h JOIN w ON h.cls = w.cls)
SELECT transaction_id, {columns} CASE WHEN rk <= n - temp THEN 'train' WHEN rk <= n - test THEN 'valid' ELSE 'test' END AS split FROM r"""


@register("split_stratified", td.with_views(_HASH_SPLIT_SQL.format(cls="is_fraud", columns="is_fraud::BIGINT AS is_fraud,"), "docs_labeled"))
def split_stratified(spark, sf_dir):
    """P3 on docs_labeled (no timestamp): per-class hash order, 70/15/15."""
    df = td.docs_labeled(spark, sf_dir)
    res = sp.split_feature_frame(df, None, "transaction_id", "is_fraud")
    return res.df.select("transaction_id", "is_fraud", "split")


@register("split_random", td.with_views(_HASH_SPLIT_SQL.format(cls="0", columns=""), "docs_labeled"))
def split_random(spark, sf_dir):
    """P4 on docs_labeled without a target."""
    df = td.docs_labeled(spark, sf_dir)
    return sp.split_feature_frame(df, None, "transaction_id", None).df.select("transaction_id", "split")


@register(
    "split_can_stratify",
    td.with_views(
        """
WITH c AS (SELECT is_fraud, count(*) AS n FROM docs_labeled WHERE is_fraud IS NOT NULL GROUP BY 1)
SELECT count(*)::BIGINT AS n_classes, min(n)::BIGINT AS min_class_rows, count(*) > 1 AND min(n) >= 3 AS can_stratify FROM c""",
        "docs_labeled",
    ),
)
def split_can_stratify(spark, sf_dir):
    """P6 on docs_labeled."""
    return sp.can_stratify(td.docs_labeled(spark, sf_dir), "is_fraud")


# ------------------------------------------------------------------ encoding
MIN_FREQ = 0.08  # 12 merchants of ~8.3% each: some fall under it and are pooled

_ENC_CTES = (
    "WITH "
    + _time_split_sql("events_txn")
    + """,
t AS (SELECT e.*, s.split FROM events_txn e JOIN splits s USING (transaction_id)),
tr AS (SELECT * FROM t WHERE split = 'train'),
cnt AS (SELECT merchant AS value, count(*) AS c FROM tr WHERE merchant IS NOT NULL GROUP BY 1),
md AS (SELECT value, c FROM cnt ORDER BY c DESC, value LIMIT 1),
imp AS (SELECT value, c + CASE WHEN value = (SELECT value FROM md) THEN (SELECT count(*) FROM tr WHERE merchant IS NULL) ELSE 0 END AS c
        FROM cnt),
voc AS (SELECT value, c >= 0.08::DOUBLE * (SELECT count(*) FROM tr) AS frequent,
               CASE WHEN c >= 0.08::DOUBLE * (SELECT count(*) FROM tr) THEN 'merchant_' || value ELSE 'merchant_infrequent_sklearn' END
                 AS output_column FROM imp),
feats AS (SELECT 'amount' AS feature UNION SELECT DISTINCT output_column FROM voc),
rws AS (SELECT t.transaction_id, t.split, t.is_fraud, coalesce(t.amount, 0.0) AS amount,
               coalesce(t.merchant, (SELECT value FROM md)) AS m FROM t),
enc AS (
  SELECT r.transaction_id, r.split, r.is_fraud, f.feature,
         CASE WHEN f.feature = 'amount' THEN round(r.amount, 6)
              WHEN f.feature = coalesce(v.output_column, CASE WHEN EXISTS (SELECT 1 FROM voc WHERE NOT frequent)
                                                              THEN 'merchant_infrequent_sklearn' END) THEN 1.0
              ELSE 0.0 END AS value
  FROM rws r LEFT JOIN voc v ON r.m = v.value CROSS JOIN feats f)
"""
)


def _encoded(spark, sf_dir):
    res = _events_split(spark, sf_dir)
    return en.build_processed_splits(
        res.df, ["amount"], ["merchant"], "is_fraud", keep=["transaction_id"], min_frequency=MIN_FREQ
    )


def _long(df, ids, features):
    return df.unpivot(ids, features, "feature", "value")


@register(
    "enc_numeric_impute",
    td.with_views("SELECT transaction_id, round(coalesce(amount, 0.0), 6) AS amount FROM events_txn", "events_txn"),
)
def enc_numeric_impute(spark, sf_dir):
    """Numeric NULL → 0 (the constant does not depend on the fit)."""
    df = td.events_txn(spark, sf_dir)
    enc = en.FittedEncoder(["amount"])
    return enc.transform(df, ["transaction_id"])


@register("enc_mode_impute", td.with_views(_ENC_CTES + "SELECT 'merchant' AS column_name, value AS mode, c::BIGINT AS count FROM md", "events_txn"))
def enc_mode_impute(spark, sf_dir):
    """Train-split mode of merchant (ties → smallest value)."""
    train = _events_split(spark, sf_dir).df.where("split = 'train'")
    return en.train_modes(en.category_counts(train, ["merchant"]))


@register(
    "enc_onehot",
    td.with_views(
        _ENC_CTES + "SELECT 'merchant' AS column_name, value AS category, output_column, frequent FROM voc", "events_txn"
    ),
)
def enc_onehot(spark, sf_dir):
    """Fitted vocabulary with pooling of categories under 8% of train."""
    _, enc = _encoded(spark, sf_dir)
    return enc.vocabulary(spark)


@register("enc_transform", td.with_views(_ENC_CTES + "SELECT transaction_id, feature, value FROM enc", "events_txn"))
def enc_transform(spark, sf_dir):
    """Every row encoded (numeric, then one-hot), shown long."""
    out, enc = _encoded(spark, sf_dir)
    return _long(out.select("transaction_id", *enc.output_features), ["transaction_id"], enc.output_features)


@register(
    "enc_processed_pooled",
    td.with_views(_ENC_CTES + "SELECT transaction_id, split, is_fraud::BIGINT AS is_fraud, feature, value FROM enc", "events_txn"),
)
def enc_processed_pooled(spark, sf_dir):
    """N5 with pooling at 8%: fit on train, transform all splits in one pass, target re-attached."""
    out, enc = _encoded(spark, sf_dir)
    return _long(out, ["transaction_id", "split", "is_fraud"], enc.output_features)


# ------------------------------------------- the whole feature frame, encoded
def _full_ctes() -> str:
    """F1–F12 frame, time split and N1–N5 at the default minimum share (1%)."""
    from riskweave.operators.features import ENGINEERED_FEATURES
    from riskweave.plans.q_features import history_ctes

    numeric = ["amount", *ENGINEERED_FEATURES]
    listed = ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in numeric)
    unpivoted = "\n  UNION ALL ".join(f"SELECT transaction_id, split, is_fraud, '{c}' AS feature, {c} AS value FROM x" for c in numeric)
    return (
        history_ctes("events_txn", rounded=False).rstrip()
        + ",\n"
        + _time_split_sql("events_txn")
        + f""",
f AS (SELECT e.transaction_id, s.split, e.is_fraud, e.merchant, e.amount, hour(e.transaction_time) AS event_hour,
             isodow(e.transaction_time) - 1 AS event_day_of_week, CASE WHEN isodow(e.transaction_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
             CASE WHEN e.amount IS NULL THEN NULL ELSE ln(1 + greatest(e.amount, 0.0)) END AS amount_log1p,
             h.* EXCLUDE (transaction_id)
      FROM events_txn e JOIN h USING (transaction_id) JOIN splits s USING (transaction_id)),
tr AS (SELECT * FROM f WHERE split = 'train'),
cnt AS (SELECT merchant AS value, count(*) AS c FROM tr WHERE merchant IS NOT NULL GROUP BY 1),
md AS (SELECT value FROM cnt ORDER BY c DESC, value LIMIT 1),
imp AS (SELECT value, c + CASE WHEN value = (SELECT value FROM md) THEN (SELECT count(*) FROM tr WHERE merchant IS NULL) ELSE 0 END AS c
        FROM cnt),
voc AS (SELECT value, CASE WHEN c >= 0.01::DOUBLE * (SELECT count(*) FROM tr) THEN 'merchant_' || value ELSE 'merchant_infrequent_sklearn' END
                 AS output_column FROM imp),
x AS (SELECT transaction_id, split, is_fraud, coalesce(merchant, (SELECT value FROM md)) AS m, {listed} FROM f),
enc AS ({unpivoted}
  UNION ALL SELECT x.transaction_id, x.split, x.is_fraud, o.output_column,
         CASE WHEN o.output_column = coalesce(v.output_column, 'merchant_infrequent_sklearn') THEN 1.0 ELSE 0.0 END
  FROM x CROSS JOIN (SELECT DISTINCT output_column FROM voc) o LEFT JOIN voc v ON x.m = v.value)
"""
    )


def _full_data(spark, sf_dir):
    """The job itself, not its stored artifact."""
    from riskweave.plans import workflows as wf

    return wf.prepare_model_data(spark, sf_dir, reuse=False)


@register(
    "enc_processed_splits",
    td.with_views(
        _full_ctes() + "SELECT transaction_id, split, is_fraud::BIGINT AS is_fraud, feature, round(value, 6) AS value FROM enc", "events_txn"
    ),
)
def enc_processed_splits(spark, sf_dir):
    """N5 on the whole frame: F1–F11 features, time split, F12 on train, encoder fitted on train.

    Both sides round the raw doubles once, to six digits: means of two-digit amounts are
    often exact ties at the fifth, which sums in another order put on either side.
    """
    data = _full_data(spark, sf_dir)
    return _long(data.df, ["transaction_id", "split", "is_fraud"], data.features)


@register(
    "model_scaler_full",
    td.with_views(
        _full_ctes() + "SELECT feature, round(avg(value), 4) AS mean, round(stddev_pop(value), 3) AS std FROM enc WHERE split = 'train' GROUP BY feature",
        "events_txn",
    ),
    digits=4,
    overrides={"std": 3},
)
def model_scaler_full(spark, sf_dir):
    """M2 on the whole encoded frame: train mean and population std of every feature."""
    from riskweave.operators import models as md

    data = _full_data(spark, sf_dir)
    return md.scaler_stats(data.df.where("split = 'train'"), data.features)
