"""Registered queries for metrics (V1–V12) and thresholds (T1–T8) on ``scored``."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import metrics as mt
from riskweave.operators import thresholds as th
from riskweave.plans.registry import register
from riskweave.sources import testdata as td


def _pred():
    return F.col("score") >= F.lit(0.5)


def _sc(spark, sf_dir):
    return td.scored(spark, sf_dir)


_CONF = """
conf AS (SELECT count_if(y_true = 0 AND NOT score >= 0.5)::BIGINT AS tn, count_if(y_true = 0 AND score >= 0.5)::BIGINT AS fp,
                count_if(y_true = 1 AND NOT score >= 0.5)::BIGINT AS fn, count_if(y_true = 1 AND score >= 0.5)::BIGINT AS tp FROM scored),
prf AS (SELECT *, (tp + fn) / (tn + fp + fn + tp) AS positive_rate,
               CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
               CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
               CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM conf)"""

_CURVE = """
st AS (SELECT score, sum(y_true) AS tp, sum(1 - y_true) AS fp FROM scored WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT *, sum(tp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_tp,
               sum(fp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_fp,
               sum(tp) OVER () AS P, sum(fp) OVER () AS N FROM st),
rk AS (SELECT CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(fp / N * (cum_tp - tp / 2.0) / P) END AS roc_auc,
              CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(tp / P * cum_tp / (cum_tp + cum_fp)) END AS pr_auc,
              CASE WHEN max(P) > 0 AND max(N) > 0 THEN greatest(coalesce(max(CASE WHEN cum_tp / (cum_tp + cum_fp) >= 0.9 THEN cum_tp / P END), 0.0), 0.0) END
                AS recall_at_precision_90,
              CASE WHEN max(P) > 0 AND max(N) > 0 THEN max(CASE WHEN cum_tp / P >= 0.8 THEN cum_tp / (cum_tp + cum_fp) END) END
                AS precision_at_recall_80 FROM cum),
ll AS (SELECT avg(-(y_true * ln(least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                   + (1 - y_true) * ln(1 - least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))) AS log_loss
       FROM scored)"""


def _q(body: str) -> str:
    return td.with_views("WITH " + _CONF + "," + _CURVE + "\n" + body, "scored")


@register("metric_confusion", _q("SELECT tn, fp, fn, tp FROM conf"))
def metric_confusion(spark, sf_dir):
    """V2 at threshold 0.5."""
    return mt.confusion(_sc(spark, sf_dir), "y_true", _pred())


@register("metric_prf", _q("SELECT round(positive_rate, 6) AS positive_rate, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM prf"))
def metric_prf(spark, sf_dir):
    """V3 at threshold 0.5."""
    return mt.prf(_sc(spark, sf_dir), "y_true", _pred())


@register("metric_log_loss", _q("SELECT round(log_loss, 6) AS log_loss FROM ll"))
def metric_log_loss(spark, sf_dir):
    """V4."""
    return mt.log_loss(_sc(spark, sf_dir), "y_true", "score")


def _rank(spark, sf_dir):
    df = _sc(spark, sf_dir)
    return mt.ranking_metrics(mt.score_table(df, "y_true", "score"))


@register("metric_roc_auc", _q("SELECT round(roc_auc, 6) AS roc_auc FROM rk"))
def metric_roc_auc(spark, sf_dir):
    """V5 (ties get half credit)."""
    return _rank(spark, sf_dir).select("roc_auc")


@register("metric_pr_auc", _q("SELECT round(pr_auc, 6) AS pr_auc FROM rk"))
def metric_pr_auc(spark, sf_dir):
    """V6 step average precision."""
    return _rank(spark, sf_dir).select("pr_auc")


@register("metric_recall_at_p90", _q("SELECT round(recall_at_precision_90, 6) AS recall_at_precision_90 FROM rk"))
def metric_recall_at_p90(spark, sf_dir):
    """V8."""
    return _rank(spark, sf_dir).select("recall_at_precision_90")


@register("metric_precision_at_r80", _q("SELECT round(precision_at_recall_80, 6) AS precision_at_recall_80 FROM rk"))
def metric_precision_at_r80(spark, sf_dir):
    """V9."""
    return _rank(spark, sf_dir).select("precision_at_recall_80")


@register(
    "metric_class_report",
    _q(
        """
SELECT '0' AS label, round(CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END, 6) AS precision,
       round(CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END, 6) AS recall,
       round(CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END, 6) AS f1_score, (tn + fp)::DOUBLE AS support FROM prf
UNION ALL SELECT '1', round(precision, 6), round(recall, 6), round(f1, 6), (tp + fn)::DOUBLE FROM prf
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tn + fp + fn + tp), 6), (tn + fp + fn + tp)::DOUBLE FROM prf
UNION ALL SELECT 'macro avg', round((precision + CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END) / 2, 6),
       round((recall + CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END) / 2, 6),
       round((f1 + CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END) / 2, 6), (tn + fp + fn + tp)::DOUBLE FROM prf
UNION ALL SELECT 'weighted avg',
       round((precision * (tp + fn) + CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END * (tn + fp)) / (tn + fp + fn + tp), 6),
       round((recall * (tp + fn) + CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END * (tn + fp)) / (tn + fp + fn + tp), 6),
       round((f1 * (tp + fn) + CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END * (tn + fp)) / (tn + fp + fn + tp), 6),
       (tn + fp + fn + tp)::DOUBLE FROM prf"""
    ),
)
def metric_class_report(spark, sf_dir):
    """V7 at threshold 0.5."""
    return mt.class_report(_sc(spark, sf_dir), "y_true", _pred())


@register(
    "curve_roc",
    _q(
        """
SELECT 0.0 AS fpr, 0.0 AS tpr, 'inf'::DOUBLE AS threshold
UNION ALL SELECT round(cum_fp / N, 6), round(cum_tp / P, 6), round(score, 6) FROM cum"""
    ),
)
def curve_roc(spark, sf_dir):
    """Every distinct score (no point dropping)."""
    return mt.roc_curve(mt.score_table(_sc(spark, sf_dir), "y_true", "score"))


@register(
    "curve_pr",
    _q(
        """
SELECT round(cum_tp / (cum_tp + cum_fp), 6) AS precision, round(cum_tp / P, 6) AS recall, round(score, 6) AS threshold FROM cum
UNION ALL SELECT 1.0, 0.0, NULL"""
    ),
)
def curve_pr(spark, sf_dir):
    """V11."""
    return mt.pr_curve(mt.score_table(_sc(spark, sf_dir), "y_true", "score"))


@register(
    "metric_all",
    _q(
        """
SELECT round(positive_rate, 6) AS positive_rate, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       tn, fp, fn, tp, round(log_loss, 6) AS log_loss, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       round(recall_at_precision_90, 6) AS recall_at_precision_90, round(precision_at_recall_80, 6) AS precision_at_recall_80
FROM prf, ll, rk"""
    ),
)
def metric_all(spark, sf_dir):
    """The whole metric row at 0.5."""
    return mt.evaluate(_sc(spark, sf_dir), "y_true", "score", 0.5)


# ------------------------------------------------------------------ thresholds
_GRID = th.default_grid()
_GRID_SQL = ", ".join(f"({t!r}::DOUBLE)" for t in _GRID)
_SWEEP = f"""
g(threshold) AS (VALUES {_GRID_SQL}),
c AS (SELECT threshold, count_if(score >= threshold AND y_true = 1) AS tp, count_if(score >= threshold AND y_true = 0) AS fp,
             count_if(NOT score >= threshold AND y_true = 1) AS fn, count_if(NOT score >= threshold AND y_true = 0) AS tn
      FROM scored CROSS JOIN g WHERE score IS NOT NULL GROUP BY threshold),
sw AS (SELECT threshold, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
              CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
              CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
              fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp, tn::BIGINT AS tn, (tp + fp)::BIGINT AS predicted_positive_count,
              (fp * 5.0 + fn * 100.0)::DOUBLE AS business_cost FROM c)"""
_SWEEP_COLS = "round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, fp, fn, tp, tn, predicted_positive_count, round(business_cost, 6) AS business_cost"


def _tq(body: str) -> str:
    return td.with_views("WITH " + _SWEEP + "\n" + body, "scored")


def _sweep(spark, sf_dir):
    return th.threshold_sweep(_sc(spark, sf_dir), "y_true", "score")


@register(
    "threshold_single",
    _tq(
        """
SELECT 0.5 AS threshold, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp, tn::BIGINT AS tn, (tp + fp)::BIGINT AS predicted_positive_count,
       (fp * 5.0 + fn * 100.0)::DOUBLE AS business_cost
FROM (SELECT count_if(score >= 0.5 AND y_true = 1) AS tp, count_if(score >= 0.5 AND y_true = 0) AS fp,
             count_if(NOT score >= 0.5 AND y_true = 1) AS fn, count_if(NOT score >= 0.5 AND y_true = 0) AS tn FROM scored)"""
    ),
)
def threshold_single(spark, sf_dir):
    """T1 at 0.5 with costs FN 100 / FP 5."""
    return th.evaluate_threshold(_sc(spark, sf_dir), "y_true", "score", 0.5)


@register("threshold_sweep", _tq(f"SELECT {_SWEEP_COLS} FROM sw"))
def threshold_sweep(spark, sf_dir):
    """19-point grid in one pass."""
    return _sweep(spark, sf_dir)


@register(
    "threshold_modes",
    _tq(
        f"""
SELECT * FROM (SELECT 'conservative' AS mode, {_SWEEP_COLS} FROM sw WHERE predicted_positive_count > 0
               ORDER BY precision DESC, fp ASC, threshold DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'balanced' AS mode, {_SWEEP_COLS} FROM sw ORDER BY business_cost ASC, f1 DESC, threshold DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'aggressive' AS mode, {_SWEEP_COLS} FROM sw WHERE predicted_positive_count > 0
               ORDER BY recall DESC, fn ASC, threshold ASC LIMIT 1)"""
    ),
)
def threshold_modes(spark, sf_dir):
    """T3–T5 over the sweep table (at least one threshold predicts positives here)."""
    return th.select_modes(_sweep(spark, sf_dir))


@register("threshold_closest", _tq(f"SELECT {_SWEEP_COLS} FROM sw ORDER BY abs(threshold - 0.8), threshold LIMIT 1"))
def threshold_closest(spark, sf_dir):
    """Grid row nearest 0.80."""
    return th.closest_threshold(_sweep(spark, sf_dir), 0.8)


@register(
    "threshold_no_positive_flag",
    _tq("SELECT max(fn) = 0 AND (SELECT coalesce(sum(y_true), 0) FROM scored) = 0 AS no_positives, (SELECT coalesce(sum(y_true), 0) FROM scored)::BIGINT AS positives FROM sw"),
)
def threshold_no_positive_flag(spark, sf_dir):
    """T8."""
    df = _sc(spark, sf_dir)
    return th.no_positive_flag(th.threshold_sweep(df, "y_true", "score"), df, "y_true")
