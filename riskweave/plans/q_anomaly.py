"""Registered queries for anomaly detection and ensembling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import anomaly as an
from riskweave.operators import models as md
from riskweave.plans import workflows as wf
from riskweave.plans.registry import register
from riskweave.sources import testdata as td

T = "is_fraud"
K = "transaction_id"


def _forest(spark, sf_dir):
    data = wf.prepare_model_data(spark, sf_dir)
    train = data.df.where("split = 'train'")
    model = an.fit_isolation_forest(train, data.features, K, T)
    return data, model


@register("anomaly_forest")
def anomaly_forest(spark, sf_dir):
    """Y1+Y2: 200 trees on benign training rows; the node table."""
    _, model = _forest(spark, sf_dir)
    return spark.createDataFrame(model.forest)


@register("anomaly_score")
def anomaly_score(spark, sf_dir):
    """Y3+Y4: raw forest scores of every row, min-max normalised with the
    train bounds (clipped) and, for comparison, per batch."""
    data, model = _forest(spark, sf_dir)
    # forest scoring (200 trees per row) feeds both the bounds and the output:
    # run it once and cut the lineage (reliable checkpoint, shared folder)
    raw = an.raw_scores(model, data.df, [K, T, "split"]).checkpoint()
    b = raw.where("split = 'train'").agg(F.min("anomaly_raw"), F.max("anomaly_raw")).first()
    out = an.minmax(raw, "anomaly_raw", "anomaly_score", bounds=(b[0], b[1]))
    return an.minmax(out, "anomaly_raw", "anomaly_score_batch")


_SC = "WITH mm AS (SELECT min(score) AS lo, max(score) AS hi FROM scored)"


@register(
    "anomaly_minmax",
    td.with_views(
        _SC
        + """
SELECT transaction_id, round(CASE WHEN abs(hi - lo) <= 1e-8 + 1e-5 * abs(lo) THEN 0.5 ELSE (score - lo) / (hi - lo) END, 6) AS anomaly_score
FROM scored, mm""",
        "scored",
    ),
)
def anomaly_minmax(spark, sf_dir):
    """Y4 on a SQL-expressible score."""
    return an.minmax(td.scored(spark, sf_dir), "score").select(K, "anomaly_score")


@register("anomaly_threshold", td.with_views("SELECT round(quantile_cont(score, 0.95), 6) AS threshold FROM scored", "scored"))
def anomaly_threshold(spark, sf_dir):
    """0.95 quantile of the scores (exact)."""
    return an.quantile_threshold(td.scored(spark, sf_dir), "score", 0.95)


@register(
    "anomaly_metrics",
    td.with_views(
        """
WITH th AS (SELECT quantile_cont(score, 0.95) AS t FROM scored),
c AS (SELECT count_if(y_true = 0 AND NOT score >= t) AS tn, count_if(y_true = 0 AND score >= t) AS fp,
             count_if(y_true = 1 AND NOT score >= t) AS fn, count_if(y_true = 1 AND score >= t) AS tp, max(t) AS t FROM scored, th)
SELECT tn::BIGINT AS tn, fp::BIGINT AS fp, fn::BIGINT AS fn, tp::BIGINT AS tp,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall, round(t, 6) AS decision_threshold FROM c""",
        "scored",
    ),
)
def anomaly_metrics(spark, sf_dir):
    """Confusion and P/R at the 0.95-quantile threshold."""
    df = td.scored(spark, sf_dir)
    t = an.quantile_threshold(df, "score", 0.95).first()[0]
    return an.evaluate_at(df, "y_true", "score", t).select("tn", "fp", "fn", "tp", "precision", "recall", "decision_threshold")


_ENS = """
WITH mm AS (SELECT min(amount) AS lo, max(amount) AS hi FROM scored),
e AS (SELECT transaction_id, y_true, 0.7 * score + 0.3 * CASE WHEN abs(hi - lo) <= 1e-8 + 1e-5 * abs(lo) THEN 0.5
                                                             ELSE (amount - lo) / (hi - lo) END AS ensemble_score FROM scored, mm)"""


def _ensemble(spark, sf_dir):
    df = an.minmax(td.scored(spark, sf_dir), "amount", "amount_score")
    return df.withColumn("ensemble_score", an.ensemble(F.col("score"), F.col("amount_score")))


@register("ensemble_score", td.with_views(_ENS + "\nSELECT transaction_id, round(ensemble_score, 6) AS ensemble_score FROM e", "scored"))
def ensemble_score(spark, sf_dir):
    """0.7 · supervised score + 0.3 · min-max amount outlyingness."""
    return _ensemble(spark, sf_dir).select(K, "ensemble_score")


@register("ensemble_threshold", td.with_views(_ENS + "\nSELECT round(quantile_cont(ensemble_score, 0.75), 6) AS threshold FROM e", "scored"))
def ensemble_threshold(spark, sf_dir):
    """0.75 quantile of the ensemble score."""
    return an.quantile_threshold(_ensemble(spark, sf_dir), "ensemble_score", 0.75)


@register(
    "score_histogram",
    td.with_views(
        """
WITH s AS (SELECT y_true AS g, min(score) AS lo0, max(score) AS hi0, count(score) AS n FROM scored WHERE score IS NOT NULL GROUP BY 1),
p AS (SELECT g, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi,
             least(10, greatest(3, n)) AS bins FROM s),
c AS (SELECT p.g, least(floor((score - lo) / ((hi - lo) / bins)), bins - 1)::BIGINT AS bin, count(*) AS n
      FROM scored JOIN p ON scored.y_true = p.g WHERE score IS NOT NULL GROUP BY 1, 2),
sp AS (SELECT g, unnest(range(bins::BIGINT)) AS bin, lo, hi, bins FROM p)
SELECT sp.g::BIGINT AS "group", sp.bin::BIGINT AS bin, round(lo + sp.bin * (hi - lo) / bins, 6) AS lower,
       round(lo + (sp.bin + 1) * (hi - lo) / bins, 6) AS upper, coalesce(c.n, 0)::BIGINT AS count
FROM sp LEFT JOIN c ON sp.g = c.g AND sp.bin = c.bin""",
        "scored",
    ),
)
def score_histogram(spark, sf_dir):
    """Per-class score histograms."""
    return an.score_histograms(td.scored(spark, sf_dir), "y_true", "score").withColumn("group", F.col("group").cast("bigint"))


@register("anomaly_comparison")
def anomaly_comparison(spark, sf_dir):
    """Y10+Y11: main model, forest on holdout (valid ∪ test), forest and
    ensemble on all splits, as one metric table."""
    data, forest = _forest(spark, sf_dir)
    main = wf.main_bundle(spark, sf_dir, data)
    # the forest scores each row beside its features, and the main model scores
    # that frame: one pass and no join. Both scores feed the bounds, two quantiles
    # and four metric rows, so they are written once (reliable checkpoint)
    raw = an.raw_scores(forest, data.df, [K, T, "split", *data.features])
    both = md.score(main.model, raw, data.features, [K, T, "split", "anomaly_raw"]).checkpoint()
    rows = md.comparison(spark, an.study(both, T, "score", "anomaly_raw"))
    uses_main = F.col("model").isin("supervised_full", "ensemble_full")
    return rows.withColumn("candidate", F.when(uses_main, F.lit(main.candidate)))
