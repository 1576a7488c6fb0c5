"""Registered queries for models (M1–M11), scoring (I1–I6) and
explainability / error analysis (X1–X9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskweave.operators import explain as ex
from riskweave.operators import models as md
from riskweave.operators import scoring as sc
from riskweave.operators import thresholds as th
from riskweave.plans import workflows as wf
from riskweave.plans.q_split_encode import _ENC_CTES, _time_split_sql
from riskweave.plans.registry import register
from riskweave.session import shared_path
from riskweave.sources import io
from riskweave.sources import testdata as td

T = "is_fraud"
K = "transaction_id"


def _baseline(spark, sf_dir):
    data = wf.prepare_model_data(spark, sf_dir)
    return data, wf.fitted_bundle(spark, sf_dir, data, "baseline")


def _main(spark, sf_dir):
    data = wf.prepare_model_data(spark, sf_dir)
    return data, wf.main_bundle(spark, sf_dir, data)


@register(
    "model_class_weights",
    td.with_views(
        "WITH "
        + _time_split_sql("events_txn")
        + """,
c AS (SELECT e.is_fraud AS class, count(*) AS n FROM events_txn e JOIN splits s USING (transaction_id)
      WHERE s.split = 'train' AND e.is_fraud IS NOT NULL GROUP BY 1)
SELECT class::BIGINT AS class, n::BIGINT AS count, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c""",
        "events_txn",
    ),
)
def model_class_weights(spark, sf_dir):
    """M4 on the training split."""
    from riskweave.operators import split as sp

    res = sp.time_split(td.events_txn(spark, sf_dir), "transaction_time", K)
    return md.class_weights(res.df.where("split = 'train'"), T)


@register(
    "model_scaler_stats",
    td.with_views(
        _ENC_CTES
        + "SELECT feature, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM enc WHERE split = 'train' GROUP BY feature",
        "events_txn",
    ),
)
def model_scaler_stats(spark, sf_dir):
    """M2: train mean and population std of the encoded features."""
    from riskweave.plans.q_split_encode import _encoded

    out, enc = _encoded(spark, sf_dir)
    return md.scaler_stats(out.where("split = 'train'"), enc.output_features)


@register("model_baseline_lr")
def model_baseline_lr(spark, sf_dir):
    """M3: balanced L2 logistic regression; coefficients per feature."""
    data, model = _baseline(spark, sf_dir)
    lr = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(data.features, lr.coefficients.toArray())] + [("__intercept__", float(lr.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@register("model_score_split")
def model_score_split(spark, sf_dir):
    """Baseline scores of the test split with the 0.5 decision."""
    data, model = _baseline(spark, sf_dir)
    test = data.df.where("split = 'test'")
    s = md.score(model, test, data.features, [K, T])
    return s.withColumn("label", (F.col("score") >= 0.5).cast("int"))


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Save the bundle to the shared folder, load it, score the test split."""
    data, model = _baseline(spark, sf_dir)
    path = shared_path(spark, f"model-{uuid.uuid4().hex}")
    md.save_model(model, path)
    loaded = md.load_model(path)
    return md.score(loaded, data.df.where("split = 'test'"), data.features, [K, T])


@register("model_gbt")
def model_gbt(spark, sf_dir):
    """M5: boosting with the first grid point; test-split metric row."""
    data = wf.prepare_model_data(spark, sf_dir)
    model = wf.gbt_bundles(spark, sf_dir, data, md.GBT_GRID[:1])[0]
    s = md.score(model, data.df.where("split = 'test'"), data.features, [K, T])
    from riskweave.operators.metrics import evaluate

    return evaluate(s, T, "score", 0.5)


@register("model_grid_search")
def model_grid_search(spark, sf_dir):
    """M6–M8: 4-point grid on the validation split, refit on train ∪ valid,
    one row per candidate plus the chosen one's test metrics."""
    from riskweave.operators.metrics import evaluate

    data, main = _main(spark, sf_dir)
    scored = md.score(main.model, data.df.where("split = 'test'"), data.features, [K, T])
    test_pr = evaluate(scored, T, "score", 0.5).select("pr_auc").first()[0]
    rows = [{**r, "is_best": r["candidate"] == main.candidate, "test_pr_auc_of_final": test_pr} for r in main.rows]
    return spark.createDataFrame(rows)


@register("model_hist_grid")
def model_hist_grid(spark, sf_dir):
    """M5, M6 on histogram boosting with L2: the four grid points grown in the same
    passes over train, one row per candidate with its validation metric and its
    test PR-AUC (before the refit of M8)."""
    from riskweave.operators.metrics import evaluate

    data = wf.prepare_model_data(spark, sf_dir)
    train, valid, test = (data.df.where(F.col("split") == s) for s in ("train", "valid", "test"))
    models = wf.hist_bundles(spark, sf_dir, data)
    found = md.tune_hist(train, valid, data.features, T, fitted=models)
    pr = [evaluate(md.score(m, test, data.features, [T]), T, "score", 0.5).select("pr_auc").first()[0] for m in models]
    rows = [{**r, "is_best": md.GBT_GRID[i] == found.best_params, "test_pr_auc": pr[i]} for i, r in enumerate(found.rows)]
    return spark.createDataFrame(rows)


@register("model_comparison")
def model_comparison(spark, sf_dir):
    """Baseline vs the tuned main model on the test split."""
    from riskweave.operators.metrics import evaluate

    data, base = _baseline(spark, sf_dir)
    main = wf.main_bundle(spark, sf_dir, data)
    test = data.df.where("split = 'test'")
    rows = md.comparison(
        spark,
        {
            "baseline_logistic_regression": evaluate(md.score(base, test, data.features, [T]), T, "score", 0.5),
            "gradient_boosting": evaluate(md.score(main.model, test, data.features, [T]), T, "score", 0.5),
        },
    )
    return rows.withColumn("candidate", F.when(F.col("model") == "gradient_boosting", F.lit(main.candidate)))


@register("score_batch")
def score_batch(spark, sf_dir):
    """Every events_txn row scored with the fitted encoder and the
    main model; the threshold comes from the saved validation sweep (S6, T7)."""
    data, main = _main(spark, sf_dir)
    valid = md.score(main.model, data.df.where("split = 'valid'"), data.features, [T])
    path = shared_path(spark, f"threshold-sweep-{uuid.uuid4().hex}.csv")
    io.write_csv(th.threshold_sweep(valid, T, "score"), path)
    feats = sc.request_features(td.events_txn(spark, sf_dir).drop(T), data.roles, T)
    scored = sc.score_batch(main.model, data.encoder, feats, K, th.load_threshold(spark, path))
    return scored.withColumn("candidate", F.lit(main.candidate))


def _score_features_sql() -> str:
    from riskweave.plans.q_features import history_ctes

    body = history_ctes("events_txn") + """
SELECT e.transaction_id,
       hour(e.transaction_time)::BIGINT AS event_hour,
       (isodow(e.transaction_time) - 1)::BIGINT AS event_day_of_week,
       CASE WHEN isodow(e.transaction_time) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend,
       round(CASE WHEN e.amount IS NULL THEN NULL ELSE ln(1 + greatest(e.amount, 0.0)) END, 6) AS amount_log1p,
       h.* EXCLUDE (transaction_id)
FROM events_txn e JOIN h ON e.transaction_id = h.transaction_id"""
    return td.with_views(body, "events_txn")


@register("score_features", _score_features_sql(), overrides={"user_amount_std_prior": 4})
def score_features(spark, sf_dir):
    """Request rows without a target get the training features."""
    from riskweave.operators import features as fe

    roles = td.EVENTS_TXN_ROLES
    out = sc.request_features(td.events_txn(spark, sf_dir).drop(T), roles, T)
    return out.select(K, *fe.ENGINEERED_FEATURES)


@register(
    "score_coerce_numeric",
    """
SELECT event_id AS transaction_id,
       round(coalesce(TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE regexp_extract(props, '[0-9]+', 0) END AS DOUBLE), 0.0), 6)
         AS amount_coerced
FROM events""",
)
def score_coerce_numeric(spark, sf_dir):
    """I4: text → number, garbage and NULL → 0."""
    e = td.table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.regexp_extract("props", "[0-9]+", 0))
    return e.select(F.col("event_id").alias(K), sc.coerce_numeric(raw).alias("amount_coerced"))


_REQ_SQL = """
SELECT '{"tx_id": "t' || event_id || '", "customer_id": "u' || user_id || '", "event_time": "' || strftime(ts, '%Y-%m-%d %H:%M:%S') ||
       '", "amount": ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || ', "channel": "' || event_type || '"}' AS body,
       event_id
FROM events"""


@register(
    "score_parse_request",
    f"""
WITH r AS ({_REQ_SQL})
SELECT json_extract_string(body, '$.tx_id') AS transaction_id, json_extract_string(body, '$.customer_id') AS user_id,
       round(CAST(json_extract_string(body, '$.amount') AS DOUBLE), 6) AS amount,
       json_extract_string(body, '$.channel') AS channel
FROM r""",
)
def score_parse_request(spark, sf_dir):
    """JSON requests with aliased fields and an extra field."""
    e = td.table(spark, sf_dir, "events")
    body = F.concat(
        F.lit('{"tx_id": "t'), F.col("event_id").cast("string"),
        F.lit('", "customer_id": "u'), F.col("user_id").cast("string"),
        F.lit('", "event_time": "'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit('", "amount": '), F.round(F.col("value") * 100).cast("bigint").cast("string"),
        F.lit(', "channel": "'), F.col("event_type"), F.lit('"}'),
    )
    parsed = sc.parse_requests(e.select(body.alias("body")), "body")
    return parsed.select(K, "user_id", "amount", F.col("extras")["channel"].alias("channel"))


# ------------------------------------------------------------ error analysis
_ERR = """
p AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS y_pred,
             CASE WHEN y_true = 1 AND score >= 0.5 THEN 'TP' WHEN y_true = 1 THEN 'FN'
                  WHEN score >= 0.5 THEN 'FP' ELSE 'TN' END AS error_type FROM scored)"""


def _pred(spark, sf_dir):
    return ex.prediction_frame(td.scored(spark, sf_dir), "y_true", "score", 0.5)


@register(
    "error_prediction_frame",
    td.with_views(
        "WITH " + _ERR + "\nSELECT transaction_id, y_true::BIGINT AS y_true, round(score, 6) AS score, y_pred::BIGINT AS y_pred, error_type FROM p",
        "scored",
    ),
)
def error_prediction_frame(spark, sf_dir):
    """X5 on scored at 0.5."""
    return _pred(spark, sf_dir).select(K, "y_true", "score", "y_pred", "error_type")


@register(
    "error_group_summary",
    td.with_views(
        "WITH " + _ERR + """
SELECT error_type, count(*)::BIGINT AS count, round(avg(score), 6) AS mean_score, round(avg(transaction_id), 6) AS transaction_id_mean,
       round(avg(amount), 6) AS amount_mean FROM p GROUP BY error_type""",
        "scored",
    ),
)
def error_group_summary(spark, sf_dir):
    """X6 with the numeric columns of scored."""
    return ex.error_group_summary(_pred(spark, sf_dir), "score", ["transaction_id", "amount"])


@register(
    "error_cases_fp",
    td.with_views("WITH " + _ERR + "\nSELECT transaction_id, round(amount, 6) AS amount, round(score, 6) AS score FROM p WHERE error_type = 'FP'", "scored"),
)
def error_cases_fp(spark, sf_dir):
    """Export partitioned by error type, read the FP folder back."""
    path = shared_path(spark, f"errors-{uuid.uuid4().hex}")
    ex.export_error_tables(_pred(spark, sf_dir).select(K, "amount", "score", "error_type"), path)
    return spark.read.parquet(path).where("error_type = 'FP'").select(K, "amount", "score")


@register(
    "error_feature_quartiles",
    td.with_views(
        "WITH " + _ERR + """,
q AS (SELECT error_type, count(amount) AS n, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS median,
             quantile_cont(amount, 0.75) AS q3 FROM p WHERE amount IS NOT NULL GROUP BY error_type)
SELECT 'amount' AS feature, q.error_type, q.n::BIGINT AS count, round(min(amount), 6) AS min,
       round(min(CASE WHEN amount >= q1 - 1.5 * (q3 - q1) THEN amount END), 6) AS whisker_low,
       round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(max(CASE WHEN amount <= q3 + 1.5 * (q3 - q1) THEN amount END), 6) AS whisker_high, round(max(amount), 6) AS max
FROM p JOIN q USING (error_type) GROUP BY q.error_type, q.n, q1, median, q3""",
        "scored",
    ),
)
def error_feature_quartiles(spark, sf_dir):
    """Amount quartiles and whiskers by error type."""
    return ex.feature_quartiles(_pred(spark, sf_dir), "amount")


@register(
    "error_dominance",
    td.with_views(
        "WITH " + _ERR + """
SELECT count_if(error_type = 'TP')::BIGINT AS tp, count_if(error_type = 'FN')::BIGINT AS fn, count_if(error_type = 'FP')::BIGINT AS fp,
       count_if(error_type = 'TN')::BIGINT AS tn,
       CASE WHEN count_if(error_type = 'FP') > count_if(error_type = 'FN') THEN 'false_positives'
            WHEN count_if(error_type = 'FN') > count_if(error_type = 'FP') THEN 'false_negatives' ELSE 'balanced' END AS dominant_error
FROM p""",
        "scored",
    ),
)
def error_dominance(spark, sf_dir):
    """X9."""
    return ex.error_dominance(_pred(spark, sf_dir))


@register("explain_permutation")
def explain_permutation(spark, sf_dir):
    """X1+X3: permutation importance of the main model on the test split
    (or all splits when the test split is too small or one-class)."""
    data, main = _main(spark, sf_dir)
    chosen = ex.choose_importance_dataset(data.df, "split", "test", T)
    found = ex.permutation_importance(main.model, chosen, data.features, T, K, repeats=10)
    return found.withColumn("candidate", F.lit(main.candidate))


@register("explain_native")
def explain_native(spark, sf_dir):
    """The main model's own feature importances."""
    data, main = _main(spark, sf_dir)
    return ex.native_importance(spark, main.model, data.features).withColumn("candidate", F.lit(main.candidate))


@register("explain_topn")
def explain_topn(spark, sf_dir):
    """Top-5 permutation importances (the report size)."""
    return ex.top_importances(explain_permutation(spark, sf_dir), 5)
