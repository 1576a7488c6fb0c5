"""Binary-classification metrics (V1–V12), exact and tie-aware.

Curve metrics start from one row per distinct score with its positive and
negative counts (scores shared by many rows collapse map-side), then take
running sums in descending score order with ``ordered_prefix`` (no
single-partition window). ROC-AUC (ties get half credit) and step average
precision are plain sums over that table:

    AUC = Σ fp_i / N · (cum_tp_i − tp_i / 2) / P
    AP  = Σ tp_i / P · cum_tp_i / (cum_tp_i + cum_fp_i)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.ordered import ordered_prefix

EPS = 2.220446049250313e-16  # float64 machine epsilon, the log-loss clip


def _yp(df: DataFrame, y: str, pred: Column) -> DataFrame:
    return df.select(F.col(y).cast("int").alias("__y"), pred.cast("int").alias("__p"))


def confusion(df: DataFrame, y: str, pred: Column) -> DataFrame:
    """V2: tn, fp, fn, tp with fixed labels [0, 1]."""
    b = _yp(df, y, pred)
    return b.agg(
        F.count_if((F.col("__y") == 0) & (F.col("__p") == 0)).cast("bigint").alias("tn"),
        F.count_if((F.col("__y") == 0) & (F.col("__p") == 1)).cast("bigint").alias("fp"),
        F.count_if((F.col("__y") == 1) & (F.col("__p") == 0)).cast("bigint").alias("fn"),
        F.count_if((F.col("__y") == 1) & (F.col("__p") == 1)).cast("bigint").alias("tp"),
    )


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def prf_columns(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1 with 0 on zero division."""
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    return {"precision": precision.cast("double"), "recall": recall.cast("double"), "f1": f1.cast("double")}


def prf(df: DataFrame, y: str, pred: Column) -> DataFrame:
    """V3: positive rate, precision, recall and F1."""
    c = confusion(df, y, pred)
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cols = prf_columns(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(((F.col("tp") + F.col("fn")) / n).alias("positive_rate"), *[v.alias(k) for k, v in cols.items()])


def log_loss_expr(y: Column, p: Column, eps: float = EPS) -> Column:
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return -(y * F.log(q) + (1 - y) * F.log(1 - q))


def log_loss(df: DataFrame, y: str, score: str) -> DataFrame:
    """V4: mean log-loss with probabilities clipped to [eps, 1 − eps]."""
    return df.agg(F.avg(log_loss_expr(F.col(y).cast("double"), F.col(score))).alias("log_loss"))


def score_table(df: DataFrame, y: str, score: str) -> DataFrame:
    """Distinct scores with counts and running sums in descending score order.

    Columns: score, tp, fp, cum_tp, cum_fp (inclusive), plus P and N totals.
    """
    base = df.select(F.col(y).cast("long").alias("__y"), (-F.col(score)).alias("__neg"))
    # The totals come from one aggregate of the rows, not from the finished prefix.
    tot = base.where(F.col("__neg").isNotNull()).agg(F.sum("__y").alias("P"), F.sum(1 - F.col("__y")).alias("N")).first()
    pref = ordered_prefix(base, "__neg", {"tp": F.col("__y"), "fp": 1 - F.col("__y")})
    return pref.select(
        (-F.col("__neg")).alias("score"), "tp", "fp", "cum_tp", "cum_fp",
        F.lit(tot["P"]).cast("long").alias("P"), F.lit(tot["N"]).cast("long").alias("N"),
    )


def ranking_metrics(table: DataFrame) -> DataFrame:
    """V5, V6, V8, V9 from a ``score_table``; NULL when one class is missing."""
    P, N = F.col("P"), F.col("N")
    prec = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))  # ≥ 1 row per score
    rec = F.try_divide(F.col("cum_tp"), P)  # NULL when there is no positive
    agg = table.agg(
        F.first("P").alias("P"),
        F.first("N").alias("N"),
        F.sum(F.try_divide(F.col("fp") * (F.col("cum_tp") - F.col("tp") / 2.0), N * P)).alias("roc_auc"),
        F.sum(F.try_divide(F.col("tp"), P) * prec).alias("pr_auc"),
        F.max(F.when(prec >= 0.9, rec)).alias("r90"),
        F.max(F.when(rec >= 0.8, prec)).alias("p80"),
    )
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return agg.select(
        F.when(both, F.col("roc_auc")).alias("roc_auc"),
        F.when(both, F.col("pr_auc")).alias("pr_auc"),
        # the curve's end point (precision 1, recall 0) always qualifies
        F.when(both, F.coalesce(F.greatest(F.col("r90"), F.lit(0.0)), F.lit(0.0))).alias("recall_at_precision_90"),
        F.when(both, F.col("p80")).alias("precision_at_recall_80"),
    )


def roc_curve(table: DataFrame) -> DataFrame:
    """(fpr, tpr, threshold) for every distinct score, plus the (0, 0)
    start point with an infinite threshold."""
    pts = table.select(
        F.try_divide(F.col("cum_fp"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("cum_tp"), F.col("P")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = table.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return start.unionByName(pts)


def pr_curve(table: DataFrame) -> DataFrame:
    """(precision, recall, threshold) per distinct score plus the end
    point (1, 0) with a NULL threshold."""
    pts = table.select(
        (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
        F.try_divide(F.col("cum_tp"), F.col("P")).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = table.sparkSession.createDataFrame([(1.0, 0.0, None)], "precision double, recall double, threshold double")
    return pts.unionByName(end)


def class_report(df: DataFrame, y: str, pred: Column) -> DataFrame:
    """V7: per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion(df, y, pred)
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    one = prf_columns(tp, fp, fn)
    zero = prf_columns(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = [
        F.struct(F.lit("0").alias("label"), zero["precision"].alias("precision"), zero["recall"].alias("recall"),
                 zero["f1"].alias("f1_score"), s0.cast("double").alias("support")),
        F.struct(F.lit("1").alias("label"), one["precision"].alias("precision"), one["recall"].alias("recall"),
                 one["f1"].alias("f1_score"), s1.cast("double").alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), ((tp + tn) / n).alias("f1_score"), n.cast("double").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((one["precision"] + zero["precision"]) / 2).alias("precision"),
                 ((one["recall"] + zero["recall"]) / 2).alias("recall"), ((one["f1"] + zero["f1"]) / 2).alias("f1_score"),
                 n.cast("double").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), ((one["precision"] * s1 + zero["precision"] * s0) / n).alias("precision"),
                 ((one["recall"] * s1 + zero["recall"] * s0) / n).alias("recall"),
                 ((one["f1"] * s1 + zero["f1"] * s0) / n).alias("f1_score"), n.cast("double").alias("support")),
    ]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def evaluate(df: DataFrame, y: str, score: str, threshold: float = 0.5) -> DataFrame:
    """The whole metric row at ``threshold`` (ranking metrics NULL with one class)."""
    ranked = ranking_metrics(score_table(df, y, score)).first().asDict()  # one row
    yt, p = F.col(y).cast("int"), (F.col(score) >= F.lit(threshold)).cast("int")
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counts = [F.count_if((yt == t) & (p == q)).cast("bigint").alias(name) for name, (t, q) in cells.items()]
    c = df.agg(*counts, F.avg(log_loss_expr(F.col(y).cast("double"), F.col(score))).alias("log_loss"))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cols = prf_columns(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(
        ((F.col("tp") + F.col("fn")) / n).alias("positive_rate"),
        *[v.alias(k) for k, v in cols.items()],
        *cells,
        "log_loss",
        *[F.lit(v).cast("double").alias(k) for k, v in ranked.items()],
    )
