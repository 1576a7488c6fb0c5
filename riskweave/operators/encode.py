"""Train-only encoding.

Fitting aggregates the training rows into a small vocabulary table
(column, value, count); its size is bounded by the categorical cardinality
limit of F12 (≤ 50 values per column), so it is collected and turned into
plain column expressions. Applying the encoder is a projection: no join and
no shuffle, identical for batch and streaming input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import as_category, col, dtype_of, to_double

MIN_FREQUENCY = 0.01
INFREQUENT_SUFFIX = "_infrequent_sklearn"
#: Values of one column that can be encoded (the limit of F12); the number of columns has none.
MAX_CATEGORIES = 50


@dataclass
class CategoryEncoding:
    column: str
    mode: str | None
    frequent: list[str]
    infrequent: list[str]

    @property
    def output_columns(self) -> list[str]:
        out = [f"{self.column}_{v}" for v in self.frequent]
        if self.infrequent:
            out.append(f"{self.column}{INFREQUENT_SUFFIX}")
        return out


@dataclass
class FittedEncoder:
    """Fitted on train only; ``transform`` is a pure projection."""

    numeric: list[str]
    categorical: list[CategoryEncoding] = field(default_factory=list)

    @property
    def output_features(self) -> list[str]:
        return list(self.numeric) + [c for enc in self.categorical for c in enc.output_columns]

    def numeric_exprs(self, df: DataFrame) -> list[Column]:
        """Numeric features as doubles, NULL → 0."""
        return [F.coalesce(to_double(col(c), dtype_of(df, c)), F.lit(0.0)).alias(c) for c in self.numeric]

    def categorical_exprs(self, df: DataFrame) -> list[Column]:
        """N2+N3: impute with the train mode, then one-hot with pooling."""
        out = []
        for enc in self.categorical:
            v = as_category(df, enc.column)
            if enc.mode is not None:
                v = F.coalesce(v, F.lit(enc.mode))
            for value in enc.frequent:
                out.append(F.when(v == F.lit(value), 1.0).otherwise(0.0).alias(f"{enc.column}_{value}"))
            if enc.infrequent:
                known = F.lit(False) if not enc.frequent else v.isin(*enc.frequent)
                out.append(
                    F.when(v.isNotNull() & ~known, 1.0).otherwise(0.0).alias(f"{enc.column}{INFREQUENT_SUFFIX}")
                )
        return out

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """``keep`` columns, then numeric, then one-hot columns."""
        keep = keep or []
        return df.select(*[col(c) for c in keep], *self.numeric_exprs(df), *self.categorical_exprs(df))

    def vocabulary(self, spark) -> DataFrame:
        rows = []
        for enc in self.categorical:
            rows += [(enc.column, v, f"{enc.column}_{v}", True) for v in enc.frequent]
            rows += [(enc.column, v, f"{enc.column}{INFREQUENT_SUFFIX}", False) for v in enc.infrequent]
        return spark.createDataFrame(rows, "column_name string, category string, output_column string, frequent boolean")


def category_counts(train: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, count) over non-null training values, combined map-side."""
    long = train.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), as_category(train, c).alias("value")) for c in columns])
        ).alias("r")
    ).select("r.*")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def train_modes(counts: DataFrame) -> DataFrame:
    """Most frequent non-null value per column; smallest value on ties."""
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    return (
        counts.where(F.col("value").isNotNull())
        .withColumn("__r", F.row_number().over(w))
        .where("__r = 1")
        .select("column_name", F.col("value").alias("mode"), F.col("count").cast("bigint").alias("count"))
    )


def fit_encoder(
    train: DataFrame, numeric: list[str], categorical: list[str], min_frequency: float = MIN_FREQUENCY
) -> FittedEncoder:
    """Fit N1–N3 on the training rows."""
    enc = FittedEncoder(list(numeric))
    if not categorical:
        return enc
    one = train.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(col(c).isNull()).alias(c) for c in categorical]).first()
    n = one["__n"]
    nulls = {c: one[c] for c in categorical}
    counts = category_counts(train, categorical).cache()
    try:
        modes = {r["column_name"]: r["mode"] for r in train_modes(counts).collect()}
        values = counts.where(F.col("value").isNotNull())
        wide = values.groupBy("column_name").count().where(F.col("count") > MAX_CATEGORIES).collect()
        vocab = [] if wide else values.collect()  # at most MAX_CATEGORIES rows per column
    finally:
        counts.unpersist()
    if wide:
        raise ValueError(f"more than {MAX_CATEGORIES} categories in {sorted(r['column_name'] for r in wide)}; choose columns with F12 first")
    by_col: dict[str, dict[str, int]] = {c: {} for c in categorical}
    for r in vocab:
        by_col[r["column_name"]][r["value"]] = r["count"]
    threshold = min_frequency * n
    for c in categorical:
        cnt = dict(by_col[c])
        mode = modes.get(c)
        if mode is not None and nulls.get(c):
            cnt[mode] = cnt.get(mode, 0) + nulls[c]  # imputed rows count for the mode
        values = sorted(cnt)
        frequent = [v for v in values if cnt[v] >= threshold]
        infrequent = [v for v in values if cnt[v] < threshold]
        enc.categorical.append(CategoryEncoding(c, mode, frequent, infrequent))
    return enc


def build_processed_splits(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    target: str | None,
    keep: list[str] | None = None,
    split_col: str = "split",
    min_frequency: float = MIN_FREQUENCY,
) -> tuple[DataFrame, FittedEncoder]:
    """Fit on ``split = 'train'``, transform every row in one pass, keep
    the split label, target and ``keep`` columns."""
    enc = fit_encoder(df.where(F.col(split_col) == "train"), numeric, categorical, min_frequency)
    cols = list(keep or []) + [split_col] + ([target] if target else [])
    return enc.transform(df, cols), enc
