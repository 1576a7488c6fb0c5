"""Data audit (A1–A4): one aggregate pass per question, unpivoted to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.columns import col
from riskweave.roles import ROLE_NAMES, candidates, categorical_columns, numeric_columns
from riskweave.session import written


def _is_missing(f: T.StructField) -> Column:
    c = col(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _rows_of(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn a one-row aggregate into rows (a tiny explode, no shuffle)."""
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def missing_counts(df: DataFrame) -> DataFrame:
    """A1: (column_name, position, missing); NaN counts as missing."""
    fields = df.schema.fields
    agg = df.agg(*[F.count_if(_is_missing(f)).alias(f"m{i}") for i, f in enumerate(fields)])
    return _rows_of(
        agg,
        [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(i).cast("bigint").alias("position"),
                F.col(f"m{i}").cast("bigint").alias("missing"),
            )
            for i, f in enumerate(fields)
        ],
    )


def _row_key(df: DataFrame) -> list[Column]:
    """128 bits of a whole row; a null in another column is another row."""
    parts = [x for f in df.schema.fields for x in (_plain(f), col(f.name).isNull())]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("row"), *parts)]


def _plain(f: T.StructField) -> Column:
    """A column whose equal values have equal bytes: one zero and one NaN."""
    c = col(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(c), F.lit(float("nan")).cast(f.dataType)).otherwise(c + F.lit(0).cast(f.dataType))
    return c


def duplicate_rows(df: DataFrame) -> DataFrame:
    """A2: rows equal to an earlier row (NULLs equal) = rows − distinct rows.

    Rows are counted by 128 bits of them, combined map-side, so a row repeated a billion
    times leaves each map task as one (key, count) pair and no text is shuffled. Only rows whose key
    repeats are then compared as a whole: each map task hands on one copy of every different row under a key.
    """
    keyed = df.select(*[k.alias(f"__k{i}") for i, k in enumerate(_row_key(df))], F.struct(*[_plain(f).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]).alias("__row"))
    key = ["__k0", "__k1"]
    counts = written(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("__c")), "row-keys")
    repeated = counts.where(F.col("__c") > 1).select(*key)
    more = keyed.join(repeated, key, "left_semi").groupBy(*key).agg((F.size(F.collect_set("__row")) - 1).alias("__more"))
    # Distinct rows: one for each key, and what differs under a repeated one.
    both = counts.agg(F.coalesce(F.sum("__c"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("keys")).crossJoin(
        more.agg(F.coalesce(F.sum("__more"), F.lit(0)).alias("more"))  # one row each
    )
    distinct = F.col("keys") + F.col("more")
    return both.select(
        F.col("rows").cast("bigint").alias("row_count"),
        distinct.cast("bigint").alias("distinct_rows"),
        (F.col("rows") - distinct).cast("bigint").alias("duplicate_rows"),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """A3: one row per column with type class, missing count, role candidacy,
    and dataset-wide row/column/duplicate counts repeated on each row."""
    num = set(numeric_columns(df))
    cat = set(categorical_columns(df))
    roles = {r: set(candidates(df, r)) for r in ROLE_NAMES}
    miss = missing_counts(df)
    dup = duplicate_rows(df).select(F.lit(1).alias("__k"), "row_count", "duplicate_rows")
    meta = df.sparkSession.createDataFrame(
        [
            (
                f.name,
                f.dataType.simpleString(),
                f.name in num,
                f.name in cat,
                f.name in roles["target"],
                f.name in roles["timestamp"],
                f.name in roles["user_id"],
                f.name in roles["transaction_id"],
            )
            for f in df.schema.fields
        ],
        "column_name string, data_type string, is_numeric boolean, is_categorical boolean, "
        "is_target_candidate boolean, is_timestamp_candidate boolean, is_user_id_candidate boolean, "
        "is_transaction_id_candidate boolean",
    )
    # miss has one row per column and dup exactly one row: both schema-sized.
    out = meta.withColumn("__k", F.lit(1)).join(F.broadcast(miss), "column_name").join(F.broadcast(dup), "__k")
    return out.drop("__k").withColumn("column_count", F.lit(len(df.columns)).cast("bigint"))


def high_missing(df: DataFrame, threshold: float = 0.2) -> DataFrame:
    """A4: columns whose missing share exceeds ``threshold``."""
    fields = df.schema.fields
    agg = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(_is_missing(f)).alias(f"m{i}") for i, f in enumerate(fields)]
    )
    rows = _rows_of(
        agg,
        [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"m{i}").cast("bigint").alias("missing"),
                (F.col(f"m{i}") / F.greatest(F.col("__n"), F.lit(1))).alias("missing_share"),
            )
            for i, f in enumerate(fields)
        ],
    )
    return rows.where(F.col("missing_share") > F.lit(threshold))
