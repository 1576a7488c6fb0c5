"""Column-level coercions that stay inside Catalyst (no Python UDFs).

ANSI mode is on in Spark 4, so a plain ``cast`` raises on bad text; every
coercion here uses the ``try_`` family so garbage becomes NULL, like the
reference's ``errors="coerce"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def col(name: str) -> Column:
    """Column reference that tolerates dots/spaces in the name."""
    return F.col(f"`{name}`")


def as_category(df: DataFrame, name: str) -> Column:
    """A categorical value as text (booleans as True/False); NULL stays NULL."""
    c = col(name)
    if isinstance(dtype_of(df, name), T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    return c.cast("string")


def nan_to_null(c: Column) -> Column:
    """NaN → NULL so avg/percentile/max skip it as pandas does."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double(c: Column, dtype: T.DataType | None = None) -> Column:
    """Numeric coercion: booleans → 0/1, numbers → double, text → number or NULL."""
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(dtype, T.NumericType):
        return nan_to_null(c.cast("double"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(None).cast("double")
    return nan_to_null(c.cast("string").try_cast("double"))


def parse_timestamp(c: Column, dtype: T.DataType | None = None) -> Column:
    """Timestamp coercion: timestamps pass, dates widen, text parses or is NULL."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        return F.lit(None).cast("timestamp_ntz")
    return F.try_to_timestamp(c.cast("string"))


def has_times(df: DataFrame, name: str) -> bool:
    """Whether any value of the column can be read as a time (stops at the first)."""
    return not df.where(parse_timestamp(col(name), dtype_of(df, name)).isNotNull()).isEmpty()


def epoch_micros(c: Column, dtype: T.DataType | None = None) -> Column:
    """Microseconds since the epoch, independent of the session time zone for
    TIMESTAMP_NTZ input (wall-clock), exact for TIMESTAMP input."""
    ts = parse_timestamp(c, dtype)
    if isinstance(dtype, T.TimestampType) or dtype is None or isinstance(dtype, T.StringType):
        return F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ts)


def binary_target(c: Column, dtype: T.DataType | None = None) -> Column:
    """E1 value part: the target as a nullable int (validity is checked by
    :func:`binary_target_check`)."""
    return to_double(c, dtype).cast("int")


def binary_target_check(df: DataFrame, target: str | None) -> bool:
    """E1 validity: non-empty set of non-null values, all within {0, 1}.

    One small aggregate; the result is a single driver-side boolean.
    """
    if target is None or target not in df.columns:
        return False
    v = to_double(col(target), dtype_of(df, target))
    row = df.agg(F.count(v).alias("n"), F.count_if(v.isNotNull() & ~v.isin(0.0, 1.0)).alias("bad")).first()
    return bool(row["n"]) and row["bad"] == 0


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column and widen integral columns to bigint.

    Used by the registered queries so that Spark and the SQL oracle agree on
    types and last-digit noise.
    """
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), overrides.get(f.name, digits))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)
