"""Sources and sinks."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import path_exists

SUPPORTED_SUFFIXES = (".csv", ".parquet")
# CSV text of a time keeps its microseconds (Spark's default keeps milliseconds),
# and an empty text is written as "" so that it is not read back as NULL.
_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
CSV_OPTIONS = {"header": True, "timestampNTZFormat": _TIME, "timestampFormat": _TIME + "[XXX]", "nullValue": "", "emptyValue": '""'}
CSV_READ_OPTIONS = CSV_OPTIONS | {"nullValue": "\\N", "emptyValue": ""}  # a bare empty cell is NULL either way
SPLITS = ("train", "valid", "test")


def load_dataset(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read CSV (header, explicit schema or inference as fallback) or Parquet.

    A directory of part files is read as one dataset; its format comes from
    the suffix of the path or, for a bare directory, of its files.
    """
    suffix = _suffix(path)
    if suffix not in SUPPORTED_SUFFIXES:
        inner = {_suffix(name) for name, _ in list_folder(spark, path) or [] if _suffix(name) in SUPPORTED_SUFFIXES}
        if len(inner) == 1:
            suffix = inner.pop()
        elif inner:
            raise ValueError(f"{path} holds CSV and Parquet files: name one of them")
    if suffix == ".csv":
        # Declared schemas go with this module's own text form of times; inference takes any.
        options = {"header": True} if schema is None else CSV_READ_OPTIONS
        reader = spark.read.options(**options).option("mode", "PERMISSIVE")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return reader.csv(path)
    if suffix == ".parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    raise ValueError(f"Unsupported file format: '{suffix}'. Use CSV or Parquet.")


def _session(spark: SparkSession | None) -> SparkSession:
    return spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def list_folder(spark: SparkSession | None, path: str) -> list[tuple[str, str]] | None:
    """(name, full path) of a folder's entries by name, on any file system that Spark can reach; None if there is no such folder."""
    sc = _session(spark).sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return None
    return sorted((s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(at))


def resolve_data_path(filename: str | None, data_dir: str, spark: SparkSession | None = None) -> str:
    """The named file if it exists, else the first supported file by name.

    ``data_dir`` and ``filename`` may be of any file system (``file:``, ``hdfs:``, an object store);
    an absolute path or one with a scheme is taken as it is.
    """
    spark = _session(spark)
    if filename:
        candidate = filename if "://" in filename or filename.startswith(("/", "file:")) else f"{data_dir.rstrip('/')}/{filename}"
        if path_exists(spark, candidate):
            return candidate
        raise FileNotFoundError(f"Dataset file was not found: {candidate}")
    entries = list_folder(spark, data_dir)
    if entries is None:
        raise FileNotFoundError(f"Data directory was not found: {data_dir}")
    names = [name for name, _ in entries if _suffix(name) in SUPPORTED_SUFFIXES]
    if not names:
        raise FileNotFoundError(f"No CSV or Parquet files were found in {data_dir}")
    return f"{data_dir.rstrip('/')}/{names[0]}"


def _suffix(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """S3: one dataset partitioned by split (``split=train/…``)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, name: str | None = None, split_col: str = "split") -> DataFrame:
    """Read back one split (partition pruning) or all of them."""
    df = spark.read.parquet(path)
    return df if name is None else df.where(F.col(split_col) == name)


METADATA_SCHEMA = T.StructType(
    [
        T.StructField("target_column", T.StringType()),
        T.StructField("timestamp_column", T.StringType()),
        T.StructField("user_id_column", T.StringType()),
        T.StructField("transaction_id_column", T.StringType()),
        T.StructField("amount_column", T.StringType()),
        T.StructField("numeric_features", T.ArrayType(T.StringType())),
        T.StructField("categorical_features", T.ArrayType(T.StringType())),
        T.StructField("output_features", T.ArrayType(T.StringType())),
        T.StructField("built_features", T.ArrayType(T.StringType())),
        T.StructField("dropped_features", T.ArrayType(T.StringType())),
        T.StructField("unavailable_features", T.ArrayType(T.StringType())),
        T.StructField("limitations", T.ArrayType(T.StringType())),
        T.StructField("split_method", T.StringType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("valid_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("can_stratify", T.BooleanType()),
    ]
)


@dataclass
class FeatureMetadata:
    target_column: str | None
    timestamp_column: str | None
    user_id_column: str | None
    transaction_id_column: str | None
    amount_column: str | None
    numeric_features: list[str]
    categorical_features: list[str]
    output_features: list[str]
    built_features: list[str]
    dropped_features: list[str]
    unavailable_features: list[str]
    limitations: list[str]
    split_method: str
    train_rows: int
    valid_rows: int
    test_rows: int
    can_stratify: bool

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(getattr(self, f.name) for f in METADATA_SCHEMA.fields)], METADATA_SCHEMA)


def write_metadata(spark: SparkSession, meta: FeatureMetadata, path: str) -> None:
    """One-row JSON dataset."""
    meta.to_frame(spark).coalesce(1).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> FeatureMetadata:
    row = spark.read.schema(METADATA_SCHEMA).json(path).first()
    return FeatureMetadata(**{k: (list(v) if isinstance(v, list) else v) for k, v in row.asDict().items()})


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with header (small result tables)."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON sink for result tables."""
    df.write.mode("overwrite").json(path)

