"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskweave.session import shared_path


class Scratch:
    """Parquet tables written under ``spark.checkpoint.dir``.

    A written table cuts the lineage: an executor lost later only costs the
    tasks that read it. ``drop`` deletes the tables that no returned frame
    reads any more.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.base = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.n = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{self.n:03d}-{name}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
            path.getFileSystem(conf).delete(path, True)


#: Bytes of rows that a Python worker is sent at a time.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lets Python workers of this session get their rows ``BATCH_BYTES`` at a time, or fewer if it is set so.

    A batch of texts is held by the executor and the worker on its way there and back; at Spark's 10,000 rows
    or 64 MB those buffers take hundreds of MB of an executor.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    most = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if most > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bits of a broadcast set of ids: for each id, at most, and what one row on its way to the driver holds.
ID_BITS, BITS_AN_ID, PIECE_BITS = 1 << 26, 16, 1 << 15


def id_bits(ids: DataFrame, id_col: str) -> Broadcast:
    """The ids as bits under their hashes, 8 MB at most. An id is found again by ``has_bit``, and so are a few others
    (most of them where there are very many ids): it tells rows that a join surely doesn't need before they are shuffled."""
    bits = PIECE_BITS
    n = ids.count()
    while bits < min(ID_BITS, BITS_AN_ID * n):
        bits *= 2
    places = ids.where(F.col(id_col).isNotNull()).select(F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(bits)).alias("at"))
    piece = F.floor(F.col("at") / PIECE_BITS).cast("int").alias("piece")
    rows = places.groupBy(piece).agg(F.bitmap_construct_agg(F.col("at") % PIECE_BITS).alias("bits")).collect()
    table = np.zeros((bits // PIECE_BITS, PIECE_BITS // 8), dtype=np.uint8)
    for r in rows:
        table[r["piece"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return ids.sparkSession.sparkContext.broadcast(table.reshape(-1))


def bits_at(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set."""
    at = hashes & np.int64(8 * len(table) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def has_bit(id_col: str, table: Broadcast) -> Column:
    """False where the id is surely not one of ``id_bits``, also for a null id."""

    @pandas_udf("boolean")
    def found(hashes: pd.Series) -> pd.Series:
        return pd.Series(bits_at(table.value, hashes.to_numpy()))

    return F.col(id_col).isNotNull() & found(F.xxhash64(F.col(id_col).cast("long")))


#: A word of a text: a run of bytes that are not ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text) -> F.Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: DuckDB: the 256 steps of CRC-32, as the table ``crc_table`` of one list.
CRC_TABLE_SQL = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps)"""


def crc_sql(text: str) -> str:
    """DuckDB: the unsigned CRC-32 of an ASCII text, next to ``crc_table``; null for a null."""
    letters = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda a, c: xor(a >> 8, steps[(xor(a, c) & 255) + 1])), 4294967295)"
