"""Embedding near-dedup by int8 tile products with error bounds (operator 2).

Equal vectors form one class. Classes are dealt over tiles by hash, tiles over groups, and every two
groups meet in one task (a group also meets itself): with t tasks each vector is sent about sqrt(2t) times,
however many tiles there are. The task holds the tiles of one group, of ``HELD_BYTES`` at most in the mean, lets those of
the other pass by, and compares tile with tile. There the unit vectors are
rounded to 8 bits with one scale per vector, and the exact length of each
vector's rounding error is kept. For unit x and y with errors of length e and f
the product of the rounded vectors is off by at most e + f + e * f, so only
pairs whose product plus that bound reaches the threshold are computed again, in
double precision. 8-bit products summed in single precision are exact up to 1000
dimensions (in double precision beyond).

A task returns, for each two tiles, how many vectors each class links to and the
groups that the links connect, as stars. No list of pairs leaves a task, so a
large group of near copies costs no more rows than any other.

Comparing all vectors is quadratic work by the method; tiles whose angles to a
few reference directions lie too far apart are passed over, which is exact (the
angle between unit vectors is a metric).

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths don't link; equal
vectors always link; rows that share an id are a vector each and one node; a
null id counts as a partner but has a null component; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.components import components, local_roots
from riskweave.llm.tables import Scratch

#: Classes of one tile, rows of one product, reference directions for passing tiles over.
TILE, BLOCK, REFERENCES = 4096, 1024, 16
#: Meetings of groups for each core, and bytes (as doubles) of the tiles of one group that a task holds.
MEETINGS, HELD_BYTES = 4, 128 << 20


def valid_vector(column: F.Column) -> F.Column:
    """Whether a vector has components, all of them finite, and is not zero."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(column.isNotNull() & (F.size(column) > 0) & fine & F.exists(column, lambda x: x != 0), F.lit(False))


def classed(vectors: DataFrame) -> DataFrame:
    """(vec_id, key): the class of each valid vector; -0.0 counts as 0.0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False) + 0.0
            keys = [hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, type=pa.binary()), column], ["vec_id", "key", "vector"])

    return vectors.mapInArrow(run, "vec_id long, key binary, vector array<double>")


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(8-bit values, scales, lengths of the rounding errors) of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127
    values = np.rint(unit / scale[:, None])
    error = np.linalg.norm(unit - values * scale[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return values.astype(np.int8), scale, error


def tile_links(
    a: np.ndarray, b: np.ndarray | None, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) with cosine of at least ``threshold``; b None: pairs i < j of a."""
    same = b is None
    b = a if same else b
    norm_a, norm_b = np.sqrt(np.einsum("ij,ij->i", a, a)), np.sqrt(np.einsum("ij,ij->i", b, b))
    qa, sa, ea = quantised(a / norm_a[:, None])
    qb, sb, eb = (qa, sa, ea) if same else quantised(b / norm_b[:, None])
    kind = np.float32 if a.shape[1] <= 1000 else np.float64
    qb_t = np.ascontiguousarray(qb.T.astype(kind))
    left, right = [], []
    for begin in range(0, len(a), BLOCK):
        rows = slice(begin, begin + BLOCK)
        from_ = begin if same else 0
        product = qa[rows].astype(kind) @ qb_t[:, from_:]  # whole numbers, exact
        # product * sa * sb + (ea + eb + ea * eb) >= threshold, solved for the product
        bound = ea[rows].max() + eb[from_:] * (1 + ea[rows].max()) + 1e-7
        least = (threshold - bound) / sb[from_:]
        least -= 1e-3 + 1e-6 * np.abs(least)  # what single precision can lose
        i, j = np.nonzero(product * sa[rows, None].astype(kind) >= least.astype(kind))
        i, j = i + begin, j + from_
        if same:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 1 << 18):
            x, y = i[part : part + (1 << 18)], j[part : part + (1 << 18)]
            exact = np.einsum("ij,ij->i", a[x], b[y]) / (norm_a[x] * norm_b[y])
            left.append(x[exact >= threshold])
            right.append(y[exact >= threshold])
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(none + left), np.concatenate(none + right)


def _pack_tile(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per tile and vector length: its classes and their vectors as bytes."""
    out = []
    for size, part in rows.groupby("size"):
        x = np.array(part["vector"].tolist(), dtype=np.float64)
        most = np.abs(x).max(axis=1)
        odd = (most > 1e100) | (most < 1e-100)  # squares would leave the range; a cosine has no scale
        x[odd] /= most[odd, None]
        single = x.astype(np.float32)
        sent = single if (single == x).all() else x
        rng = np.random.default_rng(int(size))
        references = rng.standard_normal((REFERENCES, int(size)))
        references /= np.linalg.norm(references, axis=1)[:, None]
        angles = np.arccos(np.clip(x @ references.T / np.linalg.norm(x, axis=1)[:, None], -1, 1))
        out.append(
            (int(part["tile"].iloc[0]), int(size), part["rep"].to_numpy(dtype=np.int64).tobytes(),
             part["n"].to_numpy(dtype=np.int64).tobytes(), sent.tobytes(), angles.min(axis=0).tolist(), angles.max(axis=0).tolist())
        )
    return pd.DataFrame(out, columns=["tile", "size", "reps", "counts", "vectors", "low", "high"])


def unpacked(raw: bytes, size: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.float32 if len(raw) == 4 * size * n else np.float64).reshape(n, size).astype(np.float64)


def met(tiles: DataFrame, groups: int, threshold: float) -> DataFrame:
    """(node, links, root): what every two tiles of vectors of one length link, and every tile with itself.

    Tile i belongs to group i modulo ``groups``. Each group is sent to its meeting with every other and with itself.
    """
    own = F.pmod("tile", F.lit(groups))
    sent = tiles.select("*", own.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("other"))
    lesser, greater = F.least("group", "other").cast("long"), F.greatest("group", "other").cast("long")
    sent = sent.select(
        (greater * (greater + 1) / 2 + lesser).cast("long").alias("meeting"), "size", (F.col("group") > F.col("other")).alias("second"),
        (F.col("group") == F.col("other")).alias("alone"), "tile", "reps", "counts", "low", "high", "vectors",
    )
    parts = min(20_000, groups * (groups + 1) // 2)
    sent = sent.repartitionById(parts, F.pmod("meeting", F.lit(parts)).cast("int")).sortWithinPartitions("meeting", "size", "second", "tile")
    reach = float(np.arccos(min(1.0, threshold))) + 1e-9

    def links(one: tuple, two: tuple | None) -> pa.RecordBatch:
        reps_a, n_a, a = one[:3]
        reps_b, n_b, b = one[:3] if two is None else two[:3]
        size = one[5]
        i, j = tile_links(unpacked(a, size, len(reps_a)), None if two is None else unpacked(b, size, len(reps_b)), threshold)
        x, y = reps_a[i], reps_b[j]
        nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        counted = np.bincount(at, weights=np.concatenate([n_b[j], n_a[i]]), minlength=len(nodes)).astype(np.int64)
        _, roots = local_roots(x, y)
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(counted), pa.array(roots)], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            meetings, sizes, seconds, alones = (batch.column(i).to_pylist() for i in range(4))
            for r, (meeting, size, second, alone) in enumerate(zip(meetings, sizes, seconds, alones, strict=True)):
                if now != (meeting, size):
                    now, held = (meeting, size), []
                if second and not held:  # no tile of the first group has vectors of this length
                    continue
                reps, counts = (np.frombuffer(batch.column(i)[r].as_py(), dtype=np.int64) for i in (5, 6))
                angles = [np.array(batch.column(i)[r].as_py()) for i in (7, 8)]
                tile = (reps, counts, batch.column(9)[r].as_py(), *angles, size)
                if alone:
                    yield links(tile, None)
                if alone or second:
                    for other in held:
                        if not ((other[3] - tile[4] > reach) | (tile[3] - other[4] > reach)).any():
                            yield links(other, tile)
                if not second:
                    held.append(tile)

    return sent.mapInArrow(run, "node long, links long, root long")


def link_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = valid_vector(F.col("vector"))
    keyed = scratch.write(classed(rows.where(fine)), "keyed")
    # A class without any id still counts; it gets a number above all ids.
    classes = keyed.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    nowhere = F.lit(1 << 62) + F.abs(F.xxhash64("key") % (1 << 60))
    classes = scratch.write(classes.withColumn("rep", F.coalesce("rep", nowhere)), "classes")
    total, n_bytes = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vector") * F.lit(8)), F.lit(0))).first()
    n_tiles = max(1, -(-total // TILE))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    groups = min(n_tiles, max(math.ceil(math.sqrt(2 * MEETINGS * cores)), -(-n_bytes // HELD_BYTES)))
    tiled = classes.select("rep", "n", "vector", F.size("vector").alias("size"), F.pmod(F.xxhash64("key"), F.lit(n_tiles)).cast("int").alias("tile"))
    schema = "tile int, size int, reps binary, counts binary, vectors binary, low array<double>, high array<double>"
    tiles = scratch.write(tiled.groupBy("tile", "size").applyInPandas(_pack_tile, schema), "tiles")

    found = scratch.write(met(tiles, groups, threshold), "found")
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_class = (
        classes.select("key", "rep", "n")
        .join(counted, F.col("rep") == F.col("node"), "left")
        .drop("node")
        .join(linked, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("key").alias("__key"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    per_class = scratch.write(per_class, "per_class")
    good = keyed.select("vec_id", "key").join(per_class, F.col("key") == F.col("__key")).select("vec_id", "n_links", "component_id")
    alone = rows.where(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = good.withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.col("component_id"))).unionByName(alone)
    scratch.drop(tiles, found)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
