"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 7).

Nearness is the inner product. All vectors are lifted to one length (one more
component fills up to the greatest length; queries are scaled to it), where the
largest inner product is the smallest distance. A table hashes a vector by
``dims`` Gaussian projections cut into slots; its bucket is the list of slots. For a
query, the projection of a neighbour at distance r differs from its own by a normal
deviate with deviation r, so each slot's chance is known; the buckets around the
query's own are visited in order of estimated success until the chances add up to
the table's share of ``success``. The candidates of all tables are merged, and their
inner products in double precision decide.

Each query has its own r, from a bounded sample (``sample`` vectors with the smallest
id hash): the distance to its ``k``-th nearest there, which is no less than in the
whole table. Slots are ``width`` times a high quantile of r over distinct sampled
vectors.

Every vector is written once per table under its bucket; a bucket of more than ``SLICE``
vectors has parts by row hash. Buckets and parts are dealt over shards. A query asks the
shards that hold a bucket it visits, and meets only the vectors of these buckets there; a vector that
it meets in an earlier table is left out in a later one, so every candidate is ranked
once (``n_reranked`` counts them). A shard's vectors are held, its queries stream past. Queries whose
window of buckets cannot reach the share, and those left with fewer than ``k`` rows, meet every vector of
the first table, which are all.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without id, take no part; so do vectors whose length differs
from that of the query; a row is never its own candidate, while other rows with its
id are; ties go to the smaller id; fewer candidates than ``k`` give fewer rows; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.embedding_dedup import valid_vector
from riskweave.llm.tables import Scratch
from riskweave.llm.words import M1, M2, mixed

SLICE, QUERIES = 8192, 256
#: Partitions of the shards at most; a task goes through its shards one after the other.
MOST_PARTITIONS = 20_000
#: Slots are fitted to this quantile of the sampled distances, from so many queries.
HIGH, FITTED = 0.9, 256
#: Shorter distances, as shares of the greatest length, are rounding.
LEAST = 1e-7
_ERF = np.array([0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429])


def _normal_below(x: np.ndarray) -> np.ndarray:
    """The normal distribution function (a polynomial form, to 1e-7)."""
    z = np.abs(x) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    tail = sum(c * t ** (i + 1) for i, c in enumerate(_ERF)) * np.exp(-z * z) / 2
    return np.where(x >= 0, 1 - tail, tail)


class Tables:
    """``tables`` hash tables for vectors of ``size`` components and length ``longest``."""

    def __init__(self, size: int, longest: float, distance: float, *, tables: int, dims: int, width: float, success: float, seed: int) -> None:
        rng = np.random.default_rng([seed, size])
        self.longest = longest
        self.width = width * max(distance, LEAST * longest)
        self.planes = [rng.standard_normal((size + 1, dims)) for _ in range(tables)]
        self.shifts = [rng.uniform(0, self.width, dims) for _ in range(tables)]
        self.share = 1 - (1 - success) ** (1 / tables)
        # Slots further off than this on either side hold less than 1e-3 of a projection.
        self.around = max(1, int(np.ceil(3.1 / width)))
        self.steps = np.array(list(product(range(-self.around, self.around + 1), repeat=dims)))

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        if query:
            return np.hstack([x * (self.longest / norm)[:, None], np.zeros((len(x), 1))])
        return np.hstack([x, np.sqrt(np.maximum(self.longest**2 - norm**2, 0))[:, None]])

    def places(self, lifted: np.ndarray, table: int) -> np.ndarray:
        return (lifted @ self.planes[table] + self.shifts[table]) / self.width

    def keys(self, slots: np.ndarray, table: int) -> np.ndarray:
        """64 bits of each bucket; two buckets with the same bits would only share their vectors."""
        out = mixed(np.full(len(slots), (self.planes[0].shape[0] << 8) + table, dtype=np.uint64) * M1)
        for column in slots.astype(np.int64).T:
            out = mixed((out ^ column.view(np.uint64)) * M1 + M2)
        return out.view(np.int64)

    def own_keys(self, x: np.ndarray) -> np.ndarray:
        """Per vector its bucket in each table."""
        lifted = self.lifted(x, False)
        return np.stack([self.keys(np.floor(self.places(lifted, t)), t) for t in range(len(self.planes))], axis=1)

    def probes(self, lifted: np.ndarray, reach: np.ndarray, table: int) -> list[np.ndarray | None]:
        """The buckets that each query visits, in order of estimated success until they add up to
        the share; None where the window holds less than the share within ``reach``."""
        place = self.places(lifted, table)
        own = np.floor(place)
        inside = (place - own) * self.width
        edges = np.arange(-self.around, self.around + 2) * self.width
        below = _normal_below((edges[None, None, :] - inside[:, :, None]) / reach[:, None, None])
        chance = np.diff(below, axis=2)  # query, projection, slot
        joint = np.ones((len(lifted), len(self.steps)))
        for d in range(self.steps.shape[1]):
            joint *= chance[:, d, self.steps[:, d] + self.around]
        order = np.argsort(-joint, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(joint, order, axis=1), axis=1)
        needed = 1 + (before < self.share).sum(axis=1)
        return [self.keys(own[q] + self.steps[order[q, : needed[q]]], table) if needed[q] <= order.shape[1] else None for q in range(len(lifted))]


class Shard:
    """The vectors of one shard and one vector length, by bucket."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, keys: np.ndarray, table: int) -> None:
        # Groups of the same bucket in this and in every earlier table.
        order = np.lexsort(keys[:, : table + 1].T)
        self.x, self.ids, self.rows = x[order], ids[order], rows[order]
        keys = keys[order, : table + 1]
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        self.groups = [(keys[a], a, b) for a, b in zip([0, *cuts], [*cuts, len(keys)])]

    def best(self, queries: np.ndarray, query_rows: np.ndarray, probes: list[set | None], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(query, ids, inner products, candidates met) of each query's k best candidates; a query without probes meets all."""
        score = np.full((len(queries), len(self.x)), -np.inf)
        met = np.zeros(len(queries), dtype=np.int64)
        for keys, a, b in self.groups:
            own, earlier = int(keys[-1]), set(keys[:-1].tolist())
            if earlier:
                asking = [i for i, p in enumerate(probes) if p is not None and own in p and not (earlier & p)]
            else:
                asking = [i for i, p in enumerate(probes) if p is None or own in p]
            if asking:
                score[asking, a:b] = queries[asking] @ self.x[a:b].T
                met[asking] += b - a
        itself = query_rows[:, None] == self.rows[None, :]
        met -= (itself & (score > -np.inf)).sum(axis=1)
        score[itself] = -np.inf
        kth = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(score), -np.inf)
        for q in np.flatnonzero(met):
            # Products of one block may differ in the last digits by their place; those near the limit are done again alike.
            least = kth[q] - 1e-9 * (1 + abs(kth[q])) if np.isfinite(kth[q]) else -np.inf
            near = np.flatnonzero((score[q] > -np.inf) & (score[q] >= least))
            exact = (self.x[near] * queries[q]).sum(axis=1)
            first = np.lexsort((self.ids[near], -exact))[:k]
            yield int(q), self.ids[near][first], exact[first], int(met[q])


def reaches(tables: Tables, queries: np.ndarray, query_rows: np.ndarray, x: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Each query's distance to its k-th nearest other vector of the sample ``x``; infinite where the sample has fewer."""
    out = np.full(len(queries), np.inf)
    lifted = tables.lifted(x, False)
    for at in range(0, len(queries) if len(x) >= k else 0, QUERIES):
        q = slice(at, at + QUERIES)
        square = np.maximum(2 * tables.longest**2 - 2 * (tables.lifted(queries[q], True) @ lifted.T), 0)
        square[rows[None, :] == query_rows[q, None]] = np.inf
        out[q] = np.sqrt(np.partition(square, k - 1, axis=1)[:, k - 1])
    return np.maximum(out, LEAST * tables.longest)


def nearest(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_every: int = 20,
    k: int = 20,
    tables: int = 2,
    dims: int = 3,
    width: float = 2.4,
    success: float = 0.97,
    sample: int = 2000,
    seed: int = 3,
) -> DataFrame:
    """(query_id, rank, vec_id, score, n_reranked): the k nearest found of each row whose id is divisible by
    ``query_every``, and how many candidates were ranked for it."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(valid_vector(F.col("vector")) & F.col("vec_id").isNotNull())
    rows = scratch.write(rows.select("vec_id", "vector", F.size("vector").alias("size"), F.monotonically_increasing_id().alias("row")), "rows")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    fitted, sampled = {}, {}
    for size, n, longest in rows.groupBy("size").agg(F.count(F.lit(1)), F.max(length)).collect():  # one row per vector length
        taken = rows.where(F.col("size") == size).orderBy(F.xxhash64("vec_id"), "row").limit(sample).select("vector", "row").collect()
        x, x_rows = np.array([r[0] for r in taken], dtype=np.float64), np.array([r[1] for r in taken], dtype=np.int64)
        probe = Tables(size, longest, 1.0, tables=1, dims=1, width=1.0, success=0.5, seed=seed)
        distinct = np.sort(np.unique(x, axis=0, return_index=True)[1])[:FITTED]
        far = reaches(probe, x[distinct], x_rows[distinct], x, x_rows, k)
        far = far[np.isfinite(far)]
        fitted[size] = (n, longest, float(np.quantile(far, HIGH)) if len(far) else longest)
        sampled[size] = (x, x_rows)
    hashing = {
        size: Tables(size, longest, distance, tables=tables, dims=dims, width=width, success=success, seed=seed)
        for size, (_, longest, distance) in fitted.items()
    }
    shards = max(1, -(-sum(n for n, _, _ in fitted.values()) // SLICE))

    def by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places in the batch, vectors) of each vector length."""
        sizes = batch["size"].to_numpy()
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            yield size, own, batch["vector"].take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)

    def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((len(batch), tables), dtype=np.int64)
            for size, own, x in by_size(batch):
                keys[own] = hashing[size].own_keys(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(keys), pa.list_(pa.int64()))], names=[*batch.schema.names, "keys"])

    def with_probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list | None] = [None] * len(batch)
            for size, own, x in by_size(batch):
                reach = reaches(hashing[size], x, batch["row"].to_numpy()[own], *sampled[size], k)
                lifted = hashing[size].lifted(x, True)
                known = np.flatnonzero(np.isfinite(reach))
                per_table = [hashing[size].probes(lifted[known], reach[known], t) for t in range(tables)]
                for i, found in zip(own[known], zip(*per_table)):
                    if all(f is not None for f in found):
                        out[i] = np.concatenate(found).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "probes"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Holds a shard's vectors, which come first, and lets its queries pass, QUERIES at a time."""
        held: dict[int, list] = {}
        ready: dict[int, Shard] = {}
        now = None

        def answers(size: int, x: np.ndarray, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            query_rows, query_ids = part["row"].to_numpy(), part["vec_id"].to_numpy()
            probes = [None if p is None else set(p) for p in part["keys"].to_pylist()]
            out: tuple[list, ...] = ([], [], [], [], [])
            for q, ids, exact, met in ready[size].best(x, query_rows, probes, k):
                n = len(ids)
                for column, values in zip(out, (np.full(n, query_rows[q]), np.full(n, query_ids[q]), ids, exact, np.append(met, np.zeros(n - 1, dtype=np.int64)))):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["query_row", "query_id", "vec_id", "score", "met"])

        for batch in batches:
            shard, kind = batch["shard"].to_numpy(), batch["kind"].to_numpy()
            at = 0
            for (number, is_query), run in groupby(zip(shard.tolist(), kind.tolist())):
                n = sum(1 for _ in run)
                part, at = batch.slice(at, n), at + n
                if number != now:
                    held, ready, now = {}, {}, number
                if not is_query:
                    for size, own, x in by_size(part):
                        keys = np.array(part["keys"].take(pa.array(own)).to_pylist(), dtype=np.int64)
                        held.setdefault(size, []).append((x, part["vec_id"].to_numpy()[own], part["row"].to_numpy()[own], keys))
                    continue
                for size in [size for size in held if size not in ready]:
                    ready[size] = Shard(*map(np.concatenate, zip(*held[size])), table=number // shards)
                for size, own, x in by_size(part):
                    for first in range(0, len(own) if size in ready else 0, QUERIES):
                        some = own[first : first + QUERIES]
                        yield from answers(size, x[first : first + QUERIES], part.take(pa.array(some)))

    keyed = rows.mapInArrow(with_keys, "vec_id long, vector array<double>, size int, row long, keys array<long>")
    entries = keyed.select("vec_id", "vector", "size", "row", "keys", F.posexplode("keys").alias("table", "key"))
    entries = scratch.write(entries, "entries")
    counts = entries.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n"))
    buckets = scratch.write(counts.select("table", "key", F.ceil(F.col("n") / SLICE).cast("int").alias("parts")), "buckets")
    shard = (F.col("table") * shards + F.pmod(F.xxhash64("key", "part"), F.lit(shards))).cast("int").alias("shard")
    # Buckets of more than one part are few: at most one per SLICE vectors.
    large = buckets.where(F.col("parts") > 1).select("key", "parts")
    part = F.pmod(F.xxhash64("row", F.lit(2)), F.coalesce("parts", F.lit(1))).cast("int")
    index = entries.join(large, "key", "left").withColumn("part", part)
    index = index.select(shard, F.lit(0).alias("kind"), "vec_id", "vector", "size", "row", "keys")

    def best(queries: DataFrame) -> DataFrame:
        """``queries`` (shard, vec_id, vector, size, row, keys, the buckets that each visits) with their best of each shard."""
        both = index.unionByName(queries.select("shard", F.lit(1).alias("kind"), "vec_id", "vector", "size", "row", "keys"))
        dealt = both.repartition(min(MOST_PARTITIONS, shards * tables), "shard").sortWithinPartitions("shard", "kind")
        met = scratch.write(dealt.mapInArrow(meet, "query_row long, query_id long, vec_id long, score double, met long"), "met")
        order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
        ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        seen = met.groupBy("query_row").agg(F.sum("met").alias("n_reranked"))
        return ranked.drop("met").join(seen, "query_row")

    def meet_all(queries: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        return queries.select(every, "vec_id", "vector", "size", "row", F.lit(None).cast("array<long>").alias("keys"))

    asked = rows.where(F.col("vec_id") % query_every == 0)
    probing = asked.mapInArrow(with_probes, "vec_id long, vector array<double>, size int, row long, probes array<long>")
    probing = scratch.write(probing, "probing")
    wanted = probing.select("row", F.explode("probes").alias("key")).join(buckets, "key")
    wanted = wanted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    wanted = wanted.select("row", shard, "key").groupBy("row").agg(F.collect_set("shard").alias("shards"), F.collect_set("key").alias("keys"))
    hashed = probing.join(wanted, "row").select(F.explode("shards").alias("shard"), "vec_id", "vector", "size", "row", "keys")
    found = scratch.write(best(hashed.unionByName(meet_all(probing.where(F.col("probes").isNull())))), "found")
    full = found.where(F.col("rank") == k).select(F.col("query_row").alias("row"))
    left = probing.where(F.col("probes").isNotNull()).select("vec_id", "vector", "size", "row").join(full, "row", "left_anti")
    short = scratch.write(left, "short")
    columns = ["query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "n_reranked"]
    if short.isEmpty():
        return found.select(*columns)
    again = best(meet_all(short))
    kept = found.join(short.select(F.col("row").alias("query_row")), "query_row", "left_anti")
    return kept.select(*columns).unionByName(again.select(*columns))
