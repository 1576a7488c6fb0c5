"""N-gram Jaccard join by PartEnum signatures (operator 1).

A document is the set of its distinct word shingles, as 64-bit hashes. Sizes are
cut into bands. Two sets with a Jaccard similarity of at least ``num / den`` whose
larger size lies in a band differ in at most k shingles, k fixed by the band's
largest size. The hash domain is cut into partitions, each into sub-partitions; a
signature is the hash of the set's part in all but a few of a partition's
sub-partitions. With more partitions than the differences can spoil, similar
sets share a signature. A set signs for its own band and for the bands its
larger partners can lie in.

Signatures of fewer than ``weak`` shingles match too much. Each band has some
spare partitions; a set with no more weak partitions than spares leaves its weak
signatures out, and one partition that is neither weak nor spoilt remains for
every similar pair. Any other set gives all of its signatures. By the same count a
similar pair shares at least ``need`` = spares + 1 - weak partitions signatures.

Shingles of passages that very many documents share would fill signatures of
unrelated documents. Leaving features out of the domain keeps every guarantee, so a set
signs without such shingles (found by counting in every batch of documents; which ones
are found changes the work, not the result). A set with too little besides them signs
over the whole domain too, for its like; the two domains are told apart.

Sets that share a signature are paired up where at most BUCKET sets have it, and a pair
is a candidate if it shares as many signatures as it needs. Sets that share a
signature with more than BUCKET sets are all candidates of each other, which is noted as
a chain of links and not as pairs. Candidates, followed from one to the next, form
clusters; each cluster's sets are
compared exactly: walking from document to document, all sets not reached yet
are tested against the current one, so every link between separate parts is found
and no list of pairs is built. A cluster too large for one task is cut into tiles,
and every two tiles meet in a task.

Defined results: a null or wordless text has no shingles and no links; a text with
fewer words than a shingle is one shingle; copies have the same set and always
link; rows that share an id count as one document with several texts; a null id
takes no part (null component); an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import ceil, exp

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.components import components
from riskweave.llm.tables import Scratch, bits_at, bound_batches, has_bit, id_bits
from riskweave.llm.words import M1, M2, M3, mixed, words_of

#: Ratio of a size band's ends, shingles of one comparison tile, sets of a signature that are paired up.
BAND_RATIO, TILE_SHINGLES, BUCKET = 1.4, 1_000_000, 16
#: Shingles counted together, documents that make a shingle common, and how many common ones are sent to all tasks.
COUNTED, COMMON, MOST_COMMON = 500_000, 64, 500_000
_S = [np.uint64(s) for s in range(64)]


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of ``text``."""
    _, _, h = words_of(text)
    if not len(h):
        return h
    width = min(k, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out = (out ^ (out >> _S[29])) * M1 + h[j : j + len(out)]
    return np.unique(mixed(out))


@dataclass(frozen=True)
class Band:
    index: int
    parts: int  # partitions
    subs: int  # sub-partitions of each
    skip: int  # sub-partitions that a signature leaves out
    spare: int  # partitions beyond those the differences can spoil
    weak: int  # a signature of fewer shingles is weak


def _below(mean: float, least: int) -> float:
    """P(a Poisson count is below ``least``)."""
    term, total = exp(-mean), 0.0
    for i in range(least):
        total += term
        term *= mean / (i + 1)
    return total


class Bands:
    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        ends = [1]
        while ends[-1] < 1 << 40:
            ends.append(max(ends[-1] + 1, int(ends[-1] * BAND_RATIO)))
        self.ends = np.array(ends, dtype=np.int64)

    @lru_cache(maxsize=None)  # noqa: B019  one short list per worker
    def band(self, index: int) -> Band:
        low, high = int(self.ends[index]), int(self.ends[index + 1]) - 1
        k = 2 * high * (self.den - self.num) // (self.den + self.num)
        if k == 0:
            return Band(index, 1, 1, 0, 0, 0)
        subs, skip = (3, 1) if k <= 8 else (1, 0)
        need = k // (skip + 1) + 1
        for weak in (4, 3, 2, 1):
            parts = need
            for _ in range(6):
                share = min(1.0, subs * _below(low / parts * (subs - skip) / subs, weak))
                spare = ceil(share * parts + 2 * (share * (1 - share) * parts) ** 0.5 + 0.08 * need)
                parts = need + spare
            if spare <= 0.25 * need + 2 or weak == 1:  # at least, empty signatures are left out
                return Band(index, need + spare, subs, skip, spare, weak)
        raise AssertionError

    def of(self, n: int) -> list[Band]:
        """The bands that a set of size n signs for."""
        first, last = np.searchsorted(self.ends, [n, n * self.den // self.num], side="right") - 1
        return [self.band(i) for i in range(int(first), int(last) + 1)]


def band_signatures(hashes: np.ndarray, band: Band, whole: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(signatures, which are strong, number of weak partitions) of a set in one band and domain."""
    values = mixed(hashes + M1)
    part = ((hashes >> _S[40]) * np.uint64(band.parts)) >> _S[24]
    cells, size = part.astype(np.int64), band.parts * band.subs
    if band.subs > 1:
        sub = (((hashes >> _S[16]) & np.uint64(0xFFFFFF)) * np.uint64(band.subs)) >> _S[24]
        cells = cells * band.subs + sub.astype(np.int64)
    counts = np.bincount(cells, minlength=size).reshape(band.parts, band.subs)
    # Sums of 32-bit halves stay below 2**53, so they are exact.
    low, high = (values & np.uint64(0xFFFFFFFF)).astype(float), (values >> _S[32]).astype(float)
    sums = np.bincount(cells, weights=low, minlength=size).astype(np.uint64)
    sums += np.bincount(cells, weights=high, minlength=size).astype(np.uint64) << _S[32]
    sums = sums.reshape(band.parts, band.subs)
    if band.skip:
        chosen = list(combinations(range(band.subs), band.subs - band.skip))
        counts = np.stack([counts[:, c].sum(axis=1) for c in chosen], axis=1)
        sums = np.stack([sums[:, c].sum(axis=1) for c in chosen], axis=1)
    place = np.arange(sums.size, dtype=np.uint64).reshape(sums.shape) + np.uint64((2 * band.index + whole) << 48)
    strong = counts >= band.weak
    return mixed(sums + mixed(place * M1 + M2)), strong, int((~strong).any(axis=1).sum())


def signatures(hashes: np.ndarray, bands: Bands, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The PartEnum signatures of a set over all bands it signs for, and the code of each:
    band and domain, and how many signatures of them a similar set shares.

    ``common`` are the sorted shingles to leave out. A set that has more weak
    partitions without them than the band has spares gives its strong signatures,
    which similar sets without that trouble share (need 0: two such sets do not
    become candidates by them), and those of the whole domain.
    """
    rest = hashes
    if common is not None and len(common):
        rest = hashes[common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] != hashes]
    out, codes = [], []
    for band in bands.of(len(hashes)):
        for whole in (False, True):
            found, strong, weak = band_signatures(hashes if whole else rest, band, whole)
            fine = weak <= band.spare
            keep = strong if fine or not whole else np.ones_like(strong)
            need = max(1, band.spare + 1 - weak) if fine or whole else 0
            out.append(found[keep])
            codes.append(np.full(len(out[-1]), (2 * band.index + whole) << 20 | min(need, (1 << 20) - 1), dtype=np.int64))
            if fine:
                break
    return np.concatenate(out), np.concatenate(codes)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if not len(hashes):
        return 0, 0
    a = mixed(hashes + M2).sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(hashes * M3)
    return int(a.view(np.int64)), int(b.view(np.int64))


def described(texts: DataFrame, *, k: int) -> DataFrame:
    """(doc_id, n, key_a, key_b, often, times): size and key of each document's set.

    Now and then a row lists the shingles that many documents since the last
    list have, and how many have them.
    """

    def counted(held: list[np.ndarray]) -> tuple[list, list]:
        found, times = np.unique(np.concatenate(held), return_counts=True)
        many = times >= max(4, len(held) // 500)
        return found[many].view(np.int64).tolist(), times[many].tolist()

    def made(ids: pa.Array, rows: tuple[list, ...], often: list[tuple[list, list]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                ids,
                *[pa.array(c, type=pa.int64()) for c in rows],
                *[pa.array([o[j] for o in often], type=pa.list_(pa.int64())) for j in range(2)],
            ],
            ["doc_id", "n", "key_a", "key_b", "often", "times"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, last = 0, None  # last: the batch before, whose last row may get the last list
        for batch in batches:
            if not len(batch):
                continue
            if last is not None:
                yield made(*last)
            rows: tuple[list, ...] = ([], [], [])
            often: list[tuple[list, list]] = []
            for text in batch.column(1):
                raw = text.as_buffer()
                hashes = shingles(raw.to_pybytes() if raw is not None else b"", k)
                for column, value in zip(rows, (len(hashes), *set_key(hashes)), strict=True):
                    column.append(value)
                held.append(hashes)
                often.append(([], []))
                size += len(hashes)
                if size > COUNTED:
                    often[-1] = counted(held)
                    held, size = [], 0
            last = batch.column(0), rows, often
        if last is not None:
            if size:
                last[2][-1] = counted(held)
            yield made(*last)

    return texts.mapInArrow(run, "doc_id long, n long, key_a long, key_b long, often array<long>, times array<long>")


def common_shingles(rows: DataFrame) -> np.ndarray:
    """The shingles that ``described`` saw in most documents, MOST_COMMON at most."""
    listed = rows.where(F.size("often") > 0).select(F.explode(F.arrays_zip("often", "times")).alias("x"))
    counted = listed.groupBy(F.col("x.often").alias("shingle")).agg(F.sum("x.times").alias("n")).where(F.col("n") >= COMMON)
    top = counted.orderBy(F.col("n").desc(), "shingle").limit(MOST_COMMON).select("shingle").toPandas()
    return np.sort(top["shingle"].to_numpy(dtype=np.int64).view(np.uint64))


#: Codes of rows that are links already, and of signatures that more than BUCKET documents of a group have.
LINK, MANY = -1, 1 << 62
#: Signatures that a task holds before it passes them on, bytes of sets likewise, and sets whose copies a task knows.
SIGNED_ROWS, FETCHED_BYTES, KNOWN_SETS = 1 << 18, 1 << 23, 10_000


def signed(texts: DataFrame, common: Broadcast, firsts: Broadcast | None = None, *, k: int, num: int, den: int) -> DataFrame:
    """(sig, code, a, b): the signatures of each document a, and links (a, b).

    Copies have one set, and only documents with a bit in ``firsts`` (without it, all) sign; each set's smallest id has one. A copy of one of the last KNOWN_SETS documents of its task signs nothing and is linked
    to that one. A signature that more than BUCKET documents of a group, of about
    SIGNED_ROWS signatures, have is kept once, by the first of them, to which the others are linked. This is the
    partial aggregation that keeps a large group of copies or near copies out of one signature's rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)

        def rows_of(ids: list[int], found: list[tuple[np.ndarray, np.ndarray]], links: list[tuple[int, int]]) -> pa.RecordBatch:
            sigs = np.concatenate([np.zeros(0, dtype=np.uint64), *[s for s, _ in found]]).view(np.int64)
            codes = np.concatenate([np.zeros(0, dtype=np.int64), *[c for _, c in found]])
            owner = np.repeat(np.array(ids, dtype=np.int64), [len(s) for s, _ in found])
            _, first, back, times = np.unique(sigs, return_index=True, return_inverse=True, return_counts=True)
            many = times[back] > BUCKET
            codes[many] |= MANY
            later = many & (np.arange(len(sigs)) != first[back])
            pairs = np.unique(np.stack([owner[later], owner[first[back[later]]]], axis=1), axis=0)
            pairs = np.concatenate([pairs, np.array(links, dtype=np.int64).reshape(-1, 2)])
            columns = (
                np.concatenate([sigs[~later], pairs[:, 0] * np.int64(-0x61C8864680B583EB)]),
                np.concatenate([codes[~later], np.full(len(pairs), LINK)]),
                np.concatenate([owner[~later], pairs[:, 0]]),
                np.concatenate([np.zeros(int((~later).sum()), dtype=np.int64), pairs[:, 1]]),
            )
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "code", "a", "b"])

        ids, found, links, size = [], [], [], 0
        first: dict[tuple[int, int], int] = {}
        for batch in batches:
            if firsts is not None:
                batch = batch.filter(pa.array(bits_at(firsts.value, batch.column(2).to_numpy())))
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes = shingles(text.as_buffer().to_pybytes(), k)
                if not len(hashes):
                    continue
                if len(first) >= KNOWN_SETS:
                    first = {}
                owner = first.setdefault(set_key(hashes), doc_id)
                if owner != doc_id:
                    links.append((doc_id, owner))
                else:
                    ids.append(doc_id)
                    found.append(signatures(hashes, bands, common.value))
                    size += len(found[-1][0])
                if size + len(links) > SIGNED_ROWS:
                    yield rows_of(ids, found, links)
                    ids, found, links, size = [], [], [], 0
        yield rows_of(ids, found, links)

    rows = texts.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("doc_id"))
    return rows.mapInArrow(run, "sig long, code long, a long, b long")


PAIRED = "a long, b long, band long, need long, n long"


def paired(rows: DataFrame) -> DataFrame:
    """(a, b, band, need, n) from the rows of ``signed`` in order of signature.

    n pairs with a need for each band; need 0 marks links that hold without count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, dtype=np.int64) for _ in range(3)]  # the last rows of the batch before
        base = np.zeros(0, dtype=np.int64)  # their places within their signature
        for batch in batches:
            sig, code, a, b = (batch.column(i).to_numpy() for i in range(4))
            is_link = code == LINK
            out = [(a[is_link], b[is_link], np.full(int(is_link.sum()), -1), np.zeros(int(is_link.sum()), dtype=np.int64))]
            old = len(kept[0])
            sig, code, a = (np.concatenate([x, y[~is_link]]) for x, y in zip(kept, (sig, code, a), strict=True))
            start = np.flatnonzero(np.diff(sig, prepend=sig[0] ^ 1 if len(sig) else 0) != 0)
            place = np.arange(len(sig)) - np.repeat(start, np.diff(start, append=len(sig)))
            if old:  # the first signature may go on from the batch before
                goes_on = sig == sig[0]
                place[goes_on] += base[0]
            many = (code & MANY) != 0
            fresh = np.arange(len(sig)) >= old
            chained = fresh & (place > 0) & ((place >= BUCKET) | many)
            for back in range(1, BUCKET + 1):
                at = np.flatnonzero(fresh & (place >= back))
                if not len(at):
                    break
                chain = chained[at] & ((back == 1) | (place[at] == BUCKET) | many[at])
                pair = ~chained[at] & ((code[at] | code[at - back]) & 0xFFFFF > 0)
                for rows_at, is_chain in ((at[chain], True), (at[pair], False)):
                    band = np.full(len(rows_at), -1) if is_chain else (code[rows_at] & ~np.int64(MANY)) >> 20
                    need = np.maximum(code[rows_at] & 0xFFFFF, code[rows_at - back] & 0xFFFFF)
                    out.append((a[rows_at], a[rows_at - back], band, np.zeros_like(need) if is_chain else need))
            last = slice(max(0, len(sig) - BUCKET - 1), None)
            kept, base = [sig[last], code[last], a[last]], place[last]
            x, y, band, need = (np.concatenate(c) for c in zip(*out, strict=True))
            table = np.stack([np.maximum(x, y), np.minimum(x, y), band, need], axis=1)[x != y]
            table, n = np.unique(table, axis=0, return_counts=True) if len(table) else (table, np.zeros(0, dtype=np.int64))
            columns = [*[np.ascontiguousarray(table[:, i]) for i in range(4)], n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "band", "need", "n"])

    return rows.mapInArrow(run, PAIRED)


def linked_stars(nodes: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root): the linked groups of ``sets``, each as links to its smallest node.

    Exact: a set leaves the list only when it is linked to one that is compared
    with all sets still on the list.
    """
    order = np.argsort(nodes, kind="stable")
    nodes, sets = nodes[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, terms, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[terms] > 1
    terms, owner = terms[shared], owner[shared]
    start = np.searchsorted(owner, np.arange(len(sets) + 1))
    marked = np.zeros(len(times), dtype=bool)
    left = np.ones(len(sets), dtype=bool)
    live_terms, live_owner, live = terms, owner, len(sets)
    found_a, found_b = [], []
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first] = False
        queue = [first]
        while queue:
            v = queue.pop()
            remaining = int(left.sum())
            if not remaining:
                break
            if remaining < live // 2:
                keep = left[live_owner]
                live_terms, live_owner, live = live_terms[keep], live_owner[keep], remaining
            mine = terms[start[v] : start[v + 1]]
            marked[mine] = True
            both = np.bincount(live_owner[marked[live_terms]], minlength=len(sets))
            marked[mine] = False
            near = np.flatnonzero(left & (den * both >= num * (sizes + sizes[v] - both)) & (both > 0))
            left[near] = False
            queue.extend(near.tolist())
            found_a.append(nodes[near])
            found_b.append(np.full(len(near), nodes[first]))
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(none + found_a), np.concatenate(none + found_b)


def compared(members: DataFrame, docs: DataFrame, *, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b) found by exact comparison inside clusters.

    ``members`` has doc_id, key_a, key_b, cluster, tiles and tile.
    """

    def made(out: tuple[list, ...]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(out, kinds, strict=True)], ["cluster", "tile_a", "tile_b", "doc_id", "set"]
        )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            size = 0
            rows = zip(*[batch.column(i).to_pylist() for i in range(6)], batch.column(6), strict=True)
            for doc_id, key_a, key_b, cluster, tiles, tile, text in rows:
                hashes = shingles(text.as_buffer().to_pybytes(), k)
                if set_key(hashes) != (key_a, key_b):  # another text under the same id
                    continue
                others = [0] if tiles == 1 else [t for t in range(tiles) if t != tile]
                for other in others:
                    for column, value in zip(
                        out, (cluster, min(tile, other), max(tile, other), doc_id, hashes.tobytes()), strict=True
                    ):
                        column.append(value)
                    size += hashes.nbytes
                    if size > FETCHED_BYTES:
                        yield made(out)
                        out, size = ([], [], [], [], []), 0
            yield made(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, sets, a, b = None, [], [], [], []

        def close() -> None:
            if len(ids) > 1:
                x, y = linked_stars(np.array(ids, dtype=np.int64), sets, num, den)
                a.append(x)
                b.append(y)

        def taken() -> pa.RecordBatch:
            none = [np.zeros(0, dtype=np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(none + a)), pa.array(np.concatenate(none + b))], ["a", "b"])

        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True))
            for (cluster, tile_a, tile_b, doc_id), value in zip(keys, batch.column(4), strict=True):
                if (cluster, tile_a, tile_b) != group:
                    close()
                    group, ids, sets = (cluster, tile_a, tile_b), [], []
                ids.append(doc_id)
                sets.append(np.frombuffer(value.as_buffer().to_pybytes(), dtype=np.uint64))
            yield taken()
            a.clear()
            b.clear()
        close()
        yield taken()

    # Texts are most of the bytes, and few documents are in a cluster: the others are left out before the shuffle.
    asked = docs.where(F.col("text").isNotNull() & has_bit("doc_id", id_bits(members, "doc_id")))
    wanted = members.join(asked, "doc_id").select(
        "doc_id", "key_a", "key_b", "cluster", "tiles", "tile", "text"
    )
    sets = wanted.mapInArrow(fetch, "cluster long, tile_a long, tile_b long, doc_id long, set binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = sets.repartition(parts, "cluster", "tile_a", "tile_b").sortWithinPartitions("cluster", "tile_a", "tile_b")
    return met.mapInArrow(compare, "a long, b long")


def similar_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "ngrams")
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = scratch.write(described(texts, k=k), "described")

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(rows))  # MOST_COMMON numbers at most
    classes = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("key_a", "key_b").agg(F.min("doc_id").alias("node"))
    firsts = scratch.write(classes, "firsts")
    sigs = signed(texts, common, id_bits(firsts, "node"), k=k, num=num, den=den).repartition(parts, "sig")
    sigs = sigs.sortWithinPartitions("sig", F.col("code").bitwiseAND(F.lit(MANY)), "a")
    pairs = paired(sigs).groupBy("a", "b", "band").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    met = pairs.where(F.col("n") >= F.col("need")).select("a", "b")
    clusters = scratch.write(components(met, scratch), "clusters")

    sets = rows.select("doc_id", "n", "key_a", "key_b").join(clusters, F.col("doc_id") == F.col("node"))
    sets = sets.groupBy("component", "key_a", "key_b").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    sets = scratch.write(sets, "sets")
    sizes = sets.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("words"))
    tiles = F.ceil(F.col("words") / TILE_SHINGLES).cast("long")
    sizes = scratch.write(sizes.where(F.col("members") > 1).select(F.col("component").alias("cluster"), tiles.alias("tiles")), "sizes")
    members = sets.join(sizes, F.col("component") == F.col("cluster")).withColumn(
        "tile", F.pmod(F.xxhash64("doc_id", "key_a"), F.col("tiles"))
    )
    links = scratch.write(compared(members.drop("component", "n"), texts, k=k, num=num, den=den), "found")
    found = scratch.write(components(links, scratch), "components")

    classes = firsts.join(found, "node", "left").select(
        F.col("key_a").alias("__a"), F.col("key_b").alias("__b"), F.coalesce("component", "node").alias("component")
    )
    classes = scratch.write(classes, "classes")
    same = (F.col("key_a") == F.col("__a")) & (F.col("key_b") == F.col("__b")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    out = rows.select("doc_id", "n", "key_a", "key_b").join(classes, same, "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    result = scratch.write(out, "result")
    scratch.drop(rows, firsts, clusters, sets, sizes, links, found, classes)
    return result


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group of similar documents.

    Rows without id stay; of several rows with one kept id all stay.
    """
    groups = similar_documents(docs, id_col=id_col, text_col=text_col, k=k, num=num, den=den)
    gone = groups.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("__gone")).distinct()
    # Only the rows that may go are shuffled with their texts.
    doubtful = has_bit(id_col, id_bits(gone, "__gone"))
    left = docs.where(doubtful).join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    return docs.where(~F.coalesce(doubtful, F.lit(False))).union(left)
