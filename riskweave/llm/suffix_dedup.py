"""Removal of repeated byte strings by sorted suffixes (operator 3).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else in the table. Finding those starts is split over the cluster like this:

1. Every window of ``length`` bytes has an anchor: the 64-byte string in it with
   the smallest hash, the leftmost of equals. Equal windows have equal anchors, so
   only windows of one anchor key need to meet. Keys that occur once are left.
2. The windows around an anchor form a region of the text. Equal regions of a key
   count as one, kept twice if it occurs more than once. A key with very many
   occurrences is split further by the window's offset from the anchor and by the
   bytes that all windows of an offset range share.
3. The regions of some keys, about 1 MB, are one text whose suffixes are sorted in
   two stages: suffixes smaller than their successors are sorted directly (packed
   leading bytes, then by the length of the prefix shared with a pivot of each
   tied group); the others follow by scanning the buckets of first bytes in order.
   Neighbours with a common prefix of ``length`` bytes mark both starts.
4. The marked starts go back to the texts, whose covered bytes are cut.

Texts that are equal have equal results, so each is worked on once. Sorting is
exact to ``length`` bytes; beyond that order doesn't matter. Hashes of 64 bits
stand for equality of blocks.

Defined results: a null text is empty; texts shorter than ``length`` stay whole;
matches never cross texts; repeated rows are copies, so each is removed where it is
long enough; a null id is kept as it is; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch

GRAM = 64
#: Bytes of regions sorted at once, occurrences that make a key hot, offsets per part of a hot key.
SORT_BYTES, HOT, PART = 1 << 20, 4096, 48
#: Bytes of regions of a task, above 8 tasks a core and up to 20,000 tasks.
TASK_BYTES = 32 << 20
_CHUNK = 1 << 22
_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BYTES = np.random.default_rng(11).integers(0, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Multiplier of a hash that is shifted by 1, 2, 4, ... symbols.
_POWERS = [np.uint64(pow(int(_M[0]), 1 << i, 1 << 64)) for i in range(13)]


def block_hashes(symbols: np.ndarray, levels: int) -> list[np.ndarray]:
    """Hashes of the 2**i symbols from each place, i = 0 .. levels."""
    out = [_BYTES[symbols]]
    for i in range(levels):
        h, step = out[-1], 1 << i
        if len(h) <= step:
            out.append(np.zeros(0, dtype=np.uint64))
        else:
            out.append(h[:-step] * _POWERS[i] + h[step:])
    return out


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - span : len(values) - span + 1]) if span < width else out


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, place, first start, last start) of each anchor of ``text``."""
    n, width = len(text), length - GRAM + 1
    found: list[list[np.ndarray]] = [[], [], [], []]
    for begin in range(0, max(0, n - length + 1), _CHUNK):
        chunk = np.frombuffer(text, dtype=np.uint8, count=min(n - begin, _CHUNK + length - 1), offset=begin)
        h = block_hashes(chunk, 6)[6]
        h = (h ^ (h >> np.uint64(31))) * _M[1]
        h ^= h >> np.uint64(29)
        ranked = (h & ~np.uint64(0xFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        at = (_window_minimum(ranked, width) & np.uint64(0xFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.append(first[1:], len(at)) - 1
        place = at[first]
        for column, values in zip(found, (h[place].view(np.int64), place + begin, first + begin, last + begin), strict=True):
            column.append(values)
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *c]) for c in found)


class Sorter:
    """Two-stage sorting of chosen suffixes of ``symbols`` to ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, depth: int) -> None:
        self.n, self.depth = len(symbols), depth
        self.levels = depth.bit_length() - 1
        # What follows the text is a run of zeros, so every block has its full length.
        self.symbols = np.concatenate([symbols, np.zeros(2 * depth + 8, dtype=symbols.dtype)])
        self.hashes = block_hashes(self.symbols, self.levels)

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes a and b share, at least up to ``depth``."""
        shared = np.zeros(len(a), dtype=np.int64)
        for i in range(self.levels, -1, -1):
            h = self.hashes[i]
            shared += (h[a + shared] == h[b + shared]).astype(np.int64) << i
        # Blocks of 2**levels .. 1 reach 2**(levels + 1) - 1 symbols, which is depth or more.
        return shared

    def smaller_than_next(self) -> np.ndarray:
        """Whether each suffix is smaller than the one after it."""
        step = np.sign(np.diff(self.symbols[: self.n + 1].astype(np.int64)))
        place = np.where(step != 0, np.arange(self.n), self.n - 1)
        nearest = np.minimum.accumulate(place[::-1])[::-1]
        return step[nearest] > 0

    def direct(self, at: np.ndarray) -> np.ndarray:
        """The suffixes ``at`` in order, compared with each other."""
        packed = np.zeros(len(at), dtype=np.uint64)
        for j in range(7):
            packed = (packed << np.uint64(9)) | self.symbols[at + j].astype(np.uint64)
        order = np.argsort(packed, kind="stable")
        out, packed = at[order], packed[order]
        open_, group = self._tied(np.arange(len(out)), np.concatenate([[0], np.cumsum(packed[1:] != packed[:-1])]))
        while len(open_):
            # Each tied group: the prefix that its members share with the first one orders them.
            members = out[open_]
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            pivot = np.repeat(members[starts], np.diff(np.append(starts, len(members))))
            shared = self.common_prefix(members, pivot)
            equal = shared >= self.depth
            end = np.minimum(shared, self.depth)
            here, there = self.symbols[members + end].astype(np.int64), self.symbols[pivot + end].astype(np.int64)
            side = np.where(equal, 0, np.where(here < there, -1, 1))
            # Smaller ones: the shorter the shared prefix the smaller; larger ones the other way round.
            by_prefix = np.where(equal, 0, np.where(side < 0, end, -end))
            key = (side + 1) * (8 * self.depth) + by_prefix + 2 * self.depth
            key = key * 512 + np.where(equal, 0, here)
            order = np.lexsort((key, group))
            out[open_] = members[order]
            key, group, equal = key[order], group[order], equal[order]
            cut = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (group[1:] != group[:-1]))])
            open_, group = self._tied(open_[~equal], cut[~equal])
        return out

    @staticmethod
    def _tied(at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of groups of more than one, in order."""
        if not len(at):
            return at, group
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        sizes = np.diff(np.append(starts, len(group)))
        several = np.repeat(sizes > 1, sizes)
        return at[several], group[several]

    def order(self, wanted: np.ndarray) -> np.ndarray:
        """The suffixes marked in ``wanted``, in order."""
        small = self.smaller_than_next()
        # A suffix is reached from the next one that is sorted directly, over those between.
        after = np.where(small, np.arange(self.n), self.n)
        after = np.minimum.accumulate(after[::-1])[::-1]
        places = np.flatnonzero(wanted)
        need = np.zeros(self.n + 2, dtype=np.int64)
        np.add.at(need, places, 1)
        np.add.at(need, np.minimum(after[places], self.n - 1) + 1, -1)
        need = np.cumsum(need)[: self.n] > 0
        direct = self.direct(np.flatnonzero(need & small))
        rest = need & ~small
        ends = np.flatnonzero(rest & (np.arange(self.n) == self.n - 1))
        text = self.symbols
        alphabet = np.unique(text[np.flatnonzero(need)])
        slot = np.full(512, -1)
        slot[alphabet] = np.arange(len(alphabet))
        firsts = np.searchsorted(text[direct], alphabet, side="left")
        lasts = np.searchsorted(text[direct], alphabet, side="right")
        waiting: list[list[np.ndarray]] = [[] for _ in alphabet]
        for x in ends:  # the last suffix has no successor and is the smallest of its bucket
            waiting[slot[text[x]]].append(np.array([x]))
        out = []
        for c, symbol in enumerate(alphabet):
            bucket = []
            fresh = np.concatenate(waiting[c]) if waiting[c] else direct[:0]
            while len(fresh):  # runs of one symbol: each suffix follows the shorter run
                bucket.append(fresh)
                before = fresh[fresh > 0] - 1
                fresh = before[rest[before] & (text[before] == symbol)]
            bucket.append(direct[firsts[c] : lasts[c]])
            done = np.concatenate(bucket)
            out.append(done)
            before = done[done > 0] - 1
            before = before[rest[before] & (text[before] > symbol)]
            if len(before):
                to = slot[text[before]]
                before = before[np.argsort(to, kind="stable")]
                cuts = np.cumsum(np.bincount(to, minlength=len(alphabet)))
                for d in np.flatnonzero(np.diff(cuts, prepend=0)):
                    waiting[d].append(before[cuts[d - 1] if d else 0 : cuts[d]])
        every = np.concatenate(out) if out else direct
        return every[wanted[every]]


def repeated_starts(regions: list[tuple[bytes, int, bool]], length: int) -> list[np.ndarray]:
    """For each (bytes, starts, twice): which of its first ``starts`` places begin a repeated string.

    A region marked twice stands for several equal ones.
    """
    pieces, begins, wanted, at = [], [], [], 0
    for raw, starts, twice in regions:
        begins.append(at)
        for _ in range(1 + twice):
            piece = np.zeros(len(raw) + 1, dtype=np.uint16)
            piece[:-1] = np.frombuffer(raw, dtype=np.uint8)
            piece[:-1] += 1  # 0 ends a region
            pieces.append(piece)
            mark = np.zeros(len(piece), dtype=bool)
            mark[:starts] = True
            wanted.append(mark)
            at += len(piece)
    sorter = Sorter(np.concatenate(pieces), length)
    order = sorter.order(np.concatenate(wanted))
    same = sorter.common_prefix(order[1:], order[:-1]) >= length
    hit = np.zeros(at, dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return [np.flatnonzero(hit[b : b + starts]) for b, (_, starts, _) in zip(begins, regions, strict=True)]


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.append(0, cut + 1)], places[np.append(cut, len(places) - 1)]


ANCHORED = (
    "doc_id long, text_key long, n_bytes long, copies long, "
    "keys array<long>, places array<long>, firsts array<long>, lasts array<long>"
)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(
        pa.array(ends, type=pa.int32()), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *values]), type=pa.int64())
    )


def anchored(texts: DataFrame, length: int) -> DataFrame:
    """Each row's anchors; copies within a batch are counted by the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, sizes = (batch.column(i).to_pylist() for i in range(3))
            first: dict[tuple[int, int], int] = {}
            copies, found = [], ([], [], [], [])
            none = np.zeros(0, dtype=np.int64)
            for i, text in enumerate(batch.column(3)):
                raw = text.as_buffer().to_pybytes()
                mine = first.setdefault((keys[i], sizes[i]), i)
                copies.append(1 if mine == i else 0)
                if mine != i:
                    copies[mine] += 1
                here = anchors(raw, length) if mine == i and len(raw) >= length else (none,) * 4
                for column, values in zip(found, here, strict=True):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=pa.int64()), batch.column(1), batch.column(2),
                 pa.array(copies, type=pa.int64()), *map(_lists, found)],
                ["doc_id", "text_key", "n_bytes", "copies", "keys", "places", "firsts", "lasts"],
            )

    return texts.mapInArrow(run, ANCHORED)


REGIONS = "text_key long, n_bytes long, start long, starts long, group long, region long, times long, bytes binary"


def regions(held: DataFrame, length: int) -> DataFrame:
    """The regions of the anchors of each text of ``held``.

    Every row tells where a region lies; the first of equal regions in a batch
    carries its bytes and counts them all.
    """

    def parts(raw: bytes, listed: list[dict]) -> Iterator[tuple[int, int, int]]:
        """(group, first start, last start)."""
        listed.sort(key=lambda x: x["first"])
        i = 0
        while i < len(listed):
            x = listed[i]
            if not x["hot"]:
                last = x["last"]  # neighbours of one key are one region, as in periodic text
                while i + 1 < len(listed) and listed[i + 1]["key"] == x["key"] and listed[i + 1]["first"] == last + 1:
                    i += 1
                    last = listed[i]["last"]
                yield x["key"], x["first"], last
            else:
                for low in range(0, length - GRAM + 1, PART):  # offsets low .. low + PART - 1 of the anchor in the window
                    first, last = max(x["first"], x["place"] - low - PART + 1), min(x["last"], x["place"] - low)
                    if first <= last:
                        common = raw[x["place"] - low : x["place"] - low - PART + 1 + length]
                        tag = xxhash.xxh64_intdigest(common + low.to_bytes(4, "little"), seed=x["key"] & 0x7FFFFFFF)
                        yield tag - (1 << 64) if tag >> 63 else tag, first, last
            i += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [], [], [])
            seen: dict[tuple[int, int, int], int] = {}
            for text_key, n_bytes, copies, listed, text in zip(
                *[batch.column(i).to_pylist() for i in range(4)], batch.column(4), strict=True
            ):
                raw = text.as_buffer().to_pybytes()
                for group, first, last in parts(raw, listed):
                    piece = raw[first : last + length]
                    tag = xxhash.xxh64_intdigest(piece)
                    tag = tag - (1 << 64) if tag >> 63 else tag
                    at = seen.setdefault((group, tag, len(piece)), len(rows[0]))
                    fresh = at == len(rows[0])
                    if not fresh:
                        rows[6][at] += copies
                    values = (text_key, n_bytes, first, last - first + 1, group, tag, copies if fresh else 0, piece if fresh else None)
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(rows, kinds, strict=True)],
                ["text_key", "n_bytes", "start", "starts", "group", "region", "times", "bytes"],
            )

    return held.mapInArrow(run, REGIONS)


def marked(table: DataFrame, length: int) -> DataFrame:
    """Runs of repeated starts of each region (group, region, starts); ``table`` comes ordered by group."""

    def sorted_runs(chosen: dict[tuple[int, int, int], list]) -> pa.RecordBatch:
        hits = repeated_starts([(raw, key[2], times > 1) for key, (raw, times) in chosen.items()], length)
        out = [(*key, *runs(h)) for key, h in zip(chosen, hits, strict=True) if len(h)]
        return pa.RecordBatch.from_arrays(
            [*[pa.array([x[i] for x in out], type=pa.int64()) for i in range(3)], _lists([x[3] for x in out]), _lists([x[4] for x in out])],
            ["group", "region", "starts", "firsts", "lasts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come group by group; whole groups are sorted together until they reach SORT_BYTES.
        chosen: dict[tuple[int, int, int], list] = {}
        size, now = 0, None
        for batch in batches:
            keys = zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True)
            for (group, region, starts, times), raw in zip(keys, batch.column(4), strict=True):
                if group != now and size >= SORT_BYTES:
                    yield sorted_runs(chosen)
                    chosen, size = {}, 0
                now = group
                entry = chosen.get((group, region, starts))
                if entry is None:
                    entry = chosen[group, region, starts] = [raw.as_py(), 0]
                    size += len(entry[0])
                if entry[1] <= 1 < entry[1] + times:
                    size += len(entry[0])
                entry[1] += times
        if chosen:
            yield sorted_runs(chosen)

    return table.mapInArrow(run, "group long, region long, starts long, firsts array<long>, lasts array<long>")


def cut_texts(held: DataFrame, length: int) -> DataFrame:
    """(text_key, n_bytes, removed, spans, sha, text) of texts with repeated starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for text_key, n_bytes, found, text in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3), strict=True):
                raw = text.as_buffer().to_pybytes()
                kept, at, removed, spans = [], 0, 0, 0
                end = 0
                for first, last in sorted((x["first"], x["last"]) for x in found):
                    if first > end or not spans:
                        kept.append(raw[end:first])
                        spans += 1
                        removed += last + length - first
                    else:
                        removed += max(0, last + length - end)
                    end = max(end, last + length)
                kept.append(raw[end:])
                rest = b"".join(kept)
                values = (text_key, n_bytes, removed, spans, hashlib.sha256(rest).hexdigest(), rest)
                for column, value in zip(rows, values, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(rows, kinds, strict=True)],
                ["text_key", "n_bytes", "removed", "spans", "rest_sha", "rest"],
            )

    return held.mapInArrow(run, "text_key long, n_bytes long, removed long, spans long, rest_sha string, rest binary")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, kept) of every row of ``docs``.

    kept is the remaining bytes as a text, n_kept their number. Where a character lost some of
    its bytes, the text shows the rest of them as U+FFFD; kept_sha256 is that of the bytes.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    scratch = Scratch(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.octet_length("text").cast("long").alias("n_bytes"), "text"
    )
    rows = scratch.write(anchored(texts, length), "anchors")

    listed = rows.where(F.size("keys") > 0).select(
        "doc_id", "text_key", "n_bytes", "copies", F.explode(F.arrays_zip("keys", "places", "firsts", "lasts")).alias("x")
    )
    listed = listed.select(
        "doc_id", "text_key", "n_bytes", "copies", F.col("x.keys").alias("key"), F.col("x.places").alias("place"),
        F.col("x.firsts").alias("first"), F.col("x.lasts").alias("last"),
    )
    often = listed.groupBy("key").agg(F.sum("copies").alias("n")).where(F.col("n") > 1)
    often = scratch.write(often.select("key", (F.col("n") > HOT).alias("hot")), "often")
    # One row of a text stands for all its copies.
    anchor = F.struct("key", "place", "first", "last", "hot")
    wanted = listed.join(often, "key").groupBy("text_key", "n_bytes").agg(
        F.min("doc_id").alias("one"), F.collect_set(anchor).alias("listed")
    )
    counted = rows.groupBy("text_key", "n_bytes").agg(F.sum("copies").alias("copies"))
    wanted = scratch.write(wanted.join(counted, ["text_key", "n_bytes"]), "wanted")
    one = (texts["text_key"] == wanted["text_key"]) & (texts["n_bytes"] == wanted["n_bytes"]) & texts["doc_id"].eqNullSafe(wanted["one"])
    held = texts.join(wanted, one).select(texts["text_key"], texts["n_bytes"], "copies", "listed", "text")
    # Only rows with one id and one text in common can bring a text twice.
    again = rows.groupBy("doc_id", "text_key", "n_bytes").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if not again.isEmpty():
        held = held.dropDuplicates(["text_key", "n_bytes"])
    held = scratch.write(held, "held")
    table = scratch.write(regions(held, length), "regions")

    size = table.agg(F.sum(F.length("bytes"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-size // SORT_BYTES), 8 * cores), min(20_000, -(-size // TASK_BYTES)))
    sent = table.where(F.col("bytes").isNotNull()).select("group", "region", "starts", "times", "bytes")
    hits = scratch.write(marked(sent.repartition(parts, "group").sortWithinPartitions("group"), length), "hits")
    found = table.select("text_key", "n_bytes", "start", "starts", "group", "region").join(hits, ["group", "region", "starts"])
    run = F.transform(
        F.arrays_zip("firsts", "lasts"),
        lambda x: F.struct((x["firsts"] + F.col("start")).alias("first"), (x["lasts"] + F.col("start")).alias("last")),
    )
    found = found.select("text_key", "n_bytes", run.alias("runs")).groupBy("text_key", "n_bytes").agg(
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs")
    )
    found = found.join(held.select("text_key", "n_bytes", "text"), ["text_key", "n_bytes"])
    cut = cut_texts(found.select("text_key", "n_bytes", "runs", "text"), length)
    cut = scratch.write(cut, "cut")
    # The texts are read again rather than carried along; AQE splits the copies of a frequent one.
    out = texts.join(cut.withColumnRenamed("removed", "gone"), ["text_key", "n_bytes"], "left")
    scratch.drop(often, wanted, held, table, hits)
    n_removed = F.coalesce("gone", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("rest_sha", F.sha2("text", 256)).alias("kept_sha256"), (F.col("n_bytes") - n_removed).alias("n_kept"),
        F.when(F.col("rest").isNull(), F.col("text")).otherwise(F.make_valid_utf8(F.col("rest").cast("string"))).alias("kept"),
    )
