"""Prefix trie of conversations: sorted turn-id matrices, change masks, sums over runs of rows.

Every distinct sequence of first turns is a node. Conversations are brought into the order
of their turn ids; a node is then a run of rows, and whether a row starts a node of depth
d is whether any of its first d turn ids differs from the row before: the columns'
change masks, OR-accumulated from the left. Sums over the runs (``reduceat``) give each
depth's members, children, leaves and saved words.

The order is cut into ranges of rows, a matrix each. A range also gets the last row of
the range before and the first of the next, so it knows all its starts; nodes that reach
over a range's edge leave it as sums and are put together by their key (128 bits
of the turns they stand for). A root, a first turn or a conversation that a third of all rows
share is therefore spread over as many ranges as it has rows.

Saved words need no walk up the trie: over a run of rows, a row other than the first
shares its first ``lcp`` turns with the row before, so the words of the turns from the node's depth to
``lcp`` are what it saves there.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tables import CRC_TABLE_SQL, Scratch, crc_sql, n_words

#: Columns of turn ids that a matrix holds at a time.
PANEL = 64
#: Turns of a range of conversations, about.
RANGE_TURNS = 1_000_000
#: Ids of one piece of an end list that is hashed further on.
PIECE = 8192
#: Rows of one returned Arrow batch.
BATCH = 100_000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PARTIAL = (
    "kind string, key_a long, key_b long, depth long, parent_a long, parent_b long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, shared long, before long, saved_tokens long, ends_sha256 string, ends string"
)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of every rebuilt conversation; a turn is (a, b, words), a and b 128 bits of its role and text.

    Conversation c starts with the first h = crc32(c) % 4 turns of conversation c - c % 20 (``%``
    keeps the sign of c) and goes on with its own turns behind its first h. Turns go by
    ``turn``, null first, then by their 128 bits; repeated rows are turns of their own.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct(
        F.col("turn").isNotNull().alias("timed"), F.col("turn"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("turn"), role, text).alias("b"),
        n_words(text).alias("words"),
    )
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    own = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    own = own.select("conv_id", F.transform("turns", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["words"].alias("words"))).alias("turns"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    heads = own.where(F.col("conv_id") % 20 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).join(heads, "base", "left")
    lead = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast(own.schema["turns"].dataType))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(lead, rest).alias("turns"))


def in_ranges(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(range, side, conv_id, a, b, words): rows of each range (side 0) with the rows just before (-1) and after (1)."""
    pair = F.transform("turns", lambda t: F.array(t["a"], t["b"]))
    rows = scratch.write(rows.select("conv_id", F.flatten(pair).alias("path"), F.col("turns.words").alias("words")), "sequences")
    turns = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    ranges = max(1, math.ceil(turns / RANGE_TURNS))
    placed = rows.repartitionByRange(ranges, "path", "conv_id").withColumn("range", F.spark_partition_id())
    placed = scratch.write(placed, "ranges")
    row = F.struct("path", "conv_id", "words")
    edges = scratch.write(placed.groupBy("range").agg(F.min(row).alias("first"), F.max(row).alias("last")), "edges")
    # The numbers of the ranges that hold rows: at most ``ranges`` integers.
    used = sorted(r["range"] for r in edges.select("range").collect())
    out = placed.select("range", F.lit(0).alias("side"), "conv_id", "path", "words")
    for side, name, pairs in ((-1, "last", zip(used, used[1:])), (1, "first", zip(used[1:], used))):
        to = rows.sparkSession.createDataFrame(list(pairs), "range int, to int")
        ghost = edges.join(to, "range").select(F.col("to").alias("range"), F.lit(side).alias("side"), f"{name}.conv_id", f"{name}.path", f"{name}.words")
        out = out.unionByName(ghost)
    return out.repartition(ranges, "range")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sorted:
    """Rows of one range in the order of their turn ids, then conv_id.

    ``lcp`` is the number of first turns that a row shares with the one before it.
    """

    def __init__(self, conv: np.ndarray, side: np.ndarray, path: np.ndarray, words: np.ndarray, length: np.ndarray) -> None:
        n = len(conv)
        start = np.cumsum(length) - length
        ids = path.reshape(-1, 2)
        by_id = np.lexsort((ids[:, 1], ids[:, 0]))
        step = np.append(False, (ids[by_id][1:] != ids[by_id][:-1]).any(axis=1))[: len(by_id)]
        dense = np.empty(len(ids), dtype=np.int32)
        dense[by_id] = np.cumsum(step) + 1

        # Panel by panel: rows that still tie are ordered by the next columns.
        order = np.lexsort((conv,))
        tie = np.zeros(n, dtype=np.int64)  # rows with the same number are equal so far
        lcp = np.zeros(n, dtype=np.int64)  # of the row at a place of ``order`` with the one before
        width, column = int(length.max(initial=0)), 0
        open_ = np.arange(n)  # places whose rows may still tie
        while len(open_) and column < width:
            rows = order[open_]
            panel = self.panel(dense, start[rows], length[rows], column, min(PANEL, width - column))
            again = np.lexsort((conv[rows], *panel.T[::-1], tie[open_]))
            panel, rows = panel[again], rows[again]
            order[open_] = rows
            same = np.append(False, tie[open_][1:] == tie[open_][:-1])
            changed = np.ones(panel.shape, dtype=bool)
            changed[1:] = np.logical_or.accumulate(panel[1:] != panel[:-1], axis=1)
            shared = np.minimum((~changed).sum(axis=1), length[rows] - column)
            lcp[open_[same]] = column + np.maximum(shared[same], 0)
            column += panel.shape[1]
            # On with rows that tie with a neighbour and have turns left.
            joins = same & ~changed[:, -1] & (panel[:, -1] > 0)
            tie[open_] = np.cumsum(~joins)
            open_ = open_[joins | np.append(joins[1:], False)]
        self.conv, self.side, self.length, self.lcp = conv[order], side[order], length[order], lcp
        self.lcp[:1] = -1  # no row before
        self.start, self.ids = start[order], ids
        # Words of the first j turns of a row: total[start + j] - total[start].
        self.total = np.append(0, np.cumsum(words))

    @staticmethod
    def panel(dense: np.ndarray, start: np.ndarray, length: np.ndarray, column: int, width: int) -> np.ndarray:
        """The ids of ``width`` columns, 0 behind a row's end."""
        place = column + np.arange(width)
        at = start[:, None] + place[None, :]
        inside = place[None, :] < length[:, None]
        return np.where(inside, dense[np.minimum(at, max(len(dense) - 1, 0))] if len(dense) else 0, 0)

    def words_to(self, rows: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.total[self.start[rows] + depth] - self.total[self.start[rows]]


def nodes_of_range(data: Sorted) -> Iterator[dict[str, np.ndarray]]:
    """Columns of PARTIAL for the nodes of every depth of one range.

    Nodes within the range are whole (kind ``node``); those that also have rows in other ranges are sums (``part``),
    and the ends of these are pieces of their lists (``ends``).
    """
    n = len(data.conv)
    leaf = np.append(data.lcp[1:] < data.length[:-1], True)
    saves = data.words_to(np.arange(n), np.maximum(data.lcp, 0))
    alive = np.flatnonzero(data.side == 0)
    first, last = alive[0], alive[-1]
    key_a, key_b = np.zeros(len(alive), dtype=np.uint64), np.zeros(len(alive), dtype=np.uint64)
    up_a, up_b = key_a, key_b
    above = None  # first rows, smallest ids and open marks of the nodes one turn less deep
    depth = 0
    while len(alive):
        lcp, length = data.lcp[alive], data.length[alive]
        begins = lcp < depth
        begins[0] = True
        starts = np.flatnonzero(begins)
        heads, tail = alive[starts], alive[-1]
        sums = lambda values: np.add.reduceat(values.astype(np.int64), starts)  # noqa: B023, E731
        open_ = np.zeros(len(heads), dtype=bool)
        open_[0] |= heads[0] == first and lcp[0] >= depth
        open_[-1] |= tail == last and last < n - 1 and data.lcp[last + 1] >= depth
        smallest = np.minimum.reduceat(data.conv[alive], starts)
        n_convs, shared = sums(np.ones(len(alive))), sums(np.where(lcp >= depth, saves[alive], 0))
        before = data.words_to(heads, np.full(len(heads), max(depth - 1, 0)))
        if above is None:
            parent = np.ma.masked_all(len(heads), dtype=np.int64)
        else:
            at = np.searchsorted(above[0], heads, side="right") - 1
            parent = np.ma.array(above[1][at], mask=above[2][at])
        ended = data.conv[alive[length == depth]]
        ends = sums(length == depth)
        ends_to = np.cumsum(ends)
        digests, lists = np.full(len(heads), EMPTY_SHA, dtype=object), []
        for i in np.flatnonzero(ends).tolist():
            convs = ended[ends_to[i] - ends[i] : ends_to[i]]
            if open_[i]:
                lists += [(i, convs[at : at + PIECE].tolist()) for at in range(0, len(convs), PIECE)]
            else:
                digests[i] = hashlib.sha256(",".join(map(str, convs.tolist())).encode()).hexdigest()
        columns = {
            "kind": np.where(open_, "part", "node"), "key_a": key_a[starts].view(np.int64), "key_b": key_b[starts].view(np.int64),
            "depth": np.full(len(heads), depth), "parent_a": up_a[starts].view(np.int64), "parent_b": up_b[starts].view(np.int64),
            "conv_id": smallest, "parent_conv_id": parent, "n_convs": n_convs, "n_children": sums((length > depth) & (lcp <= depth)),
            "n_leaves": sums(leaf[alive]), "shared": shared, "before": before, "saved_tokens": shared - (n_convs - 1) * before,
            "ends_sha256": digests, "ends": np.full(len(heads), None, dtype=object),
        }
        yield columns
        if lists:
            pieces = {k: v[[i for i, _ in lists]] for k, v in columns.items()}
            pieces["kind"] = np.full(len(lists), "ends")
            pieces["conv_id"] = np.array([convs[0] for _, convs in lists])
            pieces["ends"] = np.array([",".join(map(str, convs)) for _, convs in lists], dtype=object)
            yield pieces
        above = heads, smallest, open_
        depth += 1
        on = length >= depth
        alive, up_a, up_b = alive[on], key_a[on], key_b[on]
        turn = data.ids[data.start[alive] + depth - 1].view(np.uint64)
        salt = np.uint64(depth * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        key_a, key_b = mixed(up_a ^ mixed(turn[:, 0] + salt)), mixed(up_b + mixed(turn[:, 1] ^ salt))


def partial_nodes(ranges: DataFrame) -> DataFrame:
    """The nodes of all ranges, one range's rows in memory at a time."""

    def table(columns: dict) -> pa.RecordBatch:
        arrays, names = [], []
        for field in PARTIAL.split(", "):
            name, kind = field.split()
            values = columns[name]
            as_type = pa.int64() if kind == "long" else pa.string()
            mask = np.ma.getmaskarray(values) if isinstance(values, np.ma.MaskedArray) else None
            arrays.append(pa.array(np.ma.getdata(values), as_type, mask=mask))
            names.append(name)
        return pa.RecordBatch.from_arrays(arrays, names)

    def finish(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        column = lambda name: rows[name].combine_chunks()
        side = column("side").to_numpy()
        if not (side == 0).any():
            return
        words = column("words")
        data = Sorted(
            column("conv_id").to_numpy(), side, column("path").flatten().to_numpy(zero_copy_only=False),
            words.flatten().to_numpy(zero_copy_only=False), words.value_lengths().to_numpy().astype(np.int64),
        )
        held, n = [], 0
        for columns in nodes_of_range(data):
            held.append(table(columns))
            n += held[-1].num_rows
            if n >= BATCH:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(numbers)]):
                if hi > lo:
                    if held and numbers[lo] != now:
                        yield from finish(held)
                        held = []
                    now = numbers[lo]
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from finish(held)

    return ranges.sortWithinPartitions("range").mapInArrow(run, PARTIAL)


def chained_digests(pieces: DataFrame) -> DataFrame:
    """(key_a, key_b, depth, ends_sha256) from the pieces of each end list.

    SHA-256 runs through a list from its start, so the pieces of one list pass through one task, a piece in
    memory at a time; their texts were sorted and joined by the ranges before.
    """
    schema = "key_a long, key_b long, depth long, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []
        for batch in batches:
            for a, b, depth, _, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b, depth) != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (a, b, depth), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ends.encode())
        if now is not None:
            done.append((*now, sha.hexdigest()))
        columns = list(zip(*done)) if done else [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key_a", "key_b", "depth", "ends_sha256"])

    keyed = pieces.select("key_a", "key_b", "depth", "conv_id", "ends").repartition("key_a", "key_b", "depth")
    return keyed.sortWithinPartitions("key_a", "key_b", "depth", "conv_id").mapInArrow(run, schema)


def trie(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes (NODE) of the prefix trie over ``rows`` (conv_id, turns), conv_ids distinct; none for an empty table."""
    parts = scratch.write(partial_nodes(in_ranges(rows, scratch)), "parts")
    key = ["key_a", "key_b", "depth"]
    summed = parts.where(F.col("kind") == "part").groupBy(*key).agg(
        F.first("parent_a").alias("parent_a"), F.first("parent_b").alias("parent_b"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "shared")], F.first("before").alias("before"),
    )
    ends = chained_digests(parts.where(F.col("kind") == "ends"))
    saved = F.col("shared") - F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("before")).otherwise(0)
    summed = summed.join(ends, key, "left").withColumns({"saved_tokens": saved, "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY_SHA))})
    summed = scratch.write(summed.withColumn("parent_conv_id", F.lit(None).cast("long")), "open")
    names = [c.split()[0] for c in NODE.split(", ")]
    keep = [*names, "parent_a", "parent_b"]
    parents = summed.select(
        F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("found")
    )
    whole = parts.where(F.col("kind") == "node").select(*keep)
    known = whole.where(F.col("parent_conv_id").isNotNull()).select(*names)
    rest = whole.where(F.col("parent_conv_id").isNull()).unionByName(summed.select(*keep))
    rest = rest.join(parents, ["parent_a", "parent_b", "depth"], "left").withColumn("parent_conv_id", F.col("found"))
    return known.unionByName(rest.select(*names))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (``sequences``).

    conv_id is the smallest member, parent_conv_id that of the parent (root: null), n_convs the members, n_children
    and n_leaves (childless nodes of the subtree, itself included) count nodes, saved_tokens sums
    (n_convs - 1) times the words of its last text over the subtree, ends_sha256 is SHA-256 of the ids, ascending
    and joined by commas, of the conversations that end here. Rows with a null conv_id belong to
    no conversation; null roles and texts are empty. An empty table has no node. The digests of a
    conversation's turns, 24 bytes each, are one row.
    """
    return trie(sequences(conversations), Scratch(conversations.sparkSession, "trie"))


TRIE_SQL = (
    "WITH RECURSIVE "
    + CRC_TABLE_SQL
    + """,
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY place) AS seq FROM turns GROUP BY conv_id),
cut AS (SELECT conv_id, seq, {crc} % 4 AS h FROM own, crc_table),
rebuilt AS (
  SELECT c.conv_id, coalesce(b.seq[1:c.h], []) || c.seq[c.h + 1:] AS seq
  FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, len(seq) AS size, d, seq[1:d] AS path FROM rebuilt, unnest(range(len(seq) + 1)) AS u(d)),
nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(path[d].t, '[^\\x20\\x09-\\x0D]+')) END AS saves
  FROM steps GROUP BY path, d),
children AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path, depth)),
below AS (
  SELECT a.path, a.depth, sum((b.n_children = 0)::INT)::BIGINT AS n_leaves, sum(b.saves)::BIGINT AS saved_tokens
  FROM full_nodes b, unnest(range(b.depth + 1)) AS u(d) JOIN nodes a ON a.depth = u.d AND a.path = b.path[1:u.d] GROUP BY a.path, a.depth)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
  b.n_leaves, b.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN below b ON n.path = b.path AND n.depth = b.depth
  LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
).replace("{crc}", crc_sql("conv_id::VARCHAR"))
