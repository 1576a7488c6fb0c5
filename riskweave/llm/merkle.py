"""Merkle manifest of a dataset: digests of rows, trees per group, proofs by pointer jumping.

Rows of a group are put in order and every ``FAN`` consecutive nodes get one parent, up to
the group's root; the roots of the groups, in the groups' order, are the leaves of one more
tree, whose root stands for the dataset. Every inner node starts with a pointer to its
parent and the digests of its siblings; joining the nodes with themselves on the pointer
doubles the distance and puts the siblings' segments together, until every pointer has
passed the root. A row's proof is its own siblings and its parent's segments.

Texts leave the first stage as 32-byte digests only. Rows are ranked by ranges of
(group, key, digest) and a salt, so a group, a key or copies of one row with a third of all
rows are spread over many ranges; a node's family has at most ``FAN`` members.

Null groups come first; null keys come first in their group; rows with the same key follow
the order of their digests, and equal rows have equal digests, so their order has no
effect on any digest. An empty table has no rows, no nodes and no root.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.tables import CRC_TABLE_SQL, Scratch, crc_sql

#: Children of a node.
FAN = 8
#: Rows that one range ranks.
RANGE_ROWS = 500_000
#: Join targets of a jump up to which they are sent to every task: bounded, about 3 KB each.
FEW_TARGETS = 10_000


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def sha(text: Column) -> Column:
    """SHA-256 of a text, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def row_digest(*values: Column) -> Column:
    """Digest of a row: each value as its UTF-8 length, a colon and the value; a null is ``-``."""

    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return sha(F.concat(*map(framed, values)))


def group_name(group: Column) -> Column:
    """A group's name in the order of groups: null before all, then by UTF-8 bytes."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), text))


def ranked(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` (tree, key, digest, pay) with ``idx``, the place in the tree from 0, and ``n``, the tree's rows."""
    rows = scratch.write(rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), f"{name}-rows")
    ranges = max(1, math.ceil(rows.count() / RANGE_ROWS))
    placed = rows.repartitionByRange(ranges, "tree", "key", "digest", "salt").withColumn("range", F.spark_partition_id())
    placed = scratch.write(placed, f"{name}-placed")
    # One row for each range that a tree reaches into.
    per_range = placed.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("here"))
    by_tree = Window.partitionBy("tree")
    before = by_tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = per_range.select(
        "tree", "range", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"), F.sum("here").over(by_tree).alias("n")
    )
    local = F.row_number().over(Window.partitionBy("tree", "range").orderBy("key", "digest", "salt"))
    out = placed.withColumn("local", local).join(per_range, ["tree", "range"])
    return out.select("tree", (F.col("before") + F.col("local") - 1).alias("idx"), "n", "digest", "pay")


def families(rows: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Levels of parents over ranked ``rows``: (tree, idx, n, kids, pays, digest) per parent.

    ``kids`` is the children's digests in a row, ``pays`` what they carry, ``n`` the parents of the
    tree on this level. A tree of one row has one parent without a digest of its own: it hands the row's on.
    """
    out = []
    rows = ranked(rows, scratch, name)
    while True:
        member = F.struct("idx", "digest", "pay")
        grouped = rows.groupBy("tree", F.floor(F.col("idx") / FAN).alias("parent"), "n").agg(F.sort_array(F.collect_list(member)).alias("members"))
        kids = F.unhex(F.array_join(F.transform("members", lambda m: hexed(m["digest"])), ""))
        grouped = grouped.select("tree", F.col("parent").alias("idx"), "n", kids.alias("kids"), F.col("members.pay").alias("pays"))
        digest = F.when(F.col("n") == 1, F.col("kids")).otherwise(sha(hexed(F.col("kids"))))
        level = grouped.select("tree", "idx", F.ceil(F.col("n") / FAN).alias("n"), (F.col("n") == 1).alias("lone"), "kids", "pays", digest.alias("digest"))
        level = scratch.write(level, f"{name}-level")
        out.append(level)
        rows = level.where(F.col("n") > 1).select("tree", "idx", "n", "digest", F.lit(None).cast("string").alias("pay"))
        if rows.isEmpty():
            return out


def members(level: DataFrame) -> DataFrame:
    """Every child of a level's parents: ``place`` in the family, ``pay``, own ``digest`` and siblings ``left`` and ``right``."""
    kids = F.col("kids")
    return level.select("*", F.posexplode("pays").alias("place", "pay")).withColumns(
        {
            "own": F.substring(kids, F.col("place") * 32 + 1, F.lit(32)),
            "left": F.substring(kids, F.lit(1), F.col("place") * 32),
            "right": F.substring(kids, F.col("place") * 32 + 33, F.lit(FAN * 32)),
        }
    )


def node(tree, level, idx) -> Column:
    return F.struct(tree.alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


NO_NODE = "struct<tree:string,level:int,idx:bigint>"
SEGMENTS = "array<struct<left:binary,right:binary>>"


def jumped(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``nodes`` (id, up, segments, subroot, root) with every pointer moved past the root."""
    nodes = scratch.write(nodes, "nodes")
    while not nodes.where(F.col("up").isNotNull()).isEmpty():
        wanted = scratch.write(nodes.where(F.col("up").isNotNull()).select(F.col("up").alias("id")).distinct(), "wanted")
        few = wanted.count() <= FEW_TARGETS
        names = {"id": "to", "up": "far", "segments": "more", "subroot": "far_subroot", "root": "far_root"}
        targets = nodes.join(F.broadcast(wanted) if few else wanted, "id", "left_semi").withColumnsRenamed(names)
        targets = F.broadcast(targets) if few else targets
        done = nodes.where(F.col("up").isNull())
        step = nodes.where(F.col("up").isNotNull()).join(targets, F.col("up") == F.col("to"))
        step = step.select(
            "id", F.col("far").alias("up"), F.concat("segments", "more").alias("segments"),
            F.coalesce("subroot", "far_subroot").alias("subroot"), F.coalesce("root", "far_root").alias("root"),
        )
        old, nodes = nodes, scratch.write(done.unionByName(step), "jump")
        scratch.drop(old, wanted)
    return nodes


@dataclass
class Manifest:
    """``rows``: (pay, leaf, subroot, root, segments) per row, siblings in ``segments`` from the row up.
    ``levels``: the parents of each level of the groups' trees; ``top``: those of the tree over the groups."""

    rows: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]


def manifest(rows: DataFrame, scratch: Scratch) -> Manifest:
    """The trees and proofs of ``rows`` (tree, key, digest, pay); ``tree`` is a ``group_name``."""
    levels = families(rows, scratch, "group")
    roots = [
        level.where(F.col("n") == 1).select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest", node(F.col("tree"), F.lit(i), F.lit(0)).alias("pay"))
        for i, level in enumerate(levels, 1)
    ]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    top = families(subroots, scratch, "top")

    siblings = F.array(F.struct("left", "right")).cast(SEGMENTS)
    none, no_node, no_digest = F.array().cast(SEGMENTS), F.lit(None).cast(NO_NODE), F.lit(None).cast("binary")
    lone = F.col("lone")
    parts = []
    for trees, base in ((levels, 2), (top, 2)):
        for i, level in enumerate(trees[1:], base):
            kids = members(level)
            parts.append(kids.select(
                node(F.col("tree"), F.lit(i - 1), F.col("idx") * FAN + F.col("place")).alias("id"), node(F.col("tree"), F.lit(i), F.col("idx")).alias("up"),
                siblings.alias("segments"), no_digest.alias("subroot"), no_digest.alias("root"),
            ))
    parts.append(members(top[0]).select(
        F.col("pay").cast(NO_NODE).alias("id"), F.when(~lone, node(F.col("tree"), F.lit(1), F.col("idx"))).alias("up"),
        F.when(lone, none).otherwise(siblings).alias("segments"), F.col("own").alias("subroot"), F.when(lone, F.col("own")).alias("root"),
    ))
    parts.append(top[-1].where((F.col("n") == 1) & ~lone).select(
        node(F.col("tree"), F.lit(len(top)), F.col("idx")).alias("id"), no_node.alias("up"), none.alias("segments"), no_digest.alias("subroot"), F.col("digest").alias("root")
    ))
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    nodes = jumped(nodes, scratch)
    parents = nodes.where(F.col("id.level") == 1).select(F.col("id.tree").alias("tree"), F.col("id.idx").alias("idx"), "segments", "subroot", "root")
    leaves = members(levels[0].join(parents, ["tree", "idx"]))
    segments = F.when(lone, F.col("segments")).otherwise(F.concat(siblings, F.col("segments")))
    return Manifest(leaves.select("pay", F.col("own").alias("leaf"), "subroot", "root", segments.alias("segments")), levels, top)


def proof_digest(segments: Column) -> Column:
    """SHA-256, in hex, of all siblings of a proof from the row up, each family from left to right."""
    return F.sha2(F.array_join(F.transform(segments, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), ""), 256)


def folded(leaf: Column, segments: Column) -> Column:
    """The root, in hex, that a leaf and its proof lead to."""
    return F.aggregate(segments, hexed(leaf), lambda at, s: F.sha2(F.concat(hexed(s["left"]), at, hexed(s["right"])), 256))


def document_proofs(docs: DataFrame) -> DataFrame:
    """Manifest of documents by language, and a check of every proof against rows that were tampered with.

    A row whose id's CRC-32 is divisible by 3 is tampered with: A-Z of its text become a-z (a
    null text stays). Its proof is that of the true row, so it leads to the true root only
    where the text has no such letter. Returns doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified. A null id is not tampered with. Other columns are left out.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    text = F.col("text").cast("string")
    fields = lambda t: row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), t)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select(
        group_name(F.col("lang")).alias("tree"), F.col("doc_id").alias("key"), fields(text).alias("digest"),
        F.struct("doc_id", F.when(tampered, fields(F.translate(text, upper, upper.lower()))).alias("other")).alias("pay"),
    )
    out = manifest(rows, scratch).rows
    found = folded(F.coalesce("pay.other", "leaf"), F.col("segments"))
    out = out.select(
        F.col("pay.doc_id").alias("doc_id"), hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"),
        proof_digest(F.col("segments")).alias("proof_sha256"), found.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


MERKLE_SQL = (
    "WITH RECURSIVE "
    + CRC_TABLE_SQL
    + """,
fields AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM documents),
hashed AS (SELECT doc_id, tree, sha256(head || body) AS leaf, CASE WHEN {crc} % 3 = 0 THEN sha256(head || low) END AS other FROM fields, crc_table),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
up AS (
  SELECT tree, 0 AS level, idx, n, leaf AS digest FROM rows_
  UNION ALL
  SELECT tree, level + 1, idx // 8, max((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, level, idx // 8),
subroots AS (SELECT tree, level, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, idx, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, max((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 8),
nodes AS (SELECT * FROM up UNION ALL SELECT '', level, idx, n, digest FROM top),
beside AS (
  SELECT a.tree, a.level, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.idx // 8 = b.idx // 8
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.idx),
walk AS (
  SELECT tree AS home, idx AS row_idx, tree, 0 AS level, idx, coalesce(other, leaf) AS fold, '' AS proof FROM rows_
  UNION ALL
  SELECT home, row_idx, t.tree, t.level, t.idx, t.fold, t.proof
  FROM (
    SELECT w.home, w.row_idx, w.tree, w.level + 1 AS level, w.idx // 8 AS idx, sha256(l || fold || r) AS fold, proof || l || r AS proof
    FROM walk w JOIN beside b ON w.tree = b.tree AND w.level = b.level AND w.idx = b.idx
    UNION ALL
    SELECT w.home, w.row_idx, '', 0, s.idx, fold, proof FROM walk w JOIN subroots s ON w.tree = s.tree AND w.level = s.level
  ) t),
ends AS (SELECT w.* FROM walk w JOIN top t ON w.tree = '' AND w.level = t.level AND t.n = 1)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.digest AS verified
FROM rows_ r JOIN ends e ON r.tree = e.home AND r.idx = e.row_idx JOIN subroots s ON r.tree = s.tree CROSS JOIN (SELECT digest FROM top WHERE n = 1) t
"""
).replace("{crc}", crc_sql("doc_id::VARCHAR"))
