"""Prefix trie and Merkle manifest: SQL on whole tables, brute force on hard ones, many small ranges."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import SF001, duck, no_docs, odd_docs, same_rows
from pyspark.sql import functions as F

from riskweave.llm import merkle, prefix_trie, queries


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def whole_numbers(frame):
    for c in frame.columns:
        if str(frame[c].dtype) in ("float64", "int64", "Int64"):
            frame[c] = frame[c].astype("Int64")
    return frame


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_merkle"])
def test_same_as_sql(spark, name):
    same_rows(whole_numbers(queries.QUERIES[name](spark, SF001).toPandas()), whole_numbers(duck().sql(queries.ORACLE_SQL[name]).df()))


# Prefix trie.

TURNS = "conv_id long, turn long, role string, text string"


def trie_by_hand(sequences):
    """Nodes of {conv_id: [(role, text), ...]}, counted one by one."""
    members, ends = {}, {}
    for conv, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(conv)
        ends.setdefault(tuple(seq), []).append(conv)
    rows = set()
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        parents = {p[:-1] for p in members if p}
        saved = sum((len(members[p]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) for p in below if p)
        parent = min(members[path[:-1]]) if path else None
        children = sum(1 for p in below if len(p) == len(path) + 1)
        listed = ",".join(map(str, sorted(ends.get(path, []))))
        rows.add((min(convs), len(path), parent, len(convs), children, sum(1 for p in below if p not in parents), saved, h(listed)))
    return rows


def rebuilt_by_hand(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, seq in own.items():
        n, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -((-c) % 20))
        out[c] = own.get(base, [])[:n] + seq[n:]
    return out


def found_trie(frame):
    return {tuple(r) for r in frame.collect()}


def random_conversations(seed, n=120):
    draw = random.Random(seed)
    rows = []
    for c in range(-25, n):
        for t in range(draw.randint(1, 7)):
            # Other texts for other turns: equal times would leave the order to the digests.
            rows.append((c, None if t == 0 and draw.random() < 0.2 else t, draw.choice(["user", "user", None, "tool"]), draw.choice(["hi  there", "a b\tc", "", None])))
    return rows


def small_ranges(monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", turns)


@pytest.mark.parametrize("turns", [40, 10**6])
def test_trie_by_hand(spark, monkeypatch, turns):
    small_ranges(monkeypatch, turns)
    rows = random_conversations(1)
    convs = spark.createDataFrame(rows, TURNS)
    for clash in ("depth", "range", "path", "kind", "words", "n_convs"):
        convs = convs.withColumn(clash, F.lit("x"))
    frame = prefix_trie.conversation_trie(convs)
    nodes = found_trie(frame)
    wanted = trie_by_hand(rebuilt_by_hand(rows))
    assert nodes == wanted and frame.count() == len(wanted)


def test_trie_odd_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (7, 1, None, None), (7, 1, None, None), (7, None, "user", "first"), (40, 0, "user", "x " * 100_000), (41, 0, "", "")]
    convs = spark.createDataFrame(rows, TURNS)
    assert found_trie(prefix_trie.conversation_trie(convs)) == trie_by_hand(rebuilt_by_hand(rows))
    assert prefix_trie.conversation_trie(convs.limit(0)).count() == 0
    only_null = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    assert prefix_trie.conversation_trie(only_null).count() == 0


def test_conversations_without_turns(spark):
    # All turns of 60 are replaced by those of an absent conversation 60 - 60 % 20 only if it is absent: 61..79 have none.
    rows = [(c, 0, "user", "same") for c in range(61, 80)]
    wanted = trie_by_hand(rebuilt_by_hand(rows))
    assert any(d == 0 and n == 19 and e != h("") for _, d, _, n, _, _, _, e in wanted)
    assert found_trie(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS))) == wanted


def test_shared_and_copied_conversations_over_many_ranges(spark, monkeypatch):
    """Copies of one conversation and one first turn reach over most ranges; none has much more than its share."""
    small_ranges(monkeypatch, 100)
    rows = []
    for c in range(0, 20_000, 20):
        rows.append((c, 0, "system", "one and the same"))
        rows += [(c, 1, "user", "copied"), (c, 2, "assistant", "copied too")] if c % 3 else [(c, 1, "user", f"own {c}")]
    convs = spark.createDataFrame(rows, TURNS)
    assert found_trie(prefix_trie.conversation_trie(convs)) == trie_by_hand(rebuilt_by_hand(rows))
    scratch = prefix_trie.Scratch(spark, "test")
    sizes = [r["n"] for r in prefix_trie.in_ranges(prefix_trie.sequences(convs), scratch).groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 5 * sum(sizes) / len(sizes)


def test_long_conversations(spark, monkeypatch):
    """Longer than a panel of columns, equal up to their last turns."""
    small_ranges(monkeypatch, 500)
    rows = [(c, t, "user", f"turn {t}" if t < 200 - c else f"{c} {t}") for c in range(0, 120, 20) for t in range(200)]
    found = found_trie(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS)))
    assert found == trie_by_hand(rebuilt_by_hand(rows))


@pytest.mark.parametrize("panel", [1, 2, 64])
def test_sorted_rows_and_shared_turns(monkeypatch, panel):
    monkeypatch.setattr(prefix_trie, "PANEL", panel)
    draw = random.Random(panel)
    seqs = [[(draw.choice([-5, 3, 2**62]), draw.choice([0, 1])) for _ in range(draw.choice([0, 1, 2, 5, 9]))] for _ in range(300)]
    length = np.array([len(s) for s in seqs])
    path = np.array([x for s in seqs for t in s for x in t], dtype=np.int64)
    data = prefix_trie.Sorted(np.arange(300)[::-1].copy(), np.zeros(300, dtype=int), path, np.ones(len(path) // 2, dtype=int), length)
    order = sorted(range(300), key=lambda i: (seqs[i], 299 - i))
    assert data.conv.tolist() == [299 - i for i in order]
    for place, (i, j) in enumerate(zip(order, order[1:]), 1):
        same = 0
        while same < min(len(seqs[i]), len(seqs[j])) and seqs[i][same] == seqs[j][same]:
            same += 1
        assert data.lcp[place] == same


def test_end_lists_in_pieces(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    side = np.array([-1] + [0] * 10 + [1])
    data = prefix_trie.Sorted(np.arange(12), side, np.tile([4, 4], 12), np.ones(12, dtype=int), np.ones(12, dtype=int))
    kinds = [(c["kind"].tolist(), c["ends"].tolist()) for c in prefix_trie.nodes_of_range(data)]
    assert kinds == [(["part"], [None]), (["part"], [None]), (["ends"] * 4, ["1,2,3", "4,5,6", "7,8,9", "10"])]


# Merkle manifest.


def manifest_by_hand(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified per (doc_id, text, lang, source, n_chars)."""

    def digest(doc_id, text, lang, source, n_chars):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def tree(leaves):
        paths, level = [[] for _ in leaves], list(leaves)
        at = list(range(len(leaves)))
        while len(level) > 1:
            for p, i in zip(paths, at):
                lo = i // 8 * 8
                p.append(("".join(level[lo:i]), "".join(level[i + 1 : lo + 8])))
            level = [h("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
            at = [i // 8 for i in at]
        return level[0], paths

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    ordered = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in ordered:
        langs[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(*r)))
        trees[g] = tree([digest(*r) for r in langs[g]])
    root, above = tree([trees[g][0] for g in ordered]) if ordered else (None, [])
    out = []
    for g, up in zip(ordered, above):
        for r, path in zip(langs[g], trees[g][1]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            at = digest(r[0], r[1] if not tampered or r[1] is None else r[1].translate(low), *r[2:])
            for left, right in path + up:
                at = h(left + at + right)
            proof = h("".join(a + b for a, b in path + up))
            out.append((r[0], digest(*r), trees[g][0], root, proof, at, at == root))
    return sorted(out, key=repr)


def found_manifest(docs):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in merkle.document_proofs(docs).select(*columns).collect()), key=repr)


def as_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("rows,few", [(500_000, 10_000), (7, 0)])
def test_manifest_of_odd_rows(spark, monkeypatch, rows, few):
    monkeypatch.setattr(merkle, "RANGE_ROWS", rows)
    monkeypatch.setattr(merkle, "FEW_TARGETS", few)
    docs = odd_docs(spark)
    for clash in ("tree", "idx", "pay", "digest", "leaf", "root"):
        docs = docs.withColumn(clash, F.lit(1))
    assert found_manifest(docs) == manifest_by_hand(as_rows(docs))
    assert merkle.document_proofs(no_docs(spark)).count() == 0


@pytest.mark.parametrize("rows,few", [(500_000, 10_000), (50, 0)])
def test_manifest_of_uneven_groups(spark, monkeypatch, rows, few):
    """One language of 1,200 rows, one of 64, many of one row; a third of all rows are one row repeated."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", rows)
    monkeypatch.setattr(merkle, "FEW_TARGETS", few)
    docs = [(i % 700, f"Text {i % 700}", "en", "s", i) for i in range(600)] + [(5, "The Same", "en", "s", 1)] * 600
    docs += [(i, "UPPER" if i % 2 else "lower", "de", None, None) for i in range(64)]
    docs += [(i, f"É {i}", f"l{i}", "s", 2) for i in range(90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert found_manifest(frame) == manifest_by_hand(docs)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_manifest_of_one_group(spark, n):
    docs = [(i, f"T{i}", None, "s", 1) for i in range(n)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert found_manifest(frame) == manifest_by_hand(docs)


def test_levels_hold_every_node(spark):
    rows = spark.range(100).select(merkle.group_name(F.lit("a")).alias("tree"), F.col("id").alias("key"), merkle.row_digest(F.col("id")).alias("digest"), F.col("id").alias("pay"))
    made = merkle.manifest(rows, merkle.Scratch(spark, "test"))
    assert [level.count() for level in made.levels] == [13, 2, 1] and made.rows.count() == 100
    assert made.rows.where(F.size("segments") != 3).count() == 0
