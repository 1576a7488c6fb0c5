"""Byte-level BPE by merge replay over the distinct words of a corpus.

``encode`` splits every whole text into pre-tokens, keeps each distinct one of a block of
documents once, and replays the merges over all of them at the same time: an index from
token pair (by the rank of what it merges to) to the places where the pair stands is taken
in rank order, all places of a rank are merged, and only the pairs beside a merged place
are looked up and entered anew. ``decode`` turns ids back into bytes.

A document's ids do not depend on other documents, so nothing is shuffled: a block is what
a task reads, ``BLOCK_BYTES`` of text at a time, and words that earlier blocks of the
task have merged are kept up to ``KEEP_WORDS``. A lost task is only that task again.

Null and empty texts have no ids. Equal rows give equal rows; other columns of the
input, whatever their names, are not touched. A text of any length is split in steps, so that its
words are never all in memory as Python strings.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose words are merged together.
BLOCK_BYTES = 8 << 20
#: Distinct words that a task keeps from block to block.
KEEP_WORDS = 200_000
#: Words of one text that are held as strings at a time.
STEP = 1 << 18
#: Bytes of one returned Arrow batch, about.
BATCH_BYTES = 8 << 20


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces data[start : start + length], one after the other."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return data[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


class Flat:
    """Byte strings in one array."""

    def __init__(self, parts: list[bytes]) -> None:
        self.lengths = np.array([len(p) for p in parts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def take(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.data, self.starts[ids], self.lengths[ids])


class Ranks:
    """A rank file: tokens by rank, and every pair of tokens that merges to a token."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.size = len(tokens)
        self.tokens = Flat(tokens)
        self.decimals = Flat([b",%d" % i for i in range(self.size)])
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (self.rank[token[:cut]] * (self.size + 1) + self.rank[token[cut:]], rank)
            for token, rank in self.rank.items()
            for cut in range(1, len(token))
            if token[:cut] in self.rank and token[cut:] in self.rank
        ]
        table = np.array(sorted(pairs) or np.zeros((0, 2)), dtype=np.int64)
        self.pair, self.merged = np.append(table[:, 0], 1 << 62), np.append(table[:, 1], -1).astype(np.int32)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank that each pair merges to, or -1; ``size`` stands for no token."""
        keys = left.astype(np.int64) * (self.size + 1) + right
        at = np.searchsorted(self.pair, keys)
        return np.where(self.pair[at] == keys, self.merged[at], -1)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


def one_by_one(ranks: Ranks, word: bytes) -> list[int]:
    """The ids of one word: always the lowest rank, at its first place."""
    tokens = [int(t) for t in ranks.of_byte[np.frombuffer(word, dtype=np.uint8)]]
    text = [bytes([b]) for b in word]
    after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))

    def wanted(i: int) -> int | None:
        return ranks.rank.get(text[i] + text[after[i]]) if after[i] < len(tokens) else None

    heap = [(r, i) for i in range(len(tokens)) if (r := wanted(i)) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not text[i] or wanted(i) != r:
            continue
        j = after[i]
        text[i], text[j], tokens[i], after[i] = text[i] + text[j], b"", r, after[j]
        if after[i] < len(tokens):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (q := wanted(k)) is not None:
                heapq.heappush(heap, (q, k))
    return [t for t, piece in zip(tokens, text) if piece]


def replay(ranks: Ranks, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of ids of each word); no word is empty.

    The merges run over all words at once in the order of their ranks. Where a merge makes
    a pair of a lower rank than its own, that pair is taken next, as it would be in the
    word alone; if the merge had another place in that word in the same step, the word
    is done once more by itself, so the result is that of merging every word alone.
    """
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    token = ranks.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
    n = len(token)
    ends = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    # Places beside a word's ends point at the extra place n, which has no token.
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[ends - 1], before[ends - lengths] = n, n
    token = np.append(token, ranks.size).astype(np.int32)
    wanted = np.append(ranks.of_pairs(token[:-1], token[after[:-1]]), -1).astype(np.int32)
    alive = np.ones(n, dtype=bool)
    index: dict[int, list[np.ndarray]] = {}
    agenda: list[int] = []

    def enter(places: np.ndarray, at: np.ndarray) -> None:
        """Put places into the index under the ranks ``at``, which ascend."""
        cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
        first = [0, *cuts.tolist()]
        for lo, hi, r in zip(first, [*first[1:], len(at)], at[first].tolist()):
            if r in index:
                index[r].append(places[lo:hi])
            else:
                index[r] = [places[lo:hi]]
                heapq.heappush(agenda, r)

    open_places = np.flatnonzero(wanted >= 0).astype(np.int32)
    open_places = open_places[np.argsort(wanted[open_places], kind="stable")]
    if len(open_places):
        enter(open_places, wanted[open_places])
    redo: set[int] = set()
    while agenda:
        r = heapq.heappop(agenda)
        found = index.pop(r)
        left = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        left = left[wanted[left] == r]
        if not len(left):
            continue
        if len(found) == 1 and len(left) > 1:
            left = np.unique(left)
        right = after[left]
        if len(left) > 1 and (meets := left[1:] == right[:-1]).any():
            # In a run of overlapping places every second one is free when its turn comes.
            k = np.arange(len(left))
            start = np.maximum.accumulate(np.where(np.append(True, ~meets), k, 0))
            left = left[(k - start) % 2 == 0]
            right = after[left]
        beyond = after[right]
        token[left] = r
        after[left] = beyond
        before[beyond] = left
        alive[right] = False
        wanted[right] = -1
        prior = before[left]
        touched = np.concatenate([left, prior[prior != n]])
        now = ranks.of_pairs(token[touched], token[after[touched]])
        wanted[touched] = now
        open_ = now >= 0
        if open_.any():
            touched, now = touched[open_], now[open_]
            order = np.argsort(now, kind="stable")
            touched, now = touched[order], now[order]
            if now[0] < r:
                again, times = np.unique(word_of[left], return_counts=True)
                redo.update(np.intersect1d(again[times > 1], word_of[touched[now < r]]).tolist())
            enter(touched, now)
    ids, per_word = token[:-1][alive], np.add.reduceat(alive, ends - lengths) if n else np.zeros(0, dtype=np.int64)
    if redo:
        cut = np.split(ids, np.cumsum(per_word)[:-1])
        for w in redo:
            cut[w] = np.array(one_by_one(ranks, words[w]), dtype=np.int32)
        ids, per_word = np.concatenate(cut), np.array([len(c) for c in cut])
    return ids, per_word.astype(np.int64)


class Words:
    """The distinct words that a task has met and, once merged, their ids."""

    def __init__(self, ranks: Ranks, pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.clear()

    def clear(self) -> None:
        self.number = defaultdict(count().__next__)
        self.ids, self.starts, self.lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def numbers(self, text: str) -> np.ndarray:
        """The numbers of a text's words; new words get new ones."""
        if len(text) < STEP:
            found = self.pattern.findall(text)
            return np.fromiter(map(self.number.__getitem__, found), dtype=np.int32, count=len(found))
        parts = []
        matches = self.pattern.finditer(text)
        while step := [m.group() for m in islice(matches, STEP)]:
            parts.append(np.fromiter(map(self.number.__getitem__, step), dtype=np.int32, count=len(step)))
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)

    def merge_new(self) -> None:
        """Merge the words that have no ids yet. A word that is a token itself is that token."""
        new = [w.encode() for w in islice(self.number, len(self.starts), None)]
        whole = [self.ranks.rank.get(w, -1) for w in new]
        rest_ids, rest_lengths = replay(self.ranks, [w for w, r in zip(new, whole) if r < 0])
        direct = np.array(whole, dtype=np.int32)
        lengths = np.ones(len(new), dtype=np.int64)
        lengths[direct < 0] = rest_lengths
        ids = np.empty(int(lengths.sum()), dtype=np.int32)
        is_direct = np.repeat(direct >= 0, lengths)
        ids[is_direct], ids[~is_direct] = direct[direct >= 0], rest_ids
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, lengths])


def digest_of(ranks: Ranks, ids: np.ndarray) -> str:
    """SHA-256 of the decimal ids joined by commas."""
    sha = hashlib.sha256()
    for at in range(0, len(ids), STEP):
        text = ranks.decimals.take(ids[at : at + STEP])
        sha.update(text[1:] if at == 0 else text)
    return sha.hexdigest()


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, n_tokens, ids_sha256) of every document; ``ids`` are little-endian unsigned 32-bit.

    ``ranks`` is the path of a rank file on every executor, ``pattern`` the expression whose
    matches are encoded one by one, without special tokens. A null text counts as empty.
    """
    key_type = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_ranks(ranks)
        words = Words(table, pattern)

        def results(held: list) -> Iterator[pa.RecordBatch]:
            words.merge_new()
            keys, rows, size = [], [], 0
            for keyed, numbers in held:
                ids = gather(words.ids, words.starts[numbers], words.lengths[numbers])
                keys.append(keyed)
                rows.append((ids.astype("<u4").tobytes(), len(ids), digest_of(table, ids)))
                size += 4 * len(ids)
                if size >= BATCH_BYTES:
                    yield batch_of(keys, rows)
                    keys, rows, size = [], [], 0
            if keys:
                yield batch_of(keys, rows)
            if len(words.number) > KEEP_WORDS:
                words.clear()

        def batch_of(keys: list, rows: list) -> pa.RecordBatch:
            ids, n, sha = zip(*rows)
            columns = [pa.concat_arrays(keys), pa.array(ids, pa.binary()), pa.array(n, pa.int64()), pa.array(sha, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["key", "ids", "n_tokens", "ids_sha256"])

        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.column(1)[i].as_py() or ""
                held.append((batch.column(0).slice(i, 1), words.numbers(one)))
                size += len(one)
                if size >= BLOCK_BYTES:
                    yield from results(held)
                    held, size = [], 0
        yield from results(held)

    schema = f"key {key_type.simpleString()}, ids binary, n_tokens long, ids_sha256 string"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the bytes that their ids stand for in place of ``ids``.

    A null becomes no bytes. The bytes need not be a text in UTF-8 where ids were cut.
    """
    others = [c for c in encoded.columns if c != ids]
    schema = ", ".join([f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in others] + [f"`{out}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_ranks(ranks)
        for batch in batches:
            texts = []
            for value in batch.column(len(others)):
                tokens = np.frombuffer(value.as_py() or b"", dtype="<u4").astype(np.int64)
                texts.append(b"".join(table.tokens.take(tokens[at : at + STEP]).tobytes() for at in range(0, len(tokens), STEP)))
            columns = [*batch.columns[:-1], pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*others, out])

    return encoded.select(*others, ids).mapInArrow(run, schema)
